from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.operators import checks
from cohortlake.plans import higher_education as he
from cohortlake.session import scratch_mark
from cohortlake.plans.export import Exporter, ExportError, ExportTable, choose_base, read_exported, total_order
from cohortlake.plans.landing import Lake, Source
from cohortlake.plans.release import Publisher, check_problems, run_pipeline, source_problems
from cohortlake.sources.decoded import DecodeOptions

SCHEMA = "co_curso string, qt_ingressante bigint, tda double, extra string"


@pytest.fixture
def table(spark):
    data = [("0002", 120, 35.5, "x"), ("0001", 8, 1.0, 'a "q", b'), ("0003", None, 2.0, None)]
    return spark.createDataFrame(data, SCHEMA)


def test_export_suppresses_orders_and_repeats_its_bytes(spark, table, tmp_path):
    spec = ExportTable("t", base=("qt_ingressante",))
    first = Exporter(str(tmp_path / "out"), {"version": "v1"}).run([(spec, table)])
    again = Exporter(str(tmp_path / "out")).run([(spec, table.repartition(3))])
    entry = first["tables"][0]
    assert (entry["rows"], entry["suppressed_rows"]) == (1, 2)
    assert [f["sha256"] for f in entry["files"]] == [f["sha256"] for f in again["tables"][0]["files"]]
    for kinds in (("csv",), ("csv", "parquet")):
        spec = ExportTable("t", suppress=False, formats=kinds)
        manifest = Exporter(str(tmp_path / "open")).run([(spec, table)])
        back = read_exported(spark, manifest, "t", codes=("co_curso",)).orderBy("co_curso").collect()
        assert [tuple(r) for r in back] == sorted((tuple(r) for r in table.collect()), key=lambda r: r[0])


def test_export_refuses_leaks_before_writing(spark, tmp_path):
    leak = spark.createDataFrame([("a", 120, 9)], "co_curso string, qt_ingressante bigint, qt_desistencia bigint")
    good = ExportTable("good", base=("qt_ingressante",))
    with pytest.raises(ExportError, match="qt_desistencia"):
        Exporter(str(tmp_path / "out")).run([(good, leak.drop("qt_desistencia")), (ExportTable("leak"), leak)])
    assert not (tmp_path / "out").exists()


def test_base_column_rules():
    several = choose_base(ExportTable("t"), ["x", "qt_mat", "qt_ing"])
    assert (several.chosen, several.candidates, several.problem) == (("qt_ing",), ("qt_ing", "qt_mat"), None)
    named = choose_base(ExportTable("t", base=("x", "y")), ["x", "y", "qt_ing"])
    assert (named.chosen, named.candidates, named.problem) == (("x", "y"), ("qt_ing",), None)
    assert "no base column" in choose_base(ExportTable("t"), ["x"]).problem
    assert "['absent']" in choose_base(ExportTable("t", base=("absent", "x")), ["x"]).problem


@pytest.mark.parametrize("base", [(), ("absent",)])
def test_a_table_without_its_base_is_not_exported(spark, tmp_path, base):
    rows = spark.createDataFrame([("oak", 30)], "tree string, height bigint")
    with pytest.raises(ExportError, match="base column"):
        Exporter(str(tmp_path)).run([(ExportTable("t", base=base), rows)])
    done = Exporter(str(tmp_path)).run([(ExportTable("t", suppress=False), rows)])
    assert done["tables"][0]["base_columns"] == [] and done["tables"][0]["rows"] == 1


def test_total_order_of_rows_repeated_past_a_file(spark):
    """One row stands 500 times where a file takes 60; the order holds across files, nulls last."""
    data = [("oak", 7)] * 500 + [(f"t{i:03d}", i) for i in range(90)] + [(None, 1), ("elm", None)] * 3 + [("ash", 1)]
    df = spark.createDataFrame(data, "tree string, height int").repartition(7)
    got = total_order(df, ["tree"], len(data), rows_per_file=60)
    parts = [list(map(tuple, p)) for p in got.rdd.glom().collect()]
    flat = [r for p in parts for r in p]
    assert flat == sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0))
    assert max(map(len, parts)) <= 130 and sum(map(bool, parts)) >= 6
    one = total_order(df, ["height"], len(data)).collect()
    assert [tuple(r) for r in one] == sorted(data, key=lambda r: (r[1] is None, r[1] or 0, r[0] is None, r[0] or ""))


def test_publish_reject_rollback(spark, table, tmp_path):
    publisher = Publisher(Lake(spark, str(tmp_path)))
    assert publisher.rollback()["status"] == "noop"
    with pytest.raises(LookupError):
        publisher.read("t")
    for version in ("v1", "v2"):
        publisher.build(version, {"t": table.withColumn("v", F.lit(version))})
        publisher.publish(version, ["t"], [])
    assert publisher.publish("v3", ["t"], ["check: fail"])["kept"] == "v2"
    assert publisher.publish("v4", [], [])["reason"] == "empty candidate"
    assert publisher.read("t").first()["v"] == "v2"
    assert publisher.rollback() == {"status": "rolled_back", "from": "v2", "to": "v1"}
    assert publisher.read("t").first()["v"] == "v1"
    log = publisher.ops.read("publications").orderBy("published_at").collect()
    assert [r["status"] for r in log] == ["published", "published", "rejected", "rejected"]


def test_gates(spark):
    results = spark.createDataFrame(
        [("a", True, "success"), ("b", True, "failed"), ("c", False, "failed"), ("d", True, None)],
        "source string, required boolean, status string",
    )
    loaded = spark.createDataFrame(
        [("a", 5, ["x"]), ("b", 0, ["x"]), ("c", None, [])],
        "source string, rows bigint, missing_columns array<string>",
    )
    got = sorted(tuple(r) for r in source_problems(results, loaded).collect())
    assert got == [("a", "essential columns"), ("b", "empty table"), ("b", "load failed"), ("d", "no table")]
    outcomes = spark.createDataFrame([("pass",), ("warn",), ("skipped",), ("pass",)], "status string")
    effects = {r["status"]: (r["n"], r["effect"]) for r in check_problems(outcomes).collect()}
    assert effects == {"pass": (2, "pass"), "warn": (1, "warn"), "skipped": (1, "block")}


# ---- end to end on hand-made domain files -----------------------------------------------------

COURSES = [f"{i:07d}" for i in range(1, 41)]


def _trajectory(cohort: int, seed: int) -> tuple[str, list[dict]]:
    rng = random.Random(seed)
    facts = []
    for i, course in enumerate(COURSES):
        entrants = stayed = rng.randint(40, 120)
        base, completed, dropped = entrants, 0, 0
        for year in range(cohort, 2025):
            out = rng.randint(0, max(1, stayed // 5))
            done = rng.randint(0, (stayed - out) // 4) if year > cohort + 2 else 0
            dead = 1 if rng.random() < 0.05 and stayed > out + done else 0
            stayed -= out + done + dead
            base -= dead
            completed += done
            dropped += out
            facts.append(
                {
                    "CO_IES": f"{i % 3:04d}", "NO_IES": f"IES {i % 3}", "CO_CURSO": course,
                    "TP_CATEGORIA_ADMINISTRATIVA": 1 + i % 5, "TP_ORGANIZACAO_ACADEMICA": 1,
                    "NO_CURSO": f"Curso {i}", "CO_UF": 51, "CO_MUNICIPIO": 100 + i % 2,
                    "TP_GRAU_ACADEMICO": 1 + i % 2, "TP_MODALIDADE_ENSINO": 1 + i % 2,
                    "CO_CINE_ROTULO": "r", "NO_CINE_ROTULO": "Rotulo", "CO_CINE_AREA_GERAL": "01",
                    "NO_CINE_AREA_GERAL": "" if i == 0 else "Saúde", "NU_ANO_INGRESSO": cohort,
                    "NU_ANO_REFERENCIA": year, "NU_PRAZO_INTEGRALIZACAO": 4,
                    "NU_ANO_INTEGRALIZACAO": cohort + 3, "NU_PRAZO_ACOMPANHAMENTO": 8,
                    "NU_ANO_MAXIMO_ACOMPANHAMENTO": 2024, "QT_INGRESSANTE": entrants,
                    "QT_PERMANENCIA": stayed, "QT_CONCLUINTE": done, "QT_DESISTENCIA": out,
                    "QT_FALECIDO": dead, "TAP": f"{100 * stayed / base:.6f}".replace(".", ","),
                    "TCA": f"{100 * completed / base:.6f}", "TDA": f"{100 * dropped / base:.6f}",
                    "TCAN": "0", "TADA": "0",
                }
            )
    return _csv(facts), facts


def _csv(rows: list[dict]) -> str:
    lines = [";".join(rows[0])] + [";".join(str(v) for v in r.values()) for r in rows]
    return "\n".join(lines) + "\n"


def _census(year: int) -> str:
    rng = random.Random(year)
    rows = []
    for i, course in enumerate(COURSES):
        for place in (100, 101)[: 1 + i % 2]:
            enrolled = rng.randint(30, 200)
            row = {
                "NU_ANO_CENSO": year, "SG_UF": "MT", "CO_MUNICIPIO": place, "NO_MUNICIPIO": "M",
                "TP_REDE": 1 + i % 2, "TP_CATEGORIA_ADMINISTRATIVA": 1, "CO_IES": "1",
                "NO_CURSO": f"Curso {i}", "CO_CURSO": course, "CO_CINE_AREA_GERAL": "01",
                "NO_CINE_AREA_GERAL": "Saúde", "TP_GRAU_ACADEMICO": 1 + i % 2,
                "TP_MODALIDADE_ENSINO": 1 + i % 2, "TP_NIVEL_ACADEMICO": 1, "QT_VG_TOTAL": 50,
                "QT_INSCRITO_TOTAL": 99, "QT_ING": rng.randint(10, 40), "QT_MAT": enrolled,
                "QT_CONC": 5,
            }
            for name in (
                "SIT_TRANCADA SIT_DESVINCULADO SIT_TRANSFERIDO SIT_FALECIDO ING_FIES ING_PROUNII "
                "ING_PROUNIP MAT_FIES MAT_PROUNII MAT_PROUNIP MAT_PROCESCPUBLICA "
                "MAT_PROCESCPRIVADA MAT_RESERVA_VAGA MAT_APOIO_SOCIAL MAT_NOTURNO MAT_PRETA "
                "MAT_PARDA MAT_INDIGENA MAT_CORND"
            ).split():
                row[f"QT_{name}"] = rng.randint(0, 9)
            rows.append(row)
    return _csv(rows)


def _scores(edition: int) -> str:
    rng = random.Random(edition)
    rows = [
        {
            "Ano": edition, "Código do Curso": c, "Código da IES": 1, "Código da Área": 2,
            "Área de Avaliação": "A", "Sigla da UF": "MT", "Nº de Concluintes Inscritos": 30,
            "Nº  de Concluintes Participantes": 25,
            **{
                h: f"{rng.uniform(0, 5):.3f}".replace(".", ",")
                for h in (
                    "Conceito Enade (Contínuo)", "Nota Padronizada - IDD",
                    "Nota Padronizada - Doutores", "Nota Padronizada - Regime de Trabalho",
                    "Nota Padronizada - Infraestrutura e Instalações Físicas",
                    "Nota Padronizada - Organização Didático-Pedagógica", "CPC (Contínuo)",
                )
            },
            "CPC (Faixa)": rng.choice(["1", "3", "5", "sc"]),
        }
        for i, c in enumerate(COURSES)
        if (i + edition) % 2
    ]
    return _csv(rows)


EXAM = "Ano;Código do Curso;Área de Avaliação;Concluintes Participantes;Total Proficientes;Percentual Proficientes;Conceito (Faixa)\n" + "".join(
    f"2025;{c};Letras;{n};{p};{str(round(p / n, 4)).replace('.', ',')};3\n"
    for c, (n, p) in zip(COURSES[1::2], [(30, 21), (25, 10), (12, 9), (8, 8)] * 5, strict=True)
)
PEOPLE = "co_municipio,no_municipio,nu_ano,co_idade,idade,qt_populacao\n" + "".join(
    f"{m},M{m},2022,{a},{a} anos,{q}\n" for m, q in ((100, 500), (101, 300), (102, 50)) for a in (18, 19)
)


def test_pipeline_from_files_to_exports(spark, tmp_path):
    landing = tmp_path / "landing"
    names = ("trajectory", "census", "scores", "exam", "population", "institutions", "institution_scores")
    for name in names:
        (landing / name).mkdir(parents=True)
    facts = []
    for cohort in (2019, 2020):
        text, rows = _trajectory(cohort, cohort)
        (landing / "trajectory" / f"t{cohort}.csv").write_bytes(text.encode("cp1252"))
        facts += rows
    for year in (2021, 2023):
        (landing / "census" / f"c{year}.csv").write_bytes(_census(year).encode("cp1252"))
    for edition in (2021, 2022):
        (landing / "scores" / f"s{edition}.csv").write_text(_scores(edition))
    (landing / "exam" / "e.csv").write_text(EXAM)
    (landing / "population" / "p.csv").write_text(PEOPLE)
    (landing / "institutions" / "i.csv").write_text("NU_ANO_CENSO;CO_IES;NO_IES;SG_IES;SG_UF_IES;CO_MUNICIPIO_IES;TP_CATEGORIA_ADMINISTRATIVA;TP_ORGANIZACAO_ACADEMICA\n"
        "2021;1;Uni;U;MT;100;1;1\n2023;1;Uni;U;MT;100;1;1\n")
    (landing / "institution_scores" / "g.csv").write_text(
        "Ano,Código da IES,Nome da IES,Sigla da UF,IGC (Contínuo),IGC (Faixa)\n2022,1,Uni,MT,3.25,4\n2022,2,Other,SP,,sc\n"
    )
    versions = {"trajectory": "nu_ano_ingresso", "census": "nu_ano_censo", "institutions": "nu_ano_censo", "scores": "ano", "institution_scores": "ano"}
    need = {"trajectory": ("co_curso", "qt_ingressante"), "census": ("co_curso",), "scores": ("codigo_do_curso",)}
    sources = [
        Source(n, str(landing / n), required=n in need, essential=need.get(n, ()), partition=versions.get(n))
        for n in names
    ]
    lake = Lake(spark, str(tmp_path / "lake"))
    silver: dict = {}

    def build(lake):
        silver["s"] = he.build_silver({s.name: lake.latest(s) if s.partition else lake.bronze(s) for s in sources})
        return he.build_gold(silver["s"], lake.ops)

    def tests(tables):
        return he.silver_tests(silver["s"]).unionByName(he.gold_tests(tables))

    def export(tables, version):
        pairs = [(spec, tables[spec.name]) for spec in he.exports()]
        return Exporter(str(tmp_path / "out"), {"version": version}).run(pairs)

    summary = run_pipeline(lake, sources, build, tests, export, keep_shared=True)
    assert summary["publication"]["status"] == "published", summary["publication"]
    assert {c["status"] for c in summary["checks"]} == {"pass"} and len(summary["checks"]) > 60
    sizes = {t["table"]: t["rows"] for t in summary["export"]["tables"]}
    assert set(sizes) == set(he.KEYS) and all(sizes.values()), sizes

    publisher = Publisher(lake)
    curve = {
        (r["modalidade"], r["nu_ano_ingresso"], r["nu_ano_referencia"]): r
        for r in publisher.read("p1_trajetoria_coorte").collect()
    }
    for mode, label in ((1, "Presencial"), (2, "EAD")):
        mine = [f for f in facts if f["TP_MODALIDADE_ENSINO"] == mode and f["NU_ANO_INGRESSO"] == 2019]
        upto = [f for f in mine if f["NU_ANO_REFERENCIA"] <= 2022]
        entered = sum(f["QT_INGRESSANTE"] for f in mine if f["NU_ANO_REFERENCIA"] == 2022)
        base = entered - sum(f["QT_FALECIDO"] for f in upto)
        row = curve[label, 2019, 2022]
        assert row["qt_ingressante"] == entered and row["nu_cursos"] == 20
        assert row["taxa_desistencia_acum"] == pytest.approx(
            100 * sum(f["QT_DESISTENCIA"] for f in upto) / base, abs=0.005001
        )
    record, files = publisher.release()
    assert record.first()["version"] == summary["version"] and files.count() == 10
    funnel = {r["rede"]: r for r in publisher.read("p5_funil_licenciaturas").collect()}
    assert set(funnel) == {"Pública", "Privada", "Total"}
    assert funnel["Total"]["nu_cursos_enade"] == 20
    assert funnel["Total"]["pct_proficiente"] == round(100 * 5 * 48 / (5 * 75), 2)
    desert = {r["co_municipio"]: r for r in publisher.read("b1_desertos_municipio").collect()}
    assert desert["102"]["is_deserto"] and desert["100"]["nu_populacao_18_24"] == 1000
    assert desert["100"]["nu_vagas_presenciais"] == 50 * 20 and desert["100"]["nu_ano_censo"] == 2023
    assert {r["fator"] for r in publisher.read("p4_fatores").collect()} == {*he.SCORE_FACTORS, "Rede privada"}
    assert publisher.read("s1_fator_social_desistencia").count() == 6 * 4
    assert publisher.read("b2_financiamento_desistencia").count() == 4
    assert publisher.read("p2_desistencia_area").where("no_cine_area_geral = 'Não informada'").count() > 0

    control = {r["fonte"]: r for r in publisher.read("controle_atualizacao").collect()}
    assert set(control) == set(names) and control["census"]["linhas_disponiveis"] > 0
    assert {(r["co_ies"], str(r["igc_faixa"])) for r in silver["s"].institution_scores.collect()} == {("1", "4"), ("2", "SC")}
    found = {c["check"] for c in summary["checks"]}
    assert {"scores.grain", "institutions.grain", "institution_scores.igc_faixa.accepted", "latest_scores.grain"} <= found
    joined = he.top_institutions(silver["s"].census, silver["s"].institutions, {"fies": "qt_mat_fies"}, "fies")
    assert {r["ies"] for r in joined.collect()} == {"Uni"}

    census = silver["s"].census
    institutions = spark.createDataFrame([("1", 2021, "Uni")], "co_ies string, nu_ano_censo int, no_ies string")
    years = {r["nu_ano_censo"]: r for r in he.funding_diagnostics(census).collect()}
    assert set(years) == set() or all(r["cursos_sem_fies"] == 0 for r in years.values())
    top = he.top_institutions(census, institutions, {"fies": "qt_mat_fies"}, "fies").collect()
    assert {(r["nu_ano_censo"], r["ies"], r["position"]) for r in top} == {(2021, "Uni", 1), (2023, "1", 1)}
    place = he.courses_of_place(census, institutions, "m%").collect()
    assert len(place) == 10 and {r["nu_ano_censo"] for r in place} == {2023}

    # A republished cohort with an unreadable count is landed, but stops at the tests.
    text, _ = _trajectory(2020, 99)
    lines = text.splitlines()
    at = lines[0].split(";").index("QT_INGRESSANTE")
    broken = lines[1].split(";")
    broken[at] = "abc"
    (landing / "trajectory" / "again.csv").write_text("\n".join([lines[0], ";".join(broken), *lines[2:]]) + "\n")
    before = publisher.pointer()
    mark = scratch_mark(spark)
    second = run_pipeline(lake, sources, build, tests, export)
    assert scratch_mark(spark) == mark
    assert second["publication"]["status"] == "rejected"
    assert "trajectory.qt_ingressante.not_null: fail" in second["publication"]["reason"]
    assert publisher.pointer() == before

    control = he.refresh_control(
        lake.ops.read("ingestion_runs"), lake.ops.read("file_manifest"), F.current_timestamp()
    )
    contract = T.StructType.fromDDL(he.CONTROL_CONTRACT)
    assert checks.schema_differences(control, contract) == []
    held = {r["fonte"]: r for r in control.collect()}
    assert held["trajectory"]["nu_arquivos_carregados"] == 3 and held["census"]["linhas_ultima_execucao"] == 0
    assert held["exam"]["ultimo_status"] == "success" and held["exam"]["linhas_disponiveis"] == 20


def test_missing_optional_relations_and_unknown_exam_layout(spark):
    bronze = spark.createDataFrame([("1", "x")], "codigo_do_curso string, outra string")
    with pytest.raises(Exception, match="proficiency"):
        he.exam_results(bronze)
