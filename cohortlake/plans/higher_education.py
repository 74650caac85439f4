"""Typed relations and published tables of the higher-education cohort domain.

Column names, labels and codes below are the public contract of these tables: fixed values.
Every function takes DataFrames and returns one; the arithmetic is in ``cohortlake.operators``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import measures as m
from cohortlake.functions import text as t
from cohortlake.operators import checks, cohorts, consume, dsl, profiles
from cohortlake.operators.latest import latest_partition, latest_per_key
from cohortlake.plans.export import ExportTable
from cohortlake.plans.ops import Ops
from cohortlake.plans.release import ZONE, freshness
from cohortlake.session import all_together, cut_lineage

MILESTONE = 4
SCORE_EDITIONS = (2021, 2022, 2023)
PUBLIC, PRIVATE = "Pública", "Privada"
NETWORK_OF_CATEGORY = {1: PUBLIC, 2: PUBLIC, 3: PUBLIC, 7: PUBLIC, 4: PRIVATE, 5: PRIVATE, 6: PRIVATE}
NETWORKS = {1: PUBLIC, 2: PRIVATE}
MODES = {1: "Presencial", 2: "EAD"}
DEGREES = {
    1: "Bacharelado",
    2: "Licenciatura",
    3: "Tecnológico",
    4: "Bacharelado e Licenciatura",
}

FLOW = cohorts.Flow(
    entity="co_curso",
    cohort="nu_ano_ingresso",
    reference="nu_ano_referencia",
    step="nu_ano_curso",
    entrants="qt_ingressante",
    stayed="qt_permanencia",
    completed="qt_concluinte",
    dropped="qt_desistencia",
    excluded="qt_falecido",
    suffix="_acum",
    base="qt_base_acum",
    last="nu_ultimo_ano_observado",
)

# Landed column -> kind, for columns that keep their name.
TRAJECTORY_COLUMNS = {
    "text": "co_curso co_ies no_ies no_curso co_municipio co_cine_rotulo no_cine_rotulo "
    "co_cine_area_geral no_cine_area_geral",
    "int": "co_uf tp_categoria_administrativa tp_organizacao_academica tp_grau_academico "
    "tp_modalidade_ensino nu_ano_ingresso nu_ano_referencia nu_prazo_integralizacao "
    "nu_ano_integralizacao nu_prazo_acompanhamento nu_ano_maximo_acompanhamento",
    "bigint": "qt_ingressante qt_permanencia qt_concluinte qt_desistencia qt_falecido",
    "numeric": "tap tca tda tcan tada",
}
CENSUS_COLUMNS = {
    "text": "co_curso co_ies no_curso co_municipio no_municipio sg_uf co_cine_area_geral "
    "no_cine_area_geral",
    "int": "nu_ano_censo tp_rede tp_categoria_administrativa tp_modalidade_ensino "
    "tp_nivel_academico tp_grau_academico",
    "bigint": "qt_ing qt_mat qt_conc qt_sit_trancada qt_sit_desvinculado qt_sit_transferido "
    "qt_sit_falecido qt_ing_fies qt_mat_fies qt_mat_reserva_vaga qt_mat_apoio_social "
    "qt_mat_noturno",
}
# Published name -> landed name, all counts.
CENSUS_RENAMED = {
    "nu_vagas": "qt_vg_total",
    "qt_inscrito": "qt_inscrito_total",
    "qt_ing_prouni_integral": "qt_ing_prounii",
    "qt_ing_prouni_parcial": "qt_ing_prounip",
    "qt_mat_prouni_integral": "qt_mat_prounii",
    "qt_mat_prouni_parcial": "qt_mat_prounip",
    "qt_mat_escola_publica": "qt_mat_procescpublica",
    "qt_mat_escola_privada": "qt_mat_procescprivada",
}
INSTITUTION_COLUMNS = {
    "text": "co_ies no_ies sg_ies sg_uf_ies co_municipio_ies",
    "int": "nu_ano_censo tp_categoria_administrativa tp_organizacao_academica",
}
INSTITUTION_SCHEMA = (
    "co_ies string, no_ies string, sg_ies string, sg_uf_ies string, co_municipio_ies string, "
    "nu_ano_censo int, tp_categoria_administrativa int, tp_organizacao_academica int"
)
INSTITUTION_SCORE_SCHEMA = (
    "nu_edicao int, co_ies string, no_ies string, sg_uf string, igc_continuo decimal(38,10), igc_faixa string"
)
# Codes of the federal states.
STATES = (
    "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO"
).split()
SCORE_RENAMED = {
    "co_curso": ("codigo_do_curso", "text"),
    "co_ies": ("codigo_da_ies", "text"),
    "co_area_avaliacao": ("codigo_da_area", "text"),
    "area_avaliacao": ("area_de_avaliacao", "text"),
    "sg_uf": ("sigla_da_uf", "text"),
    "qt_concluinte_inscrito": ("no_de_concluintes_inscritos", "bigint"),
    "qt_concluinte_participante": ("no_de_concluintes_participantes", "bigint"),
    "enade_continuo": ("conceito_enade_continuo", "numeric"),
    "idd_padronizado": ("nota_padronizada_idd", "numeric"),
    "doutores_padronizado": ("nota_padronizada_doutores", "numeric"),
    "regime_trabalho_padronizado": ("nota_padronizada_regime_de_trabalho", "numeric"),
    "infraestrutura_padronizado": (
        "nota_padronizada_infraestrutura_e_instalacoes_fisicas",
        "numeric",
    ),
    "didatico_pedagogica_padronizado": (
        "nota_padronizada_organizacao_didatico_pedagogica",
        "numeric",
    ),
    "cpc_continuo": ("cpc_continuo", "numeric"),
}
# Published name -> patterns of the landed name (best first) and kind.
EXAM_PATTERNS = {
    "nu_edicao": (("^ano$", "^nu_ano"), "int"),
    "co_curso": (("^codigo_do_curso$", "^co_curso$", "codigo.*curso"), "text"),
    "co_ies": (("^codigo_da_ies$", "^co_ies$", "codigo.*ies"), "text"),
    "area_avaliacao": (("^area_de_avaliacao$", "area.*avaliacao", "^no_area"), "text"),
    "qt_concluinte_inscrito": (("concluintes_inscritos", "inscritos"), "bigint"),
    "qt_concluinte_participante": (
        ("concluintes_participantes$", "participantes$", "participantes"),
        "bigint",
    ),
    "proficiencia": (
        (
            "(percentual|proporcao|perc|taxa).*profici",
            "profici.*(percentual|proporcao|perc|taxa)",
            "profici",
        ),
        "numeric",
    ),
    "qt_concluinte_proficiente": (("^(total|quantidade|qt|numero|no)_.*profici",), "bigint"),
    "conceito_faixa": (("conceito.*faixa", "faixa"), "text"),
    "conceito_continuo": (("conceito.*continuo", "continuo"), "numeric"),
}
EXAM_REQUIRED = {"co_curso": "course", "proficiencia": "proficiency"}
POPULATION_SCHEMA = (
    "co_municipio string, no_municipio string, co_idade string, idade string, nu_ano int, "
    "nu_populacao bigint"
)
POPULATION_COLUMNS = {"text": "co_municipio no_municipio co_idade idade", "int": "nu_ano"}

COURSE_ATTRIBUTES = [
    "no_curso",
    "no_ies",
    "rede",
    "modalidade",
    "tp_grau_academico",
    "grau_academico",
    "no_cine_area_geral",
    "no_cine_rotulo",
]
SCORE_FACTORS = {
    "CPC contínuo": "cpc_continuo",
    "Enade contínuo": "enade_continuo",
    "IDD": "idd_padronizado",
    "Doutores": "doutores_padronizado",
    "Regime de trabalho": "regime_trabalho_padronizado",
    "Infraestrutura": "infraestrutura_padronizado",
    "Organização didático-pedagógica": "didatico_pedagogica_padronizado",
}
# Working name of the operators -> published name.
PUBLISHED = {
    "qt_desistencia_step": "qt_desistencia_marco",
    "qt_concluinte_step": "qt_concluinte_marco",
    "qt_base_step": "qt_base_marco",
    "has_step": "tem_marco",
    "nu_entities": "nu_cursos",
    "nu_cohorts": "nu_coortes",
    "first_cohort": "nu_primeira_coorte",
    "last_cohort": "nu_ultima_coorte",
    "milestone_step": "nu_ano_curso_marco",
    "drop_rate_step": "taxa_desistencia_marco",
    "completion_rate_step": "taxa_conclusao_marco",
    "drop_rate_final": "taxa_desistencia_final",
    "completion_rate_final": "taxa_conclusao_final",
    "is_ranking_eligible": "is_elegivel_ranking",
    "drop_rate": "taxa_desistencia_acum",
    "completion_rate": "taxa_conclusao_acum",
    "stay_rate": "taxa_permanencia",
    "yearly_drop_rate": "taxa_desistencia_ano",
    "drop_rate_of_active": "taxa_desistencia_sobre_ativos",
    "is_worst_year": "is_ano_maior_perda",
    "qt_linked": "qt_vinculo",
    "churn_rate": "taxa_evasao_anual",
    "pause_rate": "taxa_trancamento",
    "churn_change_pp": "variacao_evasao_pp",
    "enrolled_change_pct": "variacao_matricula_pct",
    "factor": "fator",
    "pearson": "correlacao_pearson",
    "quartile": "quartil",
}


def published(df: DataFrame, extra: Mapping[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({**PUBLISHED, **(extra or {})})


# ---- typed relations -------------------------------------------------------------------------


def _typed(columns: Mapping[str, str]) -> list[Column]:
    return [t.typed_column(c, kind).alias(c) for kind, names in columns.items() for c in names.split()]


def _number(name: str) -> Column:
    return t.to_int(F.col(name))


def trajectory(bronze: DataFrame) -> DataFrame:
    """Course x entry cohort x reference year, newest file of each cohort."""
    reference, cohort = _number("nu_ano_referencia"), _number("nu_ano_ingresso")
    return latest_partition(bronze, "nu_ano_ingresso").select(
        *_typed(TRAJECTORY_COLUMNS),
        t.code_label(_number("tp_categoria_administrativa"), NETWORK_OF_CATEGORY).alias("rede"),
        t.code_label(_number("tp_grau_academico"), DEGREES).alias("grau_academico"),
        t.code_label(_number("tp_modalidade_ensino"), MODES).alias("modalidade"),
        (reference - cohort + 1).cast("int").alias("nu_ano_curso"),
        F.col("_source_file").alias("arquivo_origem"),
        F.col("_ingested_at").alias("carregado_em"),
    )


def census_courses(bronze: DataFrame) -> DataFrame:
    """Census year x course x municipality, newest file of each year."""
    some = [_number(f"qt_mat_{group}") for group in ("preta", "parda", "indigena")]
    return latest_partition(bronze, "nu_ano_censo").select(
        *_typed(CENSUS_COLUMNS),
        *[t.typed_column(landed, "bigint").alias(name) for name, landed in CENSUS_RENAMED.items()],
        t.code_label(_number("tp_rede"), NETWORKS).alias("rede"),
        t.code_label(_number("tp_modalidade_ensino"), MODES).alias("modalidade"),
        m.zero_sum(*some).alias("qt_mat_ppi"),
        (_number("qt_mat") - m.zero_sum(_number("qt_mat_cornd"))).alias("qt_mat_cor_declarada"),
        F.col("_source_file").alias("arquivo_origem"),
    )


def census_institutions(bronze: DataFrame) -> DataFrame:
    return latest_partition(bronze, "nu_ano_censo").select(*_typed(INSTITUTION_COLUMNS))


def course_scores(bronze: DataFrame) -> DataFrame:
    """Edition x course with its continuous scores and its band."""
    return latest_partition(bronze, "ano").select(
        _number("ano").cast("int").alias("nu_edicao"),
        *[t.typed_column(landed, kind).alias(n) for n, (landed, kind) in SCORE_RENAMED.items()],
        t.score_band(F.col("cpc_faixa")).alias("cpc_faixa"),
    )


def institution_scores(bronze: DataFrame) -> DataFrame:
    return latest_partition(bronze, "ano").select(
        _number("ano").cast("int").alias("nu_edicao"),
        t.clean_text(F.col("codigo_da_ies")).alias("co_ies"),
        t.clean_text(F.col("nome_da_ies")).alias("no_ies"),
        t.clean_text(F.col("sigla_da_uf")).alias("sg_uf"),
        t.to_numeric(F.col("igc_continuo"), "auto").alias("igc_continuo"),
        t.score_band(F.col("igc_faixa")).alias("igc_faixa"),
    )


EXAM_KINDS = {
    "nu_edicao": "int",
    "co_curso": "string",
    "co_ies": "string",
    "area_avaliacao": "string",
    "qt_concluinte_inscrito": "bigint",
    "qt_concluinte_participante": "bigint",
    "qt_concluinte_proficiente": "bigint",
    "pct_proficiente": "decimal(38,10)",
    "conceito_faixa": "string",
    "conceito_continuo": "decimal(38,10)",
}
EXAM_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in EXAM_KINDS.items())


def exam_results(bronze: DataFrame) -> DataFrame:
    """Exam result per course; its columns are found by pattern and its percentage scale repaired."""
    found = {
        name: dsl.require_column(bronze.columns, patterns, EXAM_REQUIRED[name])
        if name in EXAM_REQUIRED
        else dsl.pick_column(bronze.columns, patterns)
        for name, (patterns, _) in EXAM_PATTERNS.items()
    }
    rows = bronze if found["nu_edicao"] is None else latest_partition(bronze, found["nu_edicao"])
    typed = rows.select(
        *[t.typed_column(found[n], kind).alias(n) for n, (_, kind) in EXAM_PATTERNS.items()]
    ).where("co_curso is not null")
    repaired = profiles.repair_scale(typed, "proficiencia", "pct_proficiente")
    return repaired.select(*[F.col(c).cast(kind).alias(c) for c, kind in EXAM_KINDS.items()])


def population(bronze: DataFrame) -> DataFrame:
    people = _number("qt_populacao")
    return bronze.where(people.isNotNull()).select(
        *_typed(POPULATION_COLUMNS), people.alias("nu_populacao")
    )


# ---- silver ----------------------------------------------------------------------------------


def accumulated(typed: DataFrame) -> DataFrame:
    return cohorts.accumulate(typed, FLOW)


def milestone(acc: DataFrame) -> DataFrame:
    return cohorts.milestone(acc, COURSE_ATTRIBUTES, MILESTONE, FLOW)


def census_course_year(census: DataFrame) -> DataFrame:
    """Municipalities summed to one row per year and undergraduate course."""
    counts = [
        "nu_vagas", "qt_ing", "qt_mat", "qt_conc", "qt_sit_trancada", "qt_sit_desvinculado",
        "qt_sit_transferido", "qt_sit_falecido", "qt_ing_fies", "qt_mat_fies",
        "qt_mat_escola_publica", "qt_mat_escola_privada", "qt_mat_reserva_vaga",
        "qt_mat_apoio_social", "qt_mat_noturno", "qt_mat_ppi", "qt_mat_cor_declarada",
    ]
    grants = {
        f"{c}_prouni": m.zero_sum(F.col(f"{c}_prouni_integral"), F.col(f"{c}_prouni_parcial"))
        for c in ("qt_ing", "qt_mat")
    }
    attributes = [
        "co_ies", "no_curso", "tp_rede", "rede", "tp_modalidade_ensino", "modalidade",
        "tp_grau_academico", "no_cine_area_geral",
    ]
    return cohorts.entity_year(
        census.where("tp_nivel_academico = 1"),
        ["nu_ano_censo", "co_curso"],
        attributes,
        {**{c: c for c in counts}, **grants},
        rows="nu_municipios_oferta",
    )


def latest_score(scores: DataFrame) -> DataFrame:
    keep = ["nu_edicao", "area_avaliacao", "cpc_faixa", *SCORE_FACTORS.values()]
    allowed = scores.where(F.col("nu_edicao").isin(*SCORE_EDITIONS))
    newest = latest_per_key(allowed, ["co_curso"], [F.col("nu_edicao")], keep)
    return newest.withColumnRenamed("nu_edicao", "nu_edicao_cpc")


def course_outcome(snapshot: DataFrame, scores: DataFrame) -> DataFrame:
    return profiles.entity_outcome(
        snapshot,
        "co_curso",
        COURSE_ATTRIBUTES[:-1],
        "nu_ano_ingresso",
        ["qt_ingressante", "qt_desistencia_step", "qt_base_step", "qt_base_final",
         "qt_concluinte_final", "qt_desistencia_final"],
        latest_score(scores).drop("area_avaliacao"),
        "tem_cpc",
        dropped="qt_desistencia_step",
    )


def course_totals(course_year: DataFrame) -> DataFrame:
    """All census years of a course summed."""
    counts = [
        "qt_mat", "qt_mat_escola_publica", "qt_mat_escola_privada", "qt_mat_reserva_vaga",
        "qt_mat_apoio_social", "qt_mat_noturno", "qt_mat_ppi", "qt_mat_cor_declarada",
    ]
    funded = m.zero_sum(F.col("qt_mat_fies"), F.col("qt_mat_prouni"))
    return course_year.groupBy("co_curso").agg(
        *[F.sum(c).alias(c) for c in counts], F.sum(funded).alias("qt_mat_financiada")
    )


def social_profile(course_year: DataFrame) -> DataFrame:
    c = F.col
    schools = c("qt_mat_escola_publica") + c("qt_mat_escola_privada")
    return profiles.factor_shares(
        course_totals(course_year),
        "co_curso",
        {
            "Escola pública no ensino médio": (c("qt_mat_escola_publica"), schools),
            "Reserva de vagas (cotas)": (c("qt_mat_reserva_vaga"), c("qt_mat")),
            "Apoio social": (c("qt_mat_apoio_social"), c("qt_mat")),
            "Turno noturno": (c("qt_mat_noturno"), c("qt_mat")),
            "FIES ou ProUni": (c("qt_mat_financiada"), c("qt_mat")),
            "Pretos, pardos e indígenas": (c("qt_mat_ppi"), c("qt_mat_cor_declarada")),
        },
    )


# ---- published tables ------------------------------------------------------------------------

_COUNTS = ("qt_ingressante", "qt_desistencia_step", "qt_base_step")
_EXAM = {
    "taking": "qt_concluinte_participante",
    "proficient": "qt_concluinte_proficiente",
    "pct": "pct_proficiente",
}
_FINAL = {
    "entrants": "qt_ingressante",
    "dropped": "qt_desistencia_final",
    "completed": "qt_concluinte_final",
}


def cohort_curve(acc: DataFrame) -> DataFrame:
    yearly = {"qt_concluinte": "qt_concluinte_ano", "qt_desistencia": "qt_desistencia_ano"}
    return published(cohorts.curve(acc, "modalidade", FLOW), yearly)


def course_milestone(snapshot: DataFrame) -> DataFrame:
    attributes = [a for a in COURSE_ATTRIBUTES if a != "tp_grau_academico"]
    return published(cohorts.milestone_report(snapshot, attributes, MILESTONE, FLOW))


def area_curve(acc: DataFrame) -> DataFrame:
    rows = cohorts.area_curve(acc, "no_cine_area_geral", "modalidade", "Não informada", FLOW)
    return published(rows)


def yearly_churn(course_year: DataFrame) -> DataFrame:
    named = course_year.withColumnsRenamed(
        {
            "qt_ing": "qt_ingressante",
            "qt_mat": "qt_matricula",
            "qt_conc": "qt_concluinte",
            "qt_sit_trancada": "qt_trancada",
            "qt_sit_desvinculado": "qt_desvinculado",
            "qt_sit_transferido": "qt_transferido",
            "qt_sit_falecido": "qt_falecido",
        }
    )
    rows = cohorts.yearly_churn(
        named,
        "nu_ano_censo",
        ["rede", "modalidade"],
        left="qt_desvinculado",
        enrolled="qt_matricula",
        paused="qt_trancada",
        others=["qt_transferido", "qt_falecido"],
        extra=["qt_ingressante", "qt_concluinte"],
        plain=["nu_vagas"],
    )
    return published(rows.drop("qt_falecido"))


def quality_courses(outcome: DataFrame) -> DataFrame:
    rows = outcome.where(F.col("qt_ingressante") >= m.MIN_CELL).select(
        "co_curso",
        *[a for a in COURSE_ATTRIBUTES[:-1] if a != "tp_grau_academico"],
        "nu_cohorts",
        F.lit(MILESTONE).alias("milestone_step"),
        m.mask_count(F.col("qt_ingressante")).alias("qt_ingressante"),
        m.mask_count(F.col("qt_desistencia_step")).alias("qt_desistencia_step"),
        "drop_rate_step",
        "nu_edicao_cpc",
        "cpc_faixa",
        *SCORE_FACTORS.values(),
        "tem_cpc",
        m.eligible(F.col("qt_ingressante")).alias("is_ranking_eligible"),
    )
    return published(rows)


def quality_bands(outcome: DataFrame) -> DataFrame:
    label = t.band_label(F.col("cpc_faixa"), "Não avaliado", "Sem conceito (SC)")
    return published(profiles.outcome_by_band(outcome, label, "rede", *_COUNTS, name="cpc_faixa"))


def score_factors(outcome: DataFrame) -> DataFrame:
    rows = outcome.where(F.col("tem_cpc") & m.eligible(F.col("qt_ingressante")))
    factors = {label: F.col(c) for label, c in SCORE_FACTORS.items()}
    factors["Rede privada"] = (F.col("rede") == PRIVATE).cast("int")
    return published(profiles.factor_correlations(rows, factors, F.col("drop_rate_step")))


def teaching_courses(outcome: DataFrame, exam: DataFrame) -> DataFrame:
    rows = profiles.program_with_exam(
        outcome.where("tp_grau_academico = 2"),
        exam.select("co_curso", F.col("area_avaliacao").alias("area_enade"),
                    F.col("conceito_faixa").alias("conceito_enade_faixa"), *_EXAM.values()),
        "co_curso",
        ["no_curso", "no_ies", "rede", "modalidade", "no_cine_area_geral"],
        ["area_enade", "conceito_enade_faixa"],
        **_FINAL,
        **_EXAM,
    )
    return published(
        rows.withColumn("pct_proficiente", F.col("pct_proficiente").cast("double")),
        {
            "qt_concluinte_participante": "qt_participante_enade",
            "qt_concluinte_proficiente": "qt_proficiente_enade",
            "has_exam": "tem_enade",
        },
    )


def teaching_funnel(outcome: DataFrame, exam: DataFrame) -> DataFrame:
    rows = outcome.where("tp_grau_academico = 2").join(
        exam.select("co_curso", *_EXAM.values()), "co_curso", "left"
    )
    return published(
        profiles.funnel_with_total(rows, "rede", "Total", **_FINAL, **_EXAM),
        {
            "of_100_dropped": "de_100_desistem",
            "of_100_completed": "de_100_concluem",
            "of_100_proficient": "de_100_concluem_proficientes",
            "nu_with_exam": "nu_cursos_enade",
            "qt_concluinte_participante": "qt_participante_enade",
        },
    )


def supply_deserts(people: DataFrame, census: DataFrame) -> DataFrame:
    supply = census.where("tp_modalidade_ensino = 1 and tp_nivel_academico = 1")
    rows = profiles.supply_gaps(
        people,
        supply,
        "co_municipio",
        "nu_ano_censo",
        "co_curso",
        "nu_vagas",
        "qt_ing",
        "no_municipio",
        people="nu_populacao",
        years=census,
    )
    return rows.withColumnsRenamed(
        {
            "nu_populacao": "nu_populacao_18_24",
            "nu_offers": "nu_cursos_presenciais",
            "nu_vagas": "nu_vagas_presenciais",
            "seats_per_100": "vagas_por_100_jovens",
            "qt_ing": "qt_ingressante_presencial",
            "entrants_per_100": "ingressantes_por_100_jovens",
            "is_gap": "is_deserto",
        }
    )


def funding_years(course_year: DataFrame) -> DataFrame:
    private = course_year.where("tp_rede = 2").withColumnsRenamed(
        {
            "qt_ing": "qt_ingressante",
            "qt_ing_fies": "qt_ingressante_fies",
            "qt_ing_prouni": "qt_ingressante_prouni",
            "qt_mat": "qt_matricula",
            "qt_mat_fies": "qt_matricula_fies",
            "qt_mat_prouni": "qt_matricula_prouni",
        }
    )
    totals = {c: [f"{c}_fies", f"{c}_prouni"] for c in ("qt_ingressante", "qt_matricula")}
    rows = profiles.funding_by_year(private, "nu_ano_censo", "modalidade", totals, "qt_matricula")
    return published(rows)


def funding_outcome(outcome: DataFrame, course_year: DataFrame) -> DataFrame:
    private = course_totals(course_year.where("tp_rede = 2"))
    shares = private.select(
        "co_curso", m.ratio(F.col("qt_mat_financiada"), F.col("qt_mat")).alias("share")
    ).where("share is not null")
    ranked = outcome.where((F.col("rede") == PRIVATE) & m.eligible(F.col("qt_ingressante")))
    rows = shares.join(ranked.select("co_curso", *_COUNTS), "co_curso")
    names = {
        "quartile": "quartil_financiamento",
        "pct_min": "pct_financiado_min",
        "pct_max": "pct_financiado_max",
    }
    return published(profiles.outcome_by_quartile(rows, "co_curso", *_COUNTS), names)


def social_outcome(outcome: DataFrame, profile: DataFrame) -> DataFrame:
    ranked = outcome.where(m.eligible(F.col("qt_ingressante"))).select("co_curso", *_COUNTS)
    rows = profile.join(ranked, "co_curso")
    return published(profiles.outcome_by_factor_quartile(rows, "co_curso", *_COUNTS))


def refresh_control(runs: DataFrame, manifest: DataFrame, built_at: Column) -> DataFrame:
    return freshness(runs, manifest, built_at, ZONE).withColumnsRenamed(
        {
            "source": "fonte",
            "last_status": "ultimo_status",
            "last_success_local": "ultima_carga_sucesso_local",
            "last_success_utc": "ultima_carga_sucesso_utc",
            "rows_last_run": "linhas_ultima_execucao",
            "rejected_last_run": "linhas_rejeitadas_ultima_execucao",
            "nu_files": "nu_arquivos_carregados",
            "rows_held": "linhas_disponiveis",
            "built_local": "ultima_transformacao_local",
            "time_zone": "fuso_horario",
        }
    )


# Names and types the control table promises.
CONTROL_CONTRACT = (
    "fonte string, ultimo_status string, ultima_carga_sucesso_local timestamp_ntz, "
    "ultima_carga_sucesso_utc timestamp, linhas_ultima_execucao bigint, "
    "linhas_rejeitadas_ultima_execucao bigint, nu_arquivos_carregados bigint, "
    "linhas_disponiveis bigint, ultima_transformacao_local timestamp_ntz, fuso_horario string"
)


# ---- source diagnostics ----------------------------------------------------------------------


def _with_institutions(census: DataFrame, institutions: DataFrame) -> DataFrame:
    names = institutions.select("co_ies", "nu_ano_censo", "no_ies")
    return census.join(names, ["co_ies", "nu_ano_censo"], "left").withColumn(
        "ies", F.coalesce("no_ies", "co_ies")
    )


def funding_diagnostics(census: DataFrame) -> DataFrame:
    """Private on-site undergraduate courses per year: missing funding parts and sums."""
    grants = [F.col("qt_mat_prouni_integral"), F.col("qt_mat_prouni_parcial")]
    rows = census.where("tp_rede = 2 and tp_modalidade_ensino = 1 and tp_nivel_academico = 1")
    return consume.source_diagnostics(
        rows,
        "nu_ano_censo",
        {
            "cursos_sem_fies": F.col("qt_mat_fies").isNull(),
            "cursos_sem_prouni": grants[0].isNull() | grants[1].isNull(),
        },
        {"matriculas": F.col("qt_mat"), "fies": F.col("qt_mat_fies"), "prouni": m.zero_sum(*grants)},
    ).withColumnRenamed("nu_rows", "cursos")


def top_institutions(
    rows: DataFrame, institutions: DataFrame, sums: Mapping[str, str], by: str, nulls_last: bool = True
) -> DataFrame:
    """Five institutions per year with most of ``by``; filter ``rows`` to the part in question."""
    top = consume.top_contributors(
        rows,
        institutions.select("co_ies", "nu_ano_censo", "no_ies"),
        ["co_ies", "nu_ano_censo"],
        "nu_ano_censo",
        "co_ies",
        "no_ies",
        {name: F.sum(column) for name, column in sums.items()},
        by,
        nulls_last=nulls_last,
    )
    return top.withColumnRenamed("contributor", "ies")


def courses_of_place(
    census: DataFrame, institutions: DataFrame, pattern: str, n: int = 10
) -> DataFrame:
    """Largest on-site courses of the latest year in places whose name matches a pattern."""
    newest = census.agg(F.max("nu_ano_censo")).scalar()
    rows = census.where(F.col("no_municipio").ilike(pattern) & (F.col("tp_modalidade_ensino") == 1))
    return (
        _with_institutions(rows.where(F.col("nu_ano_censo") == newest), institutions)
        .select("nu_ano_censo", "ies", "no_curso", "nu_vagas", "qt_ing", "qt_mat")
        .orderBy(F.col("nu_vagas").desc_nulls_first(), "no_curso")
        .limit(n)
    )


@dataclass(frozen=True)
class Silver:
    """Relations several published tables share; each is written once."""

    trajectory: DataFrame
    accumulated: DataFrame
    milestone: DataFrame
    census: DataFrame
    course_year: DataFrame
    outcome: DataFrame
    profile: DataFrame
    exam: DataFrame
    population: DataFrame
    scores: DataFrame
    latest_scores: DataFrame
    institutions: DataFrame
    institution_scores: DataFrame


def build_silver(bronze: Mapping[str, DataFrame]) -> Silver:
    """``bronze``: trajectory, census, scores, and optionally exam, population, institutions and
    institution_scores."""
    spark = bronze["trajectory"].sparkSession

    def cohorts_of() -> tuple[DataFrame, ...]:
        typed = cut_lineage(trajectory(bronze["trajectory"]), "trajectory")
        acc = cut_lineage(accumulated(typed), "accumulated")
        return typed, acc, cut_lineage(milestone(acc), "milestone")

    def courses_of() -> tuple[DataFrame, ...]:
        census = cut_lineage(census_courses(bronze["census"]), "census")
        return census, cut_lineage(census_course_year(census), "course_year")

    def exam_of() -> DataFrame:
        if "exam" not in bronze:
            return spark.createDataFrame([], EXAM_SCHEMA)
        return cut_lineage(exam_results(bronze["exam"]), "exam")

    def people_of() -> DataFrame:
        if "population" not in bronze:
            return spark.createDataFrame([], POPULATION_SCHEMA)
        return population(bronze["population"])

    def optional(name: str, typed, year: str, schema: str) -> DataFrame:
        # A source that has never delivered a file has no business columns yet.
        if name not in bronze or year not in bronze[name].columns:
            return spark.createDataFrame([], schema)
        return cut_lineage(typed(bronze[name]), name)

    parts = all_together(
        {
            "cohorts": cohorts_of,
            "courses": courses_of,
            "scores": lambda: cut_lineage(course_scores(bronze["scores"]), "scores"),
            "exam": exam_of,
            "institutions": lambda: optional("institutions", census_institutions, "nu_ano_censo", INSTITUTION_SCHEMA),
            "institution_scores": lambda: optional(
                "institution_scores", institution_scores, "ano", INSTITUTION_SCORE_SCHEMA
            ),
        }
    )
    (typed, acc, snapshot), (census, course_year) = parts["cohorts"], parts["courses"]
    later = all_together(
        {
            "outcome": lambda: cut_lineage(course_outcome(snapshot, parts["scores"]), "outcome"),
            "profile": lambda: cut_lineage(social_profile(course_year), "profile"),
        }
    )
    return Silver(
        typed,
        acc,
        snapshot,
        census,
        course_year,
        later["outcome"],
        later["profile"],
        parts["exam"],
        people_of(),
        parts["scores"],
        latest_score(parts["scores"]),
        parts["institutions"],
        parts["institution_scores"],
    )


def build_gold(s: Silver, ops: Ops) -> dict[str, DataFrame]:
    """All published tables; the control table comes from the run log and manifest of ``ops``."""
    plans = {
        "controle_atualizacao": lambda: refresh_control(
            ops.read("ingestion_runs"), ops.read("file_manifest"), F.current_timestamp()
        ),
        "p1_trajetoria_coorte": lambda: cohort_curve(s.accumulated),
        "p2_desistencia_curso": lambda: course_milestone(s.milestone),
        "p2_desistencia_area": lambda: area_curve(s.accumulated),
        "p3_rede_modalidade_ano": lambda: yearly_churn(s.course_year),
        "p4_qualidade_curso": lambda: quality_courses(s.outcome),
        "p4_qualidade_faixa": lambda: quality_bands(s.outcome),
        "p4_fatores": lambda: score_factors(s.outcome),
        "p5_licenciaturas_curso": lambda: teaching_courses(s.outcome, s.exam),
        "p5_funil_licenciaturas": lambda: teaching_funnel(s.outcome, s.exam),
        "b1_desertos_municipio": lambda: supply_deserts(s.population, s.census),
        "b2_financiamento_ano": lambda: funding_years(s.course_year),
        "b2_financiamento_desistencia": lambda: funding_outcome(s.outcome, s.course_year),
        "s1_fator_social_desistencia": lambda: social_outcome(s.outcome, s.profile),
    }
    # The quartile tables sort their rows while they are planned; the others only describe work.
    return all_together(plans)


# Published table -> key columns, and base column of its export (none: not suppressed).
KEYS = {
    "controle_atualizacao": ["fonte"],
    "p1_trajetoria_coorte": ["modalidade", "nu_ano_ingresso", "nu_ano_referencia"],
    "p2_desistencia_curso": ["co_curso", "nu_ano_ingresso"],
    "p2_desistencia_area": ["no_cine_area_geral", "modalidade", "nu_ano_ingresso", "nu_ano_curso"],
    "p3_rede_modalidade_ano": ["nu_ano_censo", "rede", "modalidade"],
    "p4_qualidade_curso": ["co_curso"],
    "p4_qualidade_faixa": ["cpc_faixa", "rede"],
    "p4_fatores": ["fator"],
    "p5_licenciaturas_curso": ["co_curso"],
    "p5_funil_licenciaturas": ["rede"],
    "b1_desertos_municipio": ["co_municipio"],
    "b2_financiamento_ano": ["nu_ano_censo", "modalidade"],
    "b2_financiamento_desistencia": ["quartil_financiamento"],
    "s1_fator_social_desistencia": ["fator", "quartil"],
}
BASES = {
    "p3_rede_modalidade_ano": "qt_vinculo",
    "p4_fatores": "nu_cursos",
    "b2_financiamento_ano": "qt_matricula",
    "b1_desertos_municipio": None,
    "controle_atualizacao": None,
}


def exports() -> list[ExportTable]:
    """Export rules of the published tables."""
    specs = []
    for name in KEYS:
        base = BASES.get(name, "qt_ingressante")
        specs.append(ExportTable(name, base=(base,) if base else (), suppress=base is not None))
    return specs


def silver_tests(s: Silver) -> DataFrame:
    """Grain, domain and balance tests: one scan per relation for all its row tests."""
    low = checks.min_value
    flows = ["qt_permanencia", "qt_concluinte", "qt_desistencia", "qt_falecido"]
    typed = {
        **{f"trajectory.{c}.not_null": checks.not_null(c)
           for c in ("co_curso", "nu_ano_ingresso", "nu_ano_referencia", "tp_modalidade_ensino",
                     "rede", "qt_ingressante", *flows)},
        "trajectory.nu_ano_ingresso.between": checks.between("nu_ano_ingresso", 2010, 2030),
        "trajectory.nu_ano_curso.between": checks.between("nu_ano_curso", 1, 15),
        "trajectory.tp_modalidade_ensino.accepted": checks.accepted_values("tp_modalidade_ensino", [1, 2]),
        "trajectory.qt_ingressante.min": low("qt_ingressante", 1),
        **{f"trajectory.{c}.min": low(c) for c in flows},
    }
    balance = {
        "accumulated.balance": checks.flow_unbalanced(
            ["qt_permanencia", "qt_concluinte_acum", "qt_desistencia_acum", "qt_falecido_acum"],
            "qt_ingressante",
        ),
        "accumulated.rates": checks.rates_differ(
            "qt_base_acum",
            {"qt_desistencia_acum": "tda", "qt_concluinte_acum": "tca", "qt_permanencia": "tap"},
        ),
    }
    census = {
        **{f"census.{c}.not_null": checks.not_null(c)
           for c in ("nu_ano_censo", "co_curso", "tp_rede", "tp_modalidade_ensino", "qt_mat",
                     "qt_ing", "qt_sit_desvinculado")},
        "census.tp_rede.accepted": checks.accepted_values("tp_rede", [1, 2]),
        "census.tp_modalidade_ensino.accepted": checks.accepted_values("tp_modalidade_ensino", [1, 2]),
        **{f"census.{c}.min": low(c) for c in ("qt_mat", "qt_ing", "qt_sit_desvinculado")},
    }
    grains = {
        "trajectory": (s.trajectory, ["co_curso", "nu_ano_ingresso", "nu_ano_referencia"]),
        "census": (s.census, ["nu_ano_censo", "co_curso", "co_municipio"]),
        "course_year": (s.course_year, ["nu_ano_censo", "co_curso"]),
        "milestone": (s.milestone, ["co_curso", "nu_ano_ingresso"]),
        "outcome": (s.outcome, ["co_curso"]),
        "profile": (s.profile, ["co_curso", "factor"]),
        "exam": (s.exam, ["nu_edicao", "co_curso"]),
        "population": (s.population, ["co_municipio", "co_idade"]),
        "scores": (s.scores, ["nu_edicao", "co_curso"]),
        "latest_scores": (s.latest_scores, ["co_curso"]),
        "institutions": (s.institutions, ["nu_ano_censo", "co_ies"]),
        "institution_scores": (s.institution_scores, ["nu_edicao", "co_ies"]),
    }
    bands = [str(n) for n in range(1, 6)] + ["SC"]
    rated = {
        "scores": (s.scores, "co_curso", "cpc"),
        "institution_scores": (s.institution_scores, "co_ies", "igc"),
    }
    undergraduate = s.census.where("tp_nivel_academico = 1")
    return checks.suite(
        [
            checks.run_row_checks(s.trajectory, typed),
            checks.run_row_checks(s.accumulated, balance),
            checks.run_row_checks(s.census, census),
            checks.run_row_checks(
                s.profile, {"profile.share.between": checks.between("share", 0, 1)}
            ),
            checks.run_row_checks(
                s.exam, {"exam.pct.between": checks.between("pct_proficiente", 0, 100)}
            ),
            checks.run_row_checks(
                s.institutions,
                {f"institutions.{c}.not_null": checks.not_null(c) for c in ("nu_ano_censo", "co_ies", "no_ies")}
                | {"institutions.sg_uf_ies.accepted": checks.accepted_values("sg_uf_ies", STATES)},
            ),
            *[
                checks.run_row_checks(
                    df,
                    {f"{name}.{c}.not_null": checks.not_null(c) for c in ("nu_edicao", key)}
                    | {
                        f"{name}.{mark}_faixa.accepted": checks.accepted_values(f"{mark}_faixa", bands),
                        f"{name}.{mark}_continuo.between": checks.between(f"{mark}_continuo", 0, 5),
                    },
                )
                for name, (df, key, mark) in rated.items()
            ],
            checks.count_violations(
                "accumulated.rows", checks.row_count_equal(s.accumulated, s.trajectory)
            ),
            checks.count_violations(
                "course_year.qt_mat.sum",
                checks.sum_equal(s.course_year, "qt_mat", undergraduate, "qt_mat"),
            ),
            checks.count_violations(
                "outcome.qt_ingressante.sum",
                checks.sum_equal(
                    s.outcome, "qt_ingressante", s.milestone.where("has_step"), "qt_ingressante"
                ),
            ),
            *[
                checks.count_violations(f"{name}.grain", checks.unique_combination(df, keys))
                for name, (df, keys) in grains.items()
            ],
        ]
    )


def gold_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Small cells and keys of every published table."""
    parts = []
    for name, df in tables.items():
        rows = {f"{name}.small_cells": checks.small_cells(df.columns)}
        key = KEYS.get(name, [])
        rows |= {f"{name}.{c}.not_null": checks.not_null(c) for c in key if c.startswith("co_")}
        parts.append(checks.run_row_checks(df, rows))
        if key:
            grain = checks.unique_combination(df, key)
            parts.append(checks.count_violations(f"{name}.grain", grain))
    return checks.suite(parts)
