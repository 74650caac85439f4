"""Driver tables dressed as landed files of the higher-education sources, then typed; packed files; base columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.plans import higher_education as he
from cohortlake.plans.export import ExportTable, choose_base, suppressed
from cohortlake.plans.landing import Lake, Source
from cohortlake.session import scratch_path
from cohortlake.sources.decoded import DecodeOptions
from cohortlake.workload import base


def _landed(rows: DataFrame, values: Mapping[str, Column | str], columns: Mapping[str, str], *more: str) -> DataFrame:
    """Text columns as a load leaves them: those with values, the others of the layout empty."""
    names = [n for group in columns.values() for n in group.split()] + list(more)
    empty = F.lit(None).cast("string")
    made = [F.expr(v) if isinstance(v, str) else v for v in values.values()]
    return rows.select(
        *[v.cast("string").alias(n) for n, v in zip(values, made, strict=True)],
        *[empty.alias(n) for n in dict.fromkeys(names) if n not in values],
        "_source_file", "_batch_id", "_ingested_at",
    )


def _twice(rows: DataFrame, year: str) -> DataFrame:
    """Every year delivered in an old file, and the even years again in a newer one."""
    old = rows.select("*", F.lit("a.csv").alias("_source_file"), F.lit("b1").alias("_batch_id"), F.lit(1).alias("_ingested_at"))
    new = rows.where(f"{year} % 2 = 0").select("*", F.lit("c.csv"), F.lit("b2"), F.lit(2))
    return old.union(new)


def census_courses(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier-years as census rows: counts by line status, an undeclared remainder, padded text."""
    lines = base.table(spark, sf, "lineitem")
    flag = F.col("l_returnflag")
    years = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(flag == "R").alias("r"), F.count_if(flag == "A").alias("a"),
        F.count_if(F.col("l_quantity") > 40).alias("q"),
    )
    landed = _landed(
        _twice(years, "year"),
        {
            "nu_ano_censo": "concat(' ', year, ' ')", "co_curso": "concat(' ', l_suppkey)", "tp_rede": "1 + l_suppkey % 3",
            "tp_modalidade_ensino": "concat(1 + l_suppkey % 2, if(l_suppkey % 6 = 0, 'x', ' '))", "qt_mat": "n",
            "qt_mat_preta": "r", "qt_mat_parda": "case when l_suppkey % 5 <> 0 then a end", "qt_mat_indigena": "'x'",
            "qt_mat_cornd": "case when l_suppkey % 4 <> 0 then q end", "qt_vg_total": "n + 1",
        },
        he.CENSUS_COLUMNS, *he.CENSUS_RENAMED.values(),
    )
    typed = he.census_courses(landed)
    return typed.select(
        F.col("nu_ano_censo").cast("bigint").alias("nu_ano_censo"), "co_curso", "rede", "modalidade", "qt_mat",
        "qt_mat_ppi", "qt_mat_cor_declarada", "nu_vagas", "qt_ing", "arquivo_origem",
    )


def census_institutions(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers in each ship year as institutions."""
    lines = base.table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year")).distinct()
    suppliers = base.table(spark, sf, "supplier")
    rows = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    landed = _landed(
        _twice(rows, "year"),
        {
            "nu_ano_censo": "year", "co_ies": "concat(s_suppkey, '  ')", "no_ies": "s_name", "sg_ies": "''",
            "tp_categoria_administrativa": "concat('  ', s_nationkey)", "tp_organizacao_academica": "s_nationkey % 4",
        },
        he.INSTITUTION_COLUMNS,
    )
    typed = he.census_institutions(landed)
    whole = [F.col(c).cast("bigint").alias(c) for c in he.INSTITUTION_COLUMNS["int"].split()]
    return typed.select("co_ies", "no_ies", "sg_ies", *whole)


def institution_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with a score in decimal commas and a band, some of them not to be read."""
    rows = base.table(spark, sf, "supplier").select("*", (2019 + F.col("s_suppkey") % 4).alias("year"))
    landed = _landed(
        _twice(rows, "year"),
        {
            "ano": "year", "codigo_da_ies": "s_suppkey", "nome_da_ies": "s_name", "sigla_da_uf": "' MT '",
            "igc_continuo": "case when s_suppkey % 7 = 0 then '-' else replace(cast(cast(s_suppkey % 500 as decimal(9,2)) / 100 as string), '.', ',') end",
            "igc_faixa": "case s_suppkey % 8 when 6 then 'sc' when 7 then 'none' else cast(s_suppkey % 8 as string) end",
        },
        {},
    )
    return he.institution_scores(landed).select(
        F.col("nu_edicao").cast("bigint").alias("nu_edicao"), "co_ies", "no_ies", "sg_uf",
        F.col("igc_continuo").cast("double").alias("igc_continuo"), "igc_faixa",
    )


def compressed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Parts in files of two codecs, fields over line ends among them, landed beside each other."""
    folder = scratch_path(spark, "landing")
    parts = base.table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit("\n"), "p_brand").alias("p_label"), "p_type"
    )
    for codec, remainder in (("gzip", 0), ("bzip2", 1), ("none", 2)):
        rows = parts.where(F.col("p_partkey") % 3 == remainder)
        rows.write.csv(f"{folder}/{codec}", header=True, sep=";", escape='"', compression=codec, quoteAll=True)
    lake = Lake(spark, scratch_path(spark, "lake"))
    source = Source("parts", folder, include=("*.csv", "*.csv.gz", "*.csv.bz2"), decode=DecodeOptions(sep=";"))
    lake.load(source)
    return lake.bronze(source).select("p_partkey", "p_label", "p_type")


def base_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by clerkless groups, suppressed by the best known base column of the table."""
    rows = base.table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("alunos"), F.count_if(F.col("o_orderstatus") == "F").alias("qt_mat")
    )
    choice = choose_base(ExportTable("orders", min_cell=3), rows.columns)
    kept = suppressed(rows, choice.chosen, 3)
    return kept.select("*", F.lit(",".join(choice.chosen)).alias("base"), F.lit(",".join(choice.candidates)).alias("candidates"))


def newest_from_index(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed by day, the even days again: rows of the newest version of each day, by the load's index."""
    folder = scratch_path(spark, "landing")
    lake = Lake(spark, scratch_path(spark, "lake"))
    events = base.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    source = Source("events", folder, include=("*.csv",), decode=DecodeOptions(sep=","), partition="day")
    events.repartition(4, "day").write.csv(f"{folder}/first", header=True)
    lake.load(source)
    again = events.where("day(to_date(day)) % 2 = 0 and event_type <> 'error'")
    again.repartition(4, "day").write.csv(f"{folder}/second", header=True)
    lake.load(source)
    return lake.latest(source).select("event_id", "day", "event_type")


QUERIES = {
    "census_courses": census_courses,
    "census_institutions": census_institutions,
    "institution_scores": institution_scores,
    "compressed_scan": compressed_scan,
    "base_choice": base_choice,
    "newest_from_index": newest_from_index,
}

ORACLE = {
    "census_courses": """
SELECT year::BIGINT AS nu_ano_censo, l_suppkey::VARCHAR AS co_curso,
       CASE l_suppkey % 3 WHEN 0 THEN 'Pública' WHEN 1 THEN 'Privada' END AS rede,
       CASE WHEN l_suppkey % 6 = 0 THEN NULL WHEN l_suppkey % 2 = 0 THEN 'Presencial' ELSE 'EAD' END AS modalidade, n AS qt_mat,
       r + CASE WHEN l_suppkey % 5 <> 0 THEN a ELSE 0 END AS qt_mat_ppi,
       n - CASE WHEN l_suppkey % 4 <> 0 THEN q ELSE 0 END AS qt_mat_cor_declarada, n + 1 AS nu_vagas,
       NULL::BIGINT AS qt_ing, CASE WHEN year % 2 = 0 THEN 'c.csv' ELSE 'a.csv' END AS arquivo_origem
FROM (SELECT l_suppkey, year(l_shipdate) AS year, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r,
             count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_quantity > 40) AS q FROM lineitem GROUP BY 1, 2)""",
    "census_institutions": """
SELECT s_suppkey::VARCHAR AS co_ies, s_name AS no_ies, NULL::VARCHAR AS sg_ies, year::BIGINT AS nu_ano_censo,
       s_nationkey::BIGINT AS tp_categoria_administrativa, (s_nationkey % 4)::BIGINT AS tp_organizacao_academica
FROM (SELECT DISTINCT l_suppkey, year(l_shipdate) AS year FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey""",
    "institution_scores": """
SELECT (2019 + s_suppkey % 4)::BIGINT AS nu_edicao, s_suppkey::VARCHAR AS co_ies, s_name AS no_ies, 'MT' AS sg_uf,
       CASE WHEN s_suppkey % 7 <> 0 THEN (s_suppkey % 500) / 100.0 END AS igc_continuo,
       CASE WHEN s_suppkey % 8 = 6 THEN 'SC' WHEN s_suppkey % 8 BETWEEN 1 AND 5 THEN (s_suppkey % 8)::VARCHAR END AS igc_faixa
FROM supplier""",
    "compressed_scan": r"""
SELECT p_partkey::VARCHAR AS p_partkey, p_name || chr(10) || p_brand AS p_label, p_type FROM part""",
    "base_choice": """
SELECT *, 'qt_mat' AS base, 'qt_mat,alunos' AS candidates FROM (
  SELECT o_custkey, o_orderpriority, count(*) AS alunos, count(*) FILTER (o_orderstatus = 'F') AS qt_mat
  FROM orders GROUP BY 1, 2) WHERE qt_mat >= 3""",
    "newest_from_index": """
SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%d') AS day, event_type FROM events
WHERE day(ts) % 2 = 1 OR event_type <> 'error'""",
}
