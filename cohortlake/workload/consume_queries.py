"""Reading steps and diagnostics on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators import consume, ranking
from cohortlake.session import cut_lineage
from cohortlake.workload import base
from cohortlake.workload.cohort_queries import ORACLE as COHORT_ORACLE
from cohortlake.workload.cohort_queries import cohort_curve
from cohortlake.workload.profile_queries import ORACLE as PROFILE_ORACLE
from cohortlake.workload.profile_queries import funnel_relation

MEASURES = ["drop_rate", "completion_rate", "stay_rate"]


def part_totals(spark: SparkSession, sf: str) -> DataFrame:
    lines = base.table(spark, sf, "lineitem")
    return lines.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        (F.count_if(F.col("l_returnflag") == "R") >= 5).alias("is_eligible"),
    )


def ranking_top_bottom(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_and_bottom(
        part_totals(spark, sf), "quantity", "l_partkey", 10, F.col("is_eligible")
    )


def melt_measures(spark: SparkSession, sf: str) -> DataFrame:
    rows = cohort_curve(spark, sf).select("p_type", "cohort", "ref_year", *MEASURES)
    return consume.melt(rows, MEASURES)


def block_filter(spark: SparkSession, sf: str) -> DataFrame:
    choices = {"cohort": "min", "p_type": "ECONOMY", "absent": "x", "step": "all"}
    published = cut_lineage(cohort_curve(spark, sf), "published")
    rows = consume.block_filters(published, choices)
    series = consume.series_key(["p_type", "cohort"]).alias("series")
    return rows.select(series, "ref_year", "qt_entrants", "drop_rate")


def funnel_steps(spark: SparkSession, sf: str) -> DataFrame:
    steps = {
        "of_100_completed": "Complete",
        "of_100_proficient": "Complete and proficient",
        "qt_hidden": "Never measured",
    }
    rows = funnel_relation(spark, sf).withColumn("qt_hidden", F.lit(None).cast("double"))
    return consume.funnel_steps(rows.select("r_name", *steps), steps)


def headline(spark: SparkSession, sf: str) -> DataFrame:
    rows = cohort_curve(spark, sf).select("p_type", "cohort", "ref_year", "qt_entrants", *MEASURES)
    return consume.headline(rows, "cohort", "ref_year", ["p_type"])


def top_contributors(spark: SparkSession, sf: str) -> DataFrame:
    """Five suppliers with most returned quantity per ship year; no name in two segments."""
    lines = base.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.col("l_suppkey").alias("code"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")).alias("quantity"),
    )
    years = base.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("code"),
        F.explode(F.sequence(F.lit(1995).cast("bigint"), F.lit(1999).cast("bigint"))).alias("year"),
        F.col("s_name").alias("name"),
    )
    return consume.top_contributors(
        lines,
        years,
        ["code", "year"],
        "year",
        "code",
        "name",
        {"returned": F.sum("quantity"), "nu_lines": F.count(F.lit(1))},
        by="returned",
    )


def drill_down(spark: SparkSession, sf: str) -> DataFrame:
    """Latest ship year of parts whose name matches a pattern: the ten largest."""
    lines = base.table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    latest = lines.agg(F.date_trunc("year", F.max("l_shipdate")).cast("timestamp_ntz")).scalar()
    parts = base.table(spark, sf, "part").where(F.col("p_name").ilike("S_a%"))
    return (
        lines.where(F.col("l_shipdate") >= latest)
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("nu_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_partkey", "p_name", "nu_lines", F.col("q").alias("quantity"))
        .orderBy(F.col("quantity").desc_nulls_last(), "l_partkey")
        .limit(10)
    )


def source_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """Landed events per user: rows, rows lacking a part, sums."""
    rows = base.text_events(spark, sf)
    amount = F.col("amount").try_cast("decimal(18,2)")
    totals = consume.source_diagnostics(
        rows,
        "user_id",
        {
            "without_kind": F.col("kind").isNull(),
            "without_any": F.col("kind").isNull() | amount.isNull(),
        },
        {"amount": amount},
    )
    return totals.withColumn("amount", F.col("amount").cast("double"))


def recovery_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Tables against a written copy; one copy lost rows, one is missing, one is new."""
    names = ("orders", "customer", "lineitem", "part")
    original = {name: base.table(spark, sf, name) for name in names}
    copy = {
        "orders": cut_lineage(original["orders"].select("o_orderkey"), "copy"),
        "lineitem": original["lineitem"].where("l_returnflag <> 'N'"),
        "customer": cut_lineage(original["customer"].select("c_custkey"), "copy"),
        "events": base.table(spark, sf, "events"),
    }
    return consume.compare_counts(original, copy)


QUERIES = {
    "ranking_top_bottom": ranking_top_bottom,
    "melt_measures": melt_measures,
    "block_filters": block_filter,
    "funnel_steps": funnel_steps,
    "headline": headline,
    "top_contributors": top_contributors,
    "drill_down": drill_down,
    "source_diagnostics": source_diagnostics,
    "recovery_compare": recovery_compare,
}

_TOTALS = """
t AS (SELECT l_partkey, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity,
             count(*) FILTER (WHERE l_returnflag = 'R') >= 5 AS is_eligible
      FROM lineitem GROUP BY 1 HAVING is_eligible)"""
_CURVE = COHORT_ORACLE["cohort_curve"]

ORACLE = {
    "ranking_top_bottom": f"""
WITH {_TOTALS}
SELECT 'top' AS side, row_number() OVER (ORDER BY quantity DESC, l_partkey) AS position, t.* FROM t
QUALIFY position <= 10
UNION ALL
SELECT 'bottom', row_number() OVER (ORDER BY quantity, l_partkey DESC) AS position, t.* FROM t
QUALIFY position <= 10""",
    "melt_measures": f"""
WITH curve AS ({_CURVE})
SELECT p_type, cohort, ref_year, 'drop_rate' AS variable, drop_rate AS value FROM curve
UNION ALL SELECT p_type, cohort, ref_year, 'completion_rate', completion_rate FROM curve
UNION ALL SELECT p_type, cohort, ref_year, 'stay_rate', stay_rate FROM curve""",
    "block_filters": f"""
WITH curve AS ({_CURVE})
SELECT p_type || ' · ' || cohort AS series, ref_year, qt_entrants, drop_rate FROM curve
WHERE cohort = (SELECT min(cohort) FROM curve) AND p_type = 'ECONOMY'""",
    "funnel_steps": f"""
WITH f AS ({PROFILE_ORACLE["funnel_total"]}),
s AS (
  SELECT r_name, 0 AS o, 'Enter' AS stage, 100.0::DOUBLE AS of_100 FROM f
  UNION ALL SELECT r_name, 1, 'Complete', of_100_completed FROM f
  UNION ALL SELECT r_name, 2, 'Complete and proficient', of_100_proficient FROM f)
SELECT r_name, row_number() OVER (PARTITION BY r_name ORDER BY o) - 1 AS position, stage, of_100
FROM s WHERE of_100 IS NOT NULL""",
    "headline": f"""
WITH curve AS ({_CURVE})
SELECT p_type, cohort, ref_year, qt_entrants, drop_rate, completion_rate, stay_rate FROM curve
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY cohort, ref_year DESC) = 1""",
    "top_contributors": """
WITH g AS (
  SELECT year(l_shipdate) AS year,
         CASE WHEN year(l_shipdate) <= 1999 THEN s_name ELSE l_suppkey::VARCHAR END AS contributor,
         sum(l_quantity::BIGINT) FILTER (WHERE l_returnflag = 'R')::BIGINT AS returned,
         count(*) AS nu_lines
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT year, contributor, returned, nu_lines,
       row_number() OVER (PARTITION BY year ORDER BY returned DESC NULLS LAST, contributor) AS position
FROM g QUALIFY position <= 5""",
    "drill_down": """
SELECT l_partkey, p_name, count(*) AS nu_lines, sum(l_quantity::BIGINT)::BIGINT AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_name ILIKE 'S_a%'
  AND l_shipdate >= (SELECT date_trunc('year', max(l_shipdate)) FROM lineitem)
GROUP BY 1, 2 ORDER BY quantity DESC, l_partkey LIMIT 10""",
    "source_diagnostics": f"""
WITH {base.TEXT_EVENTS_SQL}
SELECT user_id, count(*) AS nu_rows, count(*) FILTER (WHERE kind IS NULL) AS without_kind,
       count(*) FILTER (WHERE kind IS NULL OR TRY_CAST(amount AS DECIMAL(18,2)) IS NULL)
         AS without_any,
       sum(TRY_CAST(amount AS DECIMAL(18,2)))::DOUBLE AS amount
FROM texts GROUP BY 1""",
    "recovery_compare": """
SELECT *, rows_original IS NOT DISTINCT FROM rows_copy AS is_equal FROM (
  SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS rows_original,
         (SELECT count(*) FROM orders) AS rows_copy
  UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)
  UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem),
         (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'N')
  UNION ALL SELECT 'part', (SELECT count(*) FROM part), NULL
  UNION ALL SELECT 'events', NULL, (SELECT count(*) FROM events))""",
}
