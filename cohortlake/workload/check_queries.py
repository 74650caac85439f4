"""Data tests on the driver tables: violating rows or counts per check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.text import to_int
from cohortlake.operators import checks
from cohortlake.workload import base
from cohortlake.workload.cohort_queries import accumulated
from cohortlake.workload.text_queries import DIRTY_SQL, dirty_events


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unique_combination(base.table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


def check_min(spark: SparkSession, sf: str) -> DataFrame:
    return base.table(spark, sf, "customer").where(checks.min_value("c_acctbal", 0))


def check_between(spark: SparkSession, sf: str) -> DataFrame:
    lines = base.table(spark, sf, "lineitem").where(checks.between("l_quantity", 5, 45))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def check_small_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = base.yearly_orders(spark, sf).select(
        "year", "o_custkey", "o_orderpriority", "qt_enrolled", "qt_paused", "qt_left"
    )
    return rows.where(checks.small_cells(rows.columns))


def check_count_equal(spark: SparkSession, sf: str) -> DataFrame:
    lines = base.table(spark, sf, "lineitem")
    return checks.row_count_equal(
        lines.where("l_returnflag = 'R'"), lines.where("l_linestatus = 'F'")
    )


def check_sum_equal(spark: SparkSession, sf: str) -> DataFrame:
    lines = base.table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("bigint").alias("quantity"), "l_returnflag"
    )
    return checks.sum_equal(
        lines.where("l_returnflag = 'R'"), "quantity", lines.where("l_returnflag = 'A'"), "quantity"
    )


def check_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates recomputed from counts against rates delivered with one digit."""
    acc = accumulated(spark, sf)
    delivered = acc.withColumn(
        "given", F.floor(F.col("qt_dropped_acc") * 1000 / F.nullif("qt_base_acc", F.lit(0))) / 10
    )
    return delivered.where(
        checks.rates_differ("qt_base_acc", {"qt_dropped_acc": "given"}, 0.05)
    ).select("entity", "cohort", "ref_year")


def check_balance(spark: SparkSession, sf: str) -> DataFrame:
    parts = ["qt_stayed", "qt_completed_acc", "qt_dropped_acc", "qt_excluded"]
    rows = accumulated(spark, sf)
    return rows.where(checks.flow_unbalanced(parts, "qt_entrants")).select(
        "entity", "cohort", "ref_year"
    )


def check_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that are also users of events: far fewer than half."""
    coverage = checks.join_coverage(
        base.table(spark, sf, "customer"), "c_custkey", base.table(spark, sf, "events"), "user_id"
    )
    return checks.coverage_below(coverage, 0.5)


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return base.text_events(spark, sf).where(checks.not_null("kind"))


def check_accepted(spark: SparkSession, sf: str) -> DataFrame:
    rows = base.text_events(spark, sf)
    return rows.where(checks.accepted_values("kind", ["view", "click"])).select("event_id", "kind")


def check_cast_loss(spark: SparkSession, sf: str) -> DataFrame:
    rows = dirty_events(spark, sf)
    lost = checks.cast_loss(F.col("int_text"), to_int(F.col("int_text")))
    return rows.where(lost).select("event_id", "int_text")


def check_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Differences of orders from a contract that wants another key type and one more column."""
    orders = base.table(spark, sf, "orders")
    wanted = T.StructType.fromDDL(
        "o_orderkey bigint, o_custkey int, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string, o_note string"
    )
    found = F.array(*map(F.lit, checks.schema_differences(orders, wanted)))
    counted = orders.agg(F.count(F.lit(1)).alias("nu_rows"))
    return counted.select(F.explode(found).alias("difference"), "nu_rows")


def check_suite(spark: SparkSession, sf: str) -> DataFrame:
    """One scan per relation for all row checks, one aggregate per grain check."""
    acc = accumulated(spark, sf)
    row_checks = {
        "entrants_positive": checks.min_value("qt_entrants", 1),
        "step_in_range": checks.between("step", 1, 4),
        "flows_balance": checks.flow_unbalanced(
            ["qt_stayed", "qt_completed_acc", "qt_dropped_acc", "qt_excluded_acc"], "qt_entrants"
        ),
        "sector_known": checks.not_null("sector"),
        "type_accepted": checks.accepted_values("p_type", ["ECONOMY", "STANDARD"]),
    }
    grain = checks.unique_combination(
        base.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )
    return checks.suite(
        [checks.run_row_checks(acc, row_checks), checks.count_violations("line_grain", grain)]
    )


QUERIES = {
    "check_unique": check_unique,
    "check_min": check_min,
    "check_between": check_between,
    "check_small_cells": check_small_cells,
    "check_count_equal": check_count_equal,
    "check_sum_equal": check_sum_equal,
    "check_rates": check_rates,
    "check_balance": check_balance,
    "check_coverage": check_coverage,
    "check_not_null": check_not_null,
    "check_accepted": check_accepted,
    "check_cast_loss": check_cast_loss,
    "check_contract": check_contract,
    "check_suite": check_suite,
}

ORACLE = {
    "check_unique": """
SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_min": "SELECT * FROM customer WHERE c_acctbal < 0",
    "check_between": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_quantity NOT BETWEEN 5 AND 45""",
    "check_small_cells": f"""
WITH {base.YEARLY_SQL}
SELECT year, o_custkey, o_orderpriority, qt_enrolled, qt_paused, qt_left FROM yearly
WHERE qt_enrolled BETWEEN 1 AND 9 OR qt_paused BETWEEN 1 AND 9 OR qt_left BETWEEN 1 AND 9""",
    "check_count_equal": """
SELECT a AS model, b AS reference FROM (
  SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS a,
         count(*) FILTER (WHERE l_linestatus = 'F') AS b FROM lineitem) WHERE a <> b""",
    "check_sum_equal": """
SELECT a AS model, b AS reference FROM (
  SELECT sum(l_quantity::BIGINT) FILTER (WHERE l_returnflag = 'R')::BIGINT AS a,
         sum(l_quantity::BIGINT) FILTER (WHERE l_returnflag = 'A')::BIGINT AS b FROM lineitem)
WHERE a <> b""",
    "check_rates": f"""
WITH {base.TRAJECTORY_SQL}
SELECT entity, cohort, ref_year FROM acc WHERE qt_base_acc > 0
  AND abs(100.0 * qt_dropped_acc / qt_base_acc - floor(qt_dropped_acc * 1000 / qt_base_acc) / 10) > 0.05""",
    "check_balance": f"""
WITH {base.TRAJECTORY_SQL}
SELECT entity, cohort, ref_year FROM acc
WHERE qt_stayed + qt_completed_acc + qt_dropped_acc + qt_excluded <> qt_entrants""",
    "check_coverage": """
SELECT count(*) AS total, count(user_id) AS found, count(user_id) / count(*) AS ratio
FROM (SELECT DISTINCT c_custkey FROM customer) c
LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON c_custkey = user_id
HAVING count(user_id) / count(*) < 0.5""",
    "check_not_null": f"WITH {base.TEXT_EVENTS_SQL} SELECT * FROM texts WHERE kind IS NULL",
    "check_accepted": f"""
WITH {base.TEXT_EVENTS_SQL} SELECT event_id, kind FROM texts WHERE kind NOT IN ('view', 'click')""",
    "check_cast_loss": f"""
WITH {DIRTY_SQL}
SELECT event_id, int_text FROM dirty
WHERE trim(int_text) <> '' AND NOT regexp_full_match(trim(int_text), '[+-]?[0-9]+')""",
    "check_contract": """
SELECT difference, nu_rows FROM (SELECT count(*) AS nu_rows FROM orders),
  (VALUES ('missing o_custkey int'), ('missing o_note string'), ('unexpected o_custkey bigint')) d(difference)""",
    "check_suite": f"""
WITH {base.TRAJECTORY_SQL},
c AS (
  SELECT 'entrants_positive' AS "check", count(*) FILTER (WHERE qt_entrants < 1) AS violations FROM acc
  UNION ALL SELECT 'step_in_range', count(*) FILTER (WHERE step NOT BETWEEN 1 AND 4) FROM acc
  UNION ALL SELECT 'flows_balance', count(*) FILTER (WHERE
    qt_stayed + qt_completed_acc + qt_dropped_acc + qt_excluded_acc <> qt_entrants) FROM acc
  UNION ALL SELECT 'sector_known', count(*) FILTER (WHERE sector IS NULL) FROM acc
  UNION ALL SELECT 'type_accepted', count(*) FILTER (WHERE p_type NOT IN ('ECONOMY', 'STANDARD'))
    FROM acc
  UNION ALL SELECT 'line_grain', count(*) FROM (
    SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM c""",
}
