"""Cohort curves, milestones and yearly churn on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import measures as m
from cohortlake.operators import cohorts
from cohortlake.workload import base
from cohortlake.workload.base import sql_mask as M
from cohortlake.workload.base import sql_rate as R


def accumulated(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.accumulate(base.trajectory(spark, sf))


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.milestone(
        accumulated(spark, sf), ["p_name", "p_brand", "p_type", "sector"]
    )


def trajectory_flows(spark: SparkSession, sf: str) -> DataFrame:
    return accumulated(spark, sf).select(
        "entity", "cohort", "ref_year", "step", "qt_entrants", "qt_stayed",
        "qt_dropped_acc", "qt_completed_acc", "qt_excluded_acc", "qt_base_acc", "last_year",
    )


def cohort_curve(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.curve(accumulated(spark, sf), "p_type")


def cohort_milestone(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.milestone_report(snapshot(spark, sf), ["p_name", "p_brand", "p_type"])


def milestone_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot(spark, sf)


def cohort_area(spark: SparkSession, sf: str) -> DataFrame:
    # One brand is treated as unknown, so that the label of a missing area is exercised.
    rows = accumulated(spark, sf).withColumn("area", F.nullif("p_brand", F.lit("Brand#1")))
    return cohorts.area_curve(rows, "area", "p_type", "Not informed")


def annual_churn(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.yearly_churn(
        base.customer_years(spark, sf),
        "year",
        ["c_mktsegment"],
        left="qt_left",
        enrolled="qt_enrolled",
        paused="qt_paused",
        others=[],
        plain=["nu_seats"],
    )


def customer_year_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return base.customer_years(spark, sf)


def mask_small(spark: SparkSession, sf: str) -> DataFrame:
    lines = base.table(spark, sf, "lineitem")
    counts = lines.groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "l_partkey",
        "l_returnflag",
        m.mask_count(F.col("n")).alias("qt_lines"),
        m.eligible(F.col("n")).alias("is_eligible"),
    )


def rate_table(spark: SparkSession, sf: str) -> DataFrame:
    counts = (
        base.table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count_if(F.col("l_returnflag") == "N").alias("open"),
            F.count(F.lit(1)).alias("total"),
        )
    )
    return counts.select(
        "l_suppkey",
        m.rate(F.col("returned"), F.col("total")).alias("return_rate"),
        m.rate(F.col("open"), F.col("returned")).alias("open_rate"),
        m.rate(F.col("returned"), F.col("total") - F.col("total")).alias("no_base_rate"),
        m.published_if(m.rate(F.col("open"), F.col("total")), F.col("open"), 200).alias("kept_rate"),
    )


QUERIES = {
    "cohort_curve": cohort_curve,
    "trajectory_flows": trajectory_flows,
    "cohort_milestone": cohort_milestone,
    "milestone_snapshot": milestone_snapshot,
    "cohort_area": cohort_area,
    "annual_churn": annual_churn,
    "customer_year_rollup": customer_year_rollup,
    "mask_small": mask_small,
    "rate_table": rate_table,
}

ORACLE = {
    "cohort_curve": f"""
WITH {base.TRAJECTORY_SQL},
g AS (
  SELECT p_type, cohort, ref_year, step, count(DISTINCT entity) AS nu_entities,
         sum(qt_entrants) AS qt_entrants, sum(qt_stayed) AS qt_stayed,
         sum(qt_completed) AS qt_completed, sum(qt_dropped) AS qt_dropped,
         sum(qt_excluded) AS qt_excluded, sum(qt_completed_acc) AS qt_completed_acc,
         sum(qt_dropped_acc) AS qt_dropped_acc, sum(qt_excluded_acc) AS qt_excluded_acc,
         sum(qt_base_acc) AS qt_base_acc
  FROM acc GROUP BY 1, 2, 3, 4),
r AS (SELECT *, rank() OVER (PARTITION BY p_type, cohort ORDER BY qt_dropped DESC NULLS FIRST) = 1
             AS is_worst_year FROM g)
SELECT p_type, cohort, ref_year, step, nu_entities,
       {M('qt_entrants')} AS qt_entrants, {M('qt_stayed')} AS qt_stayed,
       {M('qt_completed')} AS qt_completed, {M('qt_dropped')} AS qt_dropped,
       {M('qt_completed_acc')} AS qt_completed_acc, {M('qt_dropped_acc')} AS qt_dropped_acc,
       {M('qt_excluded_acc')} AS qt_excluded_acc,
       {R('qt_dropped_acc', 'qt_base_acc')} AS drop_rate,
       {R('qt_completed_acc', 'qt_base_acc')} AS completion_rate,
       {R('qt_stayed', 'qt_base_acc')} AS stay_rate,
       {R('qt_dropped', 'qt_base_acc')} AS yearly_drop_rate,
       {R('qt_dropped', 'qt_stayed + qt_completed + qt_dropped + qt_excluded')}
         AS drop_rate_of_active,
       is_worst_year
FROM r WHERE qt_entrants >= 10""",
    "trajectory_flows": f"""
WITH {base.TRAJECTORY_SQL}
SELECT entity, cohort, ref_year, step, qt_entrants, qt_stayed, qt_dropped_acc, qt_completed_acc,
       qt_excluded_acc, qt_base_acc, last_year FROM acc""",
    "cohort_milestone": f"""
WITH {base.MILESTONE_SQL}
SELECT entity, cohort, p_name, p_brand, p_type, 4::BIGINT AS milestone_step,
       {M('qt_entrants')} AS qt_entrants, {M('qt_dropped_step')} AS qt_dropped_step,
       {R('qt_dropped_step', 'qt_base_step')} AS drop_rate_step,
       {R('qt_completed_step', 'qt_base_step')} AS completion_rate_step, last_year,
       {R('qt_dropped_final', 'qt_base_final')} AS drop_rate_final,
       {R('qt_completed_final', 'qt_base_final')} AS completion_rate_final,
       qt_entrants >= 30 AS is_ranking_eligible
FROM mile WHERE qt_entrants >= 10 AND has_step""",
    "milestone_snapshot": f"WITH {base.MILESTONE_SQL} SELECT * FROM mile",
    "cohort_area": f"""
WITH {base.TRAJECTORY_SQL},
g AS (
  SELECT CASE WHEN p_brand = 'Brand#1' THEN 'Not informed' ELSE p_brand END AS area, p_type,
         cohort, step, count(DISTINCT entity) AS nu_entities, sum(qt_entrants) AS qt_entrants,
         sum(qt_dropped_acc) AS qt_dropped_acc, sum(qt_completed_acc) AS qt_completed_acc,
         sum(qt_base_acc) AS qt_base_acc
  FROM acc GROUP BY 1, 2, 3, 4)
SELECT area, p_type, cohort, step, nu_entities, {M('qt_entrants')} AS qt_entrants,
       {M('qt_dropped_acc')} AS qt_dropped_acc,
       {R('qt_dropped_acc', 'qt_base_acc')} AS drop_rate,
       {R('qt_completed_acc', 'qt_base_acc')} AS completion_rate
FROM g WHERE qt_entrants >= 10""",
    "annual_churn": f"""
WITH {base.CUSTOMER_YEARS_SQL},
g AS (
  SELECT year, c_mktsegment, count(*) AS nu_entities, sum(nu_seats)::BIGINT AS nu_seats,
         sum(qt_enrolled)::BIGINT AS qt_enrolled, sum(qt_paused)::BIGINT AS qt_paused,
         sum(qt_left)::BIGINT AS qt_left FROM custyears GROUP BY 1, 2),
b AS (SELECT *, qt_enrolled + qt_paused + qt_left AS qt_linked FROM g),
k AS (
  SELECT *, (20000 * qt_left + qt_linked) // (2 * qt_linked) AS churn_cents,
         lag(qt_enrolled) OVER w AS before_enrolled,
         lag((20000 * qt_left + qt_linked) // (2 * qt_linked)) OVER w AS before_cents
  FROM b WHERE qt_linked >= 10 WINDOW w AS (PARTITION BY c_mktsegment ORDER BY year))
SELECT year, c_mktsegment, nu_entities, nu_seats, {M('qt_enrolled')} AS qt_enrolled,
       {M('qt_paused')} AS qt_paused, {M('qt_left')} AS qt_left, {M('qt_linked')} AS qt_linked,
       churn_cents / 100.0 AS churn_rate, {R('qt_paused', 'qt_linked')} AS pause_rate,
       (churn_cents - before_cents) / 100.0 AS churn_change_pp,
       CASE WHEN before_enrolled > 0 THEN
         sign(qt_enrolled - before_enrolled) *
         ((20000 * abs(qt_enrolled - before_enrolled) + before_enrolled) // (2 * before_enrolled))
         / 100.0 END AS enrolled_change_pct
FROM k""",
    "customer_year_rollup": f"WITH {base.CUSTOMER_YEARS_SQL} SELECT * FROM custyears",
    "mask_small": f"""
SELECT l_partkey, l_returnflag, {M('count(*)')} AS qt_lines, count(*) >= 30 AS is_eligible
FROM lineitem GROUP BY 1, 2""",
    "rate_table": f"""
WITH c AS (
  SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         count(*) FILTER (WHERE l_returnflag = 'N') AS open, count(*) AS total
  FROM lineitem GROUP BY 1)
SELECT l_suppkey, {R('returned', 'total')} AS return_rate, {R('open', 'returned')} AS open_rate,
       CAST(NULL AS DOUBLE) AS no_base_rate,
       CASE WHEN open >= 200 THEN {R('open', 'total')} END AS kept_rate
FROM c""",
}
