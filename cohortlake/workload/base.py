"""Driver tables seen as trajectories, yearly records, run logs and dirty text.

Every relation covers its whole source tables. Each has its SQL counterpart here, so that
the oracle of a query is written without the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.session import table

# Which order priorities count as funded and which part types as public.
FUNDED = ("1-URGENT", "2-HIGH")
PUBLIC_TYPES = ("ECONOMY", "STANDARD", "SMALL")


def flows(spark: SparkSession, sf: str, key: str = "l_partkey") -> DataFrame:
    """Lines shipped in each year since their order year, per entity and order year."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", key, "l_returnflag", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    return (
        both.where("l_shipdate >= o_orderdate")
        .groupBy(
            F.col(key).alias("entity"),
            F.year("o_orderdate").cast("bigint").alias("cohort"),
            F.year("l_shipdate").cast("bigint").alias("ref_year"),
        )
        .agg(
            F.count(F.lit(1)).alias("entered"),
            F.count_if(flag == "R").alias("qt_dropped"),
            F.count_if(flag == "A").alias("qt_completed"),
            F.count_if(flag == "N").alias("qt_excluded"),
        )
    )


def part_entities(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("entity"),
        "p_name",
        "p_brand",
        "p_type",
        F.when(F.col("p_type").isin(*PUBLIC_TYPES), "Public").otherwise("Private").alias("sector"),
    )


def supplier_entities(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = table(spark, sf, "supplier")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("entity"),
        "s_name",
        "n_name",
        "r_name",
        F.when(F.col("s_acctbal") > 5000, "Public").otherwise("Private").alias("sector"),
    )


def dense_trajectory(flow_rows: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per entity, order year and reference year, without holes between the years.

    The missing years are generated from the gap to the next present year, inside the group
    that later windows use; no second relation of years is joined.
    """
    attributes = [c for c in entities.columns if c != "entity"]
    group = Window.partitionBy("entity", "cohort")
    order = group.orderBy("ref_year")
    # The whole group under the same order: all window values share one sort.
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = ["qt_dropped", "qt_completed", "qt_excluded"]
    start = F.when(F.row_number().over(order) == 1, F.col("cohort")).otherwise(F.col("ref_year"))
    stop = F.coalesce(F.lead("ref_year").over(order) - 1, F.col("ref_year"))
    dense = (
        flow_rows.join(entities, "entity")
        .withColumn("qt_entrants", F.sum("entered").over(whole))
        .withColumn("_years", F.sequence(start, stop))
        .withColumn("year", F.explode("_years"))
    )
    present = F.col("year") == F.col("ref_year")
    rows = dense.select(
        "entity",
        *attributes,
        "cohort",
        F.col("year").alias("ref_year"),
        (F.col("year") - F.col("cohort") + 1).alias("step"),
        "qt_entrants",
        *[F.when(present, F.col(c)).otherwise(F.lit(0)).alias(c) for c in counts],
    )
    past = group.orderBy("ref_year").rowsBetween(Window.unboundedPreceding, 0)
    gone = F.sum(sum((F.col(c) for c in counts[1:]), F.col(counts[0]))).over(past)
    return rows.withColumn("qt_stayed", F.col("qt_entrants") - gone)


def trajectory(spark: SparkSession, sf: str) -> DataFrame:
    return dense_trajectory(flows(spark, sf), part_entities(spark, sf))


def supplier_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    return dense_trajectory(flows(spark, sf, "l_suppkey"), supplier_entities(spark, sf))


def yearly_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per year, customer and priority; status O stays, P pauses, F leaves."""
    status = F.col("o_orderstatus")
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey"
    )
    counts = (
        table(spark, sf, "orders")
        .groupBy(
            F.year("o_orderdate").cast("bigint").alias("year"), "o_custkey", "o_orderpriority"
        )
        .agg(
            F.count(F.lit(1)).alias("nu_seats"),
            F.count_if(status == "O").alias("qt_enrolled"),
            F.count_if(status == "P").alias("qt_paused"),
            F.count_if(status == "F").alias("qt_left"),
        )
    )
    return counts.join(people, "o_custkey")


def customer_years(spark: SparkSession, sf: str) -> DataFrame:
    """One row per year and customer, with the funded part of each count."""
    from cohortlake.operators.cohorts import entity_year

    funded = F.col("o_orderpriority").isin(*FUNDED)
    return entity_year(
        yearly_orders(spark, sf),
        ["year", "o_custkey"],
        ["c_name", "c_mktsegment", "c_nationkey"],
        {
            "nu_seats": "nu_seats",
            "qt_enrolled": "qt_enrolled",
            "qt_paused": "qt_paused",
            "qt_left": "qt_left",
            "qt_enrolled_funded": F.when(funded, F.col("qt_enrolled")).otherwise(F.lit(0)),
            "qt_enrolled_urgent": F.when(
                F.col("o_orderpriority") == FUNDED[0], F.col("qt_enrolled")
            ).otherwise(F.lit(0)),
        },
        rows="nu_priorities",
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as load runs: source = type, rows = value, failed where k is above 79."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("batch"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=k.cast("decimal(18,6)"))).alias("finished_at"),
        F.when(k > 79, "failed").otherwise("success").alias("status"),
        F.floor(F.col("value")).cast("bigint").alias("rows_loaded"),
        k.alias("units"),
    )


def text_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as landed text: errors lack a value, signups carry an unreadable one."""
    value = F.col("value").cast("decimal(18,2)").cast("string")
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(kind == "error", F.lit(None)).otherwise(kind).alias("kind"),
        F.when(kind == "error", F.lit(None))
        .when(kind == "signup", F.concat(F.lit("n/a "), value))
        .otherwise(value)
        .alias("amount"),
        "props",
    )


# ---- the same relations for the oracle -------------------------------------------------------

PUBLIC_SQL = ", ".join(f"'{t}'" for t in PUBLIC_TYPES)
FUNDED_SQL = ", ".join(f"'{t}'" for t in FUNDED)

PART_ENTITIES_SQL = f"""
entities AS (
  SELECT p_partkey AS entity, p_name, p_brand, p_type,
         CASE WHEN p_type IN ({PUBLIC_SQL}) THEN 'Public' ELSE 'Private' END AS sector FROM part)"""

SUPPLIER_ENTITIES_SQL = """
entities AS (
  SELECT s_suppkey AS entity, s_name, n_name, r_name,
         CASE WHEN s_acctbal > 5000 THEN 'Public' ELSE 'Private' END AS sector
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _trajectory_sql(key: str, entities: str) -> str:
    return f"""
flows AS (
  SELECT {key} AS entity, year(o_orderdate) AS cohort, year(l_shipdate) AS ref_year,
         count(*) AS entered,
         count(*) FILTER (WHERE l_returnflag = 'R') AS qt_dropped,
         count(*) FILTER (WHERE l_returnflag = 'A') AS qt_completed,
         count(*) FILTER (WHERE l_returnflag = 'N') AS qt_excluded
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_shipdate >= o_orderdate GROUP BY 1, 2, 3),
{entities},
heads AS (SELECT entity, cohort, sum(entered)::BIGINT AS qt_entrants, max(ref_year) AS last_ref
          FROM flows GROUP BY 1, 2),
spine AS (SELECT entity, cohort, qt_entrants, unnest(range(cohort, last_ref + 1)) AS ref_year
          FROM heads),
dense AS (
  SELECT e.*, s.cohort, s.ref_year, s.ref_year - s.cohort + 1 AS step, s.qt_entrants,
         coalesce(qt_dropped, 0) AS qt_dropped, coalesce(qt_completed, 0) AS qt_completed,
         coalesce(qt_excluded, 0) AS qt_excluded
  FROM spine s LEFT JOIN flows f
    ON s.entity = f.entity AND s.cohort = f.cohort AND s.ref_year = f.ref_year
  JOIN entities e ON e.entity = s.entity),
acc AS (
  SELECT *,
         sum(qt_dropped) OVER w::BIGINT AS qt_dropped_acc,
         sum(qt_completed) OVER w::BIGINT AS qt_completed_acc,
         sum(qt_excluded) OVER w::BIGINT AS qt_excluded_acc,
         (qt_entrants - sum(qt_excluded) OVER w)::BIGINT AS qt_base_acc,
         (qt_entrants - sum(qt_dropped + qt_completed + qt_excluded) OVER w)::BIGINT AS qt_stayed,
         max(ref_year) OVER (PARTITION BY entity, cohort) AS last_year
  FROM dense
  WINDOW w AS (PARTITION BY entity, cohort ORDER BY ref_year
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _milestone_sql(attributes: str) -> str:
    picked = ", ".join(f"min({a}) AS {a}" for a in attributes.split())
    return f""",
mile AS (
  SELECT entity, cohort, {picked}, max(qt_entrants) AS qt_entrants,
         max(qt_dropped_acc) FILTER (WHERE step = 4) AS qt_dropped_step,
         max(qt_completed_acc) FILTER (WHERE step = 4) AS qt_completed_step,
         max(qt_base_acc) FILTER (WHERE step = 4) AS qt_base_step,
         bool_or(step = 4) AS has_step,
         max(qt_dropped_acc) FILTER (WHERE ref_year = last_year) AS qt_dropped_final,
         max(qt_completed_acc) FILTER (WHERE ref_year = last_year) AS qt_completed_final,
         max(qt_stayed) FILTER (WHERE ref_year = last_year) AS qt_stayed_final,
         max(qt_base_acc) FILTER (WHERE ref_year = last_year) AS qt_base_final,
         max(last_year) AS last_year
  FROM acc GROUP BY 1, 2)"""


TRAJECTORY_SQL = _trajectory_sql("l_partkey", PART_ENTITIES_SQL)
MILESTONE_SQL = TRAJECTORY_SQL + _milestone_sql("p_name p_brand p_type sector")
SUPPLIER_MILESTONE_SQL = _trajectory_sql("l_suppkey", SUPPLIER_ENTITIES_SQL) + _milestone_sql(
    "s_name n_name r_name sector"
)

YEARLY_SQL = """
yearly AS (
  SELECT year(o_orderdate) AS year, o_custkey, o_orderpriority,
         count(*) AS nu_seats,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS qt_enrolled,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS qt_paused,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS qt_left
  FROM orders GROUP BY 1, 2, 3)"""

CUSTOMER_YEARS_SQL = (
    YEARLY_SQL
    + f""",
custyears AS (
  SELECT year, o_custkey, min(c_name) AS c_name, min(c_mktsegment) AS c_mktsegment,
         min(c_nationkey) AS c_nationkey, count(*) AS nu_priorities,
         sum(nu_seats)::BIGINT AS nu_seats, sum(qt_enrolled)::BIGINT AS qt_enrolled,
         sum(qt_paused)::BIGINT AS qt_paused, sum(qt_left)::BIGINT AS qt_left,
         sum(CASE WHEN o_orderpriority IN ({FUNDED_SQL}) THEN qt_enrolled ELSE 0 END)::BIGINT
           AS qt_enrolled_funded,
         sum(CASE WHEN o_orderpriority = '{FUNDED[0]}' THEN qt_enrolled ELSE 0 END)::BIGINT
           AS qt_enrolled_urgent
  FROM yearly JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""
)

RUNS_SQL = """
runs AS (
  SELECT event_type AS source, event_id AS run_id, user_id AS batch, ts AS started_at,
         ts + to_seconds(json_extract_string(props, '$.k')::BIGINT) AS finished_at,
         CASE WHEN json_extract_string(props, '$.k')::BIGINT > 79 THEN 'failed'
              ELSE 'success' END AS status,
         floor(value)::BIGINT AS rows_loaded, json_extract_string(props, '$.k')::BIGINT AS units
  FROM events)"""

TEXT_EVENTS_SQL = """
texts AS (
  SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS kind,
         CASE WHEN event_type = 'error' THEN NULL
              WHEN event_type = 'signup' THEN 'n/a ' || value::DECIMAL(18,2)::VARCHAR
              ELSE value::DECIMAL(18,2)::VARCHAR END AS amount, props
  FROM events)"""


def sql_rate(num: str, den: str) -> str:
    """Half-up percentage with two digits of non-negative counts, in whole numbers."""
    return f"CASE WHEN ({den}) > 0 THEN ((20000 * ({num}) + ({den})) // (2 * ({den}))) / 100.0 END"


def sql_mask(value: str) -> str:
    return f"CASE WHEN ({value}) BETWEEN 1 AND 9 THEN NULL ELSE ({value})::BIGINT END"
