"""Outcome against quality, social profile, exam and supply on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import measures as m
from cohortlake.functions.text import band_label, code_label, score_band
from cohortlake.operators import cohorts, profiles
from cohortlake.operators.latest import latest_per_key
from cohortlake.session import cut_lineage
from cohortlake.workload import base
from cohortlake.workload.base import sql_mask as M
from cohortlake.workload.base import sql_rate as R

# Editions that count, and labels of codes.
EDITIONS = (1996, 1997, 1998)
SIZE_LABELS = {1: "Tiny", 2: "Small", 3: "Medium", 4: "Large"}
SUMS = [
    "qt_entrants",
    "qt_dropped_step",
    "qt_base_step",
    "qt_base_final",
    "qt_completed_final",
    "qt_dropped_final",
]


def quality_editions(spark: SparkSession, sf: str) -> DataFrame:
    """Score, secondary scores and band per supplier and ship year."""
    lines = base.table(spark, sf, "lineitem")
    rows = F.count(F.lit(1))
    cents = F.sum(F.round(F.col("l_discount") * 100).cast("bigint"))
    taxes = F.sum(F.round(F.col("l_tax") * 100).cast("bigint"))
    grouped = lines.groupBy(
        F.col("l_suppkey").alias("entity"), F.year("l_shipdate").cast("bigint").alias("edition")
    ).agg(
        (F.sum("l_quantity") / rows).alias("score"),
        (cents / rows).alias("discount_score"),
        (taxes / rows).alias("tax_score"),
        rows.alias("_rows"),
        cents.alias("_cents"),
    )
    number = F.floor((F.col("_cents") * 3 / F.col("_rows"))) - 10
    text = F.when(F.col("_rows") < 60, F.lit(" sc ")).otherwise(number.cast("string"))
    return grouped.select(
        "entity", "edition", "score", "discount_score", "tax_score", score_band(text).alias("band")
    )


def latest_quality(spark: SparkSession, sf: str) -> DataFrame:
    editions = quality_editions(spark, sf).where(F.col("edition").isin(*EDITIONS))
    return latest_per_key(editions, ["entity"], [F.col("edition")])


def outcome(spark: SparkSession, sf: str) -> DataFrame:
    rows = cohorts.milestone(
        cohorts.accumulate(base.supplier_trajectory(spark, sf)),
        ["s_name", "n_name", "r_name", "sector"],
    )
    return profiles.entity_outcome(
        rows,
        "entity",
        ["s_name", "n_name", "r_name", "sector"],
        "cohort",
        SUMS,
        latest_quality(spark, sf),
        "has_quality",
    )


def latest_order(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders")
    return latest_per_key(
        orders,
        ["o_custkey"],
        [F.col("o_orderdate"), F.col("o_orderkey")],
        keep=["o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"],
    )


def outcome_with_quality(spark: SparkSession, sf: str) -> DataFrame:
    return (
        outcome(spark, sf)
        .where(F.col("qt_entrants") >= m.MIN_CELL)
        .select(
            "entity",
            "s_name",
            "r_name",
            "sector",
            "nu_cohorts",
            "first_cohort",
            "last_cohort",
            m.mask_count(F.col("qt_entrants")).alias("qt_entrants"),
            m.mask_count(F.col("qt_dropped_step")).alias("qt_dropped_step"),
            "drop_rate_step",
            "edition",
            "band",
            "score",
            "has_quality",
            m.eligible(F.col("qt_entrants")).alias("is_ranking_eligible"),
        )
    )


def outcome_by_band(spark: SparkSession, sf: str) -> DataFrame:
    label = band_label(F.col("band"), "Not assessed", "No score (SC)")
    return profiles.outcome_by_band(
        outcome(spark, sf), label, "r_name", "qt_entrants", "qt_dropped_step", "qt_base_step"
    )


def factor_correlation(spark: SparkSession, sf: str) -> DataFrame:
    rows = outcome(spark, sf).where(
        F.col("has_quality") & (F.col("qt_entrants") >= m.MIN_BASE_RANKING)
    )
    factors = {
        "Score": F.col("score"),
        "Discount score": F.col("discount_score"),
        "Tax score": F.col("tax_score"),
        "Band": F.col("band").try_cast("int"),
        "Cohorts": F.col("nu_cohorts"),
        "Constant": F.lit(1),
        "Private sector": (F.col("sector") == "Private").cast("int"),
    }
    return profiles.factor_correlations(rows, factors, F.col("drop_rate_step"))


def supplier_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Line counts per supplier by order priority and outcome, in one join and one aggregate."""
    lines = base.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    orders = base.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    priority, flag = F.col("o_orderpriority"), F.col("l_returnflag")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_suppkey").alias("entity"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(priority == "1-URGENT").alias("urgent"),
            F.count_if(priority == "2-HIGH").alias("high"),
            F.count_if(priority == "5-LOW").alias("low"),
            F.count_if(flag == "R").alias("returned"),
            F.count_if(flag == "A").alias("accepted"),
        )
    )


def social_long(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n")
    return profiles.factor_shares(
        supplier_profile(spark, sf),
        "entity",
        {
            "Urgent orders": (F.col("urgent"), n),
            "High priority": (F.col("high"), n),
            "Low priority": (F.col("low"), n),
            "Funded (any)": (m.zero_sum(F.col("urgent"), F.col("high")), n),
            "Returned over decided": (F.col("returned"), F.col("returned") + F.col("accepted")),
            "Above its base": (n, F.col("accepted")),
        },
    )


def social_profile(spark: SparkSession, sf: str) -> DataFrame:
    share = F.round("share", 6).cast("double")
    return social_long(spark, sf).select("entity", "factor", share.alias("share"))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    return (
        outcome(spark, sf)
        .where(F.col("qt_entrants") >= m.MIN_BASE_RANKING)
        .select("entity", "sector", "qt_entrants", "qt_dropped_step", "qt_base_step")
    )


def outcome_by_factor_quartile(spark: SparkSession, sf: str) -> DataFrame:
    rows = social_long(spark, sf).join(_ranked(spark, sf), "entity")
    return profiles.outcome_by_factor_quartile(
        rows, "entity", "qt_entrants", "qt_dropped_step", "qt_base_step"
    )


def outcome_by_quartile(spark: SparkSession, sf: str) -> DataFrame:
    shares = supplier_profile(spark, sf).select(
        "entity", m.share(m.zero_sum(F.col("urgent"), F.col("high")), F.col("n")).alias("share")
    )
    rows = shares.join(_ranked(spark, sf).where("sector = 'Private'"), "entity")
    return profiles.outcome_by_quartile(
        rows.where("share is not null"), "entity", "qt_entrants", "qt_dropped_step", "qt_base_step"
    )


def exam(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the last ship year as an exam: quantity above 25 is proficient.

    The percentage arrives as a fraction and its scale is repaired from the data.
    """
    lines = base.table(spark, sf, "lineitem")
    lines = lines.where(F.year("l_shipdate") == lines.agg(F.max(F.year("l_shipdate"))).scalar())
    counts = lines.groupBy(F.col("l_suppkey").alias("entity")).agg(
        F.count(F.lit(1)).alias("qt_participants"),
        F.count_if(F.col("l_quantity") > 25).alias("qt_proficient"),
    )
    fraction = m.exact_rate(F.col("qt_proficient"), F.col("qt_participants"), 1, 4)
    raw = counts.withColumn("fraction", fraction)
    return profiles.repair_scale(raw, "fraction", "pct").select(
        "entity",
        "qt_participants",
        "qt_proficient",
        F.col("pct").cast("double").alias("pct_proficient"),
    )


def program_with_exam(spark: SparkSession, sf: str) -> DataFrame:
    rows = outcome(spark, sf).where("sector = 'Public'")
    return profiles.program_with_exam(rows, exam(spark, sf), "entity", ["s_name", "r_name"])


def funnel_relation(spark: SparkSession, sf: str) -> DataFrame:
    rows = outcome(spark, sf).join(exam(spark, sf), "entity", "left")
    return profiles.funnel_with_total(rows, "r_name")


def deserts(spark: SparkSession, sf: str) -> DataFrame:
    nations = base.table(spark, sf, "nation").select("n_nationkey", "n_name")
    people = (
        base.table(spark, sf, "customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("nu_population"))
        .join(nations, "n_nationkey")
    )
    shipped = (
        base.table(spark, sf, "lineitem")
        .where("l_returnflag = 'R' and l_linestatus = 'F'")
        .groupBy(F.year("l_shipdate").cast("bigint").alias("year"), "l_suppkey")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("nu_seats"),
            F.count(F.lit(1)).alias("qt_entrants"),
        )
    )
    # One row per year and supplier, written once: the latest year is asked of it three times.
    shipped = cut_lineage(shipped, "shipped")
    places = base.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    return profiles.supply_gaps(
        people,
        shipped.join(places, "l_suppkey"),
        "n_nationkey",
        "year",
        "l_suppkey",
        "nu_seats",
        "qt_entrants",
        "n_name",
    )


def financing_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.funding_by_year(
        base.customer_years(spark, sf),
        "year",
        "c_mktsegment",
        {"qt_enrolled": ["qt_enrolled_funded", "qt_enrolled_urgent"]},
        base="qt_enrolled",
    )


def scale_repair(spark: SparkSession, sf: str) -> DataFrame:
    lines = base.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                     "l_discount", "l_quantity")
    small = profiles.repair_scale(lines, "l_discount", "discount_pct")
    both = profiles.repair_scale(small, "l_quantity", "quantity_pct")
    return both.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round("discount_pct", 6).alias("discount_pct"),
        "quantity_pct",
    )


def code_maps(spark: SparkSession, sf: str) -> DataFrame:
    parts = base.table(spark, sf, "part")
    size = F.floor((F.col("p_size") - 1) / 10).cast("int")
    return parts.select(
        "p_partkey",
        code_label(size, SIZE_LABELS).alias("size_label"),
        F.coalesce(code_label(size, SIZE_LABELS), F.lit("Unknown")).alias("size_or_unknown"),
    )


def weighted_percentage(spark: SparkSession, sf: str) -> DataFrame:
    """Share of large lines per supplier and flag: from hits where known, else a weighted mean."""
    lines = base.table(spark, sf, "lineitem")
    counts = lines.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") > 25).alias("hits")
    )
    pct = F.when(F.col("hits") > 0, m.exact_rate(F.col("hits"), F.col("n")))
    known = F.when(F.col("l_returnflag") != "N", F.col("hits"))
    rows = counts.withColumn("pct", pct).withColumn("hits", known)
    total = m.weighted_percentage(F.col("hits"), F.col("n"), F.col("pct"))
    return rows.groupBy("l_suppkey", "l_returnflag").agg(
        F.round(total, 4).cast("double").alias("pct_large")
    )


QUERIES = {
    "latest_per_key": latest_order,
    "quality_editions": quality_editions,
    "latest_quality": latest_quality,
    "outcome_with_quality": outcome_with_quality,
    "outcome_by_band": outcome_by_band,
    "factor_correlation": factor_correlation,
    "social_profile": social_profile,
    "outcome_by_factor_quartile": outcome_by_factor_quartile,
    "outcome_by_quartile": outcome_by_quartile,
    "program_with_exam": program_with_exam,
    "funnel_total": funnel_relation,
    "deserts": deserts,
    "financing_by_year": financing_by_year,
    "scale_repair": scale_repair,
    "code_maps": code_maps,
    "weighted_percentage": weighted_percentage,
}

EDITIONS_SQL = """
editions AS (
  SELECT entity, edition, score, discount_score, tax_score,
         CASE WHEN n < 60 THEN 'SC'
              WHEN floor(cents * 3 / n) - 10 BETWEEN 1 AND 5
              THEN (floor(cents * 3 / n) - 10)::BIGINT::VARCHAR END AS band
  FROM (SELECT l_suppkey AS entity, year(l_shipdate) AS edition, count(*) AS n,
               sum(round(l_discount * 100)::BIGINT)::BIGINT AS cents,
               sum(l_quantity) / count(*) AS score,
               sum(round(l_discount * 100)::BIGINT)::BIGINT / count(*) AS discount_score,
               sum(round(l_tax * 100)::BIGINT)::BIGINT / count(*) AS tax_score
        FROM lineitem GROUP BY 1, 2))"""
LATEST_SQL = f"""{EDITIONS_SQL},
latest AS (SELECT * FROM editions WHERE edition IN {EDITIONS}
           QUALIFY row_number() OVER (PARTITION BY entity ORDER BY edition DESC) = 1)"""
OUTCOME_SQL = f"""{base.SUPPLIER_MILESTONE_SQL},
{LATEST_SQL},
sums AS (
  SELECT entity, min(s_name) AS s_name, min(n_name) AS n_name, min(r_name) AS r_name,
         min(sector) AS sector, count(*) AS nu_cohorts, min(cohort) AS first_cohort,
         max(cohort) AS last_cohort, {", ".join(f"sum({c})::BIGINT AS {c}" for c in SUMS)}
  FROM mile WHERE has_step GROUP BY 1),
outcome AS (
  SELECT s.*, {R("qt_dropped_step", "qt_base_step")} AS drop_rate_step, l.edition, l.score,
         l.discount_score, l.tax_score, l.band, l.entity IS NOT NULL AS has_quality
  FROM sums s LEFT JOIN latest l ON s.entity = l.entity)"""
PROFILE_SQL = """
prof AS (
  SELECT l_suppkey AS entity, count(*) AS n,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
         count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high,
         count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         count(*) FILTER (WHERE l_returnflag = 'A') AS accepted
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
long AS (
  SELECT entity, factor, least(part, whole) AS part, whole FROM (
    SELECT entity, 'Urgent orders' AS factor, urgent AS part, n AS whole FROM prof
    UNION ALL SELECT entity, 'High priority', high, n FROM prof
    UNION ALL SELECT entity, 'Low priority', low, n FROM prof
    UNION ALL SELECT entity, 'Funded (any)', urgent + high, n FROM prof
    UNION ALL SELECT entity, 'Returned over decided', returned, returned + accepted FROM prof
    UNION ALL SELECT entity, 'Above its base', n, accepted FROM prof)
  WHERE whole > 0)"""
EXAM_SQL = """
exam AS (
  SELECT entity, qt_participants, qt_proficient,
         ((20000 * qt_proficient + qt_participants) // (2 * qt_participants)) / 100.0
           AS pct_proficient
  FROM (SELECT l_suppkey AS entity, count(*) AS qt_participants,
               count(*) FILTER (WHERE l_quantity > 25) AS qt_proficient
        FROM lineitem WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem) GROUP BY 1))"""
QUARTILE_COLUMNS_SQL = f"""
       min((20000 * part + whole) // (2 * whole)) / 100.0 AS pct_min,
       max((20000 * part + whole) // (2 * whole)) / 100.0 AS pct_max,
       count(*) AS nu_entities, {M("sum(qt_entrants)")} AS qt_entrants,
       {M("sum(qt_dropped_step)")} AS qt_dropped_step,
       {R("sum(qt_dropped_step)::BIGINT", "sum(qt_base_step)::BIGINT")} AS drop_rate_step"""

ORACLE = {
    "latest_per_key": """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "quality_editions": f"WITH {EDITIONS_SQL} SELECT * FROM editions",
    "latest_quality": f"WITH {LATEST_SQL} SELECT * FROM latest",
    "outcome_with_quality": f"""
WITH {OUTCOME_SQL}
SELECT entity, s_name, r_name, sector, nu_cohorts, first_cohort, last_cohort,
       {M("qt_entrants")} AS qt_entrants, {M("qt_dropped_step")} AS qt_dropped_step,
       drop_rate_step, edition, band, score, has_quality, qt_entrants >= 30 AS is_ranking_eligible
FROM outcome WHERE qt_entrants >= 10""",
    "outcome_by_band": f"""
WITH {OUTCOME_SQL},
g AS (
  SELECT CASE WHEN band IS NULL THEN 'Not assessed' WHEN band = 'SC' THEN 'No score (SC)'
              ELSE band END AS band, r_name, count(*) AS nu_entities,
         sum(qt_entrants)::BIGINT AS e, sum(qt_dropped_step)::BIGINT AS d,
         sum(qt_base_step)::BIGINT AS b
  FROM outcome GROUP BY 1, 2)
SELECT band, r_name, nu_entities, {M("e")} AS qt_entrants, {M("d")} AS qt_dropped_step,
       {R("d", "b")} AS drop_rate_step FROM g WHERE e >= 10""",
    "factor_correlation": f"""
WITH {OUTCOME_SQL},
rows_ AS (SELECT * FROM outcome WHERE has_quality AND qt_entrants >= 30),
f AS (
  SELECT 'Score' AS factor, score::DOUBLE AS x, drop_rate_step AS y FROM rows_
  UNION ALL SELECT 'Discount score', discount_score, drop_rate_step FROM rows_
  UNION ALL SELECT 'Tax score', tax_score, drop_rate_step FROM rows_
  UNION ALL SELECT 'Band', TRY_CAST(band AS INTEGER), drop_rate_step FROM rows_
  UNION ALL SELECT 'Cohorts', nu_cohorts, drop_rate_step FROM rows_
  UNION ALL SELECT 'Constant', 1, drop_rate_step FROM rows_
  UNION ALL SELECT 'Private sector', (sector = 'Private')::INT, drop_rate_step FROM rows_),
c AS (SELECT factor, corr(x, y) AS r, count(x) AS n, stddev_pop(x) AS sx, stddev_pop(y) AS sy
      FROM f GROUP BY 1)
SELECT factor, CASE WHEN sx > 0 AND sy > 0 THEN round(r, 3) END AS pearson, n AS nu_entities
FROM c WHERE n >= 10""",
    "social_profile": f"""
WITH {PROFILE_SQL}
SELECT entity, factor, ((2000000 * part + whole) // (2 * whole)) / 1000000.0 AS share FROM long""",
    "outcome_by_factor_quartile": f"""
WITH {OUTCOME_SQL}, {PROFILE_SQL},
j AS (
  SELECT l.factor, l.part, l.whole, l.part / l.whole AS share, o.*,
         ntile(4) OVER (PARTITION BY l.factor ORDER BY l.part / l.whole, l.entity) AS quartile
  FROM long l JOIN outcome o ON l.entity = o.entity WHERE o.qt_entrants >= 30),
c AS (SELECT factor, CASE WHEN stddev_pop(share) > 0 THEN
               round(corr(share, 100.0 * qt_dropped_step / nullif(qt_base_step, 0)), 3) END
             AS pearson FROM j GROUP BY 1)
SELECT j.factor, quartile, {QUARTILE_COLUMNS_SQL}, max(c.pearson) AS pearson
FROM j JOIN c ON j.factor = c.factor GROUP BY 1, 2 HAVING sum(qt_entrants) >= 10""",
    "outcome_by_quartile": f"""
WITH {OUTCOME_SQL}, {PROFILE_SQL},
j AS (
  SELECT l.part, l.whole, o.*, ntile(4) OVER (ORDER BY l.part / l.whole, l.entity) AS quartile
  FROM long l JOIN outcome o ON l.entity = o.entity
  WHERE l.factor = 'Funded (any)' AND o.qt_entrants >= 30 AND o.sector = 'Private')
SELECT quartile, {QUARTILE_COLUMNS_SQL} FROM j GROUP BY 1 HAVING sum(qt_entrants) >= 10""",
    "program_with_exam": f"""
WITH {OUTCOME_SQL}, {EXAM_SQL}
SELECT o.entity, s_name, r_name, nu_cohorts, {M("qt_entrants")} AS qt_entrants, drop_rate_step,
       {R("qt_dropped_final", "qt_base_final")} AS drop_rate_final,
       {R("qt_completed_final", "qt_base_final")} AS completion_rate_final,
       {M("qt_participants")} AS qt_participants, {M("qt_proficient")} AS qt_proficient,
       CASE WHEN qt_participants >= 10 THEN pct_proficient END AS pct_proficient,
       e.entity IS NOT NULL AS has_exam
FROM outcome o LEFT JOIN exam e ON o.entity = e.entity
WHERE sector = 'Public' AND qt_entrants >= 10""",
    "funnel_total": f"""
WITH {OUTCOME_SQL}, {EXAM_SQL},
g AS (
  SELECT CASE WHEN grouping(r_name) = 1 THEN 'Total' ELSE r_name END AS r_name,
         count(*) AS nu_entities, sum(qt_entrants)::BIGINT AS e, sum(qt_base_final)::BIGINT AS b,
         sum(qt_dropped_final)::BIGINT AS d, sum(qt_completed_final)::BIGINT AS c,
         count(pct_proficient) AS nu_with_exam,
         sum(qt_participants) FILTER (WHERE pct_proficient IS NOT NULL)::BIGINT AS p,
         sum(qt_proficient) FILTER (WHERE pct_proficient IS NOT NULL)::BIGINT AS h
  FROM outcome o LEFT JOIN exam x ON o.entity = x.entity
  GROUP BY GROUPING SETS ((r_name), ()))
SELECT r_name, nu_entities, {M("e")} AS qt_entrants, {R("d", "b")} AS of_100_dropped,
       {R("c", "b")} AS of_100_completed, nu_with_exam, {M("p")} AS qt_participants,
       CASE WHEN p >= 10 THEN {R("h", "p")} END AS pct_proficient,
       CASE WHEN p >= 10 THEN
         ((2 * ((20000 * c + b) // (2 * b)) * h + p) // (2 * p)) / 100.0 END AS of_100_proficient
FROM g WHERE e >= 10""",
    "deserts": f"""
WITH people AS (SELECT c_nationkey AS n_nationkey, min(n_name) AS n_name, count(*) AS nu_population
                FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
shipped AS (
  SELECT year(l_shipdate) AS year, s_nationkey AS n_nationkey, l_suppkey,
         sum(l_quantity::BIGINT)::BIGINT AS seats, count(*) AS entrants
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1, 2, 3),
offered AS (
  SELECT n_nationkey, count(DISTINCT l_suppkey) AS offers, sum(seats)::BIGINT AS seats,
         sum(entrants)::BIGINT AS entrants
  FROM shipped WHERE year = (SELECT max(year) FROM shipped) GROUP BY 1),
j AS (
  SELECT p.*, coalesce(offers, 0) AS nu_offers, coalesce(seats, 0) AS nu_seats,
         coalesce(entrants, 0) AS ent
  FROM people p LEFT JOIN offered o ON p.n_nationkey = o.n_nationkey)
SELECT n_nationkey, n_name, (SELECT max(year) FROM shipped) AS year, nu_population, nu_offers,
       nu_seats, {R("nu_seats", "nu_population")} AS seats_per_100, {M("ent")} AS qt_entrants,
       CASE WHEN ent NOT BETWEEN 1 AND 9 THEN {R("ent", "nu_population")} END AS entrants_per_100,
       nu_seats = 0 AS is_gap
FROM j""",
    "financing_by_year": f"""
WITH {base.CUSTOMER_YEARS_SQL},
g AS (
  SELECT year, c_mktsegment, count(*) AS nu_entities, sum(qt_enrolled)::BIGINT AS q,
         sum(qt_enrolled_funded)::BIGINT AS f, sum(qt_enrolled_urgent)::BIGINT AS u
  FROM custyears GROUP BY 1, 2)
SELECT year, c_mktsegment, nu_entities, {M("q")} AS qt_enrolled, {M("f")} AS qt_enrolled_funded,
       {M("u")} AS qt_enrolled_urgent, {R("f", "q")} AS pct_enrolled_funded,
       {R("u", "q")} AS pct_enrolled_urgent
FROM g WHERE q >= 10""",
    "scale_repair": """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * 100, 6) AS discount_pct,
       l_quantity AS quantity_pct FROM lineitem""",
    "code_maps": """
SELECT p_partkey,
       CASE (p_size - 1) // 10 WHEN 1 THEN 'Tiny' WHEN 2 THEN 'Small' WHEN 3 THEN 'Medium'
            WHEN 4 THEN 'Large' END AS size_label,
       CASE (p_size - 1) // 10 WHEN 1 THEN 'Tiny' WHEN 2 THEN 'Small' WHEN 3 THEN 'Medium'
            WHEN 4 THEN 'Large' ELSE 'Unknown' END AS size_or_unknown
FROM part""",
    "weighted_percentage": """
WITH c AS (
  SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n,
         count(*) FILTER (WHERE l_quantity > 25) AS hits FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT *, (20000 * hits + n) // (2 * n) AS cents FROM c WHERE hits > 0),
t AS (SELECT l_suppkey, l_returnflag, sum(n)::BIGINT AS n, sum(hits)::BIGINT AS hits,
             sum(cents * n)::BIGINT AS weighted FROM p GROUP BY 1, 2)
SELECT g.l_suppkey, g.l_returnflag,
       CASE WHEN t.n IS NULL THEN NULL
            WHEN g.l_returnflag <> 'N' THEN ((2000000 * t.hits + t.n) // (2 * t.n)) / 10000.0
            ELSE ((200 * weighted + t.n) // (2 * t.n)) / 10000.0 END AS pct_large
FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem) g
LEFT JOIN t ON t.l_suppkey = g.l_suppkey AND t.l_returnflag = g.l_returnflag""",
}
