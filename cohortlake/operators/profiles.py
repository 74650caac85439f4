"""Outcome by profile: shares, quartiles, correlations, bands, funnels, supply gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions import measures as m
from cohortlake.operators.ranking import selected_ntile
from cohortlake.session import cut_lineage


def _stack(labels: Sequence[str], columns: Sequence[Sequence[str]], names: Sequence[str]) -> str:
    """``stack`` expression turning one row into one row per label."""
    quoted = [label.replace("'", "\\'") for label in labels]
    rows = ", ".join(
        f"'{label}', " + ", ".join(cols) for label, cols in zip(quoted, columns, strict=True)
    )
    return f"stack({len(labels)}, {rows}) as ({', '.join(names)})"


def entity_outcome(
    snapshot: DataFrame,
    entity: str,
    attributes: Sequence[str],
    cohort: str,
    sums: Sequence[str],
    quality: DataFrame,
    presence: str,
    dropped: str = "qt_dropped_step",
    base: str = "qt_base_step",
) -> DataFrame:
    """Cohorts summed per entity where the milestone was reached, with the entity's latest score."""
    total = (
        snapshot.where("has_step")
        .groupBy(entity)
        .agg(
            *[F.min(a).alias(a) for a in attributes],
            F.count(F.lit(1)).alias("nu_cohorts"),
            F.min(cohort).alias("first_cohort"),
            F.max(cohort).alias("last_cohort"),
            *[F.sum(s).alias(s) for s in sums],
        )
    )
    scored = quality.withColumn("_found", F.lit(True))
    return (
        total.withColumn("drop_rate_step", m.rate(F.col(dropped), F.col(base)))
        .join(scored, entity, "left")
        .withColumn(presence, F.col("_found").isNotNull())
        .drop("_found")
    )


def outcome_by_band(
    outcome: DataFrame,
    band: Column,
    group: str,
    entrants: str,
    dropped: str,
    base: str,
    name: str = "band",
    min_cell: int = m.MIN_CELL,
) -> DataFrame:
    totals = outcome.groupBy(band.alias(name), group).agg(
        F.count(F.lit(1)).alias("nu_entities"),
        *[F.sum(c).alias(c) for c in (entrants, dropped, base)],
    )
    return totals.where(F.col(entrants) >= min_cell).select(
        name,
        group,
        "nu_entities",
        m.mask_count(F.col(entrants), min_cell).alias(entrants),
        m.mask_count(F.col(dropped), min_cell).alias(dropped),
        m.rate(F.col(dropped), F.col(base)).alias("drop_rate_step"),
    )


def factor_correlations(
    df: DataFrame, factors: Mapping[str, Column], outcome: Column, min_rows: int = m.MIN_CELL
) -> DataFrame:
    """Correlation of every factor with the outcome and its row count, in one pass."""
    labels = list(factors)
    aggregates = []
    for i, factor in enumerate(factors.values()):
        aggregates += [m.pearson(factor, outcome).alias(f"r{i}"), F.count(factor).alias(f"n{i}")]
    stacked = _stack(
        labels, [(f"r{i}", f"n{i}") for i in range(len(labels))], ("factor", "pearson", "nu_entities")
    )
    return df.agg(*aggregates).selectExpr(stacked).where(F.col("nu_entities") >= min_rows)


def factor_shares(
    df: DataFrame, entity: str, factors: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Long form (entity, factor, share) of several capped shares, from one row per entity."""
    labels = list(factors)
    shares = [
        m.share(part, whole).cast(T.DecimalType(38, 20)).alias(f"s{i}")
        for i, (part, whole) in enumerate(factors.values())
    ]
    stacked = _stack(labels, [(f"s{i}",) for i in range(len(labels))], ("factor", "share"))
    return df.select(entity, *shares).selectExpr(entity, stacked).where("share is not null")


def _quartile_report(
    groups: Sequence[str], placed: DataFrame, entrants: str, dropped: str, base: str, min_cell: int
) -> DataFrame:
    totals = placed.groupBy(*groups).agg(
        F.min("share").alias("_low"),
        F.max("share").alias("_high"),
        F.count(F.lit(1)).alias("nu_entities"),
        *[F.sum(c).alias(c) for c in (entrants, dropped, base)],
    )
    return totals.where(F.col(entrants) >= min_cell).select(
        *groups,
        F.round(F.col("_low") * 100, 2).cast("double").alias("pct_min"),
        F.round(F.col("_high") * 100, 2).cast("double").alias("pct_max"),
        "nu_entities",
        m.mask_count(F.col(entrants), min_cell).alias(entrants),
        m.mask_count(F.col(dropped), min_cell).alias(dropped),
        m.rate(F.col(dropped), F.col(base)).alias("drop_rate_step"),
    )


def outcome_by_quartile(
    df: DataFrame,
    entity: str,
    entrants: str,
    dropped: str,
    base: str,
    min_cell: int = m.MIN_CELL,
) -> DataFrame:
    """Quartile limits, counts and rate over all rows; ``df`` has a ``share`` column."""
    placed = selected_ntile(df, 4, "share", entity)
    return _quartile_report(["quartile"], placed, entrants, dropped, base, min_cell)


def outcome_by_factor_quartile(
    df: DataFrame,
    entity: str,
    entrants: str,
    dropped: str,
    base: str,
    min_cell: int = m.MIN_CELL,
) -> DataFrame:
    """The same per factor, with the correlation of share and outcome of the whole factor."""
    placed = selected_ntile(df, 4, "share", entity, ["factor"])
    outcome = F.col(dropped).cast("double") * 100 / F.nullif(F.col(base), F.lit(0))
    strength = placed.groupBy("factor").agg(m.pearson(F.col("share"), outcome).alias("pearson"))
    report = _quartile_report(["factor", "quartile"], placed, entrants, dropped, base, min_cell)
    return report.join(strength, "factor")


def program_with_exam(
    outcome: DataFrame,
    exam: DataFrame,
    entity: str,
    attributes: Sequence[str],
    exam_attributes: Sequence[str] = (),
    entrants: str = "qt_entrants",
    dropped: str = "qt_dropped_final",
    completed: str = "qt_completed_final",
    base: str = "qt_base_final",
    taking: str = "qt_participants",
    proficient: str = "qt_proficient",
    pct: str = "pct_proficient",
    min_cell: int = m.MIN_CELL,
) -> DataFrame:
    """Programs beside their exam result; the percentage appears only over a large enough base."""
    marked = exam.withColumn("_found", F.lit(True))
    rows = outcome.where(F.col(entrants) >= min_cell).join(marked, entity, "left")
    return rows.select(
        entity,
        *attributes,
        "nu_cohorts",
        m.mask_count(F.col(entrants), min_cell).alias(entrants),
        "drop_rate_step",
        m.rate(F.col(dropped), F.col(base)).alias("drop_rate_final"),
        m.rate(F.col(completed), F.col(base)).alias("completion_rate_final"),
        *exam_attributes,
        m.mask_count(F.col(taking), min_cell).alias(taking),
        m.mask_count(F.col(proficient), min_cell).alias(proficient),
        m.published_if(F.col(pct), F.col(taking), min_cell).alias(pct),
        F.col("_found").isNotNull().alias("has_exam"),
    )


def funnel_with_total(
    df: DataFrame,
    group: str,
    total: str = "Total",
    entrants: str = "qt_entrants",
    dropped: str = "qt_dropped_final",
    completed: str = "qt_completed_final",
    base: str = "qt_base_final",
    taking: str = "qt_participants",
    proficient: str = "qt_proficient",
    pct: str = "pct_proficient",
    min_cell: int = m.MIN_CELL,
) -> DataFrame:
    """Of 100 entrants per group and in total: dropped, completed, completed and proficient.

    Groups are summed first and the total comes from those few rows, so the data passes once.
    """
    seen = F.col(pct).isNotNull()
    sums = {
        "nu_entities": F.count(F.lit(1)),
        entrants: F.sum(entrants),
        "_base": F.sum(base),
        "_dropped": F.sum(dropped),
        "_completed": F.sum(completed),
        "nu_with_exam": F.count(pct),
        taking: F.sum(F.when(seen, F.col(taking))),
        "_hits": F.sum(F.when(seen, F.col(proficient))),
        "_weighted": F.sum((F.col(pct) * F.col(taking)).cast(T.DecimalType(30, 6))),
    }
    parts = df.groupBy(group).agg(*[v.alias(k) for k, v in sums.items()])
    cells = parts.groupingSets([[group], []], group).agg(
        F.grouping(group).alias("_all"), *[F.sum(k).alias(k) for k in sums]
    )
    label = F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(group))
    size = F.nullif(F.col(taking), F.lit(0)).cast(m.EXACT)
    kind = T.DecimalType(38, 12)
    hits = F.try_divide(F.col("_hits").cast(m.EXACT) * F.lit(100).cast("decimal(3,0)"), size)
    # Narrow types keep all digits of products and quotients below the two that are published.
    mean = F.try_divide(F.col("_weighted").cast(T.DecimalType(24, 6)), size)
    exact_pct = F.coalesce(hits.cast(kind), mean.cast(kind))
    done = m.exact_rate(F.col("_completed"), F.col("_base"))
    both = F.round(
        done.cast(T.DecimalType(12, 2))
        * exact_pct.cast(T.DecimalType(18, 12))
        / F.lit(100).cast("decimal(3,0)"),
        2,
    )
    return cells.where(F.col(entrants) >= min_cell).select(
        label.alias(group),
        "nu_entities",
        m.mask_count(F.col(entrants), min_cell).alias(entrants),
        m.rate(F.col("_dropped"), F.col("_base")).alias("of_100_dropped"),
        done.cast("double").alias("of_100_completed"),
        "nu_with_exam",
        m.mask_count(F.col(taking), min_cell).alias(taking),
        m.published_if(F.round(exact_pct, 2).cast("double"), F.col(taking), min_cell).alias(pct),
        m.published_if(both.cast("double"), F.col(taking), min_cell).alias("of_100_proficient"),
    )


def supply_gaps(
    population: DataFrame,
    supply: DataFrame,
    place: str,
    year: str,
    entity: str,
    seats: str,
    entrants: str,
    name: str,
    people: str = "nu_population",
    min_cell: int = m.MIN_CELL,
    years: DataFrame | None = None,
) -> DataFrame:
    """Supply of the latest year beside the population of every place; none there is a gap.

    ``population`` is one row per place and age, ``supply`` one row per year, entity and place.
    The latest year is that of ``years`` if given, else of the supply.
    """
    everyone = population.groupBy(place).agg(
        F.min(name).alias(name), F.sum(people).alias(people)
    )
    latest = (supply if years is None else years).agg(F.max(year).alias(year))
    offered = (
        supply.where(F.col(year) == latest.scalar())
        .groupBy(place)
        .agg(
            F.countDistinct(entity).alias("nu_offers"),
            F.sum(seats).alias(seats),
            F.sum(entrants).alias(entrants),
        )
    )
    rows = everyone.join(offered, place, "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("nu_offers", seats, entrants)}
    hidden = zero[entrants].between(1, min_cell - 1)
    return rows.select(
        place,
        name,
        latest.scalar().alias(year),
        people,
        zero["nu_offers"].alias("nu_offers"),
        zero[seats].alias(seats),
        m.rate(zero[seats], F.col(people)).alias("seats_per_100"),
        m.mask_count(zero[entrants], min_cell).alias(entrants),
        F.when(~hidden, m.rate(zero[entrants], F.col(people))).alias("entrants_per_100"),
        (zero[seats] == 0).alias("is_gap"),
    )


def funding_by_year(
    df: DataFrame,
    year: str,
    mode: str,
    totals: Mapping[str, Sequence[str]],
    base: str,
    min_cell: int = m.MIN_CELL,
) -> DataFrame:
    """Masked sums per year and mode with the funded share of each total.

    ``totals`` maps a total column to its funded parts, for example
    ``{"qt_enrolled": ["qt_enrolled_loan", "qt_enrolled_grant"]}``.
    """
    counts = [c for total, parts in totals.items() for c in (total, *parts)]
    sums = df.groupBy(year, mode).agg(
        F.count(F.lit(1)).alias("nu_entities"), *[F.sum(c).alias(c) for c in counts]
    )
    return sums.where(F.col(base) >= min_cell).select(
        year,
        mode,
        "nu_entities",
        *[m.mask_count(F.col(c), min_cell).alias(c) for c in counts],
        *[
            m.rate(F.col(part), F.col(total)).alias(part.replace("qt_", "pct_", 1))
            for total, parts in totals.items()
            for part in parts
        ],
    )


def repair_scale(df: DataFrame, column: str, name: str) -> DataFrame:
    """Percentages delivered as fractions: if the greatest value is at most 1, times 100.

    The maximum is a scalar subquery, not a window over the whole relation.
    """
    top = df.agg(F.max(column)).scalar()
    fixed = F.when(top <= 1, F.col(column) * 100).otherwise(F.col(column))
    return df.withColumn(name, fixed)
