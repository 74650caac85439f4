"""Survival arithmetic of cohorts: accumulation, milestones, curves, yearly churn."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.measures import MIN_BASE_RANKING, MIN_CELL, exact_rate, mask_count, rate


@dataclass(frozen=True)
class Flow:
    """Column names of a trajectory: one row per entity, cohort and reference year."""

    entity: str = "entity"
    cohort: str = "cohort"
    reference: str = "ref_year"
    step: str = "step"
    entrants: str = "qt_entrants"
    stayed: str = "qt_stayed"
    completed: str = "qt_completed"
    dropped: str = "qt_dropped"
    excluded: str = "qt_excluded"
    suffix: str = "_acc"
    base: str = "qt_base_acc"
    last: str = "last_year"

    def running(self, column: str) -> str:
        return column + self.suffix


FLOW = Flow()


def accumulate(df: DataFrame, flow: Flow = FLOW) -> DataFrame:
    """Running flows per entity and cohort, the running base and the last year seen.

    A window group holds one row per year of one cohort, so its size is bounded by the calendar.
    """
    group = Window.partitionBy(flow.entity, flow.cohort)
    ordered = group.orderBy(flow.reference)
    past = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = {
        flow.running(c): F.sum(c).over(past) for c in (flow.dropped, flow.completed, flow.excluded)
    }
    return df.select(
        "*",
        *[value.alias(name) for name, value in running.items()],
        (F.col(flow.entrants) - running[flow.running(flow.excluded)]).alias(flow.base),
        F.max(flow.reference).over(whole).alias(flow.last),
    )


def milestone(
    acc: DataFrame, attributes: Sequence[str] = (), step: int = 4, flow: Flow = FLOW
) -> DataFrame:
    """State of every entity and cohort at ``step`` and in its last observed year.

    Groups on the key the accumulation already partitioned by: no further shuffle.
    """
    at_step = F.col(flow.step) == step
    at_end = F.col(flow.reference) == F.col(flow.last)
    dropped, completed = flow.running(flow.dropped), flow.running(flow.completed)

    def at(test: Column, column: str, name: str) -> Column:
        return F.max(F.when(test, F.col(column))).alias(name)

    return acc.groupBy(flow.entity, flow.cohort).agg(
        *[F.min(a).alias(a) for a in attributes],
        F.max(flow.entrants).alias(flow.entrants),
        at(at_step, dropped, f"{flow.dropped}_step"),
        at(at_step, completed, f"{flow.completed}_step"),
        at(at_step, flow.base, "qt_base_step"),
        F.bool_or(at_step).alias("has_step"),
        at(at_end, dropped, f"{flow.dropped}_final"),
        at(at_end, completed, f"{flow.completed}_final"),
        at(at_end, flow.stayed, f"{flow.stayed}_final"),
        at(at_end, flow.base, "qt_base_final"),
        F.max(flow.last).alias(flow.last),
    )


def milestone_report(
    snapshot: DataFrame,
    attributes: Sequence[str] = (),
    step: int = 4,
    flow: Flow = FLOW,
    min_cell: int = MIN_CELL,
    min_base: int = MIN_BASE_RANKING,
) -> DataFrame:
    """Published form of :func:`milestone`: rates, masked counts and the ranking flag."""
    dropped, completed = flow.dropped, flow.completed
    rows = snapshot.where((F.col(flow.entrants) >= min_cell) & F.col("has_step"))
    return rows.select(
        flow.entity,
        flow.cohort,
        *attributes,
        F.lit(step).cast("bigint").alias("milestone_step"),
        mask_count(F.col(flow.entrants), min_cell).alias(flow.entrants),
        mask_count(F.col(f"{dropped}_step"), min_cell).alias(f"{dropped}_step"),
        rate(F.col(f"{dropped}_step"), F.col("qt_base_step")).alias("drop_rate_step"),
        rate(F.col(f"{completed}_step"), F.col("qt_base_step")).alias("completion_rate_step"),
        F.col(flow.last),
        rate(F.col(f"{dropped}_final"), F.col("qt_base_final")).alias("drop_rate_final"),
        rate(F.col(f"{completed}_final"), F.col("qt_base_final")).alias("completion_rate_final"),
        (F.col(flow.entrants) >= min_base).alias("is_ranking_eligible"),
    )


def curve(
    acc: DataFrame, group: str, flow: Flow = FLOW, min_cell: int = MIN_CELL
) -> DataFrame:
    """Cohort curve per group: cumulative rates, yearly loss and the year of greatest loss.

    The worst year is ranked over all years, before small bases are removed.
    """
    dropped, completed, excluded = (
        flow.running(c) for c in (flow.dropped, flow.completed, flow.excluded)
    )
    counts = [flow.entrants, flow.stayed, flow.completed, flow.dropped, flow.excluded]
    base = acc.groupBy(group, flow.cohort, flow.reference, flow.step).agg(
        F.countDistinct(flow.entity).alias("nu_entities"),
        *[F.sum(c).alias(c) for c in [*counts, completed, dropped, excluded, flow.base]],
    )
    active = sum((F.col(c) for c in counts[2:]), F.col(flow.stayed))
    order = Window.partitionBy(group, flow.cohort).orderBy(F.col(flow.dropped).desc_nulls_first())
    at_risk = F.col(flow.base)
    ranked = base.withColumn("is_worst_year", F.rank().over(order) == 1)
    return ranked.where(F.col(flow.entrants) >= min_cell).select(
        group,
        flow.cohort,
        flow.reference,
        flow.step,
        "nu_entities",
        *[
            mask_count(F.col(c), min_cell).alias(c)
            for c in [*counts[:4], completed, dropped, excluded]
        ],
        rate(F.col(dropped), at_risk).alias("drop_rate"),
        rate(F.col(completed), at_risk).alias("completion_rate"),
        rate(F.col(flow.stayed), at_risk).alias("stay_rate"),
        rate(F.col(flow.dropped), at_risk).alias("yearly_drop_rate"),
        rate(F.col(flow.dropped), active).alias("drop_rate_of_active"),
        "is_worst_year",
    )


def area_curve(
    acc: DataFrame,
    area: str,
    mode: str,
    missing: str,
    flow: Flow = FLOW,
    min_cell: int = MIN_CELL,
) -> DataFrame:
    """Curve per area, mode and step; a missing area gets its own label."""
    dropped, completed = flow.running(flow.dropped), flow.running(flow.completed)
    label = F.coalesce(F.col(area), F.lit(missing)).alias(area)
    base = acc.groupBy(label, mode, flow.cohort, flow.step).agg(
        F.countDistinct(flow.entity).alias("nu_entities"),
        *[F.sum(c).alias(c) for c in (flow.entrants, dropped, completed, flow.base)],
    )
    return base.where(F.col(flow.entrants) >= min_cell).select(
        area,
        mode,
        flow.cohort,
        flow.step,
        "nu_entities",
        mask_count(F.col(flow.entrants), min_cell).alias(flow.entrants),
        mask_count(F.col(dropped), min_cell).alias(dropped),
        rate(F.col(dropped), F.col(flow.base)).alias("drop_rate"),
        rate(F.col(completed), F.col(flow.base)).alias("completion_rate"),
    )


def entity_year(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    sums: Mapping[str, Column | str],
    rows: str = "nu_rows",
) -> DataFrame:
    """Roll a finer grain up to one row per key: least attribute text, row count and sums."""
    return df.groupBy(*keys).agg(
        *[F.min(a).alias(a) for a in attributes],
        F.count(F.lit(1)).alias(rows),
        *[F.sum(source).alias(name) for name, source in sums.items()],
    )


def yearly_churn(
    df: DataFrame,
    year: str,
    group: Sequence[str],
    left: str,
    enrolled: str,
    paused: str,
    others: Sequence[str],
    extra: Sequence[str] = (),
    plain: Sequence[str] = (),
    min_cell: int = MIN_CELL,
) -> DataFrame:
    """Churn per year and group with the change to the previous published year.

    ``extra`` are further counts to publish masked, ``plain`` sums published as they are.
    The lag runs after the base filter, so a removed year is skipped.
    """
    counts = [*extra, enrolled, paused, left, *others]
    ties = [enrolled, paused, left, *others]
    base = df.groupBy(year, *group).agg(
        F.count(F.lit(1)).alias("nu_entities"),
        *[F.sum(c).alias(c) for c in [*plain, *counts]],
    )
    linked = sum((F.col(c) for c in ties[1:]), F.col(ties[0]))
    base = base.withColumn("qt_linked", linked).where(F.col("qt_linked") >= min_cell)
    churn = exact_rate(F.col(left), F.col("qt_linked"))
    base = base.withColumn("_churn", churn)
    before = Window.partitionBy(*group).orderBy(year)
    change = exact_rate(
        F.col(enrolled) - F.lag(enrolled).over(before), F.lag(enrolled).over(before)
    )
    return base.select(
        year,
        *group,
        "nu_entities",
        *plain,
        *[mask_count(F.col(c), min_cell).alias(c) for c in [*counts, "qt_linked"]],
        F.col("_churn").cast("double").alias("churn_rate"),
        rate(F.col(paused), F.col("qt_linked")).alias("pause_rate"),
        (F.col("_churn") - F.lag("_churn").over(before)).cast("double").alias("churn_change_pp"),
        change.cast("double").alias("enrolled_change_pct"),
    )
