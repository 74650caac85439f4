"""Reading steps over published tables: filters, melts, funnels, headlines, diagnostics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.ranking import top_per_group


def block_filters(df: DataFrame, choices: Mapping[str, object]) -> DataFrame:
    """Equality per column; ``"min"`` means its smallest value, ``"all"`` no filter.

    Columns the table does not have are ignored. Each minimum is taken over the rows left by
    the filters before it.
    """
    for column, wanted in choices.items():
        if column not in df.columns or wanted == "all":
            continue
        if wanted == "min":
            df = df.where(F.col(column) == df.agg(F.min(column)).scalar())
        else:
            df = df.where(F.col(column) == F.lit(wanted))
    return df


def melt(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    keep = [c for c in df.columns if c not in measures]
    return df.unpivot(keep, list(measures), "variable", "value")


def series_key(columns: Sequence[str], separator: str = " · ") -> Column:
    return F.concat_ws(separator, *[F.col(c).cast("string") for c in columns])


def funnel_steps(df: DataFrame, steps: Mapping[str, str], start: str = "Enter") -> DataFrame:
    """Ordered steps of each row from 100 down; steps without a value are left out."""
    items = [F.struct(F.lit(start).alias("stage"), F.lit(100.0).alias("of_100"))]
    items += [
        F.struct(F.lit(label).alias("stage"), F.col(c).cast("double").alias("of_100"))
        for c, label in steps.items()
    ]
    present = F.filter(F.array(*items), lambda s: s["of_100"].isNotNull())
    keep = [c for c in df.columns if c not in steps]
    return df.select(*keep, F.posexplode(present).alias("position", "step")).select(
        *keep, F.col("position").cast("bigint").alias("position"), "step.stage", "step.of_100"
    )


def headline(df: DataFrame, cohort: str, reference: str, group: Sequence[str] = ()) -> DataFrame:
    """The last reference year of the first cohort, per group if given."""
    rest = [c for c in df.columns if c not in group]
    order = F.struct((-F.col(cohort)).alias("first"), F.col(reference).alias("last"))
    pick = F.max_by(F.struct(*rest), order).alias("_row")
    picked = df.groupBy(*group).agg(pick) if group else df.agg(pick)
    return picked.where(F.col("_row").isNotNull()).select(*group, *[f"_row.{c}" for c in rest])


def top_contributors(
    facts: DataFrame,
    names: DataFrame,
    keys: Sequence[str],
    period: str,
    code: str,
    name: str,
    sums: Mapping[str, Column],
    by: str,
    n: int = 5,
    nulls_last: bool = True,
) -> DataFrame:
    """Greatest contributors per period by name (code where no name is known).

    Facts are summed per code before the names are joined.
    """
    total = facts.groupBy(*keys).agg(*[v.alias(k) for k, v in sums.items()])
    label = F.coalesce(F.col(name), F.col(code).cast("string")).alias("contributor")
    named = total.join(names, list(keys), "left").groupBy(period, label)
    merged = named.agg(*[F.sum(k).alias(k) for k in sums])
    first = F.col(by).desc_nulls_last() if nulls_last else F.col(by).desc_nulls_first()
    return top_per_group(merged, [period], [first, F.col("contributor").asc()], n)


def source_diagnostics(
    df: DataFrame, period: str, missing: Mapping[str, Column], sums: Mapping[str, Column]
) -> DataFrame:
    """Rows, rows lacking a part and sums per period."""
    return df.groupBy(period).agg(
        F.count(F.lit(1)).alias("nu_rows"),
        *[F.count_if(test).alias(name) for name, test in missing.items()],
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )


def compare_counts(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of every table and of its copy, and whether they agree."""

    def counts(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
        return reduce(
            DataFrame.union,
            [
                t.agg(F.count(F.lit(1)).alias(name)).select(F.lit(key).alias("table"), name)
                for key, t in tables.items()
            ],
        )

    both = counts(left, "rows_original").join(counts(right, "rows_copy"), "table", "full_outer")
    return both.withColumn("is_equal", F.col("rows_original").eqNullSafe(F.col("rows_copy")))
