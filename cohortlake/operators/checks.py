"""Data tests as relations: each returns the violating rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.measures import MIN_CELL

COUNT_PREFIX = "qt_"


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def min_value(column: str, low: float = 0) -> Column:
    return F.col(column) < low


def between(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def accepted_values(column: str, values: Sequence[object]) -> Column:
    return ~F.col(column).isin(list(values))


def small_cells(columns: Sequence[str], min_cell: int = MIN_CELL) -> Column:
    """Any published count strictly between zero and the cell limit."""
    tests = [F.col(c).between(1, min_cell - 1) for c in columns if c.startswith(COUNT_PREFIX)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def rates_differ(base: str, pairs: Mapping[str, str], tolerance: float = 0.01) -> Column:
    """``pairs``: count column -> delivered rate column, over rows with a positive base."""
    far = [
        F.abs(F.col(n) * F.lit(100.0) / F.nullif(F.col(base), F.lit(0)) - F.col(r)) > tolerance
        for n, r in pairs.items()
    ]
    return (F.col(base) > 0) & reduce(lambda a, b: a | b, far)


def flow_unbalanced(parts: Sequence[str], whole: str) -> Column:
    return sum((F.col(p) for p in parts[1:]), F.col(parts[0])) != F.col(whole)


def row_count_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """A row with both counts where they differ."""
    left = a.agg(F.count(F.lit(1)).alias("model"))
    right = b.agg(F.count(F.lit(1))).scalar()
    return left.withColumn("reference", right).where("model <> reference")


def sum_equal(a: DataFrame, column: str, b: DataFrame, other: str) -> DataFrame:
    left = a.agg(F.coalesce(F.sum(column), F.lit(0)).alias("model"))
    right = b.agg(F.coalesce(F.sum(other), F.lit(0))).scalar()
    return left.withColumn("reference", right).where("model <> reference")


def join_coverage(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Share of distinct keys that exist on the other side (one row)."""
    keys = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_key")).distinct()
    known = to.select(F.col(field).alias("_key")).distinct().withColumn("_found", F.lit(1))
    counted = keys.join(known, "_key", "left").agg(
        F.count(F.lit(1)).alias("total"), F.count("_found").alias("found")
    )
    return counted.withColumn("ratio", F.try_divide(F.col("found").cast("double"), F.col("total")))


def coverage_below(coverage: DataFrame, min_ratio: float = 0.95) -> DataFrame:
    return coverage.where(F.col("ratio") < min_ratio)


def cast_loss(raw: Column, typed: Column) -> Column:
    """Text was present but the typed value is NULL."""
    return (F.trim(raw) != "") & typed.isNull()


def schema_differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """Names and types against a contract, order included; empty means equal."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    if have == want:
        return []
    missing = [f"missing {n} {t}" for n, t in want if (n, t) not in have]
    extra = [f"unexpected {n} {t}" for n, t in have if (n, t) not in want]
    return missing + extra or ["column order differs"]


def run_row_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Many row-wise checks over one relation in one scan: ``(check, violations)`` rows."""
    names = list(checks)
    counted = df.agg(*[F.count_if(checks[n]).alias(f"v{i}") for i, n in enumerate(names)])
    pairs = ", ".join(f"'{n}', v{i}" for i, n in enumerate(names))
    return counted.selectExpr(f"stack({len(names)}, {pairs}) as (check, violations)")


def count_violations(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def suite(results: Sequence[DataFrame]) -> DataFrame:
    """All results in one relation with a status per check."""
    stacked = reduce(DataFrame.unionByName, results)
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    return stacked.withColumn("status", status)
