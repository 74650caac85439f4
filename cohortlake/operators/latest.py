"""Newest row per key and newest version per partition value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.session import cut_lineage


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one with the greatest ``order``.

    An aggregate, not a window: every task reduces its own rows first, so a key that holds a
    large part of the data costs one row per task in the shuffle.
    """
    payload = list(keep) if keep is not None else [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_newest.{c}") for c in payload])


def latest_partition(
    df: DataFrame,
    partition: str,
    file: str = "_source_file",
    batch: str = "_batch_id",
    loaded_at: str = "_ingested_at",
) -> DataFrame:
    """Rows of the newest (file, batch) of every partition value; blank values are dropped.

    The large relation is reduced by a hash aggregate to one row per value, file and batch, which
    keeps nothing but the newest load time; only that small result is ordered for its winners. They
    are written first, so that Spark joins them by broadcast when their real size allows it and by a
    skew-aware shuffle join otherwise.
    """
    value = F.trim(F.col(partition).cast("string"))
    versions = (
        df.where(F.nullif(value, F.lit("")).isNotNull())
        .groupBy(value.alias("_value"), F.col(file).alias("_file"), F.col(batch).alias("_batch"))
        .agg(F.max(loaded_at).alias("_at"))
    )
    newest = F.max_by(F.struct("_file", "_batch"), F.struct("_at", "_file", "_batch")).alias("_win")
    winners = versions.groupBy("_value").agg(newest).select("_value", "_win.*")
    winners = cut_lineage(winners, "versions")
    match = (
        (value == F.col("_value")) & (df[file] == F.col("_file")) & (df[batch] == F.col("_batch"))
    )
    return df.join(winners, match, "inner").select(*[df[c] for c in df.columns])
