"""Positions, quantile groups and top-n without sending a large group to one task."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.session import cut_lineage


#: Rows that one task of a distributed sort numbers.
RANGE_ROWS = 2_000_000


def _placed(df: DataFrame, order: Sequence[Column], partition: Sequence[str], ranges: int) -> DataFrame:
    """Rows with ``_offset`` (rows of their group in earlier ranges), ``_inside`` (place in the range, from 1)
    and ``_total`` (rows of the group)."""
    keys = [F.col(c) for c in partition]
    ranged = df.repartitionByRange(ranges, *keys, *order).withColumn(
        "_range", F.spark_partition_id()
    )
    ranged = cut_lineage(ranged, "ranges")
    counts = ranged.groupBy(*partition, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*partition)
    offsets = counts.select(
        *partition,
        "_range",
        F.coalesce(
            F.sum("_rows").over(
                group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_offset"),
        F.sum("_rows").over(group).alias("_total"),
    )
    inside = F.row_number().over(Window.partitionBy(*partition, "_range").orderBy(*order))
    return ranged.withColumn("_inside", inside).join(offsets, [*partition, "_range"])


def exact_ntile(
    df: DataFrame,
    buckets: int,
    order: Sequence[Column],
    partition: Sequence[str] = (),
    name: str = "quartile",
    ranges: int | None = None,
) -> DataFrame:
    """``ntile(buckets) over (partition by .. order by ..)`` as a distributed sort.

    Rows are range-partitioned on (partition, order) and stored with their range number. The
    count of rows per range (at most ``ranges`` plus the number of groups) gives each range its
    offset, and the position inside a range completes the rank. ``order`` must end in a unique
    key; then no range can be filled by ties. Ranges grow in number, not in size: one holds about
    ``RANGE_ROWS`` rows at most. ``df`` is computed once, before it is counted and sampled.
    """
    spark = df.sparkSession
    columns = df.columns
    if ranges is None:
        df = cut_lineage(df, "ntile")
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(usual, -(-df.count() // RANGE_ROWS))
    placed = _placed(df, order, partition, ranges)
    place = F.col("_offset") + F.col("_inside") - 1
    small = F.expr(f"_total div {buckets}")
    extra = F.col("_total") % buckets
    head = extra * (small + 1)
    tile = F.when(place < head, F.floor(place / (small + 1)) + 1).otherwise(
        extra + F.floor((place - head) / F.greatest(small, F.lit(1))) + 1
    )
    return placed.select(*columns, tile.cast("bigint").alias(name))


#: Bins of one histogram, and rows that may stand in a cut's bin before it is looked at row by row.
BINS, CUT_ROWS = 4096, 100_000


def quantile_cuts(
    df: DataFrame, buckets: int, value: str, key: str, partition: Sequence[str] = (), most: int = CUT_ROWS
) -> DataFrame:
    """The last row (``_value``, ``_key``) of the tiles 1 to ``buckets`` - 1 of ``ntile(buckets) over
    (partition by .. order by value, key)``, as an array ``_cuts`` for each group, without sorting the rows.

    A histogram of each group tells in which bin a cut lies; that bin gets a histogram of its own, until it
    holds few rows or one value. Rows are counted where they are; only those of the last bins are numbered.
    ``value`` is numeric and not null, ``key`` unique in a group. ``df`` is read several times.
    """
    group = [F.col(c) for c in partition]
    image = F.col(value).cast("double")
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(image).alias("_lo"), F.max(image).alias("_hi"))
    numbers = F.explode(F.sequence(F.lit(1), F.lit(buckets - 1)))
    cuts = counted.where("_n > 0").select(*group, "_n", "_lo", "_hi", F.lit(0).cast("bigint").alias("_before"), numbers.alias("_cut"))
    end = F.col("_cut") * F.expr(f"_n div {buckets}") + F.least(F.col("_cut").cast("bigint"), F.col("_n") % buckets)
    cuts = cut_lineage(cuts.select("*", end.alias("_end"), F.col("_n").alias("_rows")), "cuts")
    while cuts.where((F.col("_rows") > most) & (F.col("_lo") < F.col("_hi"))).limit(1).count():
        cuts = cut_lineage(_narrowed(df, cuts, image, partition), "cuts")
    spans = cuts.select(*group, "_lo", "_hi", "_before").distinct()
    rows = _within(df.select(*group, F.col(value).alias("_value"), F.col(key).alias("_key"), image.alias("_at")), spans, partition)
    order = [F.col("_value").asc(), F.col("_key").asc()]
    tied = cuts.agg(F.max("_rows")).first()[0] or 0
    if tied > most:  # so many equal values are numbered range by range
        ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tied // RANGE_ROWS))
        rows = _placed(rows, order, [*partition, "_lo"], ranges).withColumn("_place", F.col("_offset") + F.col("_inside"))
    else:
        rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*partition, "_lo").orderBy(*order)))
    rows = rows.select(*partition, "_lo", (F.col("_before") + F.col("_place")).alias("_end"), "_value", "_key")
    ends = cuts.select(*partition, "_lo", "_cut", "_end").join(rows, [*partition, "_lo", "_end"])
    found = F.array_sort(F.collect_list(F.struct("_cut", "_value", "_key")))
    return cut_lineage(ends.groupBy(*partition).agg(found.alias("_cuts")), "cuts")


def _within(rows: DataFrame, spans: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Rows whose ``_at`` lies in a span of their group; spans are few and do not overlap."""
    inside = F.col("_at").between(F.col("_lo"), F.col("_hi"))
    if partition:
        return rows.join(spans, list(partition)).where(inside)
    # One group: its spans are fewer than the buckets.
    whole = [F.struct(*[F.lit(v).alias(c) for c, v in r.asDict().items()]) for r in spans.collect()]
    if not whole:
        return rows.where(F.lit(False)).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in spans.schema.fields])
    held = F.filter(F.array(*whole), lambda s: F.col("_at").between(s["_lo"], s["_hi"]))
    return rows.select("*", F.explode(held).alias("_s")).select(*rows.columns, "_s._lo", "_s._hi", "_s._before")


def _narrowed(df: DataFrame, cuts: DataFrame, image: Column, partition: Sequence[str]) -> DataFrame:
    """Every cut with the bin of its span that holds it as its new span."""
    spans = cuts.select(*partition, "_lo", "_hi", "_before").distinct()
    rows = _within(df.select(*partition, image.alias("_at")), spans, partition)
    step = F.floor((F.col("_at") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * BINS)
    number = F.least(F.coalesce(step, F.lit(0)), F.lit(BINS - 1))
    bins = rows.groupBy(*partition, "_lo", "_before", number.alias("_bin")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_low"), F.max("_at").alias("_high")
    )
    along = Window.partitionBy(*partition, "_lo").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.select(
        *partition, "_lo", "_low", "_high", "_rows", (F.col("_before") + F.sum("_rows").over(along)).alias("_until")
    )
    held = cuts.select(*partition, "_n", "_lo", "_cut", "_end").join(bins, [*partition, "_lo"])
    held = held.where((F.col("_end") <= F.col("_until")) & (F.col("_end") > F.col("_until") - F.col("_rows")))
    return held.select(
        *partition, "_n", F.col("_low").alias("_lo"), F.col("_high").alias("_hi"),
        (F.col("_until") - F.col("_rows")).alias("_before"), "_cut", "_end", "_rows",
    )


def selected_ntile(
    df: DataFrame, buckets: int, value: str, key: str, partition: Sequence[str] = (), name: str = "quartile", most: int = CUT_ROWS
) -> DataFrame:
    """``ntile(buckets) over (partition by .. order by value, key)`` by comparing rows with the cuts.

    The rows of ``df`` are written once and never move.
    """
    df = cut_lineage(df, "ntile")
    cuts = quantile_cuts(df, buckets, value, key, partition, most)
    def after(cut: Any) -> Column:
        ours, theirs = F.col(value), cut["_value"]
        return (ours > theirs) | ((ours == theirs) & (F.col(key) > cut["_key"]))

    if partition:
        rows, behind = df.join(cuts, list(partition)), F.size(F.filter("_cuts", after))
    else:
        row = cuts.first()  # one group: its cuts are fewer than the buckets
        kinds = df.schema[value].dataType, df.schema[key].dataType
        ends = [[F.lit(c[n]).cast(k) for n, k in zip(("_value", "_key"), kinds, strict=True)] for c in row["_cuts"]] if row else []
        rows, behind = df, F.lit(0)
        for v, k in ends:
            behind = behind + after({"_value": v, "_key": k}).cast("int")
    return rows.select(*df.columns, (behind + 1).cast("bigint").alias(name))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, position: str = "position"
) -> DataFrame:
    """First ``n`` rows of each group; Spark trims every task to ``n`` rows before the shuffle."""
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(position, number.cast("bigint")).where(F.col(position) <= n)


def top_and_bottom(
    df: DataFrame, metric: str, tie: str, n: int = 10, condition: Column | None = None
) -> DataFrame:
    """The ``n`` greatest and the ``n`` smallest rows; ties go by ``tie``."""
    rows = df if condition is None else df.where(condition)
    metric_col, tie_col = F.col(metric), F.col(tie)
    ends = {
        "top": [metric_col.desc_nulls_last(), tie_col.asc_nulls_last()],
        "bottom": [metric_col.asc_nulls_last(), tie_col.desc_nulls_last()],
    }
    parts = []
    for side, order in ends.items():
        # The window sees n rows only: the limit runs first, as a per-task top-n and a merge.
        cut = rows.orderBy(*order).limit(n)
        number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        parts.append(cut.select(F.lit(side).alias("side"), number.alias("position"), *df.columns))
    return parts[0].unionByName(parts[1])
