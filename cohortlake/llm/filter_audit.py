"""What each order of a set of filters keeps, removes and duplicates, from one pass over the texts.

A text fails some of the filters: its mask. Under an order it is removed at the step of the first filter
that it fails, so only the orders' leading letters up to that filter matter, and all orders that share
them are one interval of lexicographic (Lehmer) ranks. Each cell of texts with the same mask adds its
count at the first rank of each such interval and takes it off behind the last one; a prefix sum over
the ranks then gives the removals of every order at once. Nothing is replayed order by order.

Texts are read once. What is shuffled is a digest, an id and a mask for each row; what is audited is at
most one row for each part and mask.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage

#: More filters than this have too many orders to list.
MOST_FILTERS = 7
_BLANK = r"[\x20\x09-\x0D]+"
_SALTS = 1024


def prefix_ranks(names: Sequence[str], prefix: Sequence[str]) -> tuple[int, int]:
    """First rank, and first rank behind, of the orders of ``names`` that start with ``prefix``."""
    left = list(names)
    first = 0
    for name in prefix:
        at = left.index(name)
        first += at * factorial(len(left) - 1)
        del left[at]
    return first, first + factorial(len(left))


def removal_ends(names: Sequence[str]) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, sign): interval ends of the orders that remove a mask at a step.

    Bit i of a mask stands for ``names[i]``. The prefixes that remove a mask at step s are those whose
    first s - 1 filters pass and whose last one fails.
    """
    ends = []
    bit = {name: 1 << i for i, name in enumerate(names)}
    for mask in range(1, 1 << len(names)):
        passed = [n for n in names if not mask & bit[n]]
        failed = [n for n in names if mask & bit[n]]
        for step in range(1, len(passed) + 2):
            for lead in permutations(passed, step - 1):
                for last in failed:
                    first, behind = prefix_ranks(names, (*lead, last))
                    ends += [(mask, step, first, 1), (mask, step, behind, -1)]
    return ends


def audit(cells: DataFrame, names: Sequence[str], tallies: Sequence[str] = ()) -> DataFrame:
    """Counts for every part, order of the filters and step.

    ``cells``: ``part`` (string), ``mask`` (bit i set: fails ``names[i]``), ``n`` rows, and for each name
    of ``tallies`` how many of these rows count there; other columns are ignored, cells may repeat and a
    null part is a part of its own. The result has ``part, filter_order, step, kept, removed, redundant,
    unique_fails, shapley`` and ``<tally>_lost``; no cells give no rows.
    """
    if not 1 <= len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"1 to {MOST_FILTERS} filters with different names, not {list(names)}")
    spark = cells.sparkSession
    count = ["n", *tallies]
    small = cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in count])
    small = cut_lineage(small, "cells")
    # Two constant tables: their size depends on the number of filters alone.
    ends = spark.createDataFrame(removal_ends(names), "mask int, step int, rank int, sign int")
    orders = [
        (rank, "".join(order), step + 1, name)
        for rank, order in enumerate(permutations(names))
        for step, name in enumerate(order)
    ]
    grid = spark.createDataFrame(orders, "rank int, filter_order string, step int, name string")

    deltas = small.join(F.broadcast(ends), "mask").select(
        "part", "step", "rank", *[(F.col("sign") * F.col(c)).alias(c) for c in count]
    )
    parts = small.groupBy("part").agg(
        F.sum("n").alias("_total"),
        *[F.sum(F.when(_fails(i), F.col("n")).otherwise(0)).alias(f"_f{i}") for i in range(len(names))],
        *[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)).alias(f"_u{i}") for i in range(len(names))],
    )
    ranks = F.explode(F.sequence(F.lit(0), F.lit(factorial(len(names)) - 1)))
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(names))))
    zeros = parts.select("part", ranks.alias("rank")).select("part", steps.alias("step"), "rank", *[F.lit(0).cast("long").alias(c) for c in count])
    # Interval ends behind the last rank take nothing off any order.
    inside = deltas.where(F.col("rank") < factorial(len(names)))
    ended = zeros.unionByName(inside).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in count])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = ended.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in count])

    named = removed.join(F.broadcast(grid), ["rank", "step"])
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = named.select(
        "part", "filter_order", "step", "name", *count,
        F.sum("n").over(so_far).alias("_gone"), F.sum("n").over(Window.partitionBy("part", "name")).alias("shapley"),
    ).alias("a")
    whole = whole.join(parts.alias("p"), F.col("a.part").eqNullSafe(F.col("p.part")))
    return whole.select(
        "a.part", "filter_order", "step",
        (F.col("_total") - F.col("_gone")).alias("kept"), F.col("n").alias("removed"),
        (_chosen(names, "_f") - F.col("n")).alias("redundant"), _chosen(names, "_u").alias("unique_fails"),
        *[F.col(c).alias(f"{c}_lost") for c in tallies], "shapley",
    )


def _fails(i: int) -> Column:
    return F.col("mask").bitwiseAND(1 << i) != 0


def _chosen(names: Sequence[str], prefix: str) -> Column:
    """The column of a part's totals that belongs to the row's filter."""
    pairs = [(F.col("name") == n, F.col(f"{prefix}{i}")) for i, n in enumerate(names)]
    return reduce(lambda found, p: found.when(*p), pairs[1:], F.when(*pairs[0]))


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Five failure conditions but the last, which needs other rows: A too short, B repetitive, C shouting,
    D marks of code or tables. ``words`` are the text's words."""
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < 50,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(65) * F.size(words),
        "C": F.lit(100).cast("long") * capitals > F.lit(5).cast("long") * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def text_cells(docs: DataFrame, labels: DataFrame, flags: Mapping[str, str] | None = None) -> DataFrame:
    """Cells of ``docs`` (doc_id, text, source) under the conditions A to D of ``text_failures`` and E: equal to
    the text of a smaller doc_id.

    A null or empty text is an empty one, a null source an empty string. Rows that repeat an id are rows of
    their own, and equal texts under one id are no copies of each other. A null id is no smaller than any and
    has no smaller one, so it never fails E and makes none fail. ``flags``: tally -> condition on ``labels``
    (doc_id, ...); a row counts if any label row of its id meets it, and a null id has no labels.

    Copies meet by a digest of their text only to find the smallest id, which is an aggregate; back at the
    rows they are joined by digest and id, so a text that a third of all rows hold fills no task.
    """
    flags = {"good": "quality = 1", "toxic": "toxic = 1"} if flags is None else flags
    text = F.coalesce("text", F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text")
    ).select("*", F.array_remove(F.split("text", _BLANK), "").alias("words"))
    found = text_failures(F.col("text"), F.col("words"))
    mask = reduce(Column.__add__, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(found.values())])
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    rows = read.select("doc_id", "part", digest.alias("digest"), mask.alias("mask"))
    rows = rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows, "masks")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.where(F.col("doc_id").isNotNull()).withColumn("_first", F.lit(True))
    copied = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    # Rows without an id join nothing; a salt keeps them from meeting in one task.
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(_SALTS))).otherwise(0)
    marked = rows.join(firsts, ["digest", "doc_id"], "left").select(
        "doc_id", salt.alias("_salt"), "part", "n",
        (F.col("mask") + F.when(copied, 1 << len(found)).otherwise(0)).alias("mask"),
    )
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.bool_or(F.expr(c)), F.lit(False)).alias(name) for name, c in flags.items()]
    ).withColumn("_salt", F.lit(0).cast("long"))
    joined = marked.join(known, ["doc_id", "_salt"], "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in flags]
    )


def text_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five text filters A to E over ``docs``, by source."""
    return audit(text_cells(docs, labels), "ABCDE", ["good", "toxic"])
