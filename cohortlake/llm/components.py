"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (a long, b long); component: its smallest node.

    Each round hangs a node's larger neighbours, then its smaller ones, below the smallest, until
    nothing changes; the number of rounds grows with the logarithm of a component's size. A node of
    many links costs one aggregate row and a join that adaptive execution can split. Links are
    written between rounds. Self links and repeats are harmless; without links there are no rows.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = (
            hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = cut_lineage(small, "links")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
