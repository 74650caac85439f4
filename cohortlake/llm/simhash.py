"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most two bits agree in one of three blocks of bits, so each is dealt
out under its three blocks; fingerprints that meet under a block have it in common. A task sorts the
fingerprints it got by Gray rank, so that neighbours share bits, and builds an index bottom-up: every
node keeps the bits that all below it share (a mask and a pattern). Pairs of nodes are descended
together, and a pair is dropped as soon as the shared bits differ in more than two places: whole
groups at once. Links found in a task are joined by union-find there and leave it as a spanning
forest, never as all pairs of a group; the forests are joined by star operations.

A block that holds too many fingerprints is split under the three blocks of its remaining bits, and so
on, so no task gets an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, shuffle_partitions, tidy, words_of
from cohortlake.llm.components import components

#: Differing bits up to which two fingerprints link.
BITS = 2
#: Words of a shingle.
WORDS = 3
#: Fingerprints that may share a block before it is split under its remaining bits.
GROUP = 20_000
#: Children of an index node.
FANOUT = 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a whole text; zero where it has no word."""
    from xxhash import xxh64_intdigest

    words = words_of(text)
    if not words:
        return 0
    if len(words) < WORDS:
        return xxh64_intdigest(b" ".join(words), 42)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    pairs = zip(starts[: len(words) - WORDS + 1].tolist(), ends[WORDS - 1 :].tolist(), strict=True)
    h = np.fromiter((xxh64_intdigest(whole[a:b], 42) for a, b in pairs), np.uint64, len(words) - WORDS + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(ones * 2 > len(h))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, code``: one row for each row of ``docs``; code is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codes.view(np.int64))], names=["doc_id", "code"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _level(masks: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes above: the bits on which all FANOUT children agree."""
    starts = np.arange(0, len(masks), FANOUT)
    shared = np.bitwise_and.reduceat(masks, starts)
    ones, any_one = np.bitwise_and.reduceat(patterns, starts), np.bitwise_or.reduceat(patterns, starts)
    mask = shared & ~(ones ^ any_one)
    return mask, ones & mask


def links_within(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of codes sorted by Gray rank that differ in at most BITS bits, in chunks."""
    levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
    while len(levels[-1][0]) > FANOUT:
        levels.append(_level(*levels[-1]))
    top = len(levels[-1][0])
    i, j = np.triu_indices(top)
    stack = [(len(levels) - 1, i, j)]
    while stack:
        depth, i, j = stack.pop()
        mask, pattern = levels[depth]
        differ = np.bitwise_count((pattern[i] ^ pattern[j]) & mask[i] & mask[j])
        near = differ <= BITS
        i, j = i[near], j[near]
        if depth == 0:
            apart = i != j
            if apart.any():
                yield i[apart], j[apart]
            continue
        below = len(levels[depth - 1][0])
        # 256 child pairs for each pair of nodes; chunks keep the front small.
        for start in range(0, len(i), 4096):
            a = (i[start : start + 4096, None] * FANOUT + np.repeat(np.arange(FANOUT), FANOUT)).ravel()
            b = (j[start : start + 4096, None] * FANOUT + np.tile(np.arange(FANOUT), FANOUT)).ravel()
            ok = (a <= b) & (b < below)
            stack.append((depth - 1, a[ok], b[ok]))


def forest(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among ``codes`` (distinct): each code and its root, roots left out."""
    order = np.argsort(gray_rank(codes), kind="stable")
    sorted_codes = codes[order]
    root = np.arange(len(codes))
    for i, j in links_within(sorted_codes):
        root = _unite(root, i, j)
    child = np.flatnonzero(root != np.arange(len(root)))
    return sorted_codes[child], sorted_codes[root[child]]


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Root of every node after the links (i, j): labels fall to the smallest until none changes."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up


def _blocks(bits: list[int]) -> list[list[int]]:
    third = -(-len(bits) // (BITS + 1))
    return [bits[k * third : (k + 1) * third] for k in range(BITS + 1)]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def dealt_groups(codes: DataFrame) -> DataFrame:
    """``path, key, code``: every code under its three blocks; crowded groups under blocks of the rest.

    Two codes within BITS bits of each other always share a group: under three blocks that do not
    overlap, at least one is free of their differences.
    """
    every = [*range(63, -1, -1)]
    paths = {f"{k}": (b, [x for x in every if x not in b]) for k, b in enumerate(_blocks(every))}
    options = F.array(
        *(
            F.struct(F.lit(p).alias("path"), F.col("code").bitwiseAND(F.lit(_signed(b))).alias("key"))
            for p, (b, _) in paths.items()
        )
    )
    spread = codes.select("code", F.explode(options).alias("g")).select("g.path", "g.key", "code")
    done = []
    level = cut_lineage(spread, "simhash-groups")
    while True:
        crowded = level.groupBy("path", "key").count().where(F.col("count") > GROUP).select("path", "key")
        crowded = cut_lineage(crowded, "simhash-crowded")
        names = sorted(r[0] for r in crowded.select("path").distinct().collect())
        deeper = {p: paths[p] for p in names if len(paths[p][1]) > BITS}
        if not deeper:
            done.append(level)
            break
        crowded = crowded.where(F.col("path").isin(list(deeper)))
        done.append(level.join(crowded, ["path", "key"], "left_anti"))
        rest = level.join(crowded, ["path", "key"], "left_semi")
        paths, choices = {}, None
        for p, (fixed, free) in deeper.items():
            split = _blocks(free)
            options = F.array(
                *(
                    F.struct(
                        F.lit(f"{p}{k}").alias("path"),
                        F.col("code").bitwiseAND(F.lit(_signed(fixed + b))).alias("key"),
                    )
                    for k, b in enumerate(split)
                )
            )
            choices = F.when(F.col("path") == p, options) if choices is None else choices.when(F.col("path") == p, options)
            for k, b in enumerate(split):
                paths[f"{p}{k}"] = (fixed + b, [x for x in free if x not in b])
        level = cut_lineage(
            rest.select("code", F.explode(choices).alias("g")).select("g.path", "g.key", "code"), "simhash-groups"
        )
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs`` (doc_id, text).

    fingerprint: 16 hex digits. component_id: the smallest doc_id reachable over links of at most BITS
    differing bits, itself included. Null and wordless texts have fingerprint zero and link like any
    other. Rows that repeat a doc_id are linked by it only through their fingerprints; a null doc_id
    is kept, and gets a component only from others. Extra columns are ignored.
    """
    spark = docs.sparkSession
    prints = cut_lineage(fingerprints(docs), "simhash-prints")
    # One node for each distinct fingerprint, named by its smallest document.
    classes = cut_lineage(prints.groupBy("code").agg(F.min("doc_id").alias("node")), "simhash-codes")
    groups = dealt_groups(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if b.num_rows]
        if not whole:
            return
        part = np.concatenate([b.column("part").to_numpy(zero_copy_only=False) for b in whole])
        code = np.concatenate([b.column("code").to_numpy(zero_copy_only=False) for b in whole]).view(np.uint64)
        for p in np.unique(part):
            a, b = forest(np.unique(code[part == p]))
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

    # Groups are dealt by path and key; codes of one path that meet in a task share one index.
    parts = shuffle_partitions(spark)
    dealt = groups.repartition(parts, "path", "key").select(F.crc32("path").alias("part"), "code")
    found = cut_lineage(dealt.mapInArrow(tidy(run), "a long, b long"), "simhash-forest")
    node_a = classes.select(F.col("code").alias("a"), F.col("node").alias("na"))
    node_b = classes.select(F.col("code").alias("b"), F.col("node").alias("nb"))
    links = found.distinct().join(node_a, "a").join(node_b, "b").where("na is not null and nb is not null")
    joined = components(links.select(F.col("na").alias("a"), F.col("nb").alias("b")))
    labels = classes.join(joined, "node", "left").select("code", F.coalesce("component", "node").alias("component_id"))
    return prints.join(labels, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
