"""Exact top-k inner product search over buckets of vectors of like length.

Candidates are sorted by length and cut into buckets; queries are packed into blocks. The bucket of
the longest vectors is searched first and gives every query a lower bound ``t`` on its k-th best
score. For any other bucket with longest vector ``l`` the bound becomes a local cosine threshold
``t / (|q| l)``:

* above one: the bucket cannot hold a result and is skipped for that query;
* high: the query's largest coordinate bounds the same coordinate of any result (coordinate pruning);
* else: only vectors longer than ``t / |q|`` can be results (length pruning).

What is left is verified by whole-number products. A block meets a bucket through an equi-join on
the bucket's number, so no row pairs are formed; each meeting gives at most k rows for a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, flat

#: From this local cosine on, one coordinate prunes better than length.
COORDINATE_COSINE = 0.6
_PACKED = "bucket int, n int, dim int, ids binary, rows binary"
_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, factor: int = 64) -> DataFrame:
    """``id, v``: each component as floor(factor * x). Null vectors, and vectors that hold a null or
    a non-finite component, take no part; nor do rows without an id and empty vectors."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0))
        .where(fine)
        .select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(x, lambda c: F.floor(c * factor).cast("long")).alias("v"),
        )
    )


def _pack(batches: Iterator[pa.RecordBatch], rows: int, number_by_part: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    ids: dict[int, list[np.ndarray]] = {}
    vecs: dict[int, list[np.ndarray]] = {}

    def packed(dim: int) -> pa.RecordBatch:
        i, v = np.concatenate(ids.pop(dim)), np.concatenate(vecs.pop(dim))
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([part if number_by_part else 0], pa.int32()),
                "n": pa.array([len(i)], pa.int32()),
                "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([i.astype("<i8").tobytes()], pa.binary()),
                "rows": pa.array([v.astype("<i8").tobytes()], pa.binary()),
            }
        )

    for batch in batches:
        i = batch.column("id").to_numpy(zero_copy_only=False)
        values, sizes = flat(batch.column("v"))
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes):
            own = np.flatnonzero(sizes == dim)
            ids.setdefault(int(dim), []).append(i[own])
            vecs.setdefault(int(dim), []).append(values[starts[own][:, None] + np.arange(dim)])
            if sum(map(len, ids[int(dim)])) >= rows:
                yield packed(int(dim))
    for dim in list(ids):
        yield packed(dim)


def _unpack(row: dict, ids: str, rows: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row[ids], "<i8"), np.frombuffer(row[rows], "<i8").reshape(-1, row["dim"])


def _products(q: np.ndarray, p: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products as int64; the float type is chosen so that every sum is exact."""
    if bound < 2**24:
        return (q.astype(np.float32) @ p.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def search_bucket(
    q_ids: np.ndarray, q: np.ndarray, p_ids: np.ndarray, p: np.ndarray, k: int, at_least: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of one bucket for each query of a block, as (query index, vec_id, score).

    ``at_least``: lower bounds on the queries' k-th scores, or None where there is none yet.
    A score equal to the bound is kept, since a smaller id may win the tie.
    """
    ql, pl = np.sqrt((q.astype(float) ** 2).sum(1)), np.sqrt((p.astype(float) ** 2).sum(1))
    live = np.arange(len(q))
    if at_least is not None:
        # Slack for the rounding of square roots; it only lets more through.
        need = at_least - 1e-6 * np.abs(at_least) - 1e-6
        live = np.flatnonzero(ql * pl.max(initial=0) >= need)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    unit = p / np.maximum(pl, 1e-300)[:, None]
    plain: list[int] = []
    for i in live:
        if at_least is None or need[i] <= 0 or ql[i] == 0:
            plain.append(i)
            continue
        cosine = need[i] / (ql[i] * pl.max())
        keep = pl >= need[i] / ql[i]
        if cosine >= COORDINATE_COSINE:
            f = int(np.argmax(np.abs(q[i])))
            c = q[i, f] / ql[i]
            reach = np.sqrt(max(0.0, 1 - cosine**2) * max(0.0, 1 - c * c)) + 1e-6
            low = -1.0 if c <= -cosine else c * cosine - reach
            high = 1.0 if c >= cosine else c * cosine + reach
            keep &= (unit[:, f] >= low - 1e-6) & (unit[:, f] <= high + 1e-6)
        if keep.mean() > 0.25:
            plain.append(i)
        elif keep.any():
            rows = np.flatnonzero(keep)
            s = _products(q[i : i + 1], p[rows], ql[i] * pl.max())[0]
            out.append(_best(np.full(len(rows), i), q_ids[i], p_ids[rows], s, k, at_least[i]))
    # Products of a block in one matrix product, a few hundred queries at a time.
    for start in range(0, len(plain), 256):
        own = np.array(plain[start : start + 256], dtype=int)
        s = _products(q[own], p, float(ql[own].max() * pl.max(initial=0)))
        for row, i in enumerate(own):
            floor = None if at_least is None else at_least[i]
            out.append(_best(np.full(len(p), i), q_ids[i], p_ids, s[row], k, floor))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _best(index, own_id, ids, scores, k, floor):
    ok = ids != own_id
    if floor is not None:
        ok &= scores >= floor
    rows = np.flatnonzero(ok)
    if len(rows) > k:
        s = scores[rows]
        edge = np.partition(s, len(s) - k)[len(s) - k]
        rows = rows[s >= edge]
        rows = rows[np.lexsort((ids[rows], -scores[rows]))][:k]
    return index[rows], ids[rows], scores[rows]


def _first_pass(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for row in batch.to_pylist():
                q_ids, q = _unpack(row, "q_ids", "q_rows")
                floor = np.full(len(q_ids), float("-inf"))
                if row["ids"] is not None:
                    p_ids, p = _unpack(row, "ids", "rows")
                    who, _, score = search_bucket(q_ids, q, p_ids, p, k, None)
                    full = np.bincount(who, minlength=len(q_ids)) >= k
                    low = np.full(len(q_ids), np.iinfo(np.int64).max)
                    np.minimum.at(low, who, score)
                    floor = np.where(full, low.astype(float), floor)
                bounds.append(floor.astype("<f8").tobytes())
            keep = [batch.column(c) for c in ("block", "dim", "q_ids", "q_rows")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(bounds, pa.binary())], names=["block", "dim", "q_ids", "q_rows", "bounds"]
            )

    return run


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                q_ids, q = _unpack(row, "q_ids", "q_rows")
                p_ids, p = _unpack(row, "ids", "rows")
                bounds = np.frombuffer(row["bounds"], "<f8")
                who, ids, scores = search_bucket(q_ids, q, p_ids, p, k, bounds)
                yield pa.RecordBatch.from_pydict(
                    {"query_id": pa.array(q_ids[who], pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())}
                )

    return run


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 20, bucket_rows: int = 4096, block_rows: int = 1024
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query by inner product.

    Both inputs are ``id long, v array<long>``; a candidate with the query's own id is left out, ties
    go to the smaller id, and a query with fewer candidates gets all of them. Only vectors of the same
    number of components meet. Rows that repeat an id each count; empty inputs give no rows. Products
    beyond the range of a long are not defined.

    A bucket holds about ``bucket_rows`` vectors, whatever the corpus size. Identical vectors are
    ordinary rows of neighbouring buckets, so a frequent one is spread like any other.
    """
    spark = candidates.sparkSession
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sized = cut_lineage(candidates.select("id", "v", length.alias("len")), "topk-vectors")
    # numbers come from the partition, so each range of lengths is one bucket number
    parts = max(1, -(-sized.count() // bucket_rows))
    ranged = sized.repartitionByRange(parts, F.desc("len"), "id").select("id", "v")
    buckets = cut_lineage(
        ranged.mapInArrow(lambda b: _pack(b, bucket_rows, True), _PACKED), "topk-buckets"
    )
    packed = queries.select("id", "v").mapInArrow(lambda b: _pack(b, block_rows, False), _PACKED)
    blocks = packed.select(
        F.monotonically_increasing_id().alias("block"), "dim", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows")
    )
    # The longest vectors of each dimension: at most ``bucket_rows`` rows for each, hence the broadcast.
    first = buckets.groupBy("dim").agg(F.min_by(F.struct("ids", "rows"), "bucket").alias("f"))
    begun = cut_lineage(
        blocks.join(F.broadcast(first.select("dim", "f.ids", "f.rows")), "dim", "left").mapInArrow(
            _first_pass(k), "block long, dim int, q_ids binary, q_rows binary, bounds binary"
        ),
        "topk-bounds",
    )
    last = buckets.agg(F.max("bucket")).first()[0] or 0
    key = (F.col("bucket").cast("long") * 2**32 + F.col("dim")).alias("key")
    tasks = max(parts, spark.sparkContext.defaultParallelism)
    numbered = begun.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(int(last)))))
    left = numbered.select(key, "dim", "q_ids", "q_rows", "bounds").repartition(tasks, "key")
    right = buckets.select(key, "ids", "rows").repartition(tasks, "key")
    found = left.join(right, "key").mapInArrow(_meet(k), _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
