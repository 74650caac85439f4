"""Frequencies of text units in documents, and sums of unit values over documents.

Documents are read in blocks of some megabytes. The distinct units of a block are dealt into buckets
by their hash, and a (block, bucket) pair is one packed row: units, the places of the block's
documents that hold them, and frequencies. All rows of a unit thus meet in one bucket, where its value
is found once; the sums go back to the block. A shuffle moves packed columns instead of one row for
each unit of each document.

A hot unit, one in more than an eighth of a block's documents, would send all its postings to one
bucket. Such units of a block are packed apart and dealt by block instead; there are at most eight
times as many as a document has distinct units on average.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import flat, gathered, lists, shuffle_partitions, tidy

#: Bytes of text in a block. Memory of a task is some multiple of it, whatever the table's size.
BLOCK_BYTES = 24 << 20
#: Sums a task holds before it hands them on.
HELD_SUMS = 2 << 20
#: Share of a block's documents from which a unit is hot: one in so many.
HOT = 8
POSTINGS = (
    "block long, bucket int, n_docs int, packed binary, "
    "doc_ids array<long>, n_bytes array<long>, trained array<boolean>, sums array<double>"
)
#: Units of a column of texts: the units, and the index of the text of each.
Units = Callable[[pa.Array], tuple[pa.Array, np.ndarray]]


def packed_columns(columns: dict[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def bucket_of(units: pa.Array, buckets: int) -> np.ndarray:
    """Bucket of each unit, the same on every machine."""
    named = units.to_numpy(zero_copy_only=False)
    return (pd.util.hash_array(named, categorize=False) % np.uint64(buckets)).astype(np.int32)


def bucket_count(df: DataFrame) -> int:
    return 4 * shuffle_partitions(df.sparkSession)


def block_postings(docs: DataFrame, units: Units, block_bytes: int = BLOCK_BYTES, known=None, sort: bool = True) -> DataFrame:
    """Postings of ``docs`` (doc_id long, text string, training boolean).

    Rows: ``packed`` null: the block itself (``doc_ids, n_bytes, trained`` by place); otherwise units of
    a bucket, or, for a bucket below 0, hot units of a block. ``packed``: unit, at, times, and
    ``training``, the unit's frequency in the block's training documents. Every input row is a document
    of its own, repeated ids too. Blocks follow the order of the input's rows, so ``docs`` must be a
    plain scan, which gives the same blocks again when a lost task is run anew.

    ``known``: a broadcast of unit -> values for the most frequent units. Their sums are taken where
    they are found (``sums`` of the block's row, value by value, by place), and they are not dealt out.
    ``sort``: units of a bucket in order of their bytes, which packs them closer and takes longer.
    """
    buckets = bucket_count(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, "text", block_bytes):
            texts = pc.fill_null(batch.column("text"), "")
            training = pc.fill_null(batch.column("training"), False)
            n = len(texts)
            whole = pa.array([0, n], pa.int32())
            make = pa.ListArray.from_arrays
            words, owner = units(texts)
            rows, sums = None, None
            if len(words):
                seen = training.to_numpy(zero_copy_only=False)
                rows, sums = _unit_rows(block, words, owner, seen, n, buckets, known.value if known else None, sort)
            yield _row(
                1, block, n,
                bucket=pa.array([block % buckets], pa.int32()),
                doc_ids=make(whole, batch.column("doc_id")),
                n_bytes=make(whole, pc.binary_length(texts).cast(pa.int64())),
                trained=make(whole, training),
                **({} if sums is None else {"sums": lists(sums.ravel(), np.array([0, sums.size]))}),
            )
            if rows is not None:
                yield rows
            block += 1

    return docs.select("doc_id", "text", "training").mapInArrow(tidy(run), POSTINGS)


def _row(n: int, block: int, n_docs: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {
        "bucket": pa.int32(), "packed": pa.binary(), "doc_ids": pa.list_(pa.int64()),
        "n_bytes": pa.list_(pa.int64()), "trained": pa.list_(pa.bool_()), "sums": pa.list_(pa.float64()),
    }
    columns |= {"block": pa.array([block] * n, pa.int64()), "n_docs": pa.array([n_docs] * n, pa.int32())}
    names = ["block", "bucket", "n_docs", "packed", "doc_ids", "n_bytes", "trained", "sums"]
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, kinds[c]) for c in names], names=names)


def _unit_rows(
    block: int, words: pa.Array, owner: np.ndarray, training: np.ndarray, n_docs: int, buckets: int, known: dict | None, sort: bool
) -> tuple[pa.RecordBatch, np.ndarray | None]:
    coded = words.dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).cast(pa.binary())
    home = bucket_of(names, buckets)
    # Units in order of bucket and, if wanted, bytes, so that like ones are packed side by side.
    order = np.lexsort((pc.rank(names, tiebreaker="first").to_numpy(), home)) if sort else np.argsort(home, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    key = place[coded.indices.to_numpy(zero_copy_only=False)] * n_docs + owner
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    times = np.diff(np.r_[first, len(key)]).astype(np.int32)
    unit, at = np.divmod(key[first], n_docs)
    at = at.astype(np.int32)
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    sizes = np.diff(np.r_[starts, len(unit)])
    seen = np.add.reduceat(times * training[at].astype(np.int64), starts)
    home, names = home[order], names.take(pa.array(order))
    hot = sizes * HOT > max(n_docs, 4 * HOT)
    sums = None
    if known is not None:
        found = [known.get(u) for u in names.to_pylist()]
        hot = np.array([f is not None for f in found])
        values = np.array([f for f in found if f is not None], float)
        if len(values):
            use = np.repeat(hot, sizes)
            value = np.repeat(values, sizes[hot], axis=0)
            sums = np.stack([np.bincount(at[use], weights=v * times[use], minlength=n_docs) for v in value.T])

    def pack(chosen: np.ndarray) -> bytes:
        lengths = sizes[chosen]
        if len(chosen) and chosen[-1] - chosen[0] + 1 == len(chosen):
            rows = slice(starts[chosen[0]], starts[chosen[-1]] + lengths[-1])
        else:
            rows = np.repeat(starts[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        ends = np.r_[0, np.cumsum(lengths)]
        return packed_columns(
            {"unit": names.take(pa.array(chosen)), "at": lists(at[rows], ends), "times": lists(times[rows], ends), "training": pa.array(seen[chosen])}
        )

    bounds = np.searchsorted(home, np.arange(buckets + 1))
    out: list[tuple[int, bytes]] = []
    for b in range(buckets):
        own = np.arange(bounds[b], bounds[b + 1])
        own = own[~hot[own]]
        if len(own):
            out.append((b, pack(own)))
    if hot.any() and known is None:
        out.append((-1 - int(block % buckets), pack(np.flatnonzero(hot))))
    rows = _row(
        len(out), block, n_docs,
        bucket=pa.array([b for b, _ in out], pa.int32()), packed=pa.array([p for _, p in out], pa.binary()),
    )
    return rows, sums


class HeldSums:
    """Sums by block and place; handed on when there are many."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.held: dict[int, np.ndarray] = {}
        self.cells = 0

    def add(self, block: int, n_docs: int, at: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """values: one row for each name, one column for each entry of ``at``."""
        if block not in self.held:
            if self.cells and self.cells + n_docs > HELD_SUMS:
                yield from self.flush()
            self.held[block] = np.zeros((len(self.names), n_docs))
            self.cells += n_docs
        for total, v in zip(self.held[block], values, strict=True):
            total += np.bincount(at, weights=v, minlength=n_docs)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for block, sums in self.held.items():
            at = np.flatnonzero(sums.any(0))
            whole = np.array([0, len(at)])
            none = [pa.nulls(1, pa.list_(kind)) for kind in (pa.int64(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), lists(at.astype(np.int32), whole), *(lists(s[at], whole) for s in sums), *none],
                names=["block", "at", *self.names, "doc_ids", "n_bytes", "trained"],
            )
        self.held, self.cells = {}, 0

    def schema(self) -> str:
        sums = ", ".join(f"{n} array<double>" for n in self.names)
        return f"block long, at array<int>, {sums}, doc_ids array<long>, n_bytes array<long>, trained array<boolean>"


def sums_by_document(postings: DataFrame, value_of: Callable[[], Callable], names: list[str]) -> DataFrame:
    """``doc_id, n_bytes, training`` and, for each of ``names``, the sum over the document's units of
    frequency times value. ``value_of()`` gives, in a task, a function from units to one array of
    values for each name; it sees a unit once in a bucket. A document without units has sums of zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, held = value_of(), HeldSums(names)
        known: dict[bytes, tuple] = {}
        for batch in batches:
            yield from passed_on(batch, names)
            for block, n_docs, data in zip(*(batch.column(c).to_pylist() for c in ("block", "n_docs", "packed")), strict=True):
                if data is None:
                    continue
                rows = unpacked(data)
                units = rows.column("unit").to_pylist()
                fresh = [u for u in units if u not in known]
                if fresh:
                    known.update(zip(fresh, zip(*function(fresh), strict=True), strict=True))
                values = np.array([known[u] for u in units], float).T
                at, lengths = flat(rows.column("at"))
                times, _ = flat(rows.column("times"))
                yield from held.add(block, n_docs, at, np.repeat(values, lengths, axis=1) * times)
        yield from held.flush()

    dealt = postings.repartition(shuffle_partitions(postings.sparkSession), "bucket")
    return finished(dealt.mapInArrow(tidy(run), HeldSums(names).schema()), names)


def passed_on(batch: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks themselves, in the form of sums."""
    own = batch.filter(pc.is_valid(batch.column("doc_ids")))
    for at in range(own.num_rows):
        n = own.column("n_docs")[at].as_py()
        total = own.column("sums")[at]
        whole = np.array([0, n])
        if total.is_valid:
            values = total.values.to_numpy().reshape(len(names), n)
            sums = [lists(np.arange(n, dtype=np.int32), whole), *(lists(v, whole) for v in values)]
        else:
            sums = [pa.nulls(1, pa.list_(pa.int32())), *(pa.nulls(1, pa.list_(pa.float64())) for _ in names)]
        block = [own.column(c).slice(at, 1) for c in ("doc_ids", "n_bytes", "trained")]
        yield pa.RecordBatch.from_arrays(
            [own.column("block").slice(at, 1), *sums, *block], names=["block", "at", *names, "doc_ids", "n_bytes", "trained"]
        )


def finished(parts: DataFrame, names: list[str]) -> DataFrame:
    """Sums of parts and rows of blocks, by document."""
    out = ", ".join(f"{n} double" for n in names)

    def finish(rows: pa.Table) -> pa.Table:
        own = rows.filter(pc.is_valid(rows.column("doc_ids"))).slice(0, 1)
        kept = rows.filter(pc.is_valid(rows.column("at")))
        at, _ = flat(kept.column("at"))
        columns = {
            "doc_id": pc.list_flatten(own.column("doc_ids")),
            "n_bytes": pc.list_flatten(own.column("n_bytes")),
            "training": pc.list_flatten(own.column("trained")),
        }
        for name in names:
            v, _ = flat(kept.column(name))
            columns[name] = pa.array(np.bincount(at, weights=v, minlength=len(columns["doc_id"])).astype(float))
        return pa.table(columns)

    return parts.groupBy("block").applyInArrow(finish, f"doc_id long, n_bytes long, training boolean, {out}")
