"""Helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import cut_lineage, ship_package, table

__all__ = [
    "cut_lineage", "documents", "flat", "lists", "ragged", "shuffle_partitions", "table", "text_tokens",
    "words_of",
]


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    ship_package(spark)
    return table(spark, sf_dir, "documents").select(*columns)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at the six ASCII white-space bytes.

    ``bytes.lower`` and ``bytes.split`` know exactly those letters and those six bytes.
    """
    return (text or "").encode("utf-8", "replace").lower().split()


def text_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a column of texts as one array, and the text that each belongs to."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    parts = pc.ascii_split_whitespace(lowered.cast(pa.large_string()))
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(parts)
    some = pc.greater(pc.binary_length(words), 0)
    return words.filter(some), owner[some.to_numpy(zero_copy_only=False)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many runs, one after another: start, start + 1, ... for each run."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - first, lengths)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the length of each list (null lists count as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(column).to_numpy(zero_copy_only=False), lengths.astype(np.int64)


def gathered(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until ``column`` holds ``most_bytes``; a block never splits a row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        step = max(1, batch.num_rows * most_bytes // max(1, batch.column(column).nbytes))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            held.append(part)
            size += int(pc.sum(pc.binary_length(part.column(column))).as_py() or 0)
            if size >= most_bytes:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()
    return whole[0] if whole else parts[0]


def third(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string")) % modulus


def release_memory() -> None:
    """Give freed memory back to the system; idle Python workers otherwise keep their largest size."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable, forget: Callable[[], None] | None = None) -> Callable:
    """A task function that gives its memory back when its input is done."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            release_memory()

    return tidied
