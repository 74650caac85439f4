"""Delimited text whose quoted fields run over line ends, read in parallel.

Lines are read by byte range like any text. What a line means depends on whether it starts inside quotes,
which only the lines before it can tell. But a line has just two possible starts, so each byte range first
reports its effect for both: inside or outside at its end. The effects of a file's ranges, a few rows,
are chained, which fixes the true start of each range; then all ranges build their records at once. A record
that crosses a border leaves one fragment on each side, and only fragments are put together again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import ship_package


def _class(mark: str) -> str:
    return re.escape(mark)


def line_effects(line: Column, sep: str, quote: str) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it starts outside, and if it starts inside.

    A quote opens a field only as its first character; two quotes within a quoted field are one.
    """
    q, s = _class(quote), _class(sep)
    quoted = rf"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    field = rf"(?:{q}{quoted}{q}[^{s}]*+|[^{q}{s}][^{s}]*+|)"
    opened = rf"(?:{field}{s})*+{q}{quoted}\z"
    without = ~F.contains(line, F.lit(quote))
    outside = F.when(without, F.lit(False)).otherwise(line.rlike(rf"(?s)\A{opened}"))
    inside = F.when(without, F.lit(True)).otherwise(
        line.rlike(rf"(?s)\A{quoted}(?:\z|{q}[^{s}]*+{s}{opened})")
    )
    return outside, inside


def states_before(outside: np.ndarray, inside: np.ndarray, start: bool) -> tuple[np.ndarray, bool]:
    """Whether each line starts inside quotes, and whether the last one ends there.

    A line's effect is a constant, a swap, or nothing: the state is the last constant before, turned
    over by the swaps since.
    """
    n = len(outside)
    fixed = outside == inside
    turned = np.r_[0, np.cumsum(outside & ~inside)]
    last = np.maximum.accumulate(np.where(fixed, np.arange(n), -1)) if n else np.empty(0, int)
    base = np.where(last >= 0, outside[last], start) if n else np.empty(0, bool)
    since = turned[1:] - np.where(last >= 0, turned[last + 1], 0)
    after = base ^ (since % 2 == 1)
    return np.r_[start, after[:-1]][:n].astype(bool), bool(after[-1]) if n else start


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of a batch that belong to one byte range of one file."""
    file, block = batch.column("file"), batch.column("block").to_numpy()
    code = file.dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (block[1:] != block[:-1])]) if len(block) else []
    for a, b in zip(edges, [*edges[1:], len(block)], strict=True):
        yield file[int(a)].as_py(), int(block[a]), batch.slice(a, b - a)


def _flags(part: pa.RecordBatch) -> list[np.ndarray]:
    return [part.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("outside", "inside", "blank")]


def _range_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every byte range and both starts: the end, and how many records with content start in it."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, block, part in _runs(batch):
            outside, inside, blank = _flags(part)
            seen = found.setdefault((file, block), [False, 0, True, 0])
            for i in (0, 2):
                before, seen[i] = states_before(outside, inside, seen[i])
                seen[i + 1] += int((~before & ~blank).sum())
    rows = [(*key, *value) for key, value in found.items()]
    names = ["file", "block", "end_outside", "n_outside", "end_inside", "n_inside"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _chained(head: int):
    """The true start of every range of a file, and how many of its records stand in the first ``head``."""

    def run(ranges: pd.DataFrame) -> pd.DataFrame:
        rows, state, passed = [], False, 0
        for r in ranges.sort_values("block").itertuples():
            rows.append((r.file, r.block, state, max(0, head - passed)))
            passed += r.n_inside if state else r.n_outside
            state = r.end_inside if state else r.end_outside
        return pd.DataFrame(rows, columns=["file", "block", "starts_inside", "n_drop"])

    return run


class _Range:
    """Records of one byte range, line by line batch."""

    def __init__(self, state: bool, n_drop: int) -> None:
        self.state, self.n_drop = state, n_drop
        self.head: list[bytes] | None = [] if state else None
        self.open: list[bytes] = []
        self.dropped = False
        self.fragments: list[tuple[str, bool, bytes]] = []

    def add(self, part: pa.RecordBatch) -> pa.Array:
        """Whole records of the lines; an unfinished one waits."""
        outside, inside, blank = _flags(part)
        before, end = states_before(outside, inside, self.state)
        lines = part.column("line")
        starts = np.flatnonzero(~before)
        self.state = end
        first = int(starts[0]) if len(starts) else len(lines)
        if first:  # lines that go on with the record before
            (self.open if self.open else self.head).extend(lines.slice(0, first).to_pylist())
        done = []
        if self.open and (len(starts) or not end):
            if not self.dropped:
                done.append(b"\n".join(self.open))
            self.open = []
        if self.head is not None and (len(starts) or not end):
            self.fragments.append(("head", True, b"\n".join(self.head)))
            self.head = None
        if not len(starts):
            return pa.array(done, pa.binary())
        keep = blank[starts] | (np.cumsum(~blank[starts]) > self.n_drop)
        self.n_drop = max(0, self.n_drop - int((~blank[starts]).sum()))
        if end:
            tail = lines.slice(int(starts[-1])).to_pylist()
            lines, starts = lines.slice(0, int(starts[-1])), starts[:-1]
            last, keep = keep[-1], keep[:-1]
            # a record of the head of the file is read to its end, but not kept
            self.open = tail
            self.dropped = not last
        edges = np.r_[starts, len(lines)] - first
        held = lines.slice(first)
        groups = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), held) if len(starts) else None
        records = pc.binary_join(groups, b"\n").filter(pa.array(keep)) if groups is not None else pa.array([], pa.binary())
        return pa.concat_arrays([pa.array(done, pa.binary()), records]) if done else records

    def finish(self) -> list[tuple[str, bool, bytes]]:
        """What the range holds of records at its borders; a head is flagged if its record ends here, a tail
        if it is not to be kept."""
        if self.head is not None:
            self.fragments.append(("head", False, b"\n".join(self.head)))
        if self.open:
            self.fragments.append(("tail", self.dropped, b"\n".join(self.open)))
        return self.fragments


def _records(known, fragments: bool):
    """Task function: whole records of the ranges, or what is left of records at their borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = known.value
        current, reader = None, None
        for batch in batches:
            for file, block, part in _runs(batch):
                if (file, block) != current:
                    if reader is not None and fragments:
                        yield _fragment_rows(*current, reader.finish())
                    current = file, block
                    if current not in ranges:
                        raise RuntimeError(f"{file} was changed while it was read")
                    reader = _Range(*ranges[current])
                records = reader.add(part)
                if not fragments and len(records):
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(records)), records], names=["file", "record"])
        if reader is not None and fragments:
            yield _fragment_rows(*current, reader.finish())

    return run


def _fragment_rows(file: str, block: int, found: list) -> pa.RecordBatch:
    kinds = {"kind": pa.string(), "flag": pa.bool_(), "piece": pa.binary()}
    columns = zip(*found, strict=True) if found else [[] for _ in kinds]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
    n = len(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), *arrays], names=["file", "block", *kinds]
    )


def _stitched(pieces: pd.DataFrame) -> pd.DataFrame:
    """Records of a file that cross borders: a tail, and the heads of the ranges behind it up to a closed one."""
    out, parts, dropped = [], [], False
    rank = {"head": 0, "tail": 1}
    ordered = pieces.assign(rank=pieces["kind"].map(rank)).sort_values(["block", "rank"])
    for p in ordered.itertuples():
        if p.kind == "tail":
            parts, dropped = [p.piece], p.flag
            continue
        parts.append(p.piece)
        if p.flag:
            if not dropped:
                out.append(b"\n".join(parts))
            parts = []
    if parts and not dropped:  # the file ends inside quotes
        out.append(b"\n".join(parts))
    return pd.DataFrame({"file": pieces["file"].iloc[:1].repeat(len(out)).to_list(), "record": out})


def record_fields(text: Column, sep: str, quote: str) -> Column:
    """Fields of a record without its quotes."""
    q, s = _class(quote), _class(sep)
    quoted = rf"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    marked = F.regexp_extract_all(
        F.concat(F.lit(sep), text), F.lit(rf"(?s){s}({q}{quoted}(?:{q}[^{s}]*+|\z)|[^{s}]*+)"), 1
    )

    def bare(field: Column) -> Column:
        body = F.regexp_extract(field, rf"(?s)\A{q}({quoted})", 1)
        rest = F.regexp_extract(field, rf"(?s)\A{q}{quoted}{q}(.*)\z", 1)
        plain = F.concat(F.replace(body, F.lit(quote * 2), F.lit(quote)), rest)
        return F.when(F.startswith(field, F.lit(quote)), plain).otherwise(field)

    simple = F.split(text, s, -1)
    return F.when(F.contains(text, F.lit(quote)), F.transform(marked, bare)).otherwise(simple)


def read_records(spark: SparkSession, paths: Sequence[str], sep: str, quote: str, head: int) -> DataFrame:
    """``file, record`` (bytes, line ends within quotes kept) of all files, without the first ``head``
    records with content of each; ranges follow ``spark.sql.files.maxPartitionBytes``.

    The driver holds one small entry for each byte range, as Spark's own file index does. A quoted field that
    is never closed ends with its file.
    """
    ship_package(spark)
    raw = spark.read.text(list(paths), lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    latin = F.decode("line", "ISO-8859-1")  # a character for each byte, whatever the encoding
    outside, inside = line_effects(latin, _as_latin(sep), _as_latin(quote))
    lines = raw.select("*", outside.alias("outside"), inside.alias("inside"), latin.isin("", "\r").alias("blank"))
    effects = "file string, block long, end_outside boolean, n_outside long, end_inside boolean, n_inside long"
    found = lines.drop("line").mapInArrow(_range_effects, effects)
    chained = found.groupBy("file").applyInPandas(
        _chained(head), "file string, block long, starts_inside boolean, n_drop long"
    )
    ranges = {(r["file"], r["block"]): (r["starts_inside"], r["n_drop"]) for r in chained.toLocalIterator()}
    known = spark.sparkContext.broadcast(ranges)
    whole = lines.mapInArrow(_records(known, False), "file string, record binary")
    pieces = lines.mapInArrow(_records(known, True), "file string, block long, kind string, flag boolean, piece binary")
    return whole.unionByName(pieces.groupBy("file").applyInPandas(_stitched, "file string, record binary"))


def _as_latin(mark: str) -> str:
    return mark.encode().decode("latin-1")
