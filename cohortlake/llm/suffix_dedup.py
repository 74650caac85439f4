"""Repeated byte strings removed with a sparse suffix sort.

Of each run of suffixes whose leading 50 bytes overlap, only one is kept: the *anchor*, the suffix with
the smallest hashed leading ``LEAD`` bytes among those that start within a 50-byte window. Equal windows
have equal anchors at equal places, so suffixes with different leading bytes need never be compared.

1. Documents are packed into blocks. Each block sends the hashed leading bytes of its anchors, dealt by
   range; a range returns those that stand in more than one document.
2. For these anchors, blocks send the suffixes themselves with the bytes before them that their windows
   reach: distinct ones once, with their places. They are range-partitioned by leading bytes. The bytes
   are hashed, so splitters at equal steps share out evenly and no sample is needed to find them; a
   splitter never falls between equal leading bytes, so no window has a match across a boundary.
3. Each bucket sorts by multikey quicksort, eight bytes a key, refining only groups that are still
   tied. Equal strings meet, the smallest doc_id stands, and the windows of all others are marked.
   Strings that agree only in part are compared window by window in the same way.
4. Marks go back to the blocks, which cut the marked bytes out.

A passage that a third of all documents share is one entry for each block, not for each document. If
its surroundings differ, its leading bytes have many strings; beyond ``HOT_LEAD`` of them, each window
is sent as a string of its own under its own hash, which spreads them over all buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, flat, gathered, lists, ragged, release_memory, shuffle_partitions, tidy
from cohortlake.llm.postings import packed_columns, unpacked

#: Bytes of a string that counts as repeated.
WINDOW = 50
#: Leading bytes by which suffixes meet, and how many of them start within a window.
LEAD = 26
REACH = WINDOW - LEAD + 1
#: Bytes of text in a block, and positions looked at together within it.
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 18
#: Records of the same leading bytes from which their windows are dealt out one by one.
HOT_LEAD = 4096
#: Windows compared at once in a bucket.
HELD_WINDOWS = 1 << 19
_LAST = np.iinfo(np.int64).max


def _words(buf: np.ndarray, start: int, count: int, kind: str) -> np.ndarray:
    """Whole numbers read at every byte position from ``start`` on."""
    size = np.dtype(kind).itemsize
    view = np.ndarray((count,), kind, buffer=buf[start : start + count + size - 1], strides=(1,))
    return view.astype(np.uint64)


def lead_hashes(buf: np.ndarray, start: int, count: int) -> np.ndarray:
    """Hash of the LEAD bytes at each position."""
    h = _words(buf, start, count, "<u8") * np.uint64(0x9E3779B97F4A7C15)
    for at, odd in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9)):
        h = (h ^ (h >> np.uint64(29))) + _words(buf, start + at, count, "<u8") * np.uint64(odd)
    h = (h ^ (h >> np.uint64(32))) + _words(buf, start + 24, count, "<u2") * np.uint64(0x27D4EB2F165667C5)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end (``ends``: where each ends): the first window of each anchor, the
    number of its windows, and its leading hash (48 bits). Windows never cross an end."""
    n = len(buf)
    total = n - WINDOW + 1
    first, count, leads = [], [], []
    for a in range(0, max(total, 0), CHUNK):
        m = min(CHUNK, total - a)
        h = lead_hashes(buf, a, m + REACH - 1)
        key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        low, width = key, 1
        while width * 2 <= REACH:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:m], low[REACH - width : REACH - width + m])
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        valid = np.ones(m, bool)
        near = ends[(ends > a) & (ends < a + m + WINDOW - 1)] - a
        for e in near.tolist():
            valid[max(0, e - WINDOW + 1) : e] = False
        new = np.r_[True, at[1:] != at[:-1]]
        new[1:] |= valid[1:] & ~valid[:-1]
        starts = np.flatnonzero(new & valid)
        stops = np.flatnonzero(np.r_[(new | ~valid)[1:], True] & valid) + 1
        first.append(starts + a)
        count.append(stops - starts)
        leads.append(h[at[starts]] >> np.uint64(16))
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(first), np.concatenate(count), np.concatenate(leads)


def equal_classes(group: np.ndarray, columns: Iterator[np.ndarray]) -> np.ndarray:
    """Class of each row: rows are equal in ``group`` and in every column. Multikey quicksort: each
    column orders only the rows that are still tied."""
    label = np.unique(group, return_inverse=True)[1].astype(np.int64)
    for column in columns:
        sizes = np.bincount(label)
        tied = np.flatnonzero(sizes[label] > 1)
        if not len(tied):
            break
        own, key = label[tied], column[tied]
        order = np.lexsort((key, own))
        own, key = own[order], key[order]
        new = np.r_[True, (own[1:] != own[:-1]) | (key[1:] != key[:-1])]
        # the first key of a group keeps the group's label; each further one gets a new label
        leads = np.r_[True, own[1:] != own[:-1]]
        fresh = new & ~leads
        names = np.where(leads, own, len(sizes) + np.cumsum(fresh) - 1)
        held = np.flatnonzero(new)
        label[tied[order]] = np.repeat(names[held], np.diff(np.r_[held, len(own)]))
    return label


def smallest(label: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each row, the smallest value of its class."""
    low = np.full(int(label.max(initial=-1)) + 1, _LAST)
    np.minimum.at(low, label, value)
    return low[label]


def _laid_out(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(rows.column("text"), "").cast(pa.large_binary())
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"".join(texts.to_pylist()) + bytes(WINDOW)
    ends = np.cumsum(sizes)
    return np.frombuffer(joined, np.uint8)[: int(sizes.sum()) + WINDOW], ends


def _anchors_of(rows: pa.RecordBatch):
    buf, ends = _laid_out(rows)
    first, count, leads = anchors(buf[: len(buf) - WINDOW], ends) if len(buf) > 2 * WINDOW - 1 else anchors(buf[:0], ends)
    return buf, ends, first, count, leads


def _small(values: np.ndarray) -> dict[str, pa.Array]:
    """Sorted numbers as steps, in four bytes where they fit."""
    steps = np.diff(values, prepend=np.uint64(0))
    fits = len(steps) < 2 or int(steps[1:].max()) < 1 << 32
    rest = steps[1:].astype(np.uint32) if fits else steps[1:]
    return {"rest": lists(rest, np.array([0, len(rest)])), "from": pa.array(values[:1] if len(values) else [0], pa.uint64())}


def _large(row: pa.RecordBatch) -> np.ndarray:
    rest, _ = flat(row.column("rest"))
    return np.cumsum(np.r_[row.column("from").to_numpy(), rest.astype(np.uint64)], dtype=np.uint64)


def _send_leads(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                _, ends, first, _, leads = _anchors_of(unpacked(data))
                if not len(leads):
                    continue
                doc = np.searchsorted(ends, first, side="right")
                order = np.argsort(leads, kind="stable")
                leads, doc = leads[order], doc[order]
                starts = np.flatnonzero(np.r_[True, leads[1:] != leads[:-1]])
                several = np.maximum.reduceat(doc, starts) != np.minimum.reduceat(doc, starts)
                # frequency in the block, doubled; odd where more than one document has it
                seen = (np.diff(np.r_[starts, len(leads)]) * 2 + several).astype(np.uint32)
                leads = leads[starts]
                home = _range_of(leads, ranges)
                cuts = np.searchsorted(home, np.arange(ranges + 1))
                out = [(r, cuts[r], cuts[r + 1]) for r in range(ranges) if cuts[r] < cuts[r + 1]]
                packed = [
                    packed_columns(_small(leads[a:b]) | {"seen": lists(seen[a:b], np.array([0, b - a]))}) for _, a, b in out
                ]
                yield pa.RecordBatch.from_pydict(
                    {"range": pa.array([r for r, _, _ in out], pa.int32()), "block": pa.array([block] * len(out), pa.int64()), "packed": pa.array(packed, pa.binary())}
                )

    return run


def _range_of(leads: np.ndarray, ranges: int) -> np.ndarray:
    return ((leads >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _repeated_leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    leads, seen, blocks = [], [], []
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            row = unpacked(data)
            leads.append(_large(row))
            seen.append(flat(row.column("seen"))[0])
            blocks.append(np.full(len(leads[-1]), block))
    if not leads:
        return
    x, m, b = np.concatenate(leads), np.concatenate(seen), np.concatenate(blocks)
    order = np.argsort(x, kind="stable")
    x, m, b = x[order], m[order], b[order]
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    sizes = np.diff(np.r_[starts, len(x)])
    again = np.repeat((sizes > 1) | (np.bitwise_or.reduceat(m, starts) & 1 > 0), sizes)
    hot = np.repeat(np.add.reduceat((m >> 1).astype(np.int64), starts) > HOT_LEAD, sizes)
    x, b, hot = x[again], b[again], hot[again]
    order = np.lexsort((x, b))
    x, b, hot = x[order], b[order], hot[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else [], len(b)].astype(int)
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        packed = packed_columns(_small(x[start:stop]) | {"hot": lists(hot[start:stop], np.array([0, stop - start]))})
        yield pa.RecordBatch.from_pydict({"block": pa.array([int(b[start])], pa.int64()), "leads": pa.array([packed], pa.binary())})


def _send_strings(ranges: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"range": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "packed": pa.array([], pa.binary())})
        if not left.num_rows or not right.num_rows:
            return empty
        rows = unpacked(left.column("packed")[0].as_py())
        replies = [unpacked(d.as_py()) for d in right.column("leads")]
        wanted, hot = (np.concatenate(x) for x in zip(*((_large(r), flat(r.column("hot"))[0]) for r in replies), strict=True))
        order = np.argsort(wanted)
        wanted, hot = wanted[order], hot[order]
        buf, ends, first, count, leads = _anchors_of(rows)
        if not len(leads):
            return empty
        at = np.minimum(np.searchsorted(wanted, leads), len(wanted) - 1)
        hit = wanted[at] == leads
        first, count, leads, hot = first[hit], count[hit], leads[hit], hot[at[hit]]
        if hot.any():
            single = ragged(first[hot], count[hot])
            first = np.r_[first[~hot], single]
            leads = np.r_[leads[~hot], _window_hashes(buf, single)]
            count = np.r_[count[~hot], np.ones(len(single), np.int64)]
        ids = pc.fill_null(rows.column("doc_id"), _LAST).to_numpy(zero_copy_only=False)
        doc = ids[np.searchsorted(ends, first, side="right")]
        label = equal_classes(leads, _string_keys(buf, first, count))
        order = np.lexsort((doc, label, leads))
        first, count, leads, doc, label = first[order], count[order], leads[order], doc[order], label[order]
        starts = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
        edges = np.r_[starts, len(label)]
        sizes = (count + WINDOW - 1)[starts]
        home = _range_of(leads[starts], ranges)
        cuts = np.searchsorted(home, np.arange(ranges + 1))
        named, packed = [], []
        for r in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[r], cuts[r + 1]
            rec = slice(edges[a], edges[b])
            text = buf[ragged(first[starts[a:b]], sizes[a:b])]
            named.append(int(r))
            packed.append(
                packed_columns(
                    {
                        "lead": pa.array(leads[starts[a:b]]),
                        "string": lists(text, np.r_[0, np.cumsum(sizes[a:b])]),
                        "first": lists(first[rec].astype(np.int32), edges[a : b + 1] - edges[a]),
                        "doc": lists(doc[rec], edges[a : b + 1] - edges[a]),
                    }
                )
            )
        release_memory()
        return pa.table(
            {"range": pa.array(named, pa.int32()), "block": pa.array([key[0].as_py()] * len(named), pa.int64()), "packed": pa.array(packed, pa.binary())}
        )

    return run


def _window_hashes(buf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """48-bit hash of the window at each place."""
    view = _at_every_byte(buf)
    h = np.zeros(len(first), np.uint64)
    for at in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        h = (h ^ (h >> np.uint64(29)) ^ view[first + at]) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)


def _at_every_byte(buf: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as numbers; the texts end eight bytes before the buffer."""
    return np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))


def _string_keys(buf: np.ndarray, first: np.ndarray, count: np.ndarray) -> Iterator[np.ndarray]:
    """Keys that decide whether strings are equal: the length, then eight bytes at a time."""
    size = count + WINDOW - 1
    yield size
    view = _at_every_byte(buf)
    for at in range(0, int(size.max(initial=0)), 8):
        # a key that would pass the string's end is taken from its last eight bytes
        yield view[first + np.minimum(at, size - 8)]


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lead, size, text, n_rec, first, doc, block = [], [], [], [], [], [], []
    for batch in batches:
        for b, data in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            row = unpacked(data)
            lead.append(row.column("lead").to_numpy())
            t, s = flat(row.column("string"))
            f, n = flat(row.column("first"))
            text.append(t), size.append(s), first.append(f), n_rec.append(n)
            doc.append(flat(row.column("doc"))[0])
            block.append(np.full(len(f), b))
    if not lead:
        return
    lead, size, n_rec, first, doc, block = (np.concatenate(x) for x in (lead, size, n_rec, first, doc, block))
    text = np.concatenate([*text, np.zeros(8, np.uint8)])
    begin = np.cumsum(size) - size
    count = size - WINDOW + 1
    label = equal_classes(lead, _string_keys(text, begin, count))
    entry = np.repeat(np.arange(len(lead)), n_rec)
    low = np.full(int(label.max()) + 1, _LAST)
    np.minimum.at(low, label[entry], doc)
    # Strings that also stand in an earlier document: every window is marked.
    later = doc > low[label[entry]]
    out = [(block[later], first[later].astype(np.int64), count[entry[later]])]
    # One string of each class stands for it; those that share leading bytes meet window by window.
    stands = np.unique(label, return_index=True)[1]
    leads_of = np.unique(lead[stands], return_inverse=True, return_counts=True)
    stands = stands[leads_of[2][leads_of[1]] > 1]
    stands = stands[np.argsort(lead[stands], kind="stable")]
    rec = np.flatnonzero(~later)
    rec = rec[np.argsort(label[entry[rec]], kind="stable")]
    rec_label = label[entry[rec]]
    view = _at_every_byte(text)
    # Chunks end where the leading bytes change; no lead has more than HOT_LEAD strings.
    ends = np.flatnonzero(np.r_[lead[stands][1:] != lead[stands][:-1], True]) + 1 if len(stands) else []
    total = np.cumsum(count[stands])
    start = 0
    while start < len(stands):
        past = (total[start - 1] if start else 0) + HELD_WINDOWS
        stop = int(ends[np.searchsorted(ends, max(np.searchsorted(total, past, side="right"), start + 1))])
        some = stands[start:stop]
        start = stop
        at = ragged(begin[some], count[some])
        owner = np.repeat(np.arange(len(some)), count[some])
        keys = (view[at + min(k, WINDOW - 8)] for k in range(0, WINDOW, 8))
        window = equal_classes(lead[some][owner], keys)
        own = low[label[some]][owner]
        marked = own > smallest(window, own)
        # Runs of marked windows of each string, for all its records of the smallest document.
        new = marked & np.r_[True, ~marked[:-1] | (owner[1:] != owner[:-1])]
        end = marked & np.r_[~marked[1:] | (owner[1:] != owner[:-1]), True]
        runs, stops = np.flatnonzero(new), np.flatnonzero(end) + 1
        offset = runs - (np.cumsum(count[some]) - count[some])[owner[runs]]
        left = np.searchsorted(rec_label, label[some][owner[runs]], side="left")
        reps = np.searchsorted(rec_label, label[some][owner[runs]], side="right") - left
        who = rec[ragged(left, reps)]
        out.append((block[who], first[who] + np.repeat(offset, reps), np.repeat(stops - runs, reps)))
    b, f, c = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((f, b))
    b, f, c = b[order], f[order], c[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else [], len(b)].astype(int)
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        whole = np.array([0, stop - start])
        packed = packed_columns({"first": lists(f[start:stop].astype(np.int32), whole), "count": lists(c[start:stop].astype(np.int32), whole)})
        yield pa.RecordBatch.from_pydict({"block": pa.array([int(b[start])], pa.int64()), "marks": pa.array([packed], pa.binary())})


def _cut(columns: list[str], with_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = unpacked(left.column("packed")[0].as_py()) if left.num_rows else None
        buf, ends = _laid_out(rows)
        removed = np.zeros(len(buf) + 1, np.int32)
        for d in right.column("marks"):
            row = unpacked(d.as_py())
            f, c = flat(row.column("first"))[0], flat(row.column("count"))[0]
            np.add.at(removed, f, 1)
            np.add.at(removed, f.astype(np.int64) + c + WINDOW - 1, -1)
        gone = np.cumsum(removed, dtype=np.int32)[:-1] > 0
        del removed
        starts = np.r_[0, ends[:-1]]
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        at = starts[starts < len(gone)]
        opens[at] = gone[at]
        sums = np.r_[0, np.cumsum(gone, dtype=np.int32)]
        runs = np.r_[0, np.cumsum(opens, dtype=np.int32)]
        del opens
        n_removed = sums[ends] - sums[starts]
        kept = []
        for a, e, r in zip(starts.tolist(), ends.tolist(), n_removed.tolist(), strict=True):
            part = buf[a:e]
            kept.append(part.tobytes() if not r else part[~gone[a:e]].tobytes())
        out = {c: rows.column(c) for c in columns}
        release_memory()
        if with_text:
            out["text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        return pa.table(
            out
            | {
                "n_bytes": pa.array(ends - starts),
                "n_removed": pa.array(n_removed.astype(np.int64)),
                "n_spans": pa.array((runs[ends] - runs[starts]).astype(np.int64)),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            }
        )

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Rows of ``docs`` (doc_id long, text string, more) without text, with ``n_bytes, n_removed,
    n_spans, kept_sha256`` and, if ``with_text``, the new ``text``: what stays, without the rests of
    characters that a cut has split.

    A byte goes if a 50-byte string that covers it also starts in a row with a smaller doc_id; strings
    are judged on the input and never cross rows. Null texts are empty. Rows that repeat a doc_id do
    not count against each other; a null doc_id is larger than any other. Other columns pass through,
    but for the names above, which are replaced. The digest is of the bytes that stay.
    """
    spark = docs.sparkSession
    made = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    source = docs.select(*(c for c in docs.columns if c not in made)).withColumn("doc_id", F.col("doc_id").cast("long"))
    columns = [c for c in source.columns if c != "text"]
    # Strings are some times their text, so their ranges are finer than usual partitions.
    ranges = 4 * shuffle_partitions(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, "text", BLOCK_BYTES):
            data = packed_columns(dict(zip(batch.schema.names, batch.columns, strict=True)))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "packed": pa.array([data], pa.binary())})
            block += 1

    blocks = cut_lineage(source.mapInArrow(tidy(pack), "block long, packed binary"), "suffix-blocks")
    leads = blocks.mapInArrow(tidy(_send_leads(ranges)), "range int, block long, packed binary")
    repeated = leads.repartition(ranges, "range").mapInArrow(tidy(_repeated_leads), "block long, leads binary")
    strings = (
        blocks.groupBy("block")
        .cogroup(repeated.groupBy("block"))
        .applyInArrow(_send_strings(ranges), "range int, block long, packed binary")
    )
    marks = strings.repartition(ranges, "range").mapInArrow(tidy(_marks), "block long, marks binary")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != "text")
    kept = ", text string" if with_text else ""
    return (
        blocks.groupBy("block")
        .cogroup(marks.groupBy("block"))
        .applyInArrow(
            _cut(columns, with_text), f"{fields}{kept}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        )
    )
