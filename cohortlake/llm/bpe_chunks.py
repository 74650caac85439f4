"""Byte-level BPE by chunks that documents share.

1. A rolling hash over 32 bytes cuts every text where its value says so, so equal passages are cut alike
   wherever they stand. Chunks that more than one document holds are found by their hashes alone.
2. A document without such a chunk has nothing to share and is encoded whole, where it is. The distinct
   chunks of all others are dealt out by their hashes, block of documents by block.
3. All copies of a chunk meet in one bucket, are encoded there once, and the ids go back to the blocks.
4. A block lines up the ids of each document's chunks. A chunk knows nothing of its neighbours, so the
   tokens around a join may be wrong. From the last sure edge before a join to the first one behind it the
   text is encoded anew; if the window's edges are no token edges on both sides, the window grows by one
   sure edge each way and is encoded again, until both sides agree.

A *sure edge* is white space behind a visible ASCII character. No pre-token of the model's pattern holds
white space after its first place, and what stands before such a place cannot reach across it; so the
pattern splits there in every context, also at the edge of a chunk.

Encoding runs in a compiled library that takes the vocabulary as ranks; ``read_model`` makes sure that
ranks and merges say the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import flat, gathered, lists, ragged, shuffle_partitions, tidy
from cohortlake.llm.postings import packed_columns, unpacked

#: Bytes of text in a block. Memory of a task is some multiple of it, whatever the table's size.
BLOCK_BYTES = 8 << 20
#: Ids that a bucket keeps at hand, in bytes; beyond them it starts afresh.
KEPT_BYTES = 64 << 20
WINDOW = 32
#: A cut falls where so many low bits of the rolling hash are zero: every 256 bytes on average.
CUT_BITS = 8
#: A cut this close behind another is none; a chunk longer than the limit is cut there.
LEAST, MOST = 64, 4096
PIECES = "block long, bucket int, packed binary, doc_ids array<long>, n_chunks array<int>, refs array<int>"
RESULT = "doc_id long, n_tokens long, ids binary, decoded string"
#: 64-bit words of marks of shared chunks.
MARK_WORDS = 1 << 20
#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Model(NamedTuple):
    encoding: object
    special: frozenset
    token_bytes: pa.Array
    id_type: type


def _byte_of_char() -> dict[str, int]:
    """Printable characters stand for themselves, other bytes for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=1)
def read_model(path: str) -> Model:
    """The tokenizer at ``path``; raises where its settings are beyond this module."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain = steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space")
    if not plain or spec["normalizer"] or spec["post_processor"] or model["type"] != "BPE":
        raise ValueError(f"{path}: not a plain byte-level BPE model")
    if any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "end_of_word_suffix", "continuing_subword_prefix")):
        raise ValueError(f"{path}: options of its merges are not known here")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if not all(c.isascii() and c.isprintable() and " " not in c for c in added) or any(
        t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")
    ) or any(a != b and a in b for a in added for b in added):
        raise ValueError(f"{path}: added tokens that reach beyond themselves")
    byte = _byte_of_char()
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    made = []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made.append(model["vocab"][left + right])
    if made != sorted(made) or len(set(made)) + 256 != len(ranks):
        raise ValueError(f"{path}: merges are not in the order of ids")
    names = {i: t for t, i in ranks.items()} | {i: c.encode() for c, i in added.items()}
    if set(names) != set(range(len(names))):
        raise ValueError(f"{path}: ids have gaps")
    encoding = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    id_type = np.uint16 if len(names) <= 1 << 16 else np.uint32
    return Model(encoding, frozenset(added), pa.array([names[i] for i in range(len(names))], pa.large_binary()), id_type)


def encode_text(model: Model, text: str) -> np.ndarray:
    return np.asarray(model.encoding.encode(text, allowed_special=model.special, disallowed_special=()), model.id_type)


def _gear() -> np.ndarray:
    """One fixed odd-looking number for each byte."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(13)).astype(np.uint32)


GEAR = _gear()


def cut_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of all chunks of texts that lie one after another in ``data`` (their starts included).

    Where a chunk ends depends on the bytes around that place and on its own start only. Cuts stand
    before a character, never within one.
    """
    if not len(data):
        return np.empty(0, np.int64)
    rolled = GEAR[data]
    reach = 1
    while reach < WINDOW:
        earlier = rolled[:-reach] << np.uint32(reach)
        rolled[reach:] += earlier
        reach *= 2
    # the low bits mix the last few bytes only; the high ones all of the window
    found = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
    del rolled
    found = found[np.diff(found, prepend=-LEAST) >= LEAST]
    for _ in range(3):  # a character has at most three further bytes
        inside = found[found < len(data)]
        found = np.where(np.isin(found, inside[data[inside] & 0xC0 == 0x80]), found + 1, found)
    text = np.searchsorted(starts, found, "right") - 1
    inner = (found - starts[text] >= LEAST) & (found < ends[text])
    some = starts < ends
    cuts = np.unique(np.r_[starts[some], found[inner]])
    return _limited(data, cuts, len(data))


def _limited(data: np.ndarray, cuts: np.ndarray, end: int) -> np.ndarray:
    """Cuts, and one more wherever a chunk is longer than the limit."""
    sizes = np.diff(np.r_[cuts, end])
    extra = (sizes - 1) // MOST
    more = ragged(np.ones(len(cuts), np.int64), extra) * MOST + np.repeat(cuts, extra)
    for _ in range(3):
        more = np.where(data[more] & 0xC0 == 0x80, more - 1, more)
    return np.union1d(cuts, more)


def _slices(data: pa.Buffer, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32).tobytes()), data])


def _row(kind: dict, n: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in kind.items()], names=list(kind))


_KINDS = {
    "block": pa.int64(), "bucket": pa.int32(), "packed": pa.binary(), "doc_ids": pa.list_(pa.int64()),
    "n_chunks": pa.list_(pa.int32()), "refs": pa.list_(pa.int32()),
}


class Block(NamedTuple):
    """Documents as chunks: the distinct chunks, their hashes, and of each chunk of a document the distinct
    one (``at``) and the document (``owner``)."""

    batch: pa.RecordBatch
    texts: pa.Array
    names: pa.Array
    hashes: np.ndarray
    at: np.ndarray
    owner: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in gathered(batches, "text", BLOCK_BYTES):
        # copied, so that the bytes of the texts lie one after another from the start
        texts = pa.concat_arrays([pc.fill_null(batch.column("text"), ""), pa.array([""])])[:-1]
        edges = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2] or pa.py_buffer(b"")
        cuts = cut_points(np.frombuffer(data, np.uint8)[: edges[-1]], edges[:-1], edges[1:])
        chunks = _slices(data, np.r_[cuts, edges[-1]]).dictionary_encode()
        named = np.array(chunks.dictionary.to_pylist() + [b""], dtype=object)[:-1]
        hashes = pd.util.hash_array(named, categorize=False).astype(np.uint64)
        at = chunks.indices.to_numpy(zero_copy_only=False) if len(cuts) else np.empty(0, np.int64)
        yield Block(batch, texts, chunks.dictionary, hashes, at, np.searchsorted(edges[1:], cuts, "right"))


def _chunk_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a block's chunks, and how many of its documents hold each."""
    for block in _blocks(batches):
        held = np.unique(block.at.astype(np.int64) * len(block.texts) + block.owner) // max(1, len(block.texts))
        counts = np.bincount(held, minlength=len(block.hashes))
        yield pa.RecordBatch.from_arrays([pa.array(block.hashes.view(np.int64)), pa.array(counts)], names=["hash", "n"])


def shared_marks(rows: DataFrame) -> np.ndarray:
    """One bit for the hash of every chunk that more than one document holds: 8 MB, whatever the table.

    Other hashes may fall on the same bits; that sends documents the longer way and changes no result.
    """
    counted = rows.select("text").mapInArrow(tidy(_chunk_counts), "hash long, n long")
    shared = counted.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1")
    word = f"hash & {MARK_WORDS - 1}L"
    bit = f"shiftleft(1L, cast(shiftrightunsigned(hash, {MARK_WORDS.bit_length() - 1}) & 63 as int))"
    words = shared.groupBy(F.expr(word).alias("word")).agg(F.expr(f"bit_or({bit})").alias("bits")).toArrow()
    marks = np.zeros(MARK_WORDS, np.int64)
    marks[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return marks.view(np.uint64)


def _sharing(block: Block, marks: np.ndarray) -> np.ndarray:
    """Documents with a chunk that other documents hold, too."""
    word = block.hashes & np.uint64(MARK_WORDS - 1)
    bit = (block.hashes >> np.uint64(MARK_WORDS.bit_length() - 1)) & np.uint64(63)
    marked = (marks[word.astype(np.int64)] >> bit) & np.uint64(1) == 1
    return np.bincount(block.owner[marked[block.at]], minlength=len(block.texts)) > 0


def _encode_alone(path: str, marks):
    """Task function: documents that share no chunk are encoded whole, where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = read_model(path)
        for block in _blocks(batches):
            alone = pa.array(~_sharing(block, marks.value))
            found = [encode_text(model, t).astype("<u4") for t in block.texts.filter(alone).to_pylist()]
            if found:
                ids = np.concatenate(found)
                sizes = np.array([len(f) for f in found])
                edges = np.r_[0, np.cumsum(sizes)]
                yield pa.RecordBatch.from_pydict(_results(model, block.batch.column("doc_id").filter(alone), ids, edges))

    return run


def _results(model: Model, doc_ids: pa.Array, ids: np.ndarray, edges: np.ndarray) -> dict[str, pa.Array]:
    """Rows of documents whose ids lie between ``edges``; the text is decoded from the ids."""
    data, starts = token_edges(model, ids)
    return {
        "doc_id": doc_ids,
        "n_tokens": pa.array(np.diff(edges).astype(np.int64)),
        "ids": _slices(pa.py_buffer(ids.astype("<u4")), 4 * edges),
        "decoded": _slices(pa.py_buffer(data.tobytes()), starts[edges]).cast(pa.string()),
    }


def _cut_blocks(buckets: int, marks):
    """Task function: documents that share chunks to blocks and their distinct chunks by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for block in _blocks(batches):
            sharing = _sharing(block, marks.value)
            if not sharing.any():
                continue
            own = sharing[block.owner]
            used, refs = np.unique(block.at[own], return_inverse=True)
            home = (block.hashes[used] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(home, kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            n_chunks = np.bincount(block.owner[own], minlength=len(sharing))[sharing].astype(np.int32)
            doc_ids = block.batch.column("doc_id").filter(pa.array(sharing))
            yield _row(
                _KINDS, 1, block=pa.array([number], pa.int64()), bucket=pa.array([number % buckets], pa.int32()),
                doc_ids=pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                n_chunks=lists(n_chunks, np.array([0, len(n_chunks)])), refs=lists(place[refs], np.array([0, len(refs)])),
            )
            bounds = np.r_[np.flatnonzero(np.diff(home[order], prepend=-1)), len(order)]
            sent = [
                packed_columns({"chunk": block.names.take(pa.array(used[order[a:b]]))})
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield _row(
                _KINDS, len(sent), block=pa.array([number] * len(sent), pa.int64()),
                bucket=pa.array(home[order[bounds[:-1]]], pa.int32()), packed=pa.array(sent, pa.binary()),
            )
            number += 1

    return run


def _encode_buckets(path: str):
    """Task function: distinct chunks to their ids, each chunk of a bucket once; rows of blocks pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = read_model(path)
        known: dict[bytes, np.ndarray] = {}
        held, last = 0, None
        for batch in batches:
            out = []
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("packed"), strict=True):
                if bucket != last or held > KEPT_BYTES:
                    known, held, last = {}, 0, bucket
                if not data.is_valid:
                    out.append(None)
                    continue
                found = []
                for chunk in unpacked(data.as_py()).column("chunk").to_pylist():
                    ids = known.get(chunk)
                    if ids is None:
                        ids = known[chunk] = encode_text(model, chunk.decode())
                        held += len(chunk) + ids.nbytes + 200
                    found.append(ids)
                sizes = np.array([len(f) for f in found])
                out.append(packed_columns({"ids": lists(np.concatenate(found), np.r_[0, np.cumsum(sizes)])}))
            yield batch.set_column(2, "packed", pa.array(out, pa.binary()))

    return run


_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VISIBLE = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)


def sure_edges(data: np.ndarray) -> np.ndarray:
    """Places at which the pattern splits in every context."""
    return np.flatnonzero(_WHITE[data[1:]] & _VISIBLE[data[:-1]]) + 1


def token_edges(model: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decoded bytes, and where each token starts in them (and the end)."""
    parts = model.token_bytes.take(pa.array(ids))
    edges = np.frombuffer(parts.buffers()[1], np.int64)[: len(ids) + 1]
    data = parts.buffers()[2]
    return np.frombuffer(data, np.uint8)[: edges[-1]] if data else np.empty(0, np.uint8), edges


def repaired(model: Model, ids: np.ndarray, joins: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Ids of the texts, from the ids of their chunks put together.

    ``texts``: where each text starts in bytes, and the end of all; ``joins``: where chunks of one text meet.
    """
    data, edges = token_edges(model, ids)
    if not len(joins):
        return ids
    sure = np.union1d(sure_edges(data), texts)
    joins = joins[~np.isin(joins, sure)]
    low = np.searchsorted(sure, joins) - 1
    low, high = low, low + 1
    memory: dict[bytes, np.ndarray] = {}
    while True:
        # windows that touch or overlap become one
        low, high = _merged(low, high)
        first, behind = np.searchsorted(edges, sure[low]), np.searchsorted(edges, sure[high])
        agree = (edges[first] == sure[low]) & (edges[behind] == sure[high])
        if agree.all():
            break
        at_start, at_end = np.isin(sure[low], texts), np.isin(sure[high], texts)
        low, high = low - (~agree & ~at_start), high + (~agree & ~at_end)
    fresh = []
    for a, b in zip(sure[low].tolist(), sure[high].tolist(), strict=True):
        window = data[a:b].tobytes()
        if window not in memory:
            memory[window] = encode_text(model, window.decode())
        fresh.append(memory[window])
    if not fresh:
        return ids
    sizes = np.array([len(f) for f in fresh])
    shift = np.zeros(len(ids) + 1, np.int64)
    shift[behind] += sizes - (behind - first)
    shift = np.cumsum(shift)
    kept = np.ones(len(ids) + 1, np.int8)
    np.subtract.at(kept, first, 1)
    np.add.at(kept, behind, 1)
    stay = np.flatnonzero(np.cumsum(kept - np.r_[0, np.ones(len(ids), np.int8)])[:-1] > 0)
    out = np.empty(len(ids) + shift[-1], ids.dtype)
    out[stay + shift[stay]] = ids[stay]
    out[ragged(first + shift[first], sizes)] = np.concatenate(fresh)
    return out


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.r_[True, low[1:] > high[:-1]]
    # touching windows stay apart only if they share no token: the edge between them is sure
    new |= np.r_[True, low[1:] == high[:-1]]
    start = np.flatnonzero(new)
    return low[start], high[np.r_[start[1:] - 1, len(low) - 1]]


def _assemble(path: str):
    """Group function: a block's row and the ids of its chunks to the ids of its documents."""

    def finish(rows: pa.Table) -> pa.Table:
        model = read_model(path)
        own = rows.filter(pc.is_valid(rows.column("doc_ids"))).slice(0, 1)
        parts = rows.filter(pc.is_valid(rows.column("packed"))).sort_by("bucket").column("packed").to_pylist()
        replies = [unpacked(p).column("ids") for p in parts]
        doc_ids = pc.list_flatten(own.column("doc_ids"))
        refs, n_chunks = flat(own.column("refs"))[0], flat(own.column("n_chunks"))[0]
        pool, sizes = np.empty(0, model.id_type), np.empty(0, np.int64)
        if replies:
            flats = [flat(r) for r in replies]
            pool, sizes = np.concatenate([f[0] for f in flats]), np.concatenate([f[1] for f in flats])
        starts = np.cumsum(sizes) - sizes
        ids = pool[ragged(starts[refs], sizes[refs])]
        _, edges = token_edges(model, ids)
        chunk_ends = edges[np.cumsum(sizes[refs])] if len(refs) else np.empty(0, np.int64)
        ends = np.r_[0, chunk_ends][np.cumsum(n_chunks)] if len(n_chunks) else np.empty(0, np.int64)
        texts = np.unique(np.r_[0, ends])
        ids = repaired(model, ids, np.setdiff1d(chunk_ends, texts), texts)
        _, edges = token_edges(model, ids)
        return pa.table(_results(model, doc_ids, ids, np.r_[0, np.searchsorted(edges, ends)]))

    return finish


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for each row of ``docs`` (doc_id, text).

    ``ids`` are the library's for the whole text without added special tokens, as little-endian unsigned
    32-bit integers; strings of the model's special tokens within a text give their id, as the library does
    by default. ``decoded`` is the text of the ids. A null or empty text has no ids; rows that repeat an id
    or have none each give a row; an empty table gives none; other columns are ignored. A text of any length
    is cut into chunks; its row is put together in one task, whose memory follows the longest text. Text
    without ASCII white space is encoded as one window where a chunk's join cannot be trusted.

    ``docs`` must be a plain scan: blocks follow the order of its rows, also when a lost task runs anew.
    ``model_path`` must be readable on every executor.
    """
    read_model(model_path)
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = spark.sparkContext.broadcast(shared_marks(rows))
    alone = rows.mapInArrow(tidy(_encode_alone(model_path, marks)), RESULT)
    pieces = rows.mapInArrow(tidy(_cut_blocks(buckets, marks)), PIECES)
    dealt = pieces.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    replied = dealt.mapInArrow(tidy(_encode_buckets(model_path)), PIECES)
    together = replied.repartition(buckets, "block").groupBy("block").applyInArrow(_assemble(model_path), RESULT)
    return alone.unionByName(together)
