"""SentencePiece encoding and decoding as a shortest path through a transducer.

The compiled machine has three parts: the normaliser (spaces become space marks, one mark before the
text), the pieces as a trie of arcs, and byte arcs for characters that no piece covers. Composed with
an input it is a lattice: states are places in the input together with the piece that ended there.

For a unigram model an arc weighs minus its piece's score, and the tropical sum is the usual one. For
a BPE model scores only order merges and do not add up. There an arc weighs nothing if its piece may
follow the state's piece, and infinity if it may not: two pieces may stand side by side if merging
their joined characters gives back just these two. The merges of a text are the one path on which all
neighbours agree, so the shortest path has weight zero and is the library's result; tests hold it
against the library.

Merges never cross the start of a run of spaces or a line end (see ``tokencount``), so the input is
composed by pre-token, each distinct one of a batch once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from cohortlake.llm.common import gathered, ragged, ship_package, tidy
from cohortlake.llm.tokencount import SPACE_MARK, check_model, pre_tokens

BATCH_BYTES = 4 << 20
#: Stretches and pairs a task remembers in each of two generations: about those of its partition.
REMEMBERED = 200_000
_BPE = 2


class Memory:
    """Results of two generations: when the younger is full it becomes the older, and what is asked for
    again moves up. Frequent keys stay, and the size is bounded."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def put(self, key, value) -> None:
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Transducer:
    """Normaliser, pieces and byte arcs of one model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if proto.normalizer_spec.precompiled_charsmap or not proto.normalizer_spec.add_dummy_prefix:
            raise ValueError("only the identity normaliser with a space mark before the text is compiled")
        kinds = type(proto.pieces[0])
        self.additive = proto.trainer_spec.model_type != _BPE
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.score = [p.score for p in proto.pieces]
        self.bytes_of = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN), 0)
        self.text_of = [p.piece for p in proto.pieces]
        self.touching = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        # Arcs of the piece trie: character -> (arcs that follow, piece that ends here or -1).
        self.trie: dict[str, tuple[dict, int]] = {}
        for piece, i in self.pieces.items():
            node = self.trie
            for at, c in enumerate(piece):
                arcs, own = node.get(c, ({}, -1))
                node[c] = (arcs, i if at == len(piece) - 1 else own)
                node = arcs
        if any(c not in self.pieces for p in self.pieces for c in p):
            raise ValueError("a character stands in pieces but is none itself")
        self.penalty = min((self.score[i] for i in self.pieces.values()), default=0.0) - 10.0
        self.follows = Memory()  # pair of pieces, as one number -> whether they may meet
        self.remembered = Memory()  # stretch -> ids
        surface = []
        for p in proto.pieces:
            if p.type == kinds.BYTE:
                surface.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type in (kinds.CONTROL, kinds.UNKNOWN):
                surface.append(b"" if p.type == kinds.CONTROL else " ⁇ ".encode())
            else:
                surface.append(p.piece.replace(SPACE_MARK, " ").encode())
        self.sizes = np.array([len(s) for s in surface], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.surface = np.frombuffer(b"".join(surface), np.uint8)

    def may_follow(self, pair: int) -> bool:
        """Whether merging the characters of two pieces gives back the two."""
        left, right = self.text_of[pair >> 20], self.text_of[pair & 0xFFFFF]
        symbols, edge = [*left, *right], len(left)
        score, pieces = self.score, self.pieces
        while True:
            best, where = None, -1
            for k in range(len(symbols) - 1):
                i = pieces.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, where = score[i], k
            if where < 0:
                return len(symbols) == 2
            if where == edge - 1:
                return False
            edge -= where < edge
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]

    def path(self, text: str) -> list[int]:
        """Ids along the shortest path through the lattice of a normalised text."""
        n = len(text)
        # Of each place: the piece on the shortest way to it (-1: a byte arc), where that piece starts,
        # and the weight of the way.
        best: list[int | None] = [-1] + [None] * n
        begin = [0] * (n + 1)
        weight = [0.0] * (n + 1)
        follows, additive, score = self.follows, self.additive, self.score
        for at in range(n):
            before = best[at]
            arcs, end = self.trie, at
            while end < n:
                arc = arcs.get(text[end])
                if arc is None:
                    break
                arcs, i = arc
                end += 1
                if i < 0:
                    continue
                if additive:
                    own = weight[at] - score[i]
                    if best[end] is None or own < weight[end]:
                        best[end], begin[end], weight[end] = i, at, own
                elif best[end] is None:
                    # finite weight only where the pieces may stand side by side
                    if before >= 0:
                        pair = before << 20 | i
                        fits = follows.get(pair)
                        if fits is None:
                            fits = self.may_follow(pair)
                            follows.put(pair, fits)
                        if not fits:
                            continue
                    best[end], begin[end] = i, at
            if text[at] not in self.trie:
                # a character outside the pieces goes over byte arcs and merges with nothing
                own = weight[at] - self.penalty
                if best[at + 1] is None or own < weight[at + 1]:
                    best[at + 1], begin[at + 1], weight[at + 1] = -1, at, own
        out: list[int] = []
        at = n
        while at:
            i, at, end = best[at], begin[at], at
            if i >= 0:
                out.append(i)
            elif self.bytes_of:
                out.extend(self.bytes_of[b] for b in text[at:end].encode()[::-1])
            else:
                out.append(self.unknown)
        return out[::-1]

    def ids(self, unit: str) -> list[int]:
        """Ids of one pre-token (see ``tokencount.split_text``).

        Between two characters that stand side by side in no piece every path has a state of its own,
        so the stretches between such places are composed alone, and each is remembered.
        """
        text = unit if unit[:1] == "\n" else SPACE_MARK + unit.replace(" ", SPACE_MARK)
        touching, remembered = self.touching, self.remembered
        out: list[int] = []
        start = 0
        for at in range(1, len(text) + 1):
            if at < len(text) and text[at - 1 : at + 1] in touching:
                continue
            part = text[start:at]
            found = remembered.get(part)
            if found is None:
                found = self.path(part)
                remembered.put(part, found)
            out += found
            start = at
        return out

    def decoded(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Bytes of each sequence; the space mark before a text goes again."""
        data = self.surface[ragged(self.starts[ids], self.sizes[ids])].tobytes()
        sizes = np.r_[0, np.cumsum(self.sizes[ids])]
        ends = np.cumsum(lengths)
        out = []
        for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True):
            part = data[sizes[a] : sizes[b]]
            out.append(part[1:] if part[:1] == b" " else part)
        return out


@lru_cache(maxsize=2)
def compiled(path: str) -> Transducer:
    check_model(path)
    return Transducer(path)


def encode_batch(machine: Transducer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the number of each."""
    words, owner = pre_tokens(texts)
    order = np.argsort(owner, kind="stable")  # unusual texts come last
    words, owner = words.take(pa.array(order)), owner[order]
    coded = words.dictionary_encode()
    found = [machine.ids(unit) for unit in coded.dictionary.to_pylist()]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat_ids = np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum()))
    begin = np.cumsum(sizes) - sizes
    unit = coded.indices.to_numpy(zero_copy_only=False)
    ids = flat_ids[ragged(begin[unit], sizes[unit])] if len(unit) else np.empty(0, np.int32)
    lengths = np.bincount(owner, weights=sizes[unit], minlength=len(texts)).astype(np.int64) if len(unit) else np.zeros(len(texts), np.int64)
    return ids, lengths


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens`` and ``round_trip``; columns of these names are
    replaced, others stay.

    ids: those of the library on the whole text, without begin and end. round_trip: decoding gives the
    text back; a space mark character in a text comes back as a space, and a text that has one is
    compared that way. Null and empty texts have no ids and pass. Rows are independent, so repeated
    ids and empty tables need no care. ``model_path`` must be readable on every executor.
    """
    ship_package(docs.sparkSession)
    check_model(model_path)
    keep = [c for c in docs.columns if c not in ("ids", "n_tokens", "round_trip")]
    schema = docs.select(*keep).schema.add("ids", ArrayType(IntegerType())).add("n_tokens", "long").add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model_path)
        for batch in gathered(batches, "text", BATCH_BYTES):
            texts = pc.fill_null(batch.column("text"), "")
            ids, lengths = encode_batch(machine, texts)
            same = [
                a == b.replace(SPACE_MARK, " ").encode()
                for a, b in zip(machine.decoded(ids, lengths), texts.to_pylist(), strict=True)
            ]
            ends = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep), pa.ListArray.from_arrays(ends, pa.array(ids)),
                    pa.array(lengths), pa.array(same, pa.bool_()),
                ],
                names=[*keep, "ids", "n_tokens", "round_trip"],
            )

    def forget() -> None:
        machine = compiled(model_path)
        machine.follows.clear()
        machine.remembered.clear()

    return docs.select(*keep).mapInArrow(tidy(run, forget), schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (with ``ids``) with the decoded ``text``; bytes that are no UTF-8 become U+FFFD.
    A null sequence gives a null text, an empty one an empty text."""
    ship_package(encoded.sparkSession)
    keep = [c for c in encoded.columns if c != "text"]
    schema = encoded.select(*keep).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model_path)
        for batch in batches:
            column = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = machine.decoded(pc.list_flatten(column).to_numpy(zero_copy_only=False), sizes)
            text = [t.decode("utf-8", "replace") if v else None for t, v in zip(texts, column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(text, pa.string())], names=[*keep, "text"])

    return encoded.select(*keep).mapInArrow(tidy(run), schema)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, round_trip, ids`` of whole texts."""
    return encode(docs.select(F.col("doc_id"), F.col("text")), model_path).select("doc_id", "n_tokens", "round_trip", "ids")
