"""Log-probabilities of texts by logistic mixing of context predictors, bit by bit.

A text is its words and one end. Each word is coded bit by bit, its bytes and a space; the end is a
line end. Several predictors give a probability of the next bit from counts in the training texts:

* orders one to three: the last bytes of the word so far, hashed;
* the gate and the last two bytes, hashed;
* the whole word so far, exact, in all texts and under the same gate.

Their stretched probabilities are added with weights that are chosen by how much is known (the gated
mixer), learned online over the training counts, and refined by an adaptive map from mixed to observed
probabilities.

The *gate* of a word stands for the kind of text so far: a class of word endings, voted by the last
words of the same text. Classes come from which word beginnings follow an ending anywhere in the
corpus, so texts in one language, or in one style, share a gate.

Nothing depends on a text beyond gate and word, so every pair of them is scored once. Pairs are
range-partitioned by word; a sorted range is a trie whose counts are differences of running sums, and
what a range shares with its neighbours is exchanged for the words at its two edges only. Training
removes each token's own count from what predicts it, as coding in sequence would.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, flat, gathered, lists, shuffle_partitions, text_tokens, tidy
from cohortlake.llm.postings import (
    HeldSums, block_postings, bucket_count, bucket_of, finished, packed_columns, passed_on, unpacked,
)

#: Gates learned, words that vote on a gate, hashed endings and beginnings they are learned from.
GATES = 8
VOTERS = 24
ENDINGS, BEGINNINGS = 1024, 256
#: Bytes of a word that the exact predictors look at; longer words go on with the hashed ones.
DEPTH = 16
BITS = 8 * DEPTH
#: Hash bits of the contexts of orders 1, 2, 3 and of gate and order 2.
CONTEXT_BITS = (8, 12, 14, 14)
#: Predictors, weight sets, cells of the adaptive map and its reach.
INPUTS = 6
SETS = 48
CELLS, REACH = 49, 12.0
HASHED_PRIOR, EXACT_PRIOR = 0.05, 0.02
#: Learning rates of the mixer, one for each pass over the training counts.
RATES = (0.3, 0.1)
#: Bytes of decisions that a task keeps from its first pass for its second.
KEPT_BYTES = 64 << 20
#: A unit is common if it makes up one in so many training tokens, so there are no more of them.
COMMON = 2000
BLOCK_BYTES = 12 << 20
#: Rows of (unit, count) that a task adds up at once, twice its distinct units at least.
UNIT_ROWS = 1 << 20
_LEAST = 2.0**-22
END = b"\n"


# --- gates ---------------------------------------------------------------------------------------


def _raw(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words, and where each begins and ends; no word is empty."""
    plain = words.cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = plain.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets[:-1], offsets[1:]


def _hashed(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    mixed = (a.astype(np.uint32) * np.uint32(257) + b) * np.uint32(2654435761)
    return (mixed >> np.uint32(32 - (size - 1).bit_length())).astype(np.int64)


def endings(words: pa.Array) -> np.ndarray:
    data, start, end = _raw(words)
    return _hashed(data[np.maximum(end - 2, start)], data[end - 1], ENDINGS)


def beginnings(words: pa.Array) -> np.ndarray:
    data, start, end = _raw(words)
    return _hashed(data[start], data[np.minimum(start + 1, end - 1)], BEGINNINGS)


def learn_gates(docs: DataFrame) -> np.ndarray:
    """Class of each hashed ending, from all neighbouring words of all training texts.

    The table of endings by beginnings has a fixed size; tasks send it in slices that are summed.
    """
    slices, per = 64, ENDINGS * BEGINNINGS // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENDINGS * BEGINNINGS, np.int64)
        for batch in gathered(batches, "text", 8 << 20):
            words, owner = text_tokens(batch.column("text"))
            if len(words) > 1:
                same = owner[1:] == owner[:-1]
                pair = endings(words)[:-1] * BEGINNINGS + beginnings(words)[1:]
                total += np.bincount(pair[same], minlength=len(total))
        used = np.flatnonzero(total.reshape(slices, per).any(1))
        if len(used):
            rows = total.reshape(slices, per)[used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), lists(rows.ravel(), np.arange(len(used) + 1) * per)], names=["part", "n"]
            )

    def add(rows: pa.Table) -> pa.Table:
        n, _ = flat(rows.column("n"))
        return pa.table({"part": rows.column("part").slice(0, 1), "n": lists(n.reshape(-1, per).sum(0), np.array([0, per]))})

    schema = "part int, n array<long>"
    sums = docs.where("training").select("text").mapInArrow(tidy(run), schema).groupBy("part").applyInArrow(add, schema)
    table = np.zeros((slices, per))
    for row in sums.collect():  # at most 64 rows of a fixed size
        table[row["part"]] = row["n"]
    return cluster(table.reshape(ENDINGS, BEGINNINGS))


def cluster(table: np.ndarray) -> np.ndarray:
    """Endings with like followers in one class: weighted k-means on roots of shares."""
    mass = table.sum(1)
    used = np.flatnonzero(mass)
    classes = np.zeros(len(table), np.int64)
    if not len(used):
        return classes
    x, w = np.sqrt(table[used] / mass[used, None]), mass[used]
    centres = [x[w.argmax()]]
    for _ in range(GATES - 1):
        away = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(x[(away * np.sqrt(w)).argmax()])
    c = np.array(centres)
    for _ in range(30):
        label = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
        for k in np.unique(label):
            c[k] = np.average(x[label == k], axis=0, weights=w[label == k])
    classes[used] = label
    return classes


def gated_units(texts: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Gate and word of every token, ends included: one letter for the gate, then the word."""
    words, owner = text_tokens(texts)
    n = len(texts)
    first, last = np.searchsorted(owner, np.arange(n)), np.searchsorted(owner, np.arange(n), side="right")
    at = np.r_[np.arange(len(words)), last].astype(np.int32)  # words, then the end of each text
    whose = np.r_[owner, np.arange(n)].astype(np.int32)
    since = np.maximum(at - VOTERS, first[whose].astype(np.int32))
    kind = classes[endings(words)].astype(np.int8) if len(words) else np.empty(0, np.int8)
    best, gate = np.zeros(len(at), np.int32), np.full(len(at), GATES, np.int8)
    for k in range(GATES):
        seen = np.r_[0, np.cumsum(kind == k, dtype=np.int32)]
        votes = seen[at] - seen[since]
        more = votes > best
        best[more], gate[more] = votes[more], k
    letters = pa.array([chr(65 + g) for g in range(GATES + 1)], pa.large_string()).take(pa.array(gate))
    ends = pa.array([END.decode()] * n, pa.large_string())
    both = pa.concat_arrays([words.cast(pa.large_string()), ends])
    return pc.binary_join_element_wise(letters, both, pa.scalar("", pa.large_string())), whose


# --- tries ---------------------------------------------------------------------------------------


def _leading_zeros(x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), 64, np.int64)
    some = x > 0
    y, n = x[some].copy(), np.zeros(int(some.sum()), np.int64)
    for shift in (32, 16, 8, 4, 2, 1):
        low = y < (np.uint64(1) << np.uint64(64 - shift))
        n[low] += shift
        y[low] <<= np.uint64(shift)
    out[some] = n
    return out


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal leading bits of rows of two columns of big-endian numbers."""
    high = _leading_zeros(a[:, 0] ^ b[:, 0])
    return np.where(high == 64, 64 + _leading_zeros(a[:, 1] ^ b[:, 1]), high)


@dataclass
class Range:
    """A sorted range of (word, gate) pairs."""

    coded: list[bytes]  # the word's bytes and its stop
    gate: np.ndarray
    n: np.ndarray  # tokens in training texts
    head: np.ndarray  # rows x DEPTH bytes
    key: np.ndarray  # the same as two big-endian numbers
    size: np.ndarray
    place: np.ndarray  # rows as they were given

    @staticmethod
    def of(words: list[bytes], gate: np.ndarray, n: np.ndarray) -> Range:
        coded = [w if w == END else w + b" " for w in words]
        head = np.frombuffer(b"".join(c[:DEPTH].ljust(DEPTH, b"\0") for c in coded), np.uint8).reshape(-1, DEPTH)
        key = head.view(">u8").astype(np.uint64).reshape(-1, 2)
        order = np.lexsort((gate, key[:, 1], key[:, 0]))
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        return Range([coded[i] for i in order], gate[order], n[order].astype(float), head[order], key[order], size[order], order)

    def path(self, key: np.ndarray) -> np.ndarray:
        """Tokens of each gate that share at least d leading bits with a word, for every d."""
        shared = common_bits(self.key, np.broadcast_to(key, self.key.shape))
        out = np.zeros((GATES + 1, BITS + 1))
        np.add.at(out, (self.gate, shared), self.n)
        return out[:, ::-1].cumsum(1)[:, ::-1]


def edge_totals(firsts: np.ndarray, lasts: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """For the first and the last word of each range, the counts over all ranges along their bits.

    ``paths``: ranges x 2 x gates x depths. Ranges are in order, so those that share a prefix with an
    edge word share it with one of their own edge words, along which they have counted.
    """
    edges = np.stack([firsts, lasts], 1)
    out = np.zeros_like(paths)
    depth = np.arange(BITS + 1)
    for j in range(len(edges)):
        for side in (0, 1):
            word = np.broadcast_to(edges[j, side], firsts.shape)
            a, b = common_bits(firsts, word), common_bits(lasts, word)
            by_first = a[:, None] >= depth
            by_last = ~by_first & (b[:, None] >= depth)
            out[j, side] = np.einsum("md,mgd->gd", by_first, paths[:, 0]) + np.einsum("md,mgd->gd", by_last, paths[:, 1])
    return out


def _by_value(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of 0, 1, ... up to ``size`` in ``x``, each in ascending order."""
    order = np.argsort(x, kind="stable")
    bounds = np.searchsorted(x[order], np.arange(size + 1))
    return [order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Steps:
    """All bit decisions of a range, depth by depth, each once however many words share it."""

    def __init__(self, rows: Range, totals: np.ndarray) -> None:
        self.rows, self.totals = rows, totals
        order = np.lexsort((np.arange(len(rows.gate)), rows.gate))
        self.order = order
        key = rows.key[order]
        self.gate = rows.gate[order]
        shared = np.full(len(order), -1, np.int64)
        shared[1:] = np.where(self.gate[1:] == self.gate[:-1], common_bits(key[1:], key[:-1]), -1)
        self.shared = shared
        self.n = rows.n[order]
        self.stop = 8 * np.minimum(rows.size[order], DEPTH)
        edge = [np.broadcast_to(k, rows.key.shape) for k in (rows.key[0], rows.key[-1])]
        self.to_edge = [common_bits(rows.key, e)[order] for e in edge]
        self.whole = np.r_[-1, common_bits(rows.key[1:], rows.key[:-1])] if len(order) > 1 else np.array([-1])

    def _correct(self, at: np.ndarray, depth: int, own: np.ndarray, every: np.ndarray, gates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts in the gate and in all gates, over all ranges where a row shares its bits with an edge."""
        own, every = own.astype(float), every.astype(float)
        for side in (1, 0):
            near = np.flatnonzero(self.to_edge[side][at] >= depth)
            if len(near):
                own[near] = self.totals[side][gates[near], depth]
                every[near] = self.totals[side][:, depth].sum()
        return own, every

    def __iter__(self) -> Iterator[tuple]:
        """(depth, rows in gate order, counts before and after in the gate and in all gates).

        A node is a run of rows in gate order, and the run of all rows of its bits in word order. Both
        only shrink from one depth to the next, so they are carried along and cut where rows differ;
        counts are whole numbers, so differences of running sums are exact.
        """
        own_sum, every_sum = np.r_[0, np.cumsum(self.n)], np.r_[0, np.cumsum(self.rows.n)]
        size = len(self.order)
        cuts, cuts_wide = (_by_value(x, BITS) for x in (self.shared, self.whole))
        start = np.flatnonzero(self.shared < 0)
        stop = np.r_[start[1:], size]
        first, last = np.zeros(len(start), np.int64), np.full(len(start), size)
        before, all_before = own_sum[stop] - own_sum[start], every_sum[last] - every_sum[first]
        for depth in range(BITS):
            if depth % 8 == 0:
                alive = self.stop[start] > depth
                if not alive.all():
                    start, stop, first, last, before, all_before = (x[alive] for x in (start, stop, first, last, before, all_before))
                if not len(start):
                    break
            born = cuts[depth]
            if len(born):
                parent = np.searchsorted(start, born) - 1
                stop, first, last, before, all_before = (np.insert(x, parent + 1, x[parent]) for x in (stop, first, last, before, all_before))
                start = np.insert(start, parent + 1, born)
                stop = np.minimum(stop, np.r_[start[1:], size])
            wide = cuts_wide[depth]
            if len(wide):
                row = self.order[start]
                place = np.searchsorted(wide, row, side="right")
                first = np.maximum(first, np.r_[0, wide][place])
                last = np.minimum(last, np.r_[wide, size][place])
            after, all_after = own_sum[stop] - own_sum[start], every_sum[last] - every_sum[first]
            gates = self.gate[start]
            above, below = self._correct(start, depth, before, all_before, gates), self._correct(start, depth + 1, after, all_after, gates)
            yield (depth, start, above[0], below[0], above[1], below[1])
            before, all_before = after, all_after

    def spread(self, depth: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Value of each row's decision at this depth (rows in gate order; 0 past the word's stop)."""
        full = np.zeros(len(self.order))
        full[at] = value
        first = self.shared <= depth
        return np.where(self.stop > depth, full[first][np.cumsum(first) - 1], 0.0)


# --- predictors ----------------------------------------------------------------------------------


def contexts(gate, p1, p2, p3) -> list[np.ndarray]:
    """Hashed contexts from the gate and the three bytes before."""
    a, b, c = p1.astype(np.uint64), p2.astype(np.uint64), p3.astype(np.uint64)
    g = gate.astype(np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    raw = (a, a + (b << np.uint64(8)), a + (b << np.uint64(8)) + (c << np.uint64(16)), a + (b << np.uint64(8)) + ((g + np.uint64(1)) << np.uint64(16)))
    return [r if k == 0 else (r * odd) >> np.uint64(64 - bits) for k, (r, bits) in enumerate(zip(raw, CONTEXT_BITS, strict=True))]


def byte_rows(rows: Range) -> tuple[np.ndarray, ...]:
    """Every byte of every pair: row, place, byte, and the three bytes before (spaces at the start)."""
    data = np.frombuffer(b"   " + b"   ".join(rows.coded), np.uint8)
    begin = np.cumsum(rows.size + 3) - rows.size
    row = np.repeat(np.arange(len(rows.size)), rows.size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(rows.size) - rows.size, rows.size)
    at = begin[row] + place
    return row, place, data[at], data[at - 1], data[at - 2], data[at - 3]


def cell_counts(rows: Range) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in each (context, byte) cell of the hashed predictors."""
    row, _, v, p1, p2, p3 = byte_rows(rows)
    keep = rows.n[row] > 0
    row, v, p1, p2, p3 = row[keep], v[keep], p1[keep], p2[keep], p3[keep]
    keys, base = [], 0
    for ctx, bits in zip(contexts(rows.gate[row], p1, p2, p3), CONTEXT_BITS, strict=True):
        keys.append((np.int64(base) + ctx.astype(np.int64)) << 8 | v)
        base += 1 << bits
    cell, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return cell, np.bincount(inverse, weights=np.tile(rows.n[row], len(CONTEXT_BITS)), minlength=len(cell)).astype(float)


class Hashed:
    """Bit trees of the contexts that occur; the number of contexts is bounded by the hash bits.

    Training needs the counts, to take a token's own off; scoring needs the log-odds alone.
    """

    def __init__(self, cells: np.ndarray, counts: np.ndarray) -> None:
        ctx = cells >> 8
        used = np.unique(ctx)
        self.row = np.zeros(sum(1 << b for b in CONTEXT_BITS), np.int32)
        self.row[used] = np.arange(1, len(used) + 1)
        tree = np.zeros((len(used) + 1, 512), np.float32)
        tree[self.row[ctx], 256 + (cells & 255)] = counts
        for node in range(255, 0, -1):
            tree[:, node] = tree[:, 2 * node] + tree[:, 2 * node + 1]
        self.tree, self.odds = tree, None

    def for_scoring(self) -> Hashed:
        """The same with log-odds of each child against its sibling in place of counts."""
        out = copy.copy(self)
        tree = self.tree + np.float32(HASHED_PRIOR)
        out.tree, out.odds = None, np.log(tree / tree[:, np.arange(512) ^ 1])  # nodes 0 and 1 are no children
        return out

    def stretched(self, ctx: list[np.ndarray], v: np.ndarray, bit: int, less: float) -> Iterator[np.ndarray]:
        """Log-odds of the taken bit by each hashed predictor; ``less`` tokens are taken off the counts."""
        child = (1 << (bit + 1)) | (v.astype(np.int64) >> (7 - bit))
        base = 0
        for c, bits in zip(ctx, CONTEXT_BITS, strict=True):
            at = self.row[base + c.astype(np.int64)].astype(np.int64) * 512 + child
            if self.odds is not None:
                yield self.odds.ravel()[at]
            else:
                counts = self.tree.ravel()
                taken = np.maximum(counts[at] - np.float32(less), 0) + np.float32(HASHED_PRIOR)
                yield np.log(taken / (counts[at ^ 1] + np.float32(HASHED_PRIOR)))
            base += 1 << bits


def exact_odds(before: np.ndarray, after: np.ndarray, less: float) -> np.ndarray:
    """Log-odds of the taken bit by an exact predictor; ``less`` tokens are taken off the counts."""
    return np.log((np.maximum(after - less, 0) + EXACT_PRIOR) / (np.maximum(before - after, 0) + EXACT_PRIOR))


def weight_set(gate_before: np.ndarray, all_before: np.ndarray, less: float = 0.0) -> np.ndarray:
    own = np.minimum(np.log2(np.maximum(gate_before - less, 0) + 1), 11).astype(np.int64)
    wide = np.minimum(np.log2(np.maximum(all_before - less, 0) + 1) / 4, 3).astype(np.int64)
    return own * 4 + wide


def squashed(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -30, 30)))


def map_place(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (np.clip(t, -REACH, REACH) + REACH) * (CELLS - 1) / (2 * REACH)
    low = np.minimum(x.astype(np.int64), CELLS - 2)
    return low, x - low


@dataclass
class Mixer:
    weights: np.ndarray  # sets x inputs
    hits: np.ndarray  # sets x cells: tokens whose bit was the one predicted
    seen: np.ndarray

    @staticmethod
    def fresh() -> Mixer:
        centre = squashed(np.linspace(-REACH, REACH, CELLS))
        # A few imagined tokens keep empty cells at the identity.
        return Mixer(np.full((SETS, INPUTS), 0.3), np.tile(4 * centre, (SETS, 1)), np.full((SETS, CELLS), 4.0))

    def mixed(self, x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """``x``: a row for each predictor."""
        total = np.zeros(len(chosen))
        for weights, odds in zip(np.ascontiguousarray(self.weights.T), x, strict=True):
            total += weights[chosen] * odds
        return total

    def learn(self, x: np.ndarray, chosen: np.ndarray, n: np.ndarray, rate: float, refine: bool) -> None:
        """One step for a batch of decisions taken by ``n`` tokens each; then, with ``refine``, the adaptive map."""
        t = self.mixed(x, chosen)
        miss = n * (1 - squashed(t))
        size = np.bincount(chosen, weights=n, minlength=SETS)
        some = size > 0
        for k in range(INPUTS):
            step = np.bincount(chosen, weights=miss * x[k], minlength=SETS)
            self.weights[some, k] += rate * np.clip(step[some] / size[some], -1, 1)
        if not refine:
            return
        low, part = map_place(t)
        at = chosen * CELLS + low
        add = np.bincount(at, weights=n * (1 - part), minlength=SETS * CELLS)
        add += np.bincount(at + 1, weights=n * part, minlength=SETS * CELLS)
        add = add.reshape(SETS, CELLS)
        # the bit not taken lies at the mirrored place
        self.seen += add + add[:, ::-1]
        self.hits += add

    def probability(self, x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        t = self.mixed(x, chosen)
        low, part = map_place(t)
        table = self.hits / self.seen
        table = (table + 1 - table[:, ::-1]) / 2  # the two bits of a decision sum to one
        refined = table[chosen, low] * (1 - part) + table[chosen, low + 1] * part
        p = (squashed(t) + refined) / 2
        return _LEAST + (1 - 2 * _LEAST) * p


@dataclass
class Shared:
    """What all tasks know: hashed predictors, edge counts of the ranges, and the mixer."""

    hashed: Hashed
    totals: dict[int, np.ndarray]
    mixer: Mixer | None = None


def decisions(rows: Range, shared: Shared, part: int, less: float, passed: int = 0) -> Iterator[tuple]:
    """(where, inputs, weight set, tokens) of all bit decisions; where: (steps, depth, rows) for shared
    ones, or the rows of bytes beyond DEPTH. With ``less`` tokens taken off, decisions of no token are
    left out. The first ``passed`` of them are not made."""
    steps = Steps(rows, shared.totals[part])
    head = np.c_[np.full((len(rows.gate), 3), 32, np.uint8), rows.head]
    own = steps.order
    deepest = int(steps.stop.max(initial=0))
    for depth, at, before, after, all_before, all_after in steps if passed < deepest else ():
        if depth < passed:
            continue
        if less:
            some = after > 0
            at, before, after, all_before, all_after = at[some], before[some], after[some], all_before[some], all_after[some]
        i, bit = divmod(depth, 8)
        r = own[at]
        v, p1, p2, p3 = (head[r, 3 + i - k] for k in range(4))
        x = np.empty((INPUTS, len(at)))
        for k, odds in enumerate(shared.hashed.stretched(contexts(rows.gate[r], p1, p2, p3), v, bit, less)):
            x[k] = odds
        x[-2] = exact_odds(all_before, all_after, less)
        x[-1] = exact_odds(before, after, less)
        yield (steps, depth, at), x, weight_set(before, all_before, less), after
    row, place, v, p1, p2, p3 = byte_rows(rows)
    far = (place >= DEPTH) & ((rows.n[row] > 0) | (less == 0))
    if far.any():
        row, v, p1, p2, p3 = row[far], v[far], p1[far], p2[far], p3[far]
        ctx = contexts(rows.gate[row], p1, p2, p3)
        alone = np.zeros(len(row), np.int64)  # the weight set of no exact knowledge
        for bit in range(8):
            x = np.zeros((INPUTS, len(row)))
            for k, odds in enumerate(shared.hashed.stretched(ctx, v, bit, less)):
                x[k] = odds
            yield (None, None, row), x, alone, rows.n[row]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Range, pa.RecordBatch]]:
    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            table = unpacked(data)
            n = table.column("n").to_numpy()
            yield part, Range.of(table.column("word").to_pylist(), table.column("gate").to_numpy().astype(np.int64), n), table


def _pack_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a task as one row, sorted by word, with each word's tokens under all gates."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    table = table.take(pc.sort_indices(table, [("word", "ascending"), ("gate", "ascending")]))
    words = table.column("word").combine_chunks().dictionary_encode()
    place = words.indices.to_numpy(zero_copy_only=False)
    n = table.column("n").to_numpy()
    total = np.bincount(place, weights=n)
    columns = {"word": table.column("word").combine_chunks(), "gate": table.column("gate").combine_chunks().cast(pa.int8()), "n": pa.array(n), "c": pa.array(total[place].astype(np.int64))}
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "packed": pa.array([packed_columns(columns)], pa.binary()), "tokens": pa.array([int(n.sum())], pa.int64()), "known": pa.array([int((total > 0).sum())], pa.int64())}
    )


def _send_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows, _ in _ranges(batches):
        ends = rows.key[[0, -1]].copy()
        paths = np.stack([rows.path(k) for k in ends])
        cells, counts = cell_counts(rows)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "edges": pa.array([ends.tobytes()], pa.binary()), "paths": pa.array([paths.tobytes()], pa.binary()), "cells": lists(cells, np.array([0, len(cells)])), "counts": lists(counts, np.array([0, len(cells)]))}
        )


def train_range(rows: Range, shared: Shared, part: int) -> Mixer:
    """Two passes over all decisions. What the first depths looked like is kept for the second pass, as
    far as the memory set for it reaches; the values are the same as if made again."""
    mixer = Mixer.fresh()
    kept: list[tuple] = []

    def learn(x: np.ndarray, chosen: np.ndarray, n: np.ndarray, rate: float) -> None:
        for start in range(0, len(n), 8192):
            own = slice(start, start + 8192)
            # The adaptive map is filled in the last pass, by the weights it will refine.
            mixer.learn(x[:, own], chosen[own], n[own], rate, rate == RATES[-1])

    held = 0
    for where, x, chosen, n in decisions(rows, shared, part, 1.0):
        learn(x, chosen, n, RATES[0])
        if where[0] is not None and len(kept) == where[1] and held < KEPT_BYTES:
            # hashed log-odds are of single precision already
            kept.append((x[:-2].astype(np.float32), x[-2:], chosen.astype(np.int8), n))
            held += sum(part.nbytes for part in kept[-1])
    for rate in RATES[1:]:
        for hashed, exact, chosen, n in kept:
            learn(np.concatenate([hashed.astype(float), exact]), chosen.astype(np.int64), n, rate)
        for _, x, chosen, n in decisions(rows, shared, part, 1.0, len(kept)):
            learn(x, chosen, n, rate)
    return mixer


def score_range(rows: Range, shared: Shared, part: int) -> np.ndarray:
    """log10 of the model's probability of each pair's word under its gate, in the range's order."""
    total = np.zeros(len(rows.gate))
    for (steps, depth, at), x, chosen, _ in decisions(rows, shared, part, 0.0):
        cost = np.log10(shared.mixer.probability(x, chosen))
        if steps is None:
            total += np.bincount(at, weights=cost, minlength=len(total))
        else:
            total[steps.order] += steps.spread(depth, at, cost)
    return total


# --- jobs ----------------------------------------------------------------------------------------


def _block_counts(classes: np.ndarray, buckets: int):
    """Training tokens of the distinct units of a block, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BLOCK_BYTES):
            words, owner = gated_units(batch.column("text"), classes)
            coded = words.dictionary_encode()
            names = coded.dictionary.cast(pa.large_binary()).cast(pa.binary())
            trained = batch.column("training").to_numpy(zero_copy_only=False)[owner]
            n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weights=trained, minlength=len(names)).astype(np.int64)
            home = bucket_of(names, buckets)
            order = np.argsort(home, kind="stable")
            cuts = np.searchsorted(home[order], np.arange(buckets + 1))
            out = [(int(b), order[cuts[b] : cuts[b + 1]]) for b in np.flatnonzero(np.diff(cuts))]
            packed = [packed_columns({"unit": names.take(pa.array(i)), "n": pa.array(n[i])}) for _, i in out]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in out], pa.int32()), "packed": pa.array(packed, pa.binary())})

    return run


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All tokens of the units of the task's buckets; ``coded`` sorts as the bits of a word do."""
    held, rows, most = [], 0, UNIT_ROWS
    for batch in batches:
        for data in batch.column("packed").to_pylist():
            held.append(unpacked(data))
            rows += held[-1].num_rows
            if rows > most:
                held = _added(held)
                rows = sum(h.num_rows for h in held)
                most = max(UNIT_ROWS, 2 * rows)
    for part in _added(held):
        for start in range(0, part.num_rows, 50_000):
            own = part.slice(start, 50_000)
            units = own.column("unit").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {"gate": pa.array([u[0] - 65 for u in units], pa.int32()), "word": pa.array([u[1:] for u in units], pa.binary()), "coded": pa.array([u[1:] + b" " for u in units], pa.binary()), "n": own.column("n")}
            )


def _added(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """One row for each unit, in order of first appearance: ranges are cut by a sample that depends on it."""
    if not held:
        return []
    table = pa.Table.from_batches(held)
    table = table.append_column("at", pa.array(np.arange(table.num_rows)))
    sums = table.group_by("unit", use_threads=False).aggregate([("n", "sum"), ("at", "min")]).sort_by("at_min")
    return sums.rename_columns({"n_sum": "n"}).select(["unit", "n"]).combine_chunks().to_batches()


def _collected(edges: DataFrame) -> Shared:
    """Edge counts and hashed predictors of all ranges; one row for each range, and bounded cells."""
    tops = sorted(edges.select("part", "edges", "paths").collect(), key=lambda r: r["part"])
    if not tops:  # no texts at all
        none = np.empty(0, np.int64)
        return Shared(Hashed(none, none), {})
    ends = np.stack([np.frombuffer(r["edges"], np.uint64).reshape(2, 2) for r in tops])
    paths = np.stack([np.frombuffer(r["paths"], float).reshape(2, GATES + 1, BITS + 1) for r in tops])
    totals = edge_totals(ends[:, 0], ends[:, 1], paths)
    pairs = edges.select(F.explode(F.arrays_zip("cells", "counts")).alias("c"))
    cells = pairs.groupBy(F.col("c.cells").alias("cell")).agg(F.sum("c.counts").alias("n")).toArrow()
    hashed = Hashed(cells.column("cell").to_numpy(), cells.column("n").to_numpy())
    return Shared(hashed, {r["part"]: t for r, t in zip(tops, totals, strict=True)})


def log_probabilities(docs: DataFrame) -> DataFrame:
    """``doc_id, training, n_tokens, n_known, train_tokens, base_score, score`` for each row of
    ``docs`` (doc_id long, text string, training boolean; more columns are ignored).

    n_tokens: words and the end; n_known: those that stand in training texts; train_tokens: tokens of
    all training texts; base_score: log10 of smoothed word frequencies; score: log10 of the model's
    probability. A null or empty text is one end; a null ``training`` is false. Rows are independent,
    so a repeated doc_id gives a row each. Without training rows the counts are zero and scores still
    finite.
    """
    spark = docs.sparkSession
    parts, buckets = shuffle_partitions(spark), bucket_count(docs)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("training", F.lit(False)).alias("training"),
    )
    classes = learn_gates(source)
    counted = source.select("text", "training").mapInArrow(tidy(_block_counts(classes, buckets)), "bucket int, packed binary")
    counted = counted.repartition(parts, "bucket").mapInArrow(tidy(_unit_counts), "gate int, word binary, coded binary, n long")
    # Written, since range partitioning samples its input first. A word's gates stay together.
    ranged = cut_lineage(counted, "lm-units").repartitionByRange(parts, "coded").select("gate", "word", "n")
    packed_range = "part int, packed binary, tokens long, known long"
    ranges = cut_lineage(ranged.mapInArrow(tidy(_pack_range), packed_range), "lm-ranges")
    tokens, distinct = ranges.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    tasks = ranges.select("part", "packed")
    edges = tasks.mapInArrow(tidy(_send_edges), "part int, edges binary, paths binary, cells array<long>, counts array<double>")
    shared = _collected(cut_lineage(edges, "lm-edges"))
    told = spark.sparkContext.broadcast(shared)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, _ in _ranges(batches):
            mixer = train_range(rows, told.value, part)
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array([float(rows.n.sum())]), "weights": pa.array([mixer.weights.tobytes()]), "hits": pa.array([mixer.hits.tobytes()]), "seen": pa.array([mixer.seen.tobytes()])}
            )

    learned = tasks.mapInArrow(tidy(train), "n double, weights binary, hits binary, seen binary").collect()
    shared.mixer = averaged([r.asDict() for r in learned])
    model = spark.sparkContext.broadcast(Shared(shared.hashed.for_scoring(), shared.totals, shared.mixer))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, table in _ranges(batches):
            found = np.empty(len(rows.place), np.float32)
            found[rows.place] = score_range(rows, model.value, part)
            words, gates = table.column("word").to_pylist(), table.column("gate").to_pylist()
            names = pa.array([bytes([65 + g]) + w for w, g in zip(words, gates, strict=True)], pa.binary())
            c = table.column("c").to_numpy()
            common = table.column("n").to_numpy() * COMMON > tokens
            home = bucket_of(names, buckets)
            home[common] = -1
            order = np.argsort(home, kind="stable")
            cuts = np.searchsorted(home[order], np.arange(-1, buckets + 1))
            chosen = [(b - 1, order[cuts[b] : cuts[b + 1]]) for b in np.flatnonzero(np.diff(cuts))]
            packed = [packed_columns({"unit": names.take(pa.array(i)), "c": pa.array(c[i]), "score": pa.array(found[i])}) for _, i in chosen]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(b) for b, _ in chosen], pa.int32()), "packed": pa.array(packed, pa.binary())})

    def values_in(data: bytes) -> tuple[list[bytes], np.ndarray]:
        """Units, and a row of values for each."""
        rows = unpacked(data)
        c = rows.column("c").to_numpy()
        base = np.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1)))
        return rows.column("unit").to_pylist(), np.stack([np.ones(len(c)), c > 0, base, rows.column("score").to_numpy()], 1).astype(float)

    values = cut_lineage(tasks.mapInArrow(tidy(score), "bucket int, packed binary"), "lm-values")
    most = [values_in(data) for data in values.where("bucket < 0").toArrow().column("packed").to_pylist()]
    common = spark.sparkContext.broadcast({u: tuple(v) for units, rows in most for u, v in zip(units, rows.tolist(), strict=True)})
    names = ["n", "known", "base", "score"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, home = HeldSums(names), None
        known: dict[bytes, int] = {}
        found = np.empty((0, len(names)))
        for batch in batches:
            yield from passed_on(batch, names)
            for bucket, block, n_docs, data in zip(*(batch.column(k).to_pylist() for k in ("bucket", "block", "n_docs", "packed")), strict=True):
                if data is None:
                    continue
                if bucket != home:
                    home, known, found = bucket, {}, found[:0]
                if block < 0:
                    units, value = values_in(data)
                    known.update(zip(units, range(len(found), len(found) + len(units)), strict=True))
                    found = np.concatenate([found, value])
                    continue
                rows = unpacked(data)
                units = rows.column("unit").to_pylist()
                v = found[np.fromiter(map(known.__getitem__, units), np.int64, len(units))].T
                at, lengths = flat(rows.column("at"))
                times, _ = flat(rows.column("times"))
                yield from held.add(block, n_docs, at, np.repeat(v, lengths, axis=1) * times)
        yield from held.flush()

    postings = block_postings(source, lambda texts: gated_units(texts, classes), BLOCK_BYTES, common, sort=False)
    told_values = values.where("bucket >= 0").withColumn("block", F.lit(-1).cast("long"))
    both = postings.unionByName(told_values, allowMissingColumns=True)
    met = both.repartition(parts, "bucket").sortWithinPartitions("bucket", "block")
    out = finished(met.mapInArrow(tidy(join), HeldSums(names).schema()), names)
    return out.select(
        "doc_id", "training", F.round("n").cast("long").alias("n_tokens"), F.round("known").cast("long").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )


def averaged(learned: list[dict]) -> Mixer:
    """Weights averaged over ranges by their tokens; the adaptive maps add up."""
    out = Mixer.fresh()
    total = sum(r["n"] for r in learned)
    if total:
        out.weights = sum(np.frombuffer(r["weights"], float).reshape(SETS, INPUTS) * (r["n"] / total) for r in learned)
        first = Mixer.fresh()
        for r in learned:
            out.hits = out.hits + np.frombuffer(r["hits"], float).reshape(SETS, CELLS) - first.hits
            out.seen = out.seen + np.frombuffer(r["seen"], float).reshape(SETS, CELLS) - first.seen
    return out
