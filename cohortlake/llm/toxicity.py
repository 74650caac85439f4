"""Toxicity from misspelling-tolerant lexicon hits and their context.

A lexicon of terms is learned from labelled texts. Its trie is intersected with the Levenshtein
automaton of one edit, and the product is made deterministic once, as a transition table; a batch runs
all its distinct words through the table together, one character a step. A token is looked up by its
runs of letters, and as one word without its other characters if no run is found, so neither
``idiot,you`` nor ``i-d-i-o-t`` hides a term. Each hit is judged in a
window of words around it: quotation marks on both sides speak for quotation, words of address for
abuse. A logistic regression on the sums of a text gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, gathered, ragged, ship_package, tidy

#: Terms shorter than this must match exactly; others within one edit.
EXACT_BELOW = 4
#: Words looked at on each side of a hit.
CONTEXT = 5
BATCH_BYTES = 8 << 20
#: Evidence from which a word becomes a term.
LIKELIHOOD_RATIO = 25.0
#: Words of address, and quotation marks.
ADDRESS = {"you", "your", "du", "dich", "dein", "ihr", "tu", "te", "toi", "vous", "tú", "usted", "eres"}
_QUOTE = "[\"“”„«»‹›‘’']"
_FEATURES = 9


@dataclass
class Lexicon:
    """Deterministic product of the trie and the automaton."""

    symbol: np.ndarray  # code point -> column of the table; 0 stands for every other character
    table: np.ndarray  # state x symbol -> state; state 0 is dead
    term: np.ndarray  # state -> term, -1 where none is accepted
    exact: np.ndarray  # state -> whether the term itself was read
    weights: np.ndarray  # of each term
    longest: int

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Term of each word (-1: none), and whether it is spelled exactly."""
        out, same = np.full(len(words), -1, np.int64), np.zeros(len(words), bool)
        some = np.array([i for i, w in enumerate(words) if 0 < len(w) <= self.longest + 1], np.int64)
        if not len(some):
            return out, same
        width = self.longest + 1
        points = np.array([words[i] for i in some], dtype=f"<U{width}").view("<u4").reshape(-1, width)
        codes = self.symbol[np.minimum(points, len(self.symbol) - 1)]
        sizes = np.array([len(words[i]) for i in some])
        state = np.ones(len(some), np.int64)
        for k in range(width):
            state = np.where(k < sizes, self.table[state, codes[:, k]], state)
        out[some], same[some] = self.term[state], self.exact[state]
        return out, same


def compile_lexicon(terms: list[str], weights: list[float]) -> Lexicon:
    """Subset construction over (trie node, edits). Of several terms within reach of a word an exact
    one wins, then the first in the list."""
    nodes: list[dict[str, int]] = [{}]
    final: dict[int, int] = {}
    long_below: list[bool] = [False]
    for number, term in enumerate(terms):
        at = 0
        for c in term:
            if c not in nodes[at]:
                nodes[at][c] = len(nodes)
                nodes.append({})
                long_below.append(False)
            if len(term) >= EXACT_BELOW:
                long_below[at] = True
            at = nodes[at][c]
        long_below[at] |= len(term) >= EXACT_BELOW
        final.setdefault(at, number)
    letters = sorted({c for t in terms for c in t})

    def closed(states: set[tuple[int, int]]) -> frozenset:
        out = set(states)
        for node, edits in states:
            if edits == 0:
                out.update((child, 1) for child in nodes[node].values() if long_below[child])
        return frozenset((n, e) for n, e in out if e == 0 or (n, 0) not in out)

    def step(states: frozenset, c: str | None) -> frozenset:
        out: set[tuple[int, int]] = set()
        for node, edits in states:
            child = nodes[node].get(c) if c is not None else None
            if child is not None and (edits == 0 or long_below[child]):
                out.add((child, edits))
            if edits == 0:
                if long_below[node]:
                    out.add((node, 1))
                out.update((k, 1) for k in nodes[node].values() if long_below[k])
        return closed(out)

    start = closed({(0, 0)})
    number = {frozenset(): 0, start: 1}
    order = [frozenset(), start]
    table: list[list[int]] = []
    for states in order:  # grows while it is read
        row = []
        for c in (None, *letters):
            target = step(states, c) if states else states
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
    term, exact = np.full(len(order), -1), np.zeros(len(order), bool)
    for k, states in enumerate(order):
        found = sorted((e, final[n]) for n, e in states if n in final and (e == 0 or len(terms[final[n]]) >= EXACT_BELOW))
        if found:
            term[k], exact[k] = found[0][1], found[0][0] == 0
    symbol = np.zeros(max((ord(c) for c in letters), default=0) + 2, np.int64)
    for k, c in enumerate(letters):
        symbol[ord(c)] = k + 1
    return Lexicon(symbol, np.array(table, np.int64), term, exact, np.array(weights), max(map(len, terms), default=0))


def learn_lexicon(sample: DataFrame, least: int = 4) -> tuple[list[str], list[float]]:
    """Terms that stand in toxic texts (label 1) far more often than in others, with log-odds; the most
    telling first, equally telling ones by their letters.

    ``sample``: text, label. Words are runs of letters in lower case, counted once a text. Every word over the
    likelihood ratio is a term; their number is bounded by the sample, of which each needs several texts.
    """
    words = sample.select(
        "label", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))).alias("word")
    )
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return [], []
    counted = words.groupBy("word").agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("n"))
    odds = F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5)) - F.log((F.col("n") + 0.5) / (other - F.col("n") + 0.5))
    # Likelihood ratio of the word's share among toxic and among other texts.
    share = (F.col("t") + F.col("n")) / (toxic + other)
    part = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    ratio = 2 * (
        part(F.col("t"), toxic * share)
        + part(F.col("n"), other * share)
        + part(toxic - F.col("t"), toxic * (1 - share))
        + part(other - F.col("n"), other * (1 - share))
    )
    best = (
        counted.where((F.col("t") >= least) & (F.length("word") >= 3))
        .select("word", odds.alias("odds"), ratio.alias("ratio"))
        .where((F.col("ratio") >= LIKELIHOOD_RATIO) & (F.col("odds") >= 2.0))
        .orderBy(F.desc("ratio"), "word")
        .collect()
    )
    return [r["word"] for r in best], [r["odds"] for r in best]


def _token_hits(names: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hits of distinct tokens: token (ascending), term, whether spelled exactly; and for each token whether a
    word of address is in it."""
    joined = pc.replace_substring_regex(names, r"[^\pL]+", "").to_pylist()
    parts = pc.split_pattern_regex(names, r"[^\pL]+")
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    runs = pc.list_flatten(parts).to_pylist()
    term, exact = lexicon.match(runs)
    some = np.flatnonzero(term >= 0)
    in_runs = np.zeros(len(names), bool)
    in_runs[owner[some]] = True
    whole, same = lexicon.match(joined)
    rest = np.flatnonzero((whole >= 0) & ~in_runs)
    token = np.r_[owner[some], rest]
    order = np.argsort(token, kind="stable")
    address = np.array([p in ADDRESS for p in joined], bool)
    address[owner[np.array([r in ADDRESS for r in runs], bool)]] = True
    return token[order], np.r_[term[some], whole[rest]][order], np.r_[exact[some], same[rest]][order], address


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row for each text: sums over its hits, by spelling and by context."""
    n = len(texts)
    lowered = pc.utf8_lower(texts).cast(pa.large_string())
    parts = pc.ascii_split_whitespace(lowered)
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    tokens = pc.list_flatten(parts)
    some = pc.greater(pc.binary_length(tokens), 0)
    tokens, owner = tokens.filter(some), owner[some.to_numpy(zero_copy_only=False)]
    out = np.zeros((n, _FEATURES))
    out[:, 0] = 1
    if not len(tokens):
        return out
    coded = tokens.dictionary_encode()
    names = coded.dictionary
    ids = coded.indices.to_numpy(zero_copy_only=False)
    owners, found, same, address = _token_hits(names, lexicon)
    quote = pc.match_substring_regex(names, _QUOTE).to_numpy(zero_copy_only=False)
    first = np.searchsorted(owner, np.arange(n))
    last = np.searchsorted(owner, np.arange(n), side="right")
    words = last - first
    out[:, 8] = np.log1p(words)
    held = np.bincount(owners, minlength=len(names))
    hit = np.repeat(np.arange(len(ids)), held[ids])
    if not len(hit):
        return out
    which = ragged((np.cumsum(held) - held)[ids], held[ids])
    doc = owner[hit]
    marks, calls = np.r_[0, np.cumsum(quote[ids])], np.r_[0, np.cumsum(address[ids])]
    left, right = np.maximum(hit - CONTEXT, first[doc]), np.minimum(hit + CONTEXT + 1, last[doc])
    quoted = (marks[hit + 1] - marks[left] > 0) & (marks[right] - marks[hit] > 0)
    called = calls[right] - calls[left] > 0
    t, e = found[which], same[which]
    weight = lexicon.weights[t]
    total = lambda x: np.bincount(doc, weights=x, minlength=n)
    out[:, 1] = np.log1p(total(weight * (e & ~quoted)))
    out[:, 2] = np.log1p(total(weight * (~e & ~quoted)))
    out[:, 3] = np.log1p(total(weight * quoted))
    out[:, 4] = np.log1p(total(called & ~quoted))
    out[:, 5] = np.log1p(100 * total(weight * e) / np.maximum(words, 1))
    best = np.zeros(n)
    np.maximum.at(best, doc, weight * np.where(e, 1.0, 0.3) * ~quoted)
    out[:, 6] = best
    kinds = np.unique(np.c_[doc, t][e & ~quoted], axis=0)
    out[:, 7] = np.log1p(np.bincount(kinds[:, 0], minlength=n)) if len(kinds) else 0
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients by Newton steps; the first column is the constant and is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = ridge * np.eye(x.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - shrink @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + shrink, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """``text, label`` of at most ``per_label`` rows of each label, those with the smallest hashed (id, text),
    and how many labelled ids each label has. Ids with several labels count with each; rows that repeat an id are
    rows of their own, equal rows count as one; null ids, texts and labels take no part."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").alias("label")).distinct()
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_label).select("doc_id", "label")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Two times per_label ids at most, hence the broadcast; an id may stand in any number of rows.
    rows = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("mark"))
    rows = rows.join(F.broadcast(ids), "doc_id")
    keys = ["label", "doc_id", "mark"]
    each = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "mark")
    first = rows.select(*keys).distinct().withColumn("n", F.row_number().over(each)).where(F.col("n") <= per_label)
    chosen = rows.join(F.broadcast(first.drop("n")), keys).groupBy(*keys).agg(F.min("text").alias("text"))
    return chosen.select("text", "label"), sizes


def train(docs: DataFrame, labels: DataFrame, per_label: int = 3000) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and regression from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Only a sample of ``per_label`` rows of each label is used; its weights restore the labels' shares.
    Without labelled rows the lexicon is empty and every score is that of no knowledge.
    """
    sample, sizes = labelled_sample(docs, labels, per_label)
    sample = cut_lineage(sample, "toxicity-sample")
    lexicon = compile_lexicon(*learn_lexicon(sample))
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BATCH_BYTES):
            x = features(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), _FEATURES).cast(pa.list_(pa.float64()))],
                names=["label", "x"],
            )

    rows = sample.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(run, "label int, x array<double>").collect()
    if not rows:
        return lexicon, np.zeros(_FEATURES)
    rows = sorted((r["label"], tuple(r["x"])) for r in rows)
    y, x = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
    held = {label: max(1, int((y == label).sum())) for label in (0, 1)}
    weight = np.array([sizes.get(int(k), 0) / held[int(k)] for k in y])
    return lexicon, logistic(x, y, weight * len(y) / max(weight.sum(), 1))


def score(docs: DataFrame, lexicon: Lexicon, coefficients: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """``docs`` (text, more) without text, with ``score`` and ``predicted``; columns of these names are
    replaced. Null texts are empty; an empty text gets the score of a text without hits."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((lexicon, coefficients))  # size set by the number of terms
    keep = [c for c in docs.columns if c not in ("text", "score", "predicted")]
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = shared.value
        for batch in gathered(batches, "text", BATCH_BYTES):
            x = features(pc.fill_null(batch.column("text"), ""), own)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    return docs.select(*keep, "text").mapInArrow(tidy(run), schema)
