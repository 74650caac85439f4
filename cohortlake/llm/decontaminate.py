"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max pruning.

The index holds the test items: a posting list for each term, cut into blocks of items with the
highest score contribution of each block. Every training document is read in overlapping passages,
and every passage is a query. Scores are divided by the item's score with itself, so one threshold
serves all items. As in WAND, a passage is dropped when the sum of its terms' highest contributions
stays below the threshold; then a (passage, block of items) pair is dropped when the sum of the
block's highest contributions does; only what is left is scored. Pruning is exact: whatever reaches
the threshold is retrieved.

Retrieved pairs are verified on five-word shingles: enough of the item's question (all but its last
sentence) and of its answer (the last sentence) must stand in the document; or enough of the whole
item, with at least half of the answer's words where they belong, so an altered last sentence is no
way out. Words are compared without punctuation at their edges.

Item counts, document frequencies and the passage length are taken from all items by Spark. A large set of
items is indexed in parts, each built in a task with those statistics, so pairs and scores do not depend
on the number of parts.
"""

from __future__ import annotations

import math
import pickle
import re
import string
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, gathered, ragged, ship_package, text_tokens, tidy, words_of

#: Shingle length and overlap of verification.
SHINGLE = 5
OVERLAP = 0.8
#: Share of the answer's words that must stand in place when the whole item is held, and words by which
#: they may be shifted.
TRACE, SHIFT = 0.5, 2
#: Share of an item's score with itself from which a passage is retrieved.
RETRIEVE = 0.5
#: Items in a block of a posting list, bytes of index that are broadcast at once (WORD_BYTES for each word
#: beside the text), (passage, block) sums held at once, the block maxima they are added up from (those of
#: one passage at least), and bytes of text whose words are held at once (those of one text at least).
ITEM_BLOCK = 16
INDEX_BYTES = 32 << 20
WORD_BYTES = 80
BOUNDS = 1 << 22
MAXIMA = 1 << 20
TEXT_BYTES = 2 << 20
#: Fixed values of BM25.
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_EDGES = string.punctuation + "“”„«»‹›‘’‚…–—¿¡、。，！？"


def parts_of(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer; a single sentence is both."""
    sentences = [s for s in _SENTENCE.split(text.strip()) if s]
    if len(sentences) < 2:
        return words_of(text), words_of(text)
    return words_of(" ".join(sentences[:-1])), words_of(sentences[-1])


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def bare(words: list[bytes]) -> list[bytes]:
    """Words without punctuation at their edges; if nothing would be left, the words as they are."""
    kept = [w for w in (x.decode("utf-8").strip(_EDGES).encode() for x in words) if w]
    return kept or words


def bare_tokens(words: pa.Array, owner: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of ``text_tokens`` as ``bare`` has them, encoded; ids of words that are left."""
    coded = words.dictionary_encode()
    names = pc.utf8_trim(coded.dictionary, _EDGES)
    filled = pc.greater(pc.binary_length(names), 0).to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
    # Texts of nothing but punctuation keep it.
    has = np.zeros(int(owner.max(initial=-1)) + 1, bool)
    has[owner[filled]] = True
    kept = filled | ~has[owner]
    names = pc.if_else(pc.equal(pc.binary_length(names), 0), coded.dictionary, names)
    return pa.DictionaryArray.from_arrays(coded.indices.filter(pa.array(kept)), names), owner[kept]


@dataclass
class ItemIndex:
    ids: np.ndarray
    texts: list[tuple[list[bytes], list[bytes]]]
    terms: dict[bytes, int]
    starts: np.ndarray  # posting list of term t: starts[t] to starts[t + 1]
    items: np.ndarray
    weight: np.ndarray  # idf over the item's score with itself
    best: np.ndarray  # highest weight, by term
    block_starts: np.ndarray  # blocks that hold term t: block_starts[t] to block_starts[t + 1]
    blocks: np.ndarray
    block_best: np.ndarray  # highest weight of the term in the block
    passage: int  # words of a passage

    @property
    def n_blocks(self) -> int:
        return -(-len(self.ids) // ITEM_BLOCK)


def build_index(rows: list[tuple[int, str]], n: int, df: Mapping[bytes, int], longest: int) -> ItemIndex:
    """Index of items with a word each; ``n`` items, ``df`` of them with a term and ``longest`` words of one
    are counts over the whole set of which ``rows`` are a part."""
    bags = [Counter(bare(words_of(t))) for _, t in rows]
    terms = {w: k for k, w in enumerate(sorted({w for b in bags for w in b}))}
    idf = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in terms}
    own = [sum(idf[w] * _saturated(f) for w, f in b.items()) for b in bags]
    postings: list[list[tuple[int, float]]] = [[] for _ in terms]
    for i, b in enumerate(bags):
        for w in b:
            postings[terms[w]].append((i, idf[w] / own[i]))
    sizes = np.array([len(p) for p in postings], np.int64)
    items = np.array([i for p in postings for i, _ in p], np.int64)
    weight = np.array([w for p in postings for _, w in p])
    # Items stand in ascending order in a posting list, so those of one block stand together.
    term = np.repeat(np.arange(len(terms)), sizes)
    block = items // ITEM_BLOCK
    heads = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(items) else np.empty(0, np.int64)
    block_best = np.maximum.reduceat(weight, heads) if len(items) else np.empty(0)
    best = np.zeros(len(terms))
    np.maximum.at(best, term[heads], block_best)
    starts = lambda counts: np.r_[0, np.cumsum(counts)].astype(np.int64)
    # A passage covers two items of the greatest length, so an item always lies whole in some passage.
    return ItemIndex(
        np.array([i for i, _ in rows], np.int64), [parts_of(t) for _, t in rows], terms, starts(sizes), items, weight,
        best, starts(np.bincount(term[heads], minlength=len(terms))), block[heads], block_best, 2 * max(longest, 1),
    )


def _saturated(f):
    """BM25's frequency part of a passage; all have the same length, so its length part is one."""
    return f * (K1 + 1) / (f + K1)


def groups(rows: np.ndarray, cost: np.ndarray, most_rows: int) -> Iterator[np.ndarray]:
    """Rows in runs of at most ``most_rows`` that cost no more than ``MAXIMA`` together, or of a single row."""
    spent = np.r_[0, np.cumsum(cost)]
    at = 0
    while at < len(rows):
        end = int(np.searchsorted(spent, spent[at] + MAXIMA, side="right")) - 1
        end = max(at + 1, min(end, at + most_rows))
        yield rows[at:end]
        at = end


def search(index: ItemIndex, coded: pa.DictionaryArray, owner: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, best score) of every pair of which some passage reaches the threshold."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if not len(index.ids) or not len(coded):
        return none
    term = np.array([index.terms.get(w, -1) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()] or [-1])
    term = term[coded.indices.to_numpy(zero_copy_only=False)]
    first = np.searchsorted(owner, np.arange(n_docs))
    place = np.arange(len(owner)) - first[owner]
    known = term >= 0
    term, doc, place = term[known], owner[known], place[known]
    if not len(term):
        return none
    half = index.passage // 2
    # Passage j of a document covers words j * half to (j + 2) * half; each word lies in two of them.
    stride = int(place.max(initial=0)) // half + 2
    passage = np.r_[doc * stride + place // half + 1, doc * stride + place // half]
    both = np.r_[term, term]
    key = passage * len(index.terms) + both
    key.sort()
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[start, len(key)])
    passage, term = np.divmod(key[start], len(index.terms))
    part = _saturated(count)
    heads = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    bound = np.add.reduceat(index.best[term] * part, heads)
    live = bound >= RETRIEVE - 1e-6
    sizes = np.diff(np.r_[heads, len(passage)])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alive = np.flatnonzero(live)
    step = max(1, min(4096, BOUNDS // index.n_blocks))
    maxima = np.add.reduceat(index.block_starts[term + 1] - index.block_starts[term], heads)[alive]
    for some in groups(alive, maxima, step):
        rows = ragged(heads[some], sizes[some])
        t, p = term[rows], part[rows]
        cuts = np.cumsum(sizes[some]) - sizes[some]
        held = index.block_starts[t + 1] - index.block_starts[t]
        posts = ragged(index.block_starts[t], held)
        cell = np.repeat(np.repeat(np.arange(len(some)), sizes[some]), held) * index.n_blocks + index.blocks[posts]
        bounds = np.bincount(cell, weights=index.block_best[posts] * np.repeat(p, held), minlength=len(some) * index.n_blocks)
        blocks = bounds.reshape(len(some), -1) >= RETRIEVE - 1e-6
        keep = np.flatnonzero(blocks.any(1))
        for q in keep:
            mine = slice(cuts[q], cuts[q] + sizes[some[q]])
            tq, c = t[mine], count[rows[mine]]
            lens = index.starts[tq + 1] - index.starts[tq]
            posts = ragged(index.starts[tq], lens)
            which = index.items[posts]
            open_block = blocks[q][which // ITEM_BLOCK]
            f = np.repeat(_saturated(c), lens)
            scores = np.bincount(which[open_block], weights=(index.weight[posts] * f)[open_block], minlength=len(index.ids))
            hit = np.flatnonzero(scores >= RETRIEVE)
            if len(hit):
                found.append((np.full(len(hit), passage[heads[some[q]]] // stride), hit, scores[hit]))
    if not found:
        return none
    d, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((-s, i, d))
    d, i, s = d[order], i[order], s[order]
    top = np.r_[True, (d[1:] != d[:-1]) | (i[1:] != i[:-1])]
    return d[top], i[top], s[top]


@dataclass
class Document:
    """What verification looks at: words as they are, bare words and where their shingles stand."""

    words: list[bytes]
    plain: list[bytes]
    at: dict[tuple[bytes, ...], list[int]]

    @staticmethod
    def of(text: str) -> Document:
        words = words_of(text)
        plain = bare(words)
        at: dict[tuple[bytes, ...], list[int]] = {}
        for i in range(len(plain) - SHINGLE + 1):
            at.setdefault(tuple(plain[i : i + SHINGLE]), []).append(i)
        return Document(words, plain, at)

    def places(self, run: list[bytes]) -> list[int]:
        """Where a run of at most SHINGLE bare words stands."""
        if len(run) == SHINGLE:
            return self.at.get(tuple(run), [])
        return [i for i in range(len(self.plain) - len(run) + 1) if self.plain[i : i + len(run)] == run]


def in_place(own: list[bytes], first: int, last: int, doc: Document) -> float:
    """Share of words ``first`` to ``last`` of an item that stand where its shingles say they would."""
    size = min(SHINGLE, len(own))
    starts = {p - j for j in range(len(own) - size + 1) for p in doc.places(own[j : j + size])}
    best = 0
    for start in starts:
        seen = [max(start + first, start + k - SHIFT, 0) for k in range(first, last)]
        best = max(best, sum(own[k] in doc.plain[at : max(start + k + SHIFT + 1, 0)] for k, at in zip(range(first, last), seen, strict=True)))
    return best / max(last - first, 1)


def verified(index: ItemIndex, item: int, doc: Document, overlap: float) -> tuple[float, float, bool]:
    """Shares of the question and of the answer that stand in the document, and the judgement.

    A part of fewer than five words stands in the document as a run, or its words stand in place.
    """
    question, answer = (bare(part) for part in index.texts[item])
    single = index.texts[item][0] == index.texts[item][1]
    own = question if single else question + answer
    shares = []
    for part, plain, first in zip(index.texts[item], (question, answer), (0, len(own) - len(answer)), strict=True):
        if 0 < len(plain) < SHINGLE:
            n = len(part)
            run = any(doc.words[i : i + n] == part for i in range(len(doc.words) - n + 1))
            shares.append(1.0 if run else in_place(own, first, first + len(plain), doc))
        else:
            mine = shingles(plain)
            shares.append(len(mine & doc.at.keys()) / len(mine) if mine else 1.0)
    if min(shares) >= overlap:
        return shares[0], shares[1], True
    mine = shingles(own)
    whole = sum(s in doc.at for s in mine) / len(mine) if len(own) >= SHINGLE else float(bool(doc.places(own)))
    held = whole >= overlap and in_place(own, len(own) - len(answer), len(own), doc) >= TRACE
    return shares[0], shares[1], held


def contaminated_pairs(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question, answer, contaminated`` for every retrieved pair.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored. score: the best
    passage's BM25 score over the item's with itself. contaminated: at least ``overlap`` of the
    question's and of the answer's shingles stand in the document, or as much of the whole item's and
    half of the answer's words in place; parts of fewer than five words must stand in it as a run or in
    place. Null and wordless texts are never found. Rows that repeat a doc_id or item_id
    give a row each, in every combination that is found; null ids stay null.

    The index is broadcast in parts of about ``INDEX_BYTES``; a larger set of items takes more passes over the
    documents, each written before the next one starts, with the same result. Empty tables give no
    rows. Texts of any length are read whole; of passages with equal scores the score counts once.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kinds = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question double, answer double, contaminated boolean"
    out, target = None, _arrow_type(items)
    indexes, parts = item_indexes(items)
    for number in range(parts):
        built = pickle.loads(indexes.where(F.col("part") == number).first()["index"])
        shared = spark.sparkContext.broadcast(built)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            for batch in gathered(batches, "text", TEXT_BYTES):
                texts = pc.fill_null(batch.column("text"), "")
                words, owner = bare_tokens(*text_tokens(texts))
                d, i, s = search(index, words, owner, len(texts))
                shares = []
                last, own = -1, None
                for doc, item in zip(d.tolist(), i.tolist(), strict=True):
                    if doc != last:
                        last, own = doc, Document.of(texts[doc].as_py())
                    shares.append(verified(index, item, own, overlap))
                both = np.array(shares, float).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(d)), names.take(pa.array(index.ids[i])).cast(target),
                        pa.array(s), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(both[:, 2] > 0),
                    ],
                    names=["doc_id", "item_id", "score", "question", "answer", "contaminated"],
                )

        found = docs.select("doc_id", "text").mapInArrow(tidy(run), schema)
        if parts > 1:  # the driver holds one part at a time
            found = cut_lineage(found, "decontamination-part")
            shared.destroy()
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], schema) if out is None else out


def _arrow_type(items: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(items.schema["item_id"].dataType)


def item_indexes(items: DataFrame) -> tuple[DataFrame, int]:
    """``part, index`` with one pickled (index, item ids) for each part, and the number of parts.

    Items are dealt to parts row by row, so repeated items are no crowd; a part is put together in a task.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    numbered = items.where("text is not null").select("item_id", "text", F.monotonically_increasing_id().alias("row"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [Counter(bare(words_of(t))) for t in batch.column("text").to_pylist()]
            counts = [list(b) for b in bags], [sum(b.values()) for b in bags]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("item_id", "text", "row")), pa.array(counts[0], pa.list_(pa.binary())), pa.array(counts[1], pa.int64())],
                names=["item_id", "text", "row", "words", "n_words"],
            )

    held = numbered.mapInArrow(count, f"item_id {kind}, text string, row bigint, words array<binary>, n_words bigint")
    held = cut_lineage(held.where("n_words > 0"), "items")
    size = F.sum(F.col("n_words") * WORD_BYTES + F.octet_length("text"))
    n, longest, total = held.agg(F.count(F.lit(1)), F.max("n_words"), size).first()
    parts = -(-(total or 0) // INDEX_BYTES)
    if not parts:
        return items.sparkSession.createDataFrame([], "part int, index binary"), 0
    dealt = held.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    words = dealt.select("part", F.explode("words").alias("word"))
    df = words.groupBy("part", "word").agg(F.count(F.lit(1)).alias("df"))
    if parts > 1:
        whole = df.groupBy("word").agg(F.sum("df").alias("df"))
        df = df.select("part", "word").join(whole, "word")

    def build(key: tuple, own: pa.Table, counted: pa.Table) -> pa.Table:
        own = own.sort_by("row")
        frequency = dict(zip(counted.column("word").to_pylist(), counted.column("df").to_pylist(), strict=True))
        index = build_index(list(enumerate(own.column("text").to_pylist())), n, frequency, longest)
        names = own.column("item_id").combine_chunks()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "index": pa.array([pickle.dumps((index, names))], pa.binary())})

    grouped = dealt.select("part", "item_id", "text", "row").groupBy("part")
    built = grouped.cogroup(df.select(F.col("part").alias("part_of"), "word", "df").groupBy("part_of")).applyInArrow(build, "part int, index binary")
    # A part that no row was dealt to has no index; the others are numbered anew.
    built = cut_lineage(built, "item-index")
    filled = {r["part"] for r in built.select("part").collect()}
    if len(filled) < parts:
        order = {p: k for k, p in enumerate(sorted(filled))}
        number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
        built = built.withColumn("part", number[F.col("part")])
    return built, len(filled)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that are contaminated by some item.

    Rows are told apart by doc_id and text, so a null doc_id is no shelter, and a clean row stays that
    shares its doc_id with a contaminated one. The keys of contaminated rows are written before the join:
    texts are not sorted and shuffled while other tasks search, and Spark knows how few the keys are.
    """
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.sha2(F.col("text"), 256))
    row = "_row" + "_" * max(map(len, docs.columns))  # longer than any column's name, so it clashes with none
    marked = docs.withColumn(row, key)
    found = contaminated_pairs(marked.select(F.col(row).alias("doc_id"), "text"), items)
    bad = cut_lineage(found.where("contaminated").select(F.col("doc_id").alias(row)).distinct(), "contaminated")
    return marked.join(bad, row, "left_anti").select(*docs.columns)
