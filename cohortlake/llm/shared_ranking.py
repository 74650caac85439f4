"""Lexical ranking of all documents for many queries at once, sharing their common parts.

A query's score for a document is a sum over its terms, so terms that always occur together in the same
queries need one sum, not one for each query. ``mine`` builds the sharing plan of a block of queries:

* *Leaves*: terms grouped by the exact set of queries that hold them. A leaf's accumulator is one number
  for each document.
* *Shared sums*: each query is a list of leaves, the widest shared first; while two neighbours stand
  together in several lists, they become one node. Nodes form a DAG; each is summed once from its two parts.
* *Queries* add up the few nodes that are left in their lists.

All arithmetic is in whole numbers, so the order of sums changes nothing. Documents are read once for each
block of queries: their terms become packed postings, from which statistics and then scores are taken.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, flat, gathered, lists, tidy
from cohortlake.llm.postings import packed_columns, unpacked

#: Bytes of text in a block of documents.
BLOCK_BYTES = 8 << 20
#: Bytes of query text whose plan is broadcast at once; a query is never split.
QUERY_BYTES = 8 << 20
#: Cells of accumulators that a task holds at once.
TILE_CELLS = 4 << 20
#: A term's characters are digits, ASCII letters in lower case, and all beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
POSTINGS = "doc_ids array<long>, n_terms array<int>, packed binary, df_term array<int>, df_count array<int>"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a column of texts, and the text that each belongs to."""
    texts = pa.concat_arrays([pc.fill_null(texts, ""), pa.array([""])])[:-1]
    data = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes().translate(_TERM_BYTES)
    plain = pa.Array.from_buffers(pa.string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(data)])
    parts = pc.split_pattern(plain.cast(pa.large_string()), " ")
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    terms = pc.list_flatten(parts)
    some = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(some), owner[some.to_numpy(zero_copy_only=False)]


class Plan(NamedTuple):
    """``leaf``: of each term; ``left``, ``right``: parts of each shared sum (nodes behind the leaves, in
    order of making); ``nodes``, ``sizes``: what each query adds up."""

    terms: pa.Array
    leaf: np.ndarray
    left: np.ndarray
    right: np.ndarray
    nodes: np.ndarray
    sizes: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max(initial=-1)) + 1


def mine(queries: list[list[str]]) -> Plan:
    """The sharing plan of queries, each a list of different terms."""
    held: dict[str, list[int]] = {}
    for at, terms in enumerate(queries):
        for term in terms:
            held.setdefault(term, []).append(at)
    leaves: dict[tuple[int, ...], int] = {}
    terms = sorted(held)
    leaf = np.array([leaves.setdefault(tuple(held[t]), len(leaves)) for t in terms], np.int64)
    rows: list[list[int]] = [[] for _ in queries]
    for holders, node in sorted(leaves.items(), key=lambda x: (-len(x[0]), x[1])):
        for at in holders:
            rows[at].append(node)
    parts: list[tuple[int, int]] = []
    while True:
        seen = Counter(pair for row in rows for pair in zip(row, row[1:], strict=False))
        made: dict[tuple[int, int], int] = {}
        for at, row in enumerate(rows):
            rows[at] = _paired(row, seen, made, parts, len(leaves))
        if not made:
            break
    left, right = np.array(parts, np.int64).reshape(-1, 2).T
    sizes = np.array([len(r) for r in rows], np.int64)
    nodes = np.array([n for r in rows for n in r], np.int64)
    return Plan(pa.array(terms, pa.large_string()), leaf, left, right, nodes, sizes)


def _paired(row: list[int], seen: Counter, made: dict, parts: list, n_leaves: int) -> list[int]:
    """A row with neighbours that several rows share put together, the more frequent pair first."""
    out, i = [], 0
    while i < len(row):
        pair = (row[i], row[i + 1]) if i + 1 < len(row) else None
        times = seen[pair] if pair else 0
        later = seen[row[i + 1], row[i + 2]] if i + 2 < len(row) else 0
        if times < 2 or later > times:
            out.append(row[i])
            i += 1
            continue
        if pair not in made:
            made[pair] = n_leaves + len(parts)
            parts.append(pair)
        out.append(made[pair])
        i += 2
    return out


def accumulate(plan: Plan, leaf: np.ndarray, at: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """Score of every query (rows) for every document (columns), from values of leaves in documents."""
    n_leaves = plan.n_leaves
    sums = np.zeros((n_leaves + len(plan.left), n_docs), np.int64)
    np.add.at(sums.reshape(-1), leaf * n_docs + at, value)
    for first, behind in _levels(plan):
        a, b = plan.left[first:behind], plan.right[first:behind]
        np.add(sums[a], sums[b], out=sums[n_leaves + first : n_leaves + behind])
    out = np.zeros((len(plan.sizes), n_docs), np.int64)
    start = np.cumsum(plan.sizes) - plan.sizes
    some = np.flatnonzero(plan.sizes)
    step = max(1, TILE_CELLS // max(1, n_docs))
    done = 0
    while done < len(some):  # as many queries at a time as the tile allows, one at least
        sizes = np.cumsum(plan.sizes[some[done:]])
        take = max(1, int(np.searchsorted(sizes, step, "right")))
        own = some[done : done + take]
        span = plan.nodes[start[own[0]] : start[own[-1]] + plan.sizes[own[-1]]]
        out[own] = np.add.reduceat(sums[span], start[own] - start[own[0]], axis=0)
        done += take
    return out


def _levels(plan: Plan) -> list[tuple[int, int]]:
    """Runs of shared sums none of which is a part of another one of its run."""
    runs, first = [], 0
    newest = np.maximum(plan.left, plan.right) - plan.n_leaves
    for i, part in enumerate(newest.tolist()):
        if part >= first:
            runs.append((first, i))
            first = i
    return [*runs, (first, len(newest))] if len(newest) else []


def _post(plan_of):
    """Task function: documents to packed postings of the plan's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = plan_of().terms
        for batch in gathered(batches, "text", BLOCK_BYTES):
            n = batch.num_rows
            words, owner = terms_of(batch.column("text"))
            n_terms = np.bincount(owner, minlength=n).astype(np.int32)
            found = pc.index_in(words, terms).fill_null(-1).to_numpy(zero_copy_only=False)
            known = found >= 0
            key, times = np.unique(owner[known].astype(np.int64) * max(1, len(terms)) + found[known], return_counts=True)
            at, term = np.divmod(key, max(1, len(terms)))
            df = np.bincount(term, minlength=1)
            some = np.flatnonzero(df)
            ends = np.searchsorted(at, np.arange(n + 1))
            columns = {"term": lists(term.astype(np.int32), ends), "times": lists(times.astype(np.int32), ends)}
            whole = pa.array([0, n], pa.int32())
            one = np.array([0, len(some)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(whole, batch.column("doc_id")), lists(n_terms, np.array([0, n])),
                    pa.array([packed_columns(columns)], pa.binary()),
                    lists(some.astype(np.int32), one), lists(df[some].astype(np.int32), one),
                ],
                names=["doc_ids", "n_terms", "packed", "df_term", "df_count"],
            )

    return run


class _Best:
    """The k best documents of each query met so far: highest score, then smallest id, no id last."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.zeros((n, k), np.int64)
        self.bare = np.ones((n, k), bool)
        self.doc = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, doc: np.ndarray, bare: np.ndarray) -> None:
        last, last_doc, last_bare = self.score[:, -1:], self.doc[:, -1:], self.bare[:, -1:]
        better = (scores > last) | (scores > 0) & (scores == last) & (bare < last_bare | (bare == last_bare) & (doc < last_doc))
        for q in np.flatnonzero(better.any(axis=1)):
            new = better[q]
            score = np.r_[self.score[q], scores[q, new]]
            none, ids = np.r_[self.bare[q], bare[new]], np.r_[self.doc[q], doc[new]]
            top = np.lexsort((ids, none, -score))[: self.k]
            self.score[q], self.bare[q], self.doc[q] = score[top], none[top], ids[top]


def _score(plan_of, weights, n_docs: int, n_all: int, k: int):
    """Task function: postings to the task's k best documents of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = plan_of(), weights.value
        best = _Best(len(plan.sizes), k)
        tile = max(1, TILE_CELLS // max(1, plan.n_leaves + len(plan.left) + len(plan.sizes)))
        for batch in batches:
            for ids, lengths, data in zip(batch.column("doc_ids"), batch.column("n_terms"), batch.column("packed"), strict=True):
                rows = unpacked(data.as_py())
                (term, sizes), (times, _) = flat(rows.column("term")), flat(rows.column("times"))
                m = 10 + (90 * n_docs * lengths.values.to_numpy().astype(np.int64)) // n_all
                at = np.repeat(np.arange(len(sizes)), sizes)
                value = weight[term] * ((1_000_000_000 * times.astype(np.int64)) // (1000 * times.astype(np.int64) + 8 * m[at]))
                bare = pc.is_null(ids.values).to_numpy(zero_copy_only=False)
                doc = pc.fill_null(ids.values, 0).to_numpy(zero_copy_only=False)
                for low in range(0, len(sizes), tile):
                    high = min(low + tile, len(sizes))
                    a, b = np.searchsorted(at, [low, high])
                    scores = accumulate(plan, plan.leaf[term[a:b]], at[a:b] - low, value[a:b], high - low)
                    best.add(scores, doc[low:high], bare[low:high])
        query, place = np.nonzero(best.score > 0)
        none = best.bare[query, place]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query.astype(np.int32)), pa.array(best.doc[query, place], mask=none),
                pa.array(best.score[query, place]),
            ],
            names=["query", "doc_id", "score"],
        )

    return run


def _plan_bytes(plan: Plan, names: pa.Array) -> bytes:
    """A plan and the ids of its queries as one value, to be sent about."""
    parts = {"terms": plan.terms, "names": names}
    parts |= {c: pa.array(getattr(plan, c)) for c in Plan._fields[1:]}
    whole = {c: pa.LargeListArray.from_arrays(pa.array([0, len(a)], pa.int64()), a) for c, a in parts.items()}
    return packed_columns(whole)


@lru_cache(maxsize=1)
def _read_plan(data: bytes) -> Plan:
    row = unpacked(data)
    columns = {c: row.column(c)[0].values for c in Plan._fields}
    return Plan(columns["terms"], *(columns[c].to_numpy() for c in Plan._fields[1:]))


def query_plans(items: DataFrame, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``block, plan, names``: the plan of each block of ``items`` (item_id, text), built in a task."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, owner = terms_of(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(owner)), terms.cast(pa.string())], names=["item_id", "term"])

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        coded = rows.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        queries: list[list[str]] = [[] for _ in range(len(coded.dictionary))]
        for at, term in zip(coded.indices.to_pylist(), rows.column("term").to_pylist(), strict=True):
            queries[at].append(term)
        plan = mine(queries)
        whole = pa.array([0, len(queries)], pa.int32())
        return pa.table(
            {
                "block": rows.column("block").slice(0, 1),
                "plan": pa.array([_plan_bytes(plan, coded.dictionary)], pa.binary()),
                "names": pa.ListArray.from_arrays(whole, coded.dictionary),
            }
        )

    kind = items.schema["item_id"].dataType.simpleString()
    words = items.select("item_id", "text").mapInArrow(tidy(split), f"item_id {kind}, term string").distinct()
    words = cut_lineage(words, "query-terms")
    total = words.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / query_bytes))
    dealt = words.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(build, f"block long, plan binary, names array<{kind}>")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above zero for each item.

    ``docs`` (doc_id, text) and ``items`` (item_id, text); other columns are ignored. A null or empty text has
    no terms: such a document counts nowhere and such an item has no rows. Rows that repeat an item's id are
    one item with the terms of all; a null id is an item too. Rows that repeat a doc_id are documents of their
    own; a null doc_id can be returned and comes last among equal scores. Empty tables give no rows. Texts may
    be of any length.

    Items are taken in blocks of some megabytes, each against all documents; statistics always come from all
    documents, so blocks change no score. What is broadcast is one block's plan and its terms' weights.
    """
    spark = docs.sparkSession
    plans = cut_lineage(query_plans(items, query_bytes), "plans")
    kind = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for block in sorted(r["block"] for r in plans.select("block").collect()):
        own = plans.where(F.col("block") == block)
        shared = spark.sparkContext.broadcast(bytes(own.select("plan").first()["plan"]))

        def plan_of(shared=shared) -> Plan:
            return _read_plan(shared.value)

        posted = cut_lineage(texts.mapInArrow(tidy(_post(plan_of)), POSTINGS), "query-postings")
        lengths = F.col("n_terms")
        # N counts documents with a term, L their terms
        totals = posted.agg(
            F.sum(F.size(F.filter(lengths, lambda n: n > 0))).alias("n"),
            F.sum(F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n)).alias("all"),
        ).first()
        if not totals["all"]:
            continue
        pairs = posted.select(F.explode(F.arrays_zip("df_term", "df_count")).alias("p"))
        counted = pairs.groupBy("p.df_term").agg(F.sum("p.df_count").alias("df")).toArrow()
        df = np.zeros(len(_read_plan(shared.value).terms), np.int64)
        df[counted.column("df_term").to_numpy()] = counted.column("df").to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * totals["n"] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        weights = spark.sparkContext.broadcast(weight)
        scored = posted.select("doc_ids", "n_terms", "packed").mapInArrow(
            tidy(_score(plan_of, weights, totals["n"], totals["all"], k)), "query int, doc_id long, score long"
        )
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
        ranked = ranked.where(F.col("rank") <= k)
        names = own.select(F.posexplode("names").alias("query", "item_id"))
        found = found.unionByName(ranked.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return found
