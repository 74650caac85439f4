"""Chunked BPE, shared ranking and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import bpe_chunks, filter_audit, queries, shared_ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def byte_model():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(byte_model):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_model)


def ids_by_chunks(model, texts):
    """The steps of the operator without Spark."""
    raw = [t.encode() for t in texts]
    edges = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    cuts = bpe_chunks.cut_points(data, edges[:-1], edges[1:])
    ends = np.r_[cuts, edges[-1]]
    parts = [bpe_chunks.encode_text(model, data[a:b].tobytes().decode()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    ids = np.concatenate(parts) if parts else np.empty(0, model.id_type)
    starts = np.unique(edges)
    ids = bpe_chunks.repaired(model, ids, np.setdiff1d(cuts, starts), starts)
    _, at = bpe_chunks.token_edges(model, ids)
    stops = np.searchsorted(at, edges)
    return [ids[a:b].tolist() for a, b in zip(stops[:-1], stops[1:], strict=True)]


def test_repaired_chunks_equal_whole_texts(byte_model, library, monkeypatch):
    """Cuts every few bytes: nearly every token stands at a join."""
    monkeypatch.setattr(bpe_chunks, "LEAST", 2)
    monkeypatch.setattr(bpe_chunks, "CUT_BITS", 3)
    model = bpe_chunks.read_model(byte_model)
    bits = [
        "a", "b", "'", "s", "re", "'ll", " ", "  ", "\n", "\t", "1", "23", ".", "!", "é", "中", "文", " ", "　",
        "<|endoftext|>", "<|end", "oftext|>", "word", "The", "😀", "́", "Ⅷ", "\x1c", "\x85",
    ]
    draw = random.Random(11)
    for _ in range(60):
        texts = ["".join(draw.choices(bits, k=draw.randint(0, 150))) for _ in range(15)]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert ids_by_chunks(model, texts) == want


@pytest.mark.parametrize("text", ["a" * 60000, " " * 60000, "中" * 30000, "\n" * 20000 + "x", "ab1" * 20000])
def test_long_monotone_texts(byte_model, library, text):
    model = bpe_chunks.read_model(byte_model)
    assert ids_by_chunks(model, [text, "", text[:9]]) == [
        e.ids for e in library.encode_batch([text, "", text[:9]], add_special_tokens=False)
    ]


def test_equal_passages_are_cut_alike():
    draw = np.random.default_rng(3)
    passage = draw.integers(97, 123, 5000, dtype=np.uint8)
    chunks = []
    for lead in (40, 777):
        data = np.r_[draw.integers(97, 123, lead, dtype=np.uint8), passage]
        cuts = bpe_chunks.cut_points(data, np.array([0]), np.array([len(data)]))
        chunks.append({data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)})
    assert len(chunks[0] & chunks[1]) >= 0.8 * len(chunks[0])


def test_bpe_query_equals_library(spark, tmp_path, byte_model, library):
    draw = random.Random(4)
    words = ["alpha", "Beta's", "gamma,", "42", "delta\n", "été", "<|endoftext|>", "  "]
    shared = " ".join(draw.choices(words, k=400))
    texts = [None, "", "   ", shared, "x " + shared, shared + "\n\n", "中文" * 900, "z" * 5000]
    texts += [" ".join(draw.choices(words, k=draw.randint(1, 300))) for _ in range(40)] + [shared] * 3
    rows = [(i if i != 9 else None, t, "no such ids", -1) for i, t in enumerate(texts)] + [(3, shared, "", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string, block long").write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[
            doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        ] += 1
    got = queries.op11_bpe_chunks(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_chunks.encode(empty, byte_model).collect() == []


def plain_ranking(docs, items, k=10):
    texts = [(d, TERM.findall((t or "").translate(UPPER))) for d, t in docs]
    sizes = [len(t) for _, t in texts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, ts in texts for t in set(ts))
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall((text or "").translate(UPPER)))
    out = set()
    for item, terms in asked.items():
        found = []
        for doc, ts in texts:
            tf = Counter(ts)
            m = 100 - 90 + (90 * len(ts) * n) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in terms if tf[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.add((item, rank, doc, -score))
    return out


def ranking_tables(spark):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Élan", "ÉLAN", "x1y", "日本"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 60))) + "-tail.END") for i in range(120)]
    docs += [(200, None), (201, ""), (202, "?! ..."), (None, "w1 w2 w3 w4"), (5, "w1 w2"), (300, "w1 w2"), (301, "w1 w2")]
    common = " ".join(words[:12])
    items = [(i, f"{common}; " + " ".join(draw.choices(words, k=8))) for i in range(15)]
    items += [(20, None), (21, ""), (22, "unseen"), (3, "W7 also"), (None, "w1 w2"), (23, "w1 w2")]
    return (
        docs, items,
        spark.createDataFrame([(*d, "q") for d in docs], "doc_id long, text string, query string"),
        spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, block int"),
    )


@pytest.mark.parametrize("query_bytes", [shared_ranking.QUERY_BYTES, 300])
def test_ranking_equals_plain_version(spark, query_bytes):
    """In one block of queries and in many."""
    docs, items, doc_rows, item_rows = ranking_tables(spark)
    got = shared_ranking.rank_documents(doc_rows, item_rows, query_bytes=query_bytes).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == plain_ranking(docs, items)


def test_ranking_of_empty_tables(spark):
    docs, items, doc_rows, item_rows = ranking_tables(spark)
    assert shared_ranking.rank_documents(doc_rows.limit(0), item_rows).collect() == []
    assert shared_ranking.rank_documents(doc_rows, item_rows.limit(0)).collect() == []
    assert shared_ranking.rank_documents(doc_rows.where("doc_id between 200 and 202"), item_rows).collect() == []


def test_plan_shares_sums():
    """Every query's nodes expand to exactly its terms, and shared sums save additions."""
    draw = random.Random(2)
    base = [f"t{i}" for i in range(30)]
    asked = [sorted(set(base[:10]) | set(draw.sample(base, 6)) | {f"own{q}"}) for q in range(20)] + [[], ["t0"]]
    plan = shared_ranking.mine(asked)
    names = plan.terms.to_pylist()

    def expand(node):
        if node < plan.n_leaves:
            return [names[i] for i in np.flatnonzero(plan.leaf == node)]
        return expand(plan.left[node - plan.n_leaves]) + expand(plan.right[node - plan.n_leaves])

    ends = np.cumsum(plan.sizes)
    for terms, start, end in zip(asked, ends - plan.sizes, ends, strict=True):
        assert sorted(t for n in plan.nodes[start:end] for t in expand(n)) == terms
    assert len(plan.left) + plan.sizes.sum() < sum(map(len, asked)) * 0.7


def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    rows = []
    for d, text, source in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = ""
        fails += "A" if len(words) < 50 else ""
        fails += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if d is not None and first[text] < d else ""
        rows.append((source or "", fails, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                shapley[letter] += len(removed)
                out[part, order, step] = [
                    len(left), len(removed), sum(letter in r[1] for r in gone), sum(r[:2] == (part, letter) for r in rows),
                    sum(r[2] for r in removed), sum(r[3] for r in removed), letter,
                ]
                gone += removed
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = shapley[out[key][-1]]
    return {(*k, *v) for k, v in out.items()}


def audit_tables():
    draw = random.Random(6)
    words = [f"w{i}" for i in range(200)] + ["A%", "BIG", "#tag"]
    docs = [(i, " ".join(draw.choices(words[: draw.choice([5, 60, 203])], k=draw.randint(1, 120))), f"s{i % 3}") for i in range(90)]
    docs += [(100 + i, docs[i][1], docs[(i * 7) % 90][2]) for i in range(40)]
    docs += [(200, None, None), (201, "", ""), (202, "\t\n ", None), (203, "😀A😀", "s1"), (None, docs[0][1], "s1"), (0, docs[0][1], "s1")]
    docs += [(None, None, "null only"), (-5, docs[1][1], "s2")]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 150, 2)] + [(4, None, None), (4, 1, 1), (None, 1, 1), (999, 1, 1)]
    return docs, [(d, q, None if t is None else int(t)) for d, q, t in labels]


def test_audit_equals_replayed_orders(spark, tmp_path):
    docs, labels = audit_tables()
    spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id long, text string, source string, n int, mask string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    got = queries.op13_filter_audit(spark, str(tmp_path)).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
    assert got.count() == 600 * 5
    assert set(map(tuple, got.collect())) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.text_audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a b", "s")], docs.schema)
    assert filter_audit.text_audit(one, labels).agg(F.sum("removed")).first()[0] == 120


def test_intervals_cover_each_failing_order_once():
    names = "ABCD"
    orders = list(permutations(names))
    for mask in range(1, 16):
        at = [[0] * 25 for _ in range(6)]
        for m, step, rank, sign in filter_audit.removal_ends(names):
            if m == mask:
                at[step][rank] += sign
        for rank, order in enumerate(orders):
            hit = next(s for s, n in enumerate(order, 1) if mask >> names.index(n) & 1)
            assert [sum(row[: rank + 1]) for row in at[1:5]] == [int(s == hit) for s in range(1, 5)]


def test_audit_refuses_too_many_filters(spark):
    cells = spark.createDataFrame([], "part string, mask int, n long")
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "ABCDEFGH")
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "AAB")


def test_samples_of_repeated_ids_stay_bounded(spark):
    """A hundred rows of one id: no more texts than the parameter allows, whatever repeats."""
    from cohortlake.llm import langid, toxicity

    rows = [(1, f"der die das nummer {i}", "de") for i in range(100)] + [(2, "the and of it", "en")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}

    def spy(texts, languages, *rest):
        seen["texts"] = list(zip(languages, texts, strict=True))

    original, langid.fit = langid.fit, spy
    try:
        langid.train(docs, per_language=7)
    finally:
        langid.fit = original
    assert Counter(lang for lang, _ in seen["texts"]) == {"de": 7, "en": 1}
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    sample, sizes = toxicity.labelled_sample(docs, labels, 5)
    assert Counter(r["label"] for r in sample.collect()) == {1: 5, 0: 1} and sizes == {1: 1, 0: 1}


def test_identify_keeps_columns_of_any_name(spark):
    from cohortlake.llm import langid

    rows = [(i, text, lang, "mine", True) for i, (text, lang) in enumerate([("der die das und", "de"), ("the and of it", "en")] * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, letter string, letter_ boolean")
    got = langid.identify(docs, langid.train(docs, landmarks=2)).collect()
    assert all(r["lang_pred"] == r["lang"] and r["letter"] == "mine" and r["letter_"] for r in got) and len(got) == 12
