"""Top-k search, revisits, decontamination and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortlake.llm import decontaminate, revisits, topk
from cohortlake.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect
from tests.llm import brute


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    outcome, _ = compare(spark, connect("/root/testdata/sf0.001"), "/root/testdata/sf0.001", QUERIES[name], ORACLES[name])
    assert outcome.startswith("ok"), outcome


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 8])]) for i in range(300)]
    rows += [(300 + i, rows[4][1]) for i in range(60)]  # copies: ties
    return rows + [(900, None), (901, [1.0] * 5 + [None]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (905, [0.0] * 6), (None, [1.0] * 6), (906, [1.0, 2.0])]


def best(rows, k):
    whole = [(i, np.floor(64 * np.array(v)).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in whole:
        if q % 20 == 0:
            found = sorted((-int(a @ b), i) for i, b in whole if i != q and len(a) == len(b))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("bucket", [7, 4096])
def test_top_k_equals_brute_force(spark, bucket):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, v array<double>, score string")
    whole = topk.whole_vectors(df, "vec_id", "v")
    got = topk.top_k(whole.where("id % 20 = 0"), whole, k=20, bucket_rows=bucket, block_rows=5)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()} == best(rows, 20)


def test_top_k_of_nothing_and_large_numbers(spark):
    none = topk.whole_vectors(spark.createDataFrame([], "id long, v array<float>"), "id", "v")
    assert topk.top_k(none, none).count() == 0
    rows = [(i, [float(2**30 + i), float(i)]) for i in range(0, 60)]
    df = topk.whole_vectors(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", factor=1)
    got = topk.top_k(df.where("id = 20"), df, k=3).collect()
    want = sorted(((2**30 + 20) * (2**30 + i) + 20 * i, i) for i in range(60) if i != 20)[::-1][:3]
    assert [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == want


def test_pruning_keeps_every_result():
    rng = np.random.default_rng(3)
    q, p = rng.integers(-90, 90, (40, 8)), rng.integers(-60, 60, (500, 8))
    p[:50] *= 9
    ids = np.arange(500)
    for floor in (0.3, 0.7, 0.95):
        bound = floor * np.sort(q @ p.T, axis=1)[:, -1]
        who, found, score = topk.search_bucket(np.arange(1000, 1040), q, ids, p, 500, bound)
        want = {(i, j) for i in range(40) for j in range(500) if (q[i] @ p[j]) >= bound[i]}
        assert set(zip(who.tolist(), found.tolist(), strict=True)) == want
        assert (score == (q[who] * p[found]).sum(1)).all()


def test_canonical_urls(spark):
    urls = ["HTTP://WWW.Site.org:80/a/b/?utm_source=x&b=2&a=1#top", "https://m.site.org/a/b?a=1&b=2", "site.org/A", "", None, "http://site.org", "http://site.org/?ref=q"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(revisits.canonical_url(df.u)).collect()]
    assert got == ["site.org/a/b?a=1&b=2", "site.org/a/b?a=1&b=2", "site.org/A", "", None, "site.org", "site.org"]


def test_revisits_equal_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(500):
        url = rng.choice(["http://hot.org/", "http://hot.org/", f"http://s{rng.randint(0, 9)}.org/p", None])
        kind = rng.choice(["response", "revisit"])
        headers = rng.choice([None, {}, {"ETag": rng.choice(['"a"', 'W/"a"', '"b"'])}, {"last-modified": rng.choice("xy"), "X-Own": str(i)}])
        rows.append((i, url, rng.choice([None, *range(40)]), kind, rng.choice([200, 200, 304, 404]), headers, "clash"))
    df = spark.createDataFrame(rows, "record_id long, url string, captured int, kind string, status int, headers map<string,string>, part string")
    got = {r.record_id: r for r in revisits.resolve_revisits(df).collect()}
    low = lambda h: {k.lower(): v for k, v in (h or {}).items()}
    asked = [r for r in rows if r[3] == "revisit" or r[4] == 304]
    assert set(got) == {r[0] for r in asked}
    for i, url, at, _, _, headers, _ in asked:
        full = [r for r in rows if r[3] == "response" and r[4] == 200 and r[1] == url and None not in (url, at, r[2]) and (r[2], r[0]) < (at, i)]
        h = low(headers)
        if not full:
            assert (got[i].outcome, got[i].refers_to, got[i].headers) == ("no_response", None, h)
            continue
        old = max(full, key=lambda r: (r[2], r[0]))
        o = low(old[5])
        if "etag" in h and "etag" in o:
            fits = h["etag"].removeprefix("W/") == o["etag"].removeprefix("W/")
        elif "last-modified" in h and "last-modified" in o:
            fits = h["last-modified"] == o["last-modified"]
        else:
            fits = "etag" not in h and "last-modified" not in h
        assert got[i].outcome == ("resolved" if fits else "mismatch")
        assert got[i].refers_to == (old[0] if fits else None)
        assert got[i].headers == (o | {k: v for k, v in h.items() if k in revisits.PERMITTED} if fits else h)
    assert revisits.resolve_revisits(df.limit(0)).count() == 0


def items_and_docs():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    vocabulary = [word() for _ in range(200)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, f"{say(rng.randint(3, 40)).capitalize()}. {say(rng.randint(1, 12)).capitalize()}.") for i in range(30)]
    items += [(30, None), (31, ""), (32, "word"), (5, items[5][1])]
    docs = []
    for k in range(120):
        text = say(rng.randint(0, 400))
        if k % 4 == 0:
            text += " " + items[k % 30][1] + " " + say(rng.randint(0, 90))
        if k % 20 == 1:
            text += " " + items[k % 30][1].rsplit(". ", 1)[0]  # only the question
        docs.append((k, text))
    return items, [*docs, (900, None), (901, ""), (902, (say(30_000) + " " + items[3][1])), (0, docs[0][1])]


@pytest.mark.parametrize("index_bytes", [1 << 25, 3000])
def test_decontamination_equals_brute_force(spark, monkeypatch, index_bytes):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    items, docs = items_and_docs()
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    found = decontaminate.contaminated_pairs(d, b).where("contaminated").collect()
    want = []
    for i, text in docs:
        words = decontaminate.words_of(text)
        have = decontaminate.shingles(words)
        for k, item in items:
            if not item or len(decontaminate.words_of(item)) < 2:
                continue
            shares = []
            for part in decontaminate.parts_of(item):
                if len(part) < 5:
                    shares.append(any(words[j : j + len(part)] == part for j in range(len(words))))
                else:
                    own = decontaminate.shingles(part)
                    shares.append(len(own & have) / len(own) >= 0.8)
            if all(shares):
                want.append((i, k))
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted(want)
    assert len(want) >= 30
    left = decontaminate.drop_contaminated(d, b)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert decontaminate.contaminated_pairs(d, b.limit(0)).count() == 0
    assert decontaminate.contaminated_pairs(d.limit(0), b).count() == 0


@pytest.mark.parametrize("index_bytes", [1 << 25, 1500])
def test_retrieved_pairs_and_scores_equal_plain_bm25(spark, monkeypatch, index_bytes):
    """Every (document, item) pair over the threshold with its score, whatever the number of parts."""
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    monkeypatch.setattr(decontaminate, "BOUNDS", 8)
    items, docs = items_and_docs()
    docs = docs[:60] + docs[-4:]
    plain = lambda t: [w for w in (x.strip(decontaminate._EDGES) for x in (t or "").lower().split()) if w]
    bags = [(k, Counter(plain(t))) for k, t in items if plain(t)]
    n, longest = len(bags), max(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    part = lambda f: f * 2.2 / (f + 1.2)
    own = [sum(idf[w] * part(f) for w, f in b.items()) for _, b in bags]
    want = []
    for i, text in docs:
        words = plain(text)
        best = [0.0] * n
        for at in range(-longest, len(words), longest):
            seen = Counter(words[max(at, 0) : at + 2 * longest])
            for k, (_, b) in enumerate(bags):
                best[k] = max(best[k], sum(idf[w] * part(seen[w]) for w in b) / own[k])
        want += [(i, bags[k][0], round(s, 9)) for k, s in enumerate(best) if s >= decontaminate.RETRIEVE]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    if index_bytes == 1500:
        assert decontaminate.item_indexes(b)[1] > 10
    found = decontaminate.contaminated_pairs(d, b).collect()
    order = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(((r.doc_id, r.item_id, round(r.score, 9)) for r in found), key=order) == sorted(want, key=order)
    assert len(want) >= 20


def test_altered_endings_are_found(spark):
    """Whole items whose last sentence differs in punctuation or in a word; a question alone is clean."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    say = lambda n: [word() for _ in range(n)]
    items, docs, want = [], [], set()
    for k in range(1, 9):
        question, answer = say(30), say(k)
        items.append((k, f"{' '.join(question)}. {' '.join(answer)}."))
        lead, tail = " ".join(say(50)), " ".join(say(20))
        altered = [*answer[:-1], "zzz"] if k > 1 else answer
        docs += [
            (10 * k, f"{lead} {' '.join(question)} {' '.join(answer)} {tail}"),
            (10 * k + 1, f"{lead} «{' '.join(question)}»: {' '.join(altered)}, {tail}"),
            (10 * k + 2, f"{lead} {' '.join(question)} {tail}"),
        ]
        want |= {(10 * k, k), (10 * k + 1, k)}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated_pairs(d, b).where("contaminated").collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    text = decontaminate.pa.array(["«a» ... b!", "?! --", "", "c"])
    words, owner = decontaminate.bare_tokens(*decontaminate.text_tokens(text))
    assert (words.to_pylist(), owner.tolist()) == (["a", "b", "?!", "--", "c"], [0, 0, 1, 1, 3])


def test_contaminated_rows_go_and_no_others(spark):
    """A null doc_id is found and dropped; a clean row that shares a doc_id stays."""
    item = "one two three four five six seven eight. nine ten eleven twelve thirteen fourteen."
    rows = [(None, item, "a"), (None, "clean text", "b"), (1, f"x {item} y", "c"), (1, "clean too", "d"), (2, None, "e"), (None, None, "f")]
    d = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, tag string, _row string")
    left = decontaminate.drop_contaminated(d, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert left.columns == d.columns
    assert sorted((r.tag, r._row) for r in left.collect()) == [(t, "mine") for t in "bdef"]


def test_block_maxima_are_added_in_bounded_groups(monkeypatch):
    """Passages that share a common word with every block of items: few maxima are held, and the pairs are the same."""
    items = [(k, f"every one a{k % 7} b{k} c{k} d{k} e{k} f{k}") for k in range(400)]
    bags = [Counter(decontaminate.words_of(t)) for _, t in items]
    index = decontaminate.build_index(items, len(items), Counter(w for b in bags for w in b), 8)
    texts = decontaminate.pa.array([f"x {items[k][1]} y every a1 a2 a3 a4" for k in range(0, 400, 4)])
    held, plain = [], decontaminate.ragged

    def watched(starts, lengths):
        held.append(int(lengths.sum()))
        return plain(starts, lengths)

    monkeypatch.setattr(decontaminate, "ragged", watched)
    found = []
    for most in (1 << 40, 2000):
        held.clear()
        monkeypatch.setattr(decontaminate, "MAXIMA", most)
        found.append([x.tolist() for x in decontaminate.search(index, *decontaminate.bare_tokens(*decontaminate.text_tokens(texts)), len(texts))])
        assert (max(held) <= 2000) == (most == 2000)
    assert found[0] == found[1] and len(found[0][0]) >= 100


def test_contaminated_keys_are_written_before_the_join(spark):
    """No task searches while texts are shuffled for the join."""
    d = spark.createDataFrame([(1, "one two three four five six seven")], "doc_id long, text string")
    left = decontaminate.drop_contaminated(d, spark.createDataFrame([(7, "one two three four five")], "item_id long, text string"))
    assert "MapInArrow" not in left._jdf.queryExecution().optimizedPlan().toString()
    assert left.count() == 0


def test_pipeline_equals_its_stages_one_by_one(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], sf))
    assert all(f.columns == docs.columns for f in frames[:-1])
    # language: only texts without a letter go
    lettered = {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in frames[1].collect()} == lettered
    # near duplicates: the smallest id of each group stays
    prints = [(i, brute.fingerprint(rows[i].text)) for i in sorted(lettered)]
    kept = {i for (i, _), c in zip(prints, brute.components(prints), strict=True) if i == c}
    assert {r.doc_id for r in frames[2].collect()} == kept
    # repeated strings: lengths as in the plain version
    plain = {r[0]: r for r in brute.repeats([(i, rows[i].text) for i in kept])}
    cut = {r.doc_id: r for r in frames[3].collect()}
    assert set(cut) == {i for i, r in plain.items() if r[2] < r[1] or not r[2]}
    assert all(len(cut[i].text.encode()) <= plain[i][1] - plain[i][2] for i in cut)
    assert all(cut[i].text == rows[i].text for i in cut if not plain[i][2])
    clean = {r.doc_id: r.text for r in frames[4].collect()}
    final = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in final} == set(clean) and all(r.round_trip for r in final)


def test_pipeline_of_nothing(spark):
    none = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0
