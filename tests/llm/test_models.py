"""Language identification, toxicity and the language model."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa

from cohortlake.llm import langid, lm_mixing, toxicity
from cohortlake.llm.queries import op6_lm_mixing, op7_langid, op8_toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_slots_are_all_ngrams():
    assert langid.slots(b"") == [] and langid.slots(b"a") == []
    assert [len(s) for s in langid.slots(b"abcde")] == [4, 3, 2]
    whole = langid.slots(b"abcabc")
    assert whole[1][0] == whole[1][3]


def test_language_is_held_out(spark):
    got = {r.doc_id: r for r in op7_langid(spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(truth)
    held = [i for i, r in got.items() if r.held_out]
    assert held and all((zlib.crc32(str(i).encode()) % 4 == 2) == r.held_out for i, r in got.items())
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.9 * len(held)


def test_language_edge_cases(spark):
    rows = [(1, "le chat et la souris dorment", "fr"), (2, "the cat and the mouse sleep", "en"), (3, None, "en"), (4, "the dog", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    ask = [(5, None, "x"), (6, "", "x"), (7, "12 ?!", "x"), (8, "the mouse", "x"), (8, "le chat", "x"), (None, "et la souris " * 9000, "x")]
    out = langid.identify(spark.createDataFrame(ask, "doc_id long, text string, score string"), model).collect()
    assert [r.lang_pred for r in out] == ["und", "und", "und", "en", "fr", "fr"]
    assert all(0 <= r.score <= 1 for r in out)
    assert langid.train(df.limit(0)) is None
    assert [r.lang_pred for r in langid.identify(df, None).collect()] == ["und"] * 4


def test_automaton_equals_edit_distance():
    terms = ["idiot", "trash", "worthless", "scum", "abc", "tûr"]
    lexicon = toxicity.compile_lexicon(terms, [1.0] * len(terms))
    rng = random.Random(4)
    words = [*terms, "", "a"]
    for _ in range(1500):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "t", "é", "x"])
        words.append("".join(w))
    term, exact = lexicon.match(words)
    for w, t, e in zip(words, term, exact, strict=True):
        near = sorted((brute.edits(w, x), k) for k, x in enumerate(terms) if brute.edits(w, x) <= (len(x) >= toxicity.EXACT_BELOW))
        assert (t >= 0) == bool(near), w
        assert not near or e == (near[0][0] == 0)


def test_context_separates_quotation():
    lexicon = toxicity.compile_lexicon(["idiot"], [3.0])
    x = toxicity.features(pa.array(["you are an idiot", 'he wrote "an idiot" there', "an idoit", "an idiit", "", "nothing"]), lexicon)
    assert x[0, 1] > 0 and x[0, 3] == 0 and x[0, 4] > 0
    assert x[1, 1] == 0 and x[1, 3] > 0
    assert x[2, 2] == 0 and x[3, 2] > 0  # a swap is two edits, a wrong letter is one
    assert not x[4, 1:].any() and not x[5, 1:8].any()


def test_joined_terms_are_found():
    lexicon = toxicity.compile_lexicon(["idiot", "moron"], [3.0, 2.0])
    tokens = ["idiot,you", "idiot/moron", "you-idiot", "i-d-i-o-t", "idiot\u00a0there", "«idiot»", "idiot's", "...", "fine,thanks", "you"]
    owner, term, exact, address = toxicity._token_hits(pa.array(tokens), lexicon)
    assert list(zip(owner.tolist(), term.tolist(), exact.tolist(), strict=True)) == [
        (0, 0, True), (1, 0, True), (1, 1, True), (2, 0, True), (3, 0, True), (4, 0, True), (5, 0, True), (6, 0, True),
    ]
    assert address.tolist() == [True, False, True, False, False, False, False, False, False, True]
    x = toxicity.features(pa.array(["an idiot/moron idiot here", "idiot moron idiot", "clean,words only", ""]), lexicon)
    assert x[0, 1] == x[1, 1] and x[0, 7] == x[1, 7] > 0 and not x[2:, 1:8].any()


def test_every_telling_word_is_a_term(spark):
    """No cap: 300 terms, each in 40 of 400 toxic texts and in no other."""
    name = lambda k: "z" + "".join(chr(97 + k // 26**j % 26) for j in range(3))
    rows = [(" ".join(name(k) for k in range(i % 10, 300, 10)), 1) for i in range(400)]
    rows += [("plain words that say nothing", 0)] * 400
    terms, odds = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert sorted(terms) == sorted(name(k) for k in range(300)) and min(odds) >= 2


def test_toxicity_is_held_out(spark):
    got = op8_toxicity(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in got if r.held_out and r.doc_id in labels]
    toxic = [r.score for r in held if labels[r.doc_id] == 1]
    clean = [r.score for r in held if labels[r.doc_id] == 0]
    better = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert better > 0.75
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "a text", "x"), (None, "b", "x")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon, w = toxicity.train(docs, none)
    out = toxicity.score(docs, lexicon, w).collect()
    assert [r.score for r in out] == [0.5] * 4
    assert toxicity.score(docs.limit(0), lexicon, w).count() == 0


def test_language_model_counts_and_gain(spark):
    got = {r.doc_id: r for r in op6_lm_mixing(spark, SF).collect()}
    docs = {r.doc_id: [*brute.words(r.text), "\n"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    count: dict[str, int] = {}
    for i, w in docs.items():
        if not held[i]:
            for x in w:
                count[x] = count.get(x, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, w in docs.items():
        r = got[i]
        base = sum(math.log10((count.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(x in count for x in w), n, held[i])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0


def test_language_model_is_a_distribution():
    """Over all continuations of a prefix the model's probabilities sum to one."""
    words = [b"ab", b"ac", b"ad", b"b", b"c", lm_mixing.END]
    n = np.array([5.0, 3, 0, 2, 0, 4])
    rows = lm_mixing.Range.of(words, np.zeros(6, np.int64), n)
    cells, counts = lm_mixing.cell_counts(rows)
    paths = np.stack([rows.path(k) for k in rows.key[[0, -1]]])[None]
    totals = lm_mixing.edge_totals(rows.key[[0]], rows.key[[-1]], paths)
    shared = lm_mixing.Shared(lm_mixing.Hashed(cells, counts), {0: totals[0]})
    shared.mixer = lm_mixing.averaged([{"n": 1.0, "weights": (m := lm_mixing.train_range(rows, shared, 0)).weights.tobytes(), "hits": m.hits.tobytes(), "seen": m.seen.tobytes()}])
    # every one-byte word (with its stop byte left out) under one gate
    every = [bytes([b]) for b in range(256)]
    wide = lm_mixing.Range.of([*words, *(w for w in every if w not in words)], np.zeros(6 + 256 - 3, np.int64), np.r_[n, np.zeros(253)])
    steps = lm_mixing.Steps(wide, np.stack([wide.path(k) for k in wide.key[[0, -1]]]))
    first = np.zeros(len(wide.gate))
    for (s, depth, at), x, chosen, _ in lm_mixing.decisions(wide, lm_mixing.Shared(shared.hashed, {0: steps.totals}), 0, 0.0):
        if depth < 8:
            first[s.order] += s.spread(depth, at, np.log(shared.mixer.probability(x, chosen)))
    by_byte = {c[0]: p for c, p in zip(wide.coded, first, strict=True)}
    assert len(by_byte) == 256 and math.isclose(sum(map(math.exp, by_byte.values())), 1, rel_tol=1e-6)


def test_training_takes_own_counts_off_every_predictor():
    """A word seen once predicts itself no better than an unseen one while it is learned from."""
    rows = lm_mixing.Range.of([b"q", b"zz"], np.zeros(2, np.int64), np.array([1.0, 0.0]))
    hashed = lm_mixing.Hashed(*lm_mixing.cell_counts(rows))
    totals = lm_mixing.edge_totals(rows.key[[0]], rows.key[[-1]], np.stack([rows.path(k) for k in rows.key[[0, -1]]])[None])
    shared = lm_mixing.Shared(hashed, {0: totals[0]})
    seen = [x for _, x, _, n in lm_mixing.decisions(rows, shared, 0, 1.0) if len(n)]
    assert seen and all(np.allclose(x, 0, atol=1e-6) for x in seen)
    scored = [x for _, x, _, _ in lm_mixing.decisions(rows, lm_mixing.Shared(hashed.for_scoring(), {0: totals[0]}), 0, 0.0)]
    plain = [x for _, x, _, _ in lm_mixing.decisions(rows, shared, 0, 0.0)]
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(scored, plain, strict=True))


def test_language_model_edge_cases(spark):
    schema = "doc_id long, text string, training boolean, n string"
    rows = [(1, None, True, ""), (2, "", False, ""), (3, "Ab ab", True, ""), (3, "Ab ab", True, ""), (None, "q" * 40_000, None, "")]
    got = lm_mixing.log_probabilities(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(0, 2, 1, 7), (1, 1, 1, 7), (2, 1, 1, 7), (3, 3, 3, 7), (3, 3, 3, 7)]
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    alone = lm_mixing.log_probabilities(spark.createDataFrame([(1, "a b", False, "")], schema)).collect()
    assert (alone[0].n_tokens, alone[0].n_known, alone[0].train_tokens) == (3, 0, 0) and math.isfinite(alone[0].score)
    assert lm_mixing.log_probabilities(spark.createDataFrame([], schema)).count() == 0


def test_counts_over_ranges_agree():
    """Edge counts make a range know what its neighbours hold of its edge words' prefixes."""
    rng = random.Random(1)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(120)})
    n = np.array([rng.randint(0, 4) for _ in words], float)
    gate = np.array([rng.randint(0, 2) for _ in words])
    whole = lm_mixing.Range.of(words, gate, n)
    order = [c[:-1] for c in whole.coded]
    parts = [lm_mixing.Range.of(order[a : a + 30], whole.gate[a : a + 30], whole.n[a : a + 30]) for a in range(0, len(order), 30)]
    paths = np.stack([np.stack([p.path(k) for k in p.key[[0, -1]]]) for p in parts])
    totals = lm_mixing.edge_totals(np.stack([p.key[0] for p in parts]), np.stack([p.key[-1] for p in parts]), paths)
    for p, t in zip(parts, totals, strict=True):
        for side, k in enumerate(p.key[[0, -1]]):
            assert np.array_equal(t[side], whole.path(k))


def test_trie_counts_equal_plain_counts_and_are_made_once(monkeypatch):
    """Counts along every word's bits equal plain ones; a second pass that holds all decisions makes none anew."""
    rng = np.random.default_rng(3)
    pairs = sorted({(bytes(rng.choice(list(b"abc"), rng.integers(1, 20)).astype(np.uint8)), int(rng.integers(0, 3))) for _ in range(300)})
    n = rng.integers(0, 4, len(pairs)).astype(float)
    rows = lm_mixing.Range.of([w for w, _ in pairs], np.array([g for _, g in pairs]), n)
    assert [(w + b" ", g) for w, g in pairs] == sorted((rows.coded[i], int(rows.gate[i])) for i in np.argsort(rows.place))
    paths = np.stack([rows.path(k) for k in rows.key[[0, -1]]])
    bits = ["".join(f"{b:08b}" for b in c[: lm_mixing.DEPTH]) for c in rows.coded]
    steps = lm_mixing.Steps(rows, paths)
    seen = 0
    for depth, at, before, after, all_before, all_after in steps:
        for i, *got in zip(steps.order[at], before, after, all_before, all_after, strict=True):
            same = [[b[:d] == bits[i][:d] for b in bits] for d in (depth, depth + 1)]
            own = [sum(x for x, s, g in zip(rows.n, half, rows.gate, strict=True) if s and g == rows.gate[i]) for half in same]
            every = [sum(x for x, s in zip(rows.n, half, strict=True) if s) for half in same]
            assert got == [*own, *every]
        seen += len(at)
    assert seen == len({(g, b[: d + 1]) for g, b in zip(rows.gate.tolist(), bits, strict=True) for d in range(len(b))})
    made, plain = [], lm_mixing.Steps.__iter__
    monkeypatch.setattr(lm_mixing.Steps, "__iter__", lambda self: made.append(1) or plain(self))
    shared = lm_mixing.Shared(lm_mixing.Hashed(*lm_mixing.cell_counts(rows)), {0: paths})
    lm_mixing.train_range(rows, shared, 0)
    assert len(made) == 1


def test_unit_counts_keep_the_order_of_first_appearance(monkeypatch):
    pa = lm_mixing.pa
    blocks = [[(b"Bx", 1), (b"Aab", 2)], [(b"Aab", 3), (b"C\n", 0)], [(b"Ay", 5), (b"Bx", 7)]]
    packed = [lm_mixing.packed_columns({"unit": pa.array([u for u, _ in b], pa.binary()), "n": pa.array([n for _, n in b], pa.int64())}) for b in blocks]
    for most in (1 << 20, 2):
        monkeypatch.setattr(lm_mixing, "UNIT_ROWS", most)
        got = [r for b in lm_mixing._unit_counts(iter([pa.RecordBatch.from_pydict({"packed": pa.array(packed, pa.binary())})])) for r in b.to_pylist()]
        assert [(r["gate"], r["word"], r["coded"], r["n"]) for r in got] == [(1, b"x", b"x ", 8), (0, b"ab", b"ab ", 5), (2, b"\n", b"\n ", 0), (0, b"y", b"y ", 5)]
