"""SimHash groups, components and repeated strings against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cohortlake.llm import simhash, suffix_dedup
from cohortlake.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string, fingerprint string, n_bytes string, block int"


def corpus(seed=5):
    """Copies, near copies, nulls, empty, short and long texts; ids in no order."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120))) for _ in range(25)]
    texts = [None, "", "  \n", "one", "one two", "One  TWO", "x" * 49, "x" * 50, "x" * 51, "y" * 120, None]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(6000))]
    for t in base:
        texts += [t, t, t + " tail", "head " + t]
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    rng.shuffle(texts)
    return [(7 * i % 1009, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", -1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "GROUP", crowd)  # two: every group is split again and again
    rows = corpus()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    ordered = sorted(rows)
    prints = [(i, brute.fingerprint(t)) for i, t in ordered]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, brute.components(prints), strict=True)}
    assert got == want


def test_near_duplicates_of_nothing_and_repeated_ids(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    rows = simhash.near_duplicates(frame(spark, [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (9, None)]))
    found = sorted((r.doc_id or -1, r.component_id) for r in rows.collect())
    assert found == [(-1, 3), (3, 3), (3, 3), (9, 9)]


def test_forest_spans_the_links():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 2**62, 200).astype(np.uint64)
    near = codes[:80] ^ (np.uint64(1) << rng.integers(0, 64, 80).astype(np.uint64))
    codes = np.unique(np.r_[codes, near, near ^ np.uint64(3)])
    a, b = simhash.forest(codes)
    named = {int(c): int(c) for c in codes}

    def root(x):
        while named[x] != x:
            x = named[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert root(x) != root(y) or root(x) == root(y)
        named[max(root(x), root(y))] = min(root(x), root(y))
    for x in codes.tolist():
        for y in codes.tolist():
            if (x ^ y).bit_count() <= 2:
                assert root(x) == root(y)
    assert len(a) < len(codes)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (2, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {k: 1000 for k in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("hot", "block"), [(4096, 16 << 20), (1, 16 << 20), (4096, 400)])
def test_repeats_equal_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(suffix_dedup, "HOT_LEAD", hot)  # one: windows of all repeated leads are dealt out
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    rows = corpus(11)
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute.repeats(rows)
    assert {r.fingerprint for r in got} == {"clash"}


def test_repeats_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    monkeypatch.setattr(suffix_dedup, "HELD_WINDOWS", 40)
    rows = corpus(3)
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute.repeats(rows)


def test_repeats_of_nothing_repeated_ids_and_null_ids(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    text = "é" * 40 + " a passage that stands in several of these documents"
    rows = [(4, text), (4, text), (None, text), (8, "x" + text + "y")]
    got = sorted((r.doc_id or -1, r.n_removed, r.text) for r in suffix_dedup.remove_repeats(frame(spark, rows), True).collect())
    size = len(text.encode())
    assert got == [(-1, size, ""), (4, 0, text), (4, 0, text), (8, size, "xy")]
