"""Token counts, encoding and decoding against the library."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from cohortlake.llm import sentencepiece_fst, tokencount
from cohortlake.llm.queries import piece_model

PARTS = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "the", " the", "Th", "ing", "ation", ".", ",", "▁", "é", "ß", "日本", "😀",
    "</s>", "<s>", "<unk>", "<0x0A>", "\x00", "12", "3", "   ", "x", "…",
]


@pytest.fixture(scope="module")
def library():
    return tokencount.load_model(piece_model())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20))) for _ in range(600)]
    return [*made, "", "a" * 3000, " " * 70, "word " * 5000, "\n" * 40, None]


def test_counts_equal_the_library(spark, library, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(0, texts[0], "again", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string, block int")
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokencount.token_counts(df, piece_model()).collect())
    count = [len(library.encode(t or "")) for t in texts]
    want = [(i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(enumerate(texts), count, strict=True)]
    assert got == sorted([*want, want[0]])
    assert any(w[3] for w in want)


def test_counts_in_small_blocks_with_hot_units(spark, library, monkeypatch):
    from cohortlake.llm import postings

    monkeypatch.setattr(postings, "BLOCK_BYTES", 500)
    monkeypatch.setattr(postings, "HELD_SUMS", 3)
    texts = [f"the same words and {'number ' * (i % 5)}{i}" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(df, piece_model()).collect()}
    assert got == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_counts_of_nothing(spark):
    assert tokencount.token_counts(spark.createDataFrame([], "doc_id long, text string"), piece_model()).count() == 0


def test_paths_equal_the_library(library, texts):
    machine = sentencepiece_fst.compiled(piece_model())
    known = [t or "" for t in texts]
    ids, lengths = sentencepiece_fst.encode_batch(machine, pa.array(known))
    ends = lengths.cumsum()
    for t, a, b in zip(known, ends - lengths, ends, strict=True):
        assert ids[a:b].tolist() == library.encode(t)


def test_encode_and_decode(spark, texts):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = sentencepiece_fst.encode(df, piece_model())
    assert coded.columns == ["doc_id", "text", "ids", "n_tokens", "round_trip"]
    assert coded.where("not round_trip").count() == 0
    back = {r.doc_id: r.text for r in sentencepiece_fst.decode(coded, piece_model()).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert sentencepiece_fst.encode(df.limit(0), piece_model()).count() == 0


def test_additive_weights_take_the_cheapest_path():
    machine = sentencepiece_fst.Transducer(piece_model())
    machine.additive = True  # as for a unigram model: scores add up
    for text in ("▁the", "▁there", "▁ation", "▁xyz", "▁é日"):
        cost = lambda ids: sum(-machine.score[i] for i in ids)

        def all_paths(rest):
            if not rest:
                return [[]]
            found = []
            for k in range(1, len(rest) + 1):
                i = machine.pieces.get(rest[:k])
                if i is not None:
                    found += [[i, *p] for p in all_paths(rest[k:])]
            return found

        paths = all_paths(text)
        if paths:
            assert cost(machine.path(text)) == min(map(cost, paths))
