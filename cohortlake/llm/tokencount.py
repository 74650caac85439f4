"""Token counts without token ids: pieces are counted once for each distinct pre-token.

No piece of the model holds a space mark after another character, or a line end beside one. Merges
therefore never cross the start of a run of spaces or a line end, and the text falls apart into
pre-tokens that the library encodes alone exactly as within the text. ``check_model`` makes sure of it.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.postings import block_postings, sums_by_document

SPACE_MARK = "▁"
_PRE_TOKEN = re.compile(r"\n[^ \n]*| +[^ \n]*")
_UNUSUAL = f"  | \n|^ | $|{SPACE_MARK}"


@lru_cache(maxsize=2)
def load_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(path: str) -> None:
    """Raise where the model's pieces could cross a pre-token's edge."""
    sp = load_model(path)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if SPACE_MARK in piece.lstrip(SPACE_MARK) or ("\n" in piece and len(piece) > 1):
            raise ValueError(f"piece {piece!r} crosses pre-tokens")
    if sp.encode(" a") == sp.encode("a") or sp.encode("a", out_type=str)[0][0] != SPACE_MARK:
        raise ValueError("the model drops spaces or puts no space mark before a text")


def split_text(text: str) -> list[str]:
    """Pre-tokens of a text; each stands for itself behind one space mark, or, if it starts with a
    line end, behind nothing."""
    if not text:
        return []
    parts = _PRE_TOKEN.findall(" " + text.replace(SPACE_MARK, " "))
    return [p if p[0] == "\n" else p[1:] for p in parts]


def pre_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pre-tokens of a column of texts, and the text of each."""
    odd = pc.match_substring_regex(texts, _UNUSUAL).to_numpy(zero_copy_only=False)
    usual = np.flatnonzero(~odd & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
    some = texts.take(pa.array(usual)).cast(pa.large_string())
    parts = pc.split_pattern(pc.replace_substring(some, "\n", " \n"), " ")
    owner = usual[pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)]
    words = pc.list_flatten(parts)
    # A text that starts with a line end has an empty first part: the space mark alone.
    rest, whose = [], []
    for i in np.flatnonzero(odd):
        found = split_text(texts[i].as_py())
        rest += found
        whose += [i] * len(found)
    if rest:
        words = pa.concat_arrays([words, pa.array(rest, pa.large_string())])
        owner = np.r_[owner, np.array(whose, owner.dtype)]
    return words, owner


def count_pieces(sp, units: list[str]) -> np.ndarray:
    """Number of pieces of each pre-token."""
    counts = np.fromiter(map(len, sp.encode(units, num_threads=1)), np.int64, len(units))
    for i, u in enumerate(units):
        if u == "":
            counts[i] = 1  # the space mark alone
        elif u[0] == "\n":
            counts[i] -= 1  # no space mark stands before it in the text
    return counts


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs`` (doc_id, text).

    Counts equal those of the library on the whole text, without begin and end. A null or empty text
    has no bytes and no tokens; rows that repeat an id each give a row; other columns are ignored.
    ``model_path`` must be readable on every executor (an installed package or a mounted folder).
    """
    check_model(model_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(False).alias("training"))
    postings = block_postings(rows, pre_tokens)

    def value_of():
        sp = load_model(model_path)
        return lambda units: [count_pieces(sp, [u.decode() for u in units])]

    tokens = F.col("pieces").cast("long")
    return sums_by_document(postings, value_of, ["pieces"]).select(
        "doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit")
    )
