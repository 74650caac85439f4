"""Training corpus from ``documents``: five stages, each written as Parquet and read again.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``documents``; columns beside these do not pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import decontaminate, langid, sentencepiece_fst, simhash, suffix_dedup
from cohortlake.llm.common import cut_lineage, ship_package, table, third
from cohortlake.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language. Texts that are null or have no letter go; others stay, whatever
    their predicted language. Rows of a null doc_id take no part in training."""
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.where(third("doc_id", 4) != 2))
    judged = langid.identify(docs, model)
    if model is None:  # nothing to learn from: only the rule on letters holds
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return judged.where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id. Rows that share a
    doc_id are one document; rows without one stay."""
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    grouped = simhash.near_duplicates(docs)
    gone = grouped.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that stand in an earlier document; ``n_chars`` follows the
    text. A document of which nothing is left goes."""
    ship_package(spark)
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), with_text=True)
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.where("n_removed = 0 or n_removed < n_bytes").withColumn("n_chars", chars).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), items)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding gives the text back."""
    out = sentencepiece_fst.encode(docs.select(*COLUMNS), piece_model())
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "round_trip", "ids")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("benchmark_decontamination", decontaminated),
    ("sentencepiece_encoding", encoded),
]

#: Kernel regression, fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
