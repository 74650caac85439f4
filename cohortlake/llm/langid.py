"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams of two to four bytes (A-Z lower-cased). The kernel of two texts
is the number of n-grams that both hold, over the root of the product of their numbers. Nyström
landmarks, some texts of each language, span the feature space; one-versus-rest kernel ridge
regression is solved in it. Texts are scored by two matrix products: presence rows times landmark
rows, then times the coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import ship_package, tidy

#: n-grams are kept as hashed slots; presence of a slot stands for presence of its n-grams.
SLOT_BITS = 18
#: Texts scored by one matrix product.
BATCH = 128
UNDETERMINED = "und"
_NO_DATA = np.empty(0, np.int64)


def slots(data: bytes) -> list[np.ndarray]:
    """Slots of all byte n-grams (n = 2, 3, 4) of a text, repeats included."""
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    n = len(data)
    if n < 2:
        return []
    code = np.zeros(n, np.uint32)
    out = []
    for k in range(4):
        code |= raw[k : k + n].astype(np.uint32) << np.uint32(8 * k)
        if k:
            part = code[: n - k] if n > k else code[:0]
            mixed = (part + np.uint32(k)) * np.uint32(2654435761)
            out.append(mixed >> np.uint32(32 - SLOT_BITS))
    return out


@dataclass
class KernelModel:
    languages: list[str]
    feature_of: np.ndarray  # slot -> feature, -1 where no landmark has the slot
    landmarks: np.ndarray  # features x landmarks, scaled by the root of each landmark's size
    coefficients: np.ndarray  # landmarks x languages
    bias: np.ndarray  # by language

    def presence(self, texts: list[bytes]) -> np.ndarray:
        """Presence rows of some texts; the last column gathers what no landmark has."""
        width = self.landmarks.shape[0]
        rows = np.zeros((len(texts), width + 1), np.float32)
        for row, text in zip(rows, texts, strict=True):
            for start in range(0, len(text), 1 << 20):  # whole text, a piece at a time
                for s in slots(text[start : start + (1 << 20) + 3]):
                    row[self.feature_of[s]] = 1
        return rows[:, :width]

    def kernel(self, texts: list[bytes]) -> np.ndarray:
        rows = self.presence(texts)
        size = np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
        return (rows @ self.landmarks) / size

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.kernel(texts) @ self.coefficients + self.bias


def fit(texts: list[bytes], languages: list[str], landmarks: int, ridge: float) -> KernelModel:
    """Kernel ridge regression on ``texts``; the first ``landmarks`` texts of each language span it."""
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages])
    chosen = np.concatenate([np.flatnonzero(label == c)[:landmarks] for c in range(len(names))])
    sets = [np.unique(np.concatenate([*slots(texts[i]), np.empty(0, np.uint32)])).astype(np.int64) for i in chosen]
    used = np.unique(np.concatenate([*sets, _NO_DATA]))
    feature_of = np.full(1 << SLOT_BITS, -1, np.int32)
    feature_of[used] = np.arange(len(used))
    marks = np.zeros((len(used), len(chosen)), np.float32)
    for j, s in enumerate(sets):
        marks[feature_of[s], j] = 1 / np.sqrt(max(1, len(s)))
    model = KernelModel(names, feature_of, marks, np.zeros((len(chosen), len(names)), np.float32), np.zeros(len(names), np.float32))
    gram = marks.T.astype(float) @ marks
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # kernel rows to Nyström features
    k = np.concatenate([model.kernel(texts[i : i + BATCH]) for i in range(0, len(texts), BATCH)])
    phi = np.c_[k @ root, np.ones(len(texts))]
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Each language weighs the same, whatever its share of the sample.
    weight = 1 / np.bincount(label)[label]
    left = (phi * weight[:, None]).T @ phi + ridge * np.eye(phi.shape[1])
    solved = np.linalg.solve(left, (phi * weight[:, None]).T @ target)
    model.coefficients = (root @ solved[:-1]).astype(np.float32)
    model.bias = solved[-1].astype(np.float32)
    return model


def train(labelled: DataFrame, per_language: int = 400, landmarks: int = 24, ridge: float = 1e-3) -> KernelModel | None:
    """Fit on at most ``per_language`` texts of each language of ``labelled`` (doc_id, text, lang).

    The sample is that of the smallest hashed (id, text); ids, languages and hashes are sorted, and the chosen
    texts are looked up. Rows that repeat an id are rows of their own, equal rows count as one; a null id, text
    or language takes no part. None where no row is left, as in an empty table. Texts of any length are whole.
    """
    named = labelled.where("text is not null and lang is not null and doc_id is not null").select(
        "doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("mark")
    )
    keys = ["lang", "doc_id", "mark"]
    order = Window.partitionBy("lang").orderBy("mark", "doc_id")
    ids = (
        named.select(*keys)
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= per_language)
    )
    # Bounded by per_language times the number of languages, hence the broadcast and the collect.
    rows = named.join(F.broadcast(ids), keys).groupBy(*keys, "n").agg(F.min("text").alias("text")).collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["n"]))
    if not rows:
        return None
    texts = [r["text"].encode("utf-8", "replace").lower() for r in rows]
    return fit(texts, [r["lang"] for r in rows], landmarks, ridge)


def identify(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. Columns of these names are replaced; others stay.

    A text that is null or has no letter is ``und`` with score 0, as is every text if ``model`` is
    None. ``score`` is the predicted language's share, 0 to 1. Ties go to the first name in order.
    """
    spark = docs.sparkSession
    ship_package(spark)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # size set by slots, landmarks and languages
    rows = docs.select(*keep)
    mark = "letter"
    while mark in keep:  # whatever the user's columns are called
        mark += "_"
    source = rows.withColumn(mark, letter)
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    for field in schema.fields[-2:]:
        field.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array(own.languages, dtype=object)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                texts = batch.column("text").to_pylist()
                has = batch.column(mark).to_numpy(zero_copy_only=False)
                known = np.flatnonzero(has)
                pred = np.full(len(texts), UNDETERMINED, dtype=object)
                share = np.zeros(len(texts))
                if len(known):
                    f = own.scores([texts[i].encode("utf-8", "replace").lower() for i in known])
                    e = np.exp(4.0 * (f - f.max(1, keepdims=True)))
                    pred[known] = names[f.argmax(1)]
                    share[known] = (e / e.sum(1, keepdims=True)).max(1)
                columns = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(pred, pa.string()), pa.array(share)], names=[*keep, "lang_pred", "score"]
                )

    return source.mapInArrow(tidy(run), schema)
