"""Delimited text through the native reader, file by file in its own dialect."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.names import normalize_columns
from cohortlake.functions.text import without_nul
from cohortlake.session import ship_package
from cohortlake.sources.quoted import read_records, record_fields

# Detected encoding -> charset name of the reader.
CHARSETS = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "utf-16": "UTF-16",
    "cp1252": "ISO-8859-1",
    "latin-1": "ISO-8859-1",
}


def _western() -> tuple[str, str]:
    """Characters that ISO-8859-1 reads from the bytes at which the Western page differs, and those meant."""
    read = [chr(b) for b in range(0x80, 0xA0)]
    meant = [bytes([b]).decode("cp1252", "replace") for b in range(0x80, 0xA0)]
    pairs = [(r, m) for r, m in zip(read, meant, strict=True) if m != "\ufffd"]
    return "".join(r for r, _ in pairs), "".join(m for _, m in pairs)


CORRUPT = "_corrupt_record"


def _too_wide(record: Column, width: int, sep: str, quote: str) -> Column:
    """More separators outside quotes than a header of ``width`` names has."""
    bare = F.regexp_replace(record, f"{re.escape(quote)}[^{re.escape(quote)}]*{re.escape(quote)}", "")
    marks = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))
    return F.coalesce(marks >= width * len(sep), F.lit(False))


def _drop_head(columns: Sequence[str], lines: int):
    """Drop the first ``lines`` records of each file, wherever its first block is read."""

    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passed: dict[str, int] = defaultdict(int)
        for batch in batches:
            start = batch["_block"] == 0
            place = batch[start].groupby("_source_file").cumcount()
            place = place + batch.loc[start, "_source_file"].map(lambda f: passed[f])
            for file, count in batch.loc[start, "_source_file"].value_counts().items():
                passed[file] += count
            keep = ~start
            keep[place[place >= lines].index] = True
            yield batch.loc[keep, [*columns, "_source_file"]]

    return drop


def read_layout(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    sep: str,
    encoding: str,
    skip: int = 0,
    quote: str = '"',
    split_safe: bool = True,
) -> DataFrame:
    """Files of one layout as text columns; the empty field is the only NULL.

    Files without quoted line ends are split over tasks by the native reader; in others the ranges agree on
    where quotes are open first (``quoted``). Only UTF-16, and separators or quotes of several characters,
    need one streaming task for each file.
    A record with more fields than its header stops the read, whatever the surplus fields hold and
    whatever columns are used; one with fewer is filled up.
    """
    charset = CHARSETS.get(encoding, encoding)
    if not split_safe and charset in ("UTF-8", "ISO-8859-1") and len(sep) == len(quote) == 1:
        rows = _from_ranges(spark, paths, names, sep, charset, skip, quote)
    else:
        rows = _from_reader(spark, paths, names, sep, charset, skip, quote, split_safe)
    clean = [F.col(f"`{n}`") for n in names]
    if encoding == "cp1252":
        clean = [F.translate(c, *_western()) for c in clean]
    texts = [F.nullif(without_nul(c), F.lit("")).alias(n) for c, n in zip(clean, names, strict=True)]
    return rows.select(*texts, "_source_file")


def _stop_if(wide: Column, used: Column) -> Column:
    """A filter that no row fails, but that a record of too many fields stops.

    A filter is never pruned; naming a column of data keeps the reader from skipping the fields.
    """
    message = F.concat(F.lit("record wider than its header in "), F.col("_source_file"))
    return F.when(wide & (F.length(F.coalesce(used, F.lit(""))) >= 0), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _from_ranges(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], sep: str, charset: str, skip: int, quote: str
) -> DataFrame:
    records = read_records(spark, paths, sep, quote, skip + 1)
    text = F.col("record").cast("string") if charset == "UTF-8" else F.decode("record", charset)
    rows = records.select(F.col("file").alias("_source_file"), F.regexp_replace(text, r"\r\z", "").alias("_text"))
    rows = rows.where(F.trim("_text") != "")
    rows = rows.select("_source_file", record_fields(F.col("_text"), sep, quote).alias("_fields"))
    rows = rows.where(_stop_if(F.size("_fields") > len(names), F.get("_fields", F.lit(0))))
    return rows.select(*[F.get("_fields", F.lit(i)).alias(n) for i, n in enumerate(names)], "_source_file")


def _from_reader(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    sep: str,
    charset: str,
    skip: int,
    quote: str,
    split_safe: bool,
) -> DataFrame:
    """The native reader. It marks records of another width, and only those are counted again."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    raw = spark.read.option("columnPruning", False).csv(
        list(paths),
        schema=schema,
        sep=sep,
        encoding=charset,
        quote=quote,
        escape=quote,
        header=skip == 0,
        multiLine=not split_safe or charset == "UTF-16",
        enforceSchema=True,
        columnNameOfCorruptRecord=CORRUPT,
    )
    rows = raw.select(
        *[f"`{n}`" for n in [*names, CORRUPT]],
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    if skip:
        ship_package(spark)
        fields = [*schema.fields, T.StructField("_source_file", T.StringType())]
        rows = rows.mapInPandas(_drop_head(schema.names, skip + 1), T.StructType(fields))
    return rows.where(_stop_if(_too_wide(F.col(CORRUPT), len(names), sep, quote), F.col(f"`{names[0]}`")))


def read_delimited(spark: SparkSession, profiles: DataFrame, quote: str = '"') -> DataFrame:
    """All files of a dialect profile, united by column name: one scan per distinct layout.

    The driver sees the few layouts and one path per file, as Spark's own file index does.
    """
    layout = F.struct("header", "sep", "encoding", "skip", "is_split_safe")
    keyed = profiles.withColumn("_layout", layout)
    keyed = keyed.withColumn("_key", F.md5(F.to_json("_layout").cast("binary")))
    shapes = keyed.groupBy("_key").agg(
        F.any_value("_layout").alias("layout"), F.min("file_uri").alias("first")
    )
    paths: dict[str, list[str]] = defaultdict(list)
    for file in keyed.select("_key", "path").orderBy("path").collect():
        paths[file["_key"]].append(file["path"])
    scans = []
    for shape in shapes.orderBy("first").collect():
        header, sep, encoding, skip, safe = shape["layout"]
        if names := normalize_columns(header):
            scans.append(
                read_layout(spark, paths[shape["_key"]], names, sep, encoding, skip, quote, safe)
            )
    if not scans:
        return spark.createDataFrame([], "_source_file string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
