"""Files as rows: listing rules, what is new, dialect of contents."""

from __future__ import annotations

import fnmatch
import io
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import IO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import ship_package
from cohortlake.sources.dialect import SAMPLE_BYTES, detect
from cohortlake.sources.streamed import DIALECT_FIELDS, unpacked_stream

# Names never taken from a landing folder.
DEFAULT_EXCLUDE = (
    ".*",
    "~$*",
    "*.tmp",
    "*.part",
    "*.crdownload",
    "_source.yml",
    "_sources.yml",
)
# File name endings and the codec they stand for.
CODECS = {"gz": "gzip", "bz2": "bz2", "xz": "xz", "zst": "zstd", "zip": "zip"}


def _like_any(name: Column, globs: Iterable[str]) -> Column:
    tests = [F.lower(name).rlike("^" + fnmatch.translate(g.lower())) for g in globs]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def accepted(
    name: Column, include: Sequence[str] = ("*",), exclude: Sequence[str] = DEFAULT_EXCLUDE
) -> Column:
    """The base name matches an include glob and no exclude glob, whatever its case."""
    return _like_any(name, include) & ~_like_any(name, exclude)


def settled(modified: Column, min_age_seconds: int, now: datetime | Column | None = None) -> Column:
    """Last changed at least ``min_age_seconds`` ago."""
    if now is None:
        now = datetime.now(timezone.utc)
    limit = F.lit(now) - F.make_dt_interval(secs=F.lit(min_age_seconds).cast("decimal(18,6)"))
    return modified <= limit


def list_metadata(
    spark: SparkSession,
    path: str | Sequence[str],
    include: Sequence[str] = ("*",),
    exclude: Sequence[str] = DEFAULT_EXCLUDE,
    recursive: bool = True,
    min_age_seconds: int = 0,
    now: datetime | None = None,
    content: bool = False,
) -> DataFrame:
    """One row per accepted file; no file is opened, unless ``content`` asks for the bytes of each."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(path if isinstance(path, str) else list(path))
    keep = accepted(F.col("_metadata.file_name"), include, exclude)
    if min_age_seconds:
        keep = keep & settled(F.col("_metadata.file_modification_time"), min_age_seconds, now)
    return files.where(keep).select(
        F.col("_metadata.file_path").alias("file_uri"),
        "path",
        F.col("_metadata.file_name").alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
        *(["content"] if content else []),
    )


def list_files(spark: SparkSession, path: str | Sequence[str], *args, **options) -> DataFrame:
    """The files of ``list_metadata`` with their bytes and content hash, for files that fit a cell."""
    found = list_metadata(spark, path, *args, **options, content=True)
    return found.withColumn("sha256", F.sha2("content", 256))


def unseen(files: DataFrame, manifest: DataFrame, source: str) -> DataFrame:
    """Files whose content the manifest does not hold, whatever their name.

    Known contents are made distinct first, so a content loaded many times is one row of the join.
    """
    known = manifest.where(F.col("source") == source).select("sha256").distinct()
    return files.join(known, "sha256", "left_anti")


def codec_of(name: str, codec: str = "infer") -> str | None:
    if codec == "infer":
        return CODECS.get(name.lower().rsplit(".", 1)[-1])
    return None if codec == "none" else codec


def open_bytes(content: bytes, name: str, codec: str = "infer") -> IO[bytes]:
    return unpacked_stream(io.BytesIO(content), codec_of(name, codec))


def with_dialect(
    files: DataFrame,
    sep: str = "auto",
    encoding: str = "auto",
    skip_rows: int | str = 0,
    quote: str = '"',
    codec: str = "infer",
    keep: Sequence[str] = ("file_uri", "path", "file_name"),
) -> DataFrame:
    """Dialect of contents that a column holds (``file_name``, ``content``); plain ones send only their
    start to Python. Files on disk are profiled by ``streamed.digests``."""
    ship_package(files.sparkSession)
    packed = F.lower("file_name").rlike(rf"\.({'|'.join(CODECS)})$") & F.lit(codec == "infer")
    packed = packed | F.lit(codec not in ("infer", "none"))
    head = F.when(packed, F.col("content")).otherwise(
        F.substring(F.col("content"), 1, SAMPLE_BYTES)
    )
    rows = files.select(*keep, head.alias("_head"))

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name, content in zip(batch["file_name"], batch["_head"], strict=True):
                with open_bytes(content, name, codec) as stream:
                    sample = stream.read(SAMPLE_BYTES)
                found.append(detect(sample, sep, encoding, skip_rows, quote))
            extra = pd.DataFrame(found, columns=["encoding", "sep", "skip", "header"], dtype=object)
            yield pd.concat([batch.drop(columns="_head").reset_index(drop=True), extra], axis=1)

    kept = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInPandas(profile, f"{kept}, {DIALECT_FIELDS}")
