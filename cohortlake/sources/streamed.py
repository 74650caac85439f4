"""Files read block by block inside a task: content hash, sample and line structure of files of any size."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import lzma
from collections.abc import Iterator
from pathlib import Path
from typing import IO
from urllib.parse import quote as quoted_path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cohortlake.session import ship_package
from cohortlake.sources.dialect import SAMPLE_BYTES, detect

#: Bytes of a file that a task holds at once.
BLOCK_BYTES = 8 << 20
DIALECT_FIELDS = "encoding string, sep string, skip bigint, header array<string>"
DIGEST_FIELDS = f"sha256 string, is_split_safe boolean, {DIALECT_FIELDS}"


def open_file(path: str) -> IO[bytes]:
    """The file at a path as Spark lists it, on any file system that Arrow knows."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return Path("/" + rest.lstrip("/") if colon else path).open("rb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(quoted_path(path, safe=":/@"))
    return system.open_input_file(name)


def unpacked_stream(raw: IO[bytes], kind: str | None) -> IO[bytes]:
    """The bytes behind a codec; an archive gives its own bytes."""
    if kind == "gzip":
        return gzip.GzipFile(fileobj=raw)
    if kind == "bz2":
        return bz2.BZ2File(raw)
    if kind == "xz":
        return lzma.LZMAFile(raw)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().stream_reader(raw)
    return raw


class LineBalance:
    """Whether every line of a stream of bytes holds an even number of quotes.

    If so, no quoted field can run over a line end, and lines may be read apart from each other.
    """

    def __init__(self, quote: str) -> None:
        self.quote = ord(quote)
        self.odd = False
        self.even_lines = True

    def add(self, block: bytes) -> None:
        if not self.even_lines:
            return
        data = np.frombuffer(block, np.uint8)
        marks = np.flatnonzero(data == self.quote)
        if not self.odd and not len(marks):
            return
        before = np.searchsorted(marks, np.flatnonzero(data == 10)) + self.odd
        self.even_lines = not (before & 1).any()
        self.odd ^= bool(len(marks) & 1)


def digest(path: str, kind: str | None, quote: str = '"', block_bytes: int | None = None) -> tuple[str, bool, bytes]:
    """SHA-256 of the file, whether its lines can be read apart, and the start of its (unpacked) bytes."""
    whole, balance, head = hashlib.sha256(), LineBalance(quote), b""
    size = block_bytes or BLOCK_BYTES
    with open_file(path) as raw:
        while block := raw.read(size):
            whole.update(block)
            if kind is None:
                balance.add(block)
                if len(head) < SAMPLE_BYTES:
                    head += block[: SAMPLE_BYTES - len(head)]
    if kind is not None:
        with open_file(path) as raw, unpacked_stream(raw, kind) as stream:
            head = stream.read(SAMPLE_BYTES)
    return whole.hexdigest(), kind is None and balance.even_lines, head


def digests(
    files: DataFrame,
    with_dialect: bool,
    sep: str = "auto",
    encoding: str = "auto",
    skip_rows: int | str = 0,
    quote: str = '"',
    codec: str = "infer",
) -> DataFrame:
    """``files`` (``path``, ``file_name``, others pass through) with content hash and, if wanted, dialect.

    A task reads each of its files once, in blocks; no file is ever held as a whole.
    """
    from cohortlake.sources.files import codec_of

    ship_package(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, name in zip(batch["path"], batch["file_name"], strict=True):
                sha256, safe, head = digest(path, codec_of(name, codec), quote)
                dialect = detect(head, sep, encoding, skip_rows, quote) if with_dialect else (None, None, None, None)
                found.append((sha256, safe, *dialect))
            names = ["sha256", "is_split_safe", "encoding", "sep", "skip", "header"]
            extra = pd.DataFrame(found, columns=names, dtype=object)
            yield pd.concat([batch.reset_index(drop=True), extra], axis=1)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInPandas(run, f"{kept}, {DIGEST_FIELDS}")
