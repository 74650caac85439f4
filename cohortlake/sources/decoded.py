"""Formats the engine cannot split: workbooks, archives and codecs without a native reader.

One task decodes one file and streams its rows on as name -> text maps; everything after that is
ordinary DataFrame work.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from itertools import chain, islice
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.names import normalize_columns
from cohortlake.session import ship_package
from cohortlake.sources.dialect import SAMPLE_BYTES, csv_header, detect, header_row, is_filled
from cohortlake.sources.files import DEFAULT_EXCLUDE, codec_of, open_bytes
from cohortlake.sources.workbook import sheet_rows

BATCH_ROWS = 5000
ROW_SCHEMA = "file_uri string, member string, row_no bigint, record map<string,string>"
_ARROW = pa.schema(
    [
        ("file_uri", pa.string()),
        ("member", pa.string()),
        ("row_no", pa.int64()),
        ("record", pa.map_(pa.string(), pa.string())),
    ]
)


@dataclass(frozen=True)
class DecodeOptions:
    format: str = "csv"
    codec: str = "infer"
    member_pattern: str = "*"
    members: tuple[str, ...] = ()
    exclude: tuple[str, ...] = DEFAULT_EXCLUDE
    sep: str = "auto"
    encoding: str = "auto"
    quote: str = '"'
    skip_rows: int | str = 0
    sheet: str | int = 0
    drop_note_rows: bool = False
    header_rows: int = 60  # rows of a sheet in which the header is looked for


class NoMembersError(FileNotFoundError):
    """An archive holds no member that matches."""


def _cell_text(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    return str(value).replace("\0", "")


def _any_glob(globs: Sequence[str]) -> re.Pattern[str]:
    """One pattern for all globs, whatever the case; it matches nothing if there is none."""
    return re.compile("|".join(fnmatch.translate(g) for g in globs) or r"(?!)", re.IGNORECASE | re.DOTALL)


def archive_names(names: Sequence[str], options: DecodeOptions) -> list[str]:
    """Members to read, in order: files whose whole name fits the pattern and the list, if there is
    one, and whose base name fits no exclusion."""
    wanted, banned = _any_glob([options.member_pattern]), _any_glob(options.exclude)
    listed = {m.casefold() for m in options.members}
    kept = []
    for name in names:
        folder, _, base = name.rpartition("/")
        if not base or banned.match(base) or not wanted.match(name):
            continue
        if not listed or name.casefold() in listed:
            kept.append(name)
    return sorted(kept)


def _streams(
    content: bytes, name: str, options: DecodeOptions
) -> Iterator[tuple[str | None, IO[bytes]]]:
    if codec_of(name, options.codec) != "zip":
        with open_bytes(content, name, options.codec) as stream:
            yield None, stream
        return
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        members = archive_names(archive.namelist(), options)
        if not members:
            raise NoMembersError(f"{name}: no member matches {options.member_pattern!r}")
        for member in members:
            with archive.open(member) as stream:
                yield member, stream


def _csv_records(stream: IO[bytes], options: DecodeOptions) -> Iterator[dict[str, str | None]]:
    sample = stream.read(SAMPLE_BYTES)
    dialect = detect(
        sample, options.sep, options.encoding, options.skip_rows, options.quote
    )
    whole = io.BufferedReader(_Joined(sample, stream))
    text = io.TextIOWrapper(whole, encoding=dialect.encoding, errors="replace", newline="")
    rows = (r for r in csv.reader(text, delimiter=dialect.sep, quotechar=options.quote) if r)
    first = next(islice(rows, dialect.skip, None), [])
    names = normalize_columns(csv_header(first))
    for row in rows:
        if len(row) > len(names):
            raise ValueError(f"{len(row)} fields under {len(names)} headers: {row[:5]}")
        padded = row + [""] * (len(names) - len(row))
        yield {n: v.replace("\0", "") or None for n, v in zip(names, padded, strict=True)}


class _Joined(io.RawIOBase):
    """The sample already read, then the rest of the stream."""

    def __init__(self, head: bytes, rest: IO[bytes]) -> None:
        self.head, self.rest = io.BytesIO(head), rest

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.head.read(len(buffer)) or self.rest.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class SheetLayout:
    """Where a sheet's table starts, and its columns: up to the last named one, blank names by position."""

    def __init__(self, header: Sequence[object], drop_notes: bool) -> None:
        named = [i for i, cell in enumerate(header) if is_filled(cell)]
        self.width = named[-1] + 1 if named else len(header)
        titles = [f"col_{i + 1}" for i in range(self.width)]
        for i in named:
            titles[i] = header[i]
        self.names = normalize_columns(titles)
        # A note is a line with one cell below a table of four columns or more.
        self.least = 2 if drop_notes and self.width >= 4 else 1

    def record(self, row: Sequence[object]) -> dict[str, str | None] | None:
        cells = dict(zip(self.names, row, strict=False))
        if sum(is_filled(c) for c in cells.values()) < self.least:
            return None
        return {name: _cell_text(cells.get(name)) for name in self.names}


def _sheet_records(stream: IO[bytes], options: DecodeOptions) -> Iterator[dict[str, str | None]]:
    lines = sheet_rows(stream if stream.seekable() else io.BytesIO(stream.read()), options.sheet)
    if options.skip_rows != "auto":
        for _ in range(int(options.skip_rows)):
            next(lines, None)
        layout = SheetLayout(next(lines, []), options.drop_note_rows)
        found = filter(None, map(layout.record, lines))
    else:
        top = list(islice(lines, options.header_rows))
        if len(top) == options.header_rows and all(sum(map(is_filled, line)) < 2 for line in top):
            raise ValueError(f"no header in the first {options.header_rows} rows; raise header_rows")
        at = header_row(top)
        layout = SheetLayout(top[at] if top else [], options.drop_note_rows)
        found = filter(None, map(layout.record, chain(top[at + 1 :], lines)))
    yield from found


def decode_files(files: DataFrame, options: DecodeOptions = DecodeOptions()) -> DataFrame:
    """Rows of all ``files`` (``file_uri``, ``file_name``, ``content``) as name -> text maps."""
    ship_package(files.sparkSession)
    records = _sheet_records if options.format == "xlsx" else _csv_records

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                for member, stream in _streams(file["content"], file["file_name"], options):
                    numbered = enumerate(records(stream, options), 1)
                    while rows := list(islice(numbered, BATCH_ROWS)):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([file["file_uri"]] * len(rows)),
                                pa.array([member] * len(rows), pa.string()),
                                pa.array([n for n, _ in rows], pa.int64()),
                                pa.array([list(r.items()) for _, r in rows], _ARROW[3].type),
                            ],
                            schema=_ARROW,
                        )

    return files.select("file_uri", "file_name", "content").mapInArrow(decode, ROW_SCHEMA)


def record_columns(rows: DataFrame) -> list[str]:
    """All column names of decoded rows, in order of arrival.

    Rows of one file member share their names, so its first row stands for all.
    """
    first = (
        rows.where("row_no = 1")
        .select("file_uri", F.posexplode(F.map_keys("record")).alias("at", "name"))
        .groupBy("name")
        .agg(F.min(F.struct("file_uri", "at")).alias("seen"))
        .orderBy("seen")
    )
    return [r["name"] for r in first.collect()]


def spread_records(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns out of the maps; a column a file does not have is NULL."""
    values = [F.col("record")[c].alias(c) for c in columns]
    return rows.select(*values, F.col("file_uri").alias("_source_file"))


def file_layouts(rows: DataFrame) -> DataFrame:
    """Column names of every file, all its members together."""
    return rows.where("row_no = 1").groupBy("file_uri").agg(
        F.array_distinct(F.flatten(F.collect_set(F.map_keys("record")))).alias("header")
    )
