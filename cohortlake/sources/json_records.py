"""Records out of landed JSON payloads, flattened to text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.names import normalize_columns
from cohortlake.functions.text import to_text


class RecordsPathError(ValueError):
    """The path does not lead to a list of records."""


def _leaves(
    col: Column, kind: T.DataType, name: str, level: int, max_level: int, sep: str
) -> list[tuple[str, Column]]:
    if not isinstance(kind, T.StructType) or level > max_level:
        return [(name, to_text(col, kind))]
    found = []
    for field in kind.fields:
        path = f"{name}{sep}{field.name}" if name else field.name
        found += _leaves(
            col.getField(field.name), field.dataType, path, level + 1, max_level, sep
        )
    return found


def flatten_records(
    df: DataFrame, column: str, max_level: int = 1, sep: str = "_", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One text column per field of ``column``; nesting is joined by ``sep`` to ``max_level``.

    Deeper objects and all lists stay JSON text; a record that is no object becomes ``value``.
    """
    kind = df.schema[column].dataType
    start = "" if isinstance(kind, T.StructType) else "value"
    leaves = _leaves(F.col(column), kind, start, 0, max_level, sep)
    names = normalize_columns([name for name, _ in leaves])
    return df.select(
        *keep, *[col.alias(name) for name, (_, col) in zip(names, leaves, strict=True)]
    )


def explode_path(df: DataFrame, path: str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``record`` from the list (or the one object) at a dotted path; a number is an index."""
    fields = [c for c in df.columns if c not in keep]
    if not path:
        return df.select(*keep, F.struct(*fields).alias("record"))
    first, *steps = path.split(".")
    if first not in fields:
        return df.select(*keep, F.lit(None).cast("struct<value:string>").alias("record")).where(
            F.lit(False)
        )
    col, kind = F.col(first), df.schema[first].dataType
    for step in steps:
        if isinstance(kind, T.StructType) and step in kind.names:
            col, kind = col.getField(step), kind[step].dataType
        elif isinstance(kind, T.ArrayType) and step.isdigit():
            col, kind = F.get(col, F.lit(int(step))), kind.elementType
        else:
            raise RecordsPathError(f"{path}: no {step!r} in {kind.simpleString()}")
    if isinstance(kind, T.StructType):
        return df.select(*keep, col.alias("record")).where(F.col("record").isNotNull())
    if not isinstance(kind, T.ArrayType):
        raise RecordsPathError(f"{path}: {kind.simpleString()} is not a list of records")
    return df.select(*keep, F.explode(col).alias("record"))


def read_records(
    spark: SparkSession,
    path: str | list[str],
    records_path: str | None = None,
    max_level: int = 1,
    document_per_line: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All records of the JSON documents at ``path`` as text columns, with their file.

    A document that is no JSON stops the read; Spark's error names its file. ``schema`` saves the pass
    that infers it.

    A document that is itself a list gives one record per element. Files with one document per
    line are split over tasks.
    """
    payload = spark.read.json(path, schema=schema, multiLine=not document_per_line, mode="FAILFAST")
    fields = payload.columns
    located = payload.select(*fields, F.col("_metadata.file_path").alias("_source_file"))
    keep = ("_source_file",)
    return flatten_records(explode_path(located, records_path, keep), "record", max_level, keep=keep)


def file_columns(rows: DataFrame) -> DataFrame:
    """``file_uri, header``: the columns that some record of a file fills.

    A field that is null in every record of a file counts as absent from it.
    """
    names = [c for c in rows.columns if c != "_source_file"]
    filled = [F.count(f"`{c}`").alias(f"_n{i}") for i, c in enumerate(names)]
    counted = rows.groupBy(F.col("_source_file").alias("file_uri")).agg(*filled)
    held = F.array(*[F.when(F.col(f"_n{i}") > 0, F.lit(c)) for i, c in enumerate(names)])
    return counted.select("file_uri", F.array_compact(held).cast("array<string>").alias("header"))
