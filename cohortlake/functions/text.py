"""Total casts of dirty text and conversion of typed values to text (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 10)


def clean_text(col: Column) -> Column:
    """Strip surrounding spaces; an empty text is no value."""
    return F.nullif(F.trim(col), F.lit(""))


def safe_cast(col: Column, kind: str | T.DataType) -> Column:
    """Invalid input gives NULL, never an error."""
    return col.try_cast(kind)


def to_int(col: Column) -> Column:
    return safe_cast(clean_text(col), "bigint")


def to_numeric(col: Column, decimal: str = ".") -> Column:
    """Decimal number from text that may carry a currency sign and either decimal mark.

    ``decimal``: ``.``, ``,`` or ``auto`` (comma rules apply only where a comma is present).
    """
    bare = F.regexp_replace(clean_text(col), r"R\$|\s", "")
    comma = F.translate(bare, ",.", ".")
    text = {
        ".": bare,
        ",": comma,
        "auto": F.when(F.contains(bare, F.lit(",")), comma).otherwise(bare),
    }[decimal]
    # The test spares unreadable text the costly failure inside the cast.
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), safe_cast(text, NUMERIC))


# Fixed day-first / month-first layouts: which regex group holds year, month and day.
_DATE_LAYOUTS = {"dmy": "$3-$2-$1", "mdy": "$3-$1-$2"}
_THREE_NUMBERS = r"(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
_FULL_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def to_date(col: Column, fmt: str = "iso") -> Column:
    """``iso`` reads the first ten characters; ``dmy`` and ``mdy`` accept ``/``, ``.`` and ``-``."""
    text = clean_text(col)
    if fmt == "iso":
        text = F.left(text, F.lit(10))
    else:
        text = F.regexp_replace(text, f"^{_THREE_NUMBERS}$", _DATE_LAYOUTS[fmt])
    return F.when(text.rlike(_FULL_DATE), safe_cast(text, "date"))


def to_timestamp(col: Column, fmt: str = "iso", tz: bool = False) -> Column:
    text = clean_text(col)
    if fmt == "dmy":
        text = F.regexp_replace(text, f"^{_THREE_NUMBERS}[ T](.+)$", _DATE_LAYOUTS["dmy"] + " $4")
    full = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$")
    return F.when(full, safe_cast(text, "timestamp" if tz else "timestamp_ntz"))


def typed_column(name: str | None, kind: str = "text") -> Column:
    """A column of the wanted kind, or a typed NULL when the layout does not have it."""
    spark_type = {"text": "string", "int": "int", "bigint": "bigint", "numeric": NUMERIC}[kind]
    if name is None:
        return F.lit(None).cast(spark_type)
    col = F.col(f"`{name}`")
    if kind == "numeric":
        return to_numeric(col, "auto")
    if kind in ("int", "bigint"):
        return to_int(col).try_cast(spark_type)
    return clean_text(col)


def code_label(code: Column, labels: dict[int, str]) -> Column:
    """Text label of a code; unknown codes have none."""
    out: Column | None = None
    for value, text in labels.items():
        test = code == F.lit(value)
        out = F.when(test, F.lit(text)) if out is None else out.when(test, F.lit(text))
    return out


def score_band(col: Column) -> Column:
    """Keep the bands 1 to 5 and the no-score mark ``SC`` in any case; all else is NULL."""
    text = clean_text(col)
    return F.when(text.isin("1", "2", "3", "4", "5"), text).when(F.upper(text) == "SC", F.lit("SC"))


def band_label(band: Column, missing: str, special: str) -> Column:
    return F.when(band.isNull(), F.lit(missing)).when(band == "SC", F.lit(special)).otherwise(band)


def _float_text(col: Column) -> Column:
    """Shortest decimal text: plain between 1e-4 and 1e16, else ``1.5e+20`` style.

    Java before release 19 gives some values outside that span one digit more than needed; the
    text still reads back as the same number.
    """
    raw = col.cast("string")
    plain = F.regexp_replace(
        raw.try_cast(T.DecimalType(38, 21)).cast("string"), r"(\.\d+?)0+$", "$1"
    )
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    power = F.substring_index(raw, "E", -1).try_cast("int")
    science = F.concat(
        mantissa,
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(power).cast("string"),
    )
    return (
        F.when(F.isnan(col), F.lit(None).cast("string"))
        .when(raw.endswith("Infinity"), F.replace(raw, F.lit("Infinity"), F.lit("inf")))
        .when(~F.contains(raw, F.lit("E")), raw)
        .when(power.between(-4, 15), plain)
        .otherwise(science)
    )


def _clock_text(col: Column, layout: str) -> Column:
    seconds = F.date_format(col, layout)
    micros = F.date_format(col, "SSSSSS")
    return F.when(micros == "000000", seconds).otherwise(F.concat_ws(".", seconds, micros))


def without_nul(col: Column) -> Column:
    return F.replace(col, F.lit("\0"), F.lit(""))


def json_text(col: Column) -> Column:
    """JSON with one space after each comma and colon outside strings."""
    compact = F.to_json(col, {"ignoreNullFields": "false"})
    upto_mark = r'\G((?:"(?:[^"\\]|\\.)*+"|[^",:])*+)([,:])'
    return without_nul(F.regexp_replace(compact, upto_mark, "$1$2 "))


def to_text(col: Column, kind: T.DataType) -> Column:
    """Text form of a typed value; NULL and NaN stay NULL and NUL characters are removed."""
    if isinstance(kind, T.StringType):
        return without_nul(col)
    if isinstance(kind, T.DoubleType | T.FloatType):
        return _float_text(col)
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(col))
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return _clock_text(col, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.VariantType):
        return json_text(col)
    return col.cast("string")


def to_text_frame(df: DataFrame) -> DataFrame:
    """All columns as text under normalized, unique names."""
    from cohortlake.functions.names import normalize_columns

    names = normalize_columns(df.columns)
    return df.select(
        *[
            to_text(F.col(f"`{field.name}`"), field.dataType).alias(name)
            for field, name in zip(df.schema.fields, names, strict=True)
        ]
    )


# Fixed mark standing for NULL inside a row hash.
NULL_MARK = "\x1e~"


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row as 16 hex digits; NULL differs from every text."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.lpad(F.lower(F.hex(F.xxhash64(*parts))), 16, "0")


def row_digest(columns: list[str]) -> Column:
    """SHA-256 over the same parts, for comparison with other engines."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def json_path(col: Column, path: str) -> Column:
    """Value at a dotted path; a number is a list index."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return F.get_json_object(col, "$" + steps)
