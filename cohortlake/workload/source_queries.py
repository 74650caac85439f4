"""Files made from the driver tables by Spark, then listed, profiled, decoded and landed."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.plans.landing import Lake, LandingError, Source
from cohortlake.plans.ops import optional_parquet
from cohortlake.session import scratch_path, ship_package, spread
from cohortlake.sources import decoded, dialect, files, json_records
from cohortlake.streaming.incremental import land_available
from cohortlake.workload import base

# Separator and encoding of the files of each language.
LAYOUTS = {
    "en": (",", "UTF-8"),
    "fr": (";", "UTF-8"),
    "de": ("|", "ISO-8859-1"),
    "es": ("\t", "UTF-16"),
}
NOT_LATIN = r"[^\x00-\xFF]"


def _by_language(values: dict[str, object]) -> Column:
    out = F.lit(values["en"])
    for lang, value in values.items():
        out = F.when(F.col("lang") == lang, F.lit(value)).otherwise(out)
    return out


def _as_file(text: Column) -> Column:
    """Bytes of a text in the encoding of its language, with a mark for French."""
    plain = F.encode(text, "UTF-8")
    latin = F.encode(F.regexp_replace(text, NOT_LATIN, "?"), "ISO-8859-1")
    marked = F.concat(F.unhex(F.lit("EFBBBF")), plain)
    lang = F.col("lang")
    return (
        F.when(lang == "fr", marked)
        .when(lang == "de", latin)
        .when(lang == "es", F.encode(text, "UTF-16"))
        .otherwise(plain)
    )


def detect_dialect(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a two-column file: its lines, quoted with all separators and quotes they hold,
    behind the separator of its language."""
    sep = _by_language({k: v[0] for k, v in LAYOUTS.items()})
    mark = F.lit('"')

    def row(line: Column) -> Column:
        return F.concat(F.lit("line"), sep, mark, F.replace(line, mark, F.lit('""')), mark)

    body = F.transform(F.split("text", "\n"), row)
    text = F.concat(F.lit("kind"), sep, F.lit("content\n"), F.array_join(body, "\n"), F.lit("\n"))
    docs = spread(base.table(spark, sf, "documents").select("doc_id", "text", "lang")).select(
        "doc_id",
        F.concat(F.col("doc_id").cast("string"), F.lit(".csv")).alias("file_name"),
        _as_file(text).alias("content"),
    )
    found = files.with_dialect(docs, keep=("doc_id", "file_name"))
    return found.select(
        "doc_id", "encoding", "sep", "skip", F.array_join("header", " ").alias("header")
    )


def header_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a table of its lines below as many title lines as its source number."""
    titles = F.regexp_extract("source", r"\d+", 0).cast("int")
    line = F.split("text", "\n")
    body = F.transform(
        line,
        lambda x, i: F.concat_ws(
            ";", i.cast("string"), F.length(x).cast("string"), F.size(F.split(x, " ")).cast("string")
        ),
    )
    text = F.concat(
        F.repeat(F.lit("Report of the lines\n"), titles),
        F.lit("\nline_no;size;words\n"),
        F.array_join(body, "\n"),
        F.lit("\n"),
    )
    docs = spread(base.table(spark, sf, "documents").select("doc_id", "text", "source")).select(
        "doc_id", F.lit("table.csv").alias("file_name"), F.encode(text, "UTF-8").alias("content")
    )
    found = files.with_dialect(docs, skip_rows="auto", keep=("doc_id", "file_name"))
    return found.select("doc_id", "sep", "skip", F.array_join("header", " ").alias("header"))


def numeric_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents that look like a number, an amount or a date."""
    docs = spread(base.table(spark, sf, "documents").select("text"))
    words = docs.select(F.explode(F.split("text", r"\s+")).alias("word"))
    kept = words.where(dialect.numeric_like(F.col("word")))
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _write_documents(spark: SparkSession, sf: str) -> str:
    folder = scratch_path(spark, "landing")
    docs = spread(base.table(spark, sf, "documents"))
    for lang, (sep, charset) in LAYOUTS.items():
        text = F.regexp_replace("text", NOT_LATIN, "?") if charset == "ISO-8859-1" else F.col("text")
        rows = docs.where(F.col("lang") == lang).select(
            "doc_id", "lang", "source", "n_chars", text.alias("text")
        )
        rows.write.csv(
            f"{folder}/{lang}", header=True, sep=sep, encoding=charset, escape='"', quoteAll=True
        )
    return folder


def csv_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written in four dialects, landed by detection, read back from Bronze."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    options = decoded.DecodeOptions(skip_rows="auto")
    source = Source("documents", _write_documents(spark, sf), include=("*.csv",), decode=options,
                    essential=("doc_id", "text"))
    lake.load(source)
    return lake.bronze(source).select("doc_id", "lang", "source", "n_chars", "text")


def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Event files by type with the number of data lines in the accepted ones."""
    folder = scratch_path(spark, "landing")
    events = base.table(spark, sf, "events").select("event_id", "event_type")
    events.write.partitionBy("event_type").csv(folder)
    found = files.list_files(spark, folder, include=["part-*.CSV"])
    kind = F.regexp_extract("path", "event_type=([a-z]+)", 1).alias("event_type")
    lines = F.length("content") - F.length(F.translate(F.col("content").cast("string"), "\n", ""))
    return found.groupBy(kind).agg(F.sum(lines).alias("nu_lines"))


def json_payload_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON documents with a list of records, opened at its path and flattened."""
    folder = scratch_path(spark, "landing")
    item = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("kind"), F.struct("user_id").alias("who")).alias("cat"),
    )
    payload = F.to_json(F.struct(F.struct(F.array(item, item).alias("items")).alias("data")))
    base.table(spark, sf, "events").select(payload.alias("value")).write.text(folder)
    rows = json_records.read_records(spark, folder, "data.items", document_per_line=True)
    return rows.drop("_source_file")


def archive_members(spark: SparkSession, sf: str) -> DataFrame:
    """Pages packed into archives, a member each beside members that do not count."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blob = io.BytesIO()
            with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
                for row in batch.itertuples():
                    html = row.html.replace('"', '""')
                    text = f'page_id;url;html\n{row.page_id};{row.url};"{html}"\n'
                    archive.writestr(f"data/P{row.page_id}.CSV", text)
                    archive.writestr(f"data/{row.page_id}.tmp", "left out")
                    archive.writestr(f"data/{row.page_id}.txt", "left out")
            name = f"{batch.page_id.iloc[0]}.zip"
            yield pd.DataFrame({"file_uri": [name], "file_name": [name], "content": [blob.getvalue()]})

    pages = base.table(spark, sf, "pages")
    packed = pages.mapInPandas(pack, "file_uri string, file_name string, content binary")
    options = decoded.DecodeOptions(member_pattern="data/p*.csv", sep=";")
    rows = decoded.decode_files(packed, options)
    return decoded.spread_records(rows, ["page_id", "url", "html"]).drop("_source_file")


def _sheet(rows: list[list[object]]) -> str:
    def cell(value: object) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f"<c><v>{value!r}</v></c>"

    lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
    space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    return f'<worksheet xmlns="{space}"><sheetData>{lines}</sheetData></worksheet>'


def _workbook(rows: list[list[object]]) -> bytes:
    """A minimal workbook: a hidden sheet first, then the rows."""
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            f'xmlns:r="{office}"><sheets><sheet name="Notes" sheetId="1" state="hidden" r:id="r1"/>'
            '<sheet name="Data" sheetId="2" r:id="r2"/></sheets></workbook>',
        )
        links = "".join(
            f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in (1, 2)
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f"{links}</Relationships>",
        )
        book.writestr("xl/worksheets/sheet1.xml", _sheet([["hidden"]]))
        book.writestr("xl/worksheets/sheet2.xml", _sheet(rows))
    return blob.getvalue()


def workbook_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as workbooks with titles above the header on line 9 and a note below the data."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[list[object]] = [["Ministry"], ["Supplier report"], *[[] for _ in range(6)]]
            rows.append(["S_SUPPKEY", "Nome do Fornecedor", "sNationKey", "Saldo (R$)", None])
            rows += [
                [f"{r.s_suppkey:07d}", r.s_name, int(r.s_nationkey), float(r.s_acctbal)]
                for r in batch.itertuples()
            ]
            rows += [[], ["Source: the supplier table."]]
            name = f"{batch.s_suppkey.iloc[0]}.xlsx"
            content = _workbook(rows)
            yield pd.DataFrame({"file_uri": [name], "file_name": [name], "content": [content]})

    ship_package(spark)
    packed = base.table(spark, sf, "supplier").mapInPandas(
        pack, "file_uri string, file_name string, content binary"
    )
    options = decoded.DecodeOptions("xlsx", skip_rows="auto", sheet="auto", drop_note_rows=True)
    rows = decoded.decode_files(packed, options)
    names = ["s_suppkey", "nome_do_fornecedor", "s_nation_key", "saldo_r"]
    return decoded.spread_records(rows, names).select(
        *names[:3], F.col(names[3]).cast("double").alias(names[3])
    )


def _files(rows: DataFrame) -> int:
    """Number of files for some rows: as many as the data need, eight at least."""
    return max(8, -(-rows.count() // 1_000_000))


def _deliver(rows: DataFrame, folder: str, name: str) -> None:
    """CSV files whose bytes depend on the rows only, so that a second delivery repeats them."""
    fixed = rows.repartition(_files(rows), "event_id").sortWithinPartitions("event_id")
    fixed.write.csv(f"{folder}/{name}", header=True, escape='"')


def incremental_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of events as a stream of files; the second repeats the first and adds to it."""
    folder = scratch_path(spark, "landing")
    lake = Lake(spark, scratch_path(spark, "lake"))
    checkpoint = scratch_path(spark, "stream")
    source = Source("events", folder, include=("*.csv",), decode=decoded.DecodeOptions(sep=","))
    events = base.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    first = events.where("event_type <> 'view'")
    _deliver(first, folder, "day1")
    land_available(lake, source, checkpoint)
    _deliver(first, folder, "day2-again")
    _deliver(events.where("event_type = 'view'"), folder, "day2-new")
    land_available(lake, source, checkpoint)
    return lake.bronze(source).select("event_id", "user_id", "event_type", "props")


def full_load(spark: SparkSession, sf: str) -> DataFrame:
    """Customers landed as a full load twice; the second run filters, renames and picks columns."""
    folder = scratch_path(spark, "landing")
    lake = Lake(spark, scratch_path(spark, "lake"))
    base.table(spark, sf, "customer").write.csv(folder, header=True)
    steps = (
        {"op": "filter", "column": "c_mktsegment", "operator": "ne", "value": "BUILDING"},
        {"op": "filter", "column": "c_acctbal", "operator": "gt", "value": 0},
        {"op": "rename", "mapping": {"c_custkey": "code"}},
        {"op": "select_columns", "columns": ["code", "c_name", "c_mktsegment"]},
    )
    first = Source("customers", folder, strategy="full", include=("*.csv",))
    lake.load(first)
    second = Source("customers", folder, strategy="full", include=("*.csv",), steps=steps)
    lake.load(second)
    return lake.bronze(second).select("code", "c_name", "c_mktsegment")


def bulk_landing(spark: SparkSession, sf: str) -> DataFrame:
    """All order lines landed from CSV files and summed from Bronze."""
    folder = scratch_path(spark, "landing")
    lake = Lake(spark, scratch_path(spark, "lake"))
    lines = base.table(spark, sf, "lineitem")
    lines = lines.repartition(_files(lines))
    lines.write.csv(folder, header=True, sep=";", escape='"')
    source = Source("lines", folder, include=("*.csv",), essential=("l_orderkey", "l_shipdate"))
    lake.load(source)
    return (
        lake.bronze(source)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("nu_lines"),
            F.sum(F.col("l_quantity").try_cast("decimal(18,2)")).cast("double").alias("quantity"),
            F.max(F.length("_row_hash")).cast("bigint").alias("hash_length"),
        )
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log of four runs: a load, the same again, a full load without files, a lacking column."""
    folder, empty = scratch_path(spark, "landing"), scratch_path(spark, "landing")
    lake = Lake(spark, scratch_path(spark, "lake"))
    events = base.table(spark, sf, "events").select("event_id", "event_type")
    _deliver(events, folder, "day1")
    spark.createDataFrame([], "event_id long").write.parquet(empty)
    source = Source("events", folder, include=("*.csv",), decode=decoded.DecodeOptions(sep=","))
    for attempt in (
        source,
        source,
        Source("none", empty, strategy="full", include=("*.csv",)),
        Source("lacking", folder, include=("*.csv",), essential=("absent",)),
    ):
        try:
            lake.load(attempt)
        except LandingError:
            pass  # the log has it
    number = F.row_number().over(Window.orderBy("started_at", "run_id")).cast("bigint")
    return lake.ops.read("ingestion_runs").select(
        number.alias("run_no"), "source", "load_strategy", "status", "units_processed", "units_skipped",
        "rows_extracted", "rows_loaded", F.col("error").isNotNull().alias("has_error"),
    )


def optional_relation(spark: SparkSession, sf: str) -> DataFrame:
    """Customers beside a relation that has never arrived."""
    absent = optional_parquet(spark, scratch_path(spark, "absent"), "c_custkey long, rating double")
    customers = base.table(spark, sf, "customer").select("c_custkey", "c_name")
    return customers.join(absent, "c_custkey", "left")


QUERIES = {
    "run_log": run_log,
    "optional_relation": optional_relation,
    "detect_dialect": detect_dialect,
    "header_rows": header_rows,
    "numeric_cells": numeric_cells,
    "csv_text_scan": csv_text_scan,
    "file_listing": file_listing,
    "json_payload_scan": json_payload_scan,
    "archive_members": archive_members,
    "workbook_scan": workbook_scan,
    "incremental_landing": incremental_landing,
    "full_load": full_load,
    "bulk_landing": bulk_landing,
}

ORACLE = {
    "run_log": """
WITH n AS (SELECT count(*) AS r, greatest(8, ceil(count(*) / 1000000.0))::BIGINT AS f FROM events)
SELECT 1::BIGINT AS run_no, 'events' AS source, 'append' AS load_strategy, 'success' AS status,
       f AS units_processed, 0::BIGINT AS units_skipped, r AS rows_extracted, r AS rows_loaded, false AS has_error FROM n
UNION ALL SELECT 2, 'events', 'append', 'success', 0, f, 0, 0, false FROM n
UNION ALL SELECT 3, 'none', 'full', 'failed', 0, 0, 0, 0, true FROM n
UNION ALL SELECT 4, 'lacking', 'append', 'failed', f, 0, r, 0, true FROM n""",
    "optional_relation": "SELECT c_custkey, c_name, NULL::DOUBLE AS rating FROM customer",
    "detect_dialect": r"""
SELECT doc_id,
       CASE lang WHEN 'fr' THEN 'utf-8-sig' WHEN 'es' THEN 'utf-16'
            WHEN 'de' THEN CASE WHEN regexp_matches(text, '[\x{80}-\x{FF}]') THEN 'cp1252' ELSE 'utf-8' END
            ELSE 'utf-8' END AS encoding,
       CASE lang WHEN 'fr' THEN ';' WHEN 'de' THEN '|' WHEN 'es' THEN chr(9) ELSE ',' END AS sep,
       0::BIGINT AS skip, 'kind content' AS header
FROM documents""",
    "header_rows": r"""
SELECT doc_id, ';' AS sep, regexp_extract(source, '\d+')::BIGINT AS skip,
       'line_no size words' AS header FROM documents""",
    "numeric_cells": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
WHERE regexp_matches(word, '^(R\$\s*)?[+-]?(\d{1,3}([.,]\d{3})+|\d+)([.,]\d+)?%?$|^\d{1,4}[/.-]\d{1,2}[/.-]\d{1,4}')
GROUP BY 1""",
    "csv_text_scan": r"""
SELECT doc_id::VARCHAR AS doc_id, lang, source, n_chars::VARCHAR AS n_chars,
       CASE WHEN lang = 'de' THEN regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') ELSE text END AS text
FROM documents""",
    "file_listing": "SELECT event_type, count(*) AS nu_lines FROM events GROUP BY 1",
    "json_payload_scan": """
SELECT event_id::VARCHAR AS id, event_type AS cat_kind, '{"user_id": ' || user_id || '}' AS cat_who
FROM events, (VALUES (1), (2)) v(n)""",
    "archive_members": "SELECT page_id::VARCHAR AS page_id, url, html FROM pages",
    "workbook_scan": """
SELECT lpad(s_suppkey::VARCHAR, 7, '0') AS s_suppkey, s_name AS nome_do_fornecedor,
       s_nationkey::VARCHAR AS s_nation_key, s_acctbal AS saldo_r FROM supplier""",
    "incremental_landing": """
SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, props FROM events""",
    "full_load": """
SELECT c_custkey::VARCHAR AS code, c_name, c_mktsegment FROM customer
WHERE c_mktsegment <> 'BUILDING' AND c_acctbal > 0""",
    "bulk_landing": """
SELECT l_returnflag, l_linestatus, count(*) AS nu_lines,
       sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity, 16::BIGINT AS hash_length
FROM lineitem GROUP BY 1, 2""",
}
