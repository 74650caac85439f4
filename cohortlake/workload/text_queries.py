"""Casts, names, text conversion, JSON and the step language on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import text as t
from cohortlake.functions.names import identifier_column, normalize_columns
from cohortlake.operators import dsl
from cohortlake.operators.latest import latest_partition
from cohortlake.session import spread
from cohortlake.sources.json_records import explode_path, flatten_records
from cohortlake.workload import base


def dirty_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same facts written differently by each event type, some of it unreadable."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    value = F.col("value").cast("decimal(18,2)").cast("string")
    hour = F.date_format("ts", "HH:mm:ss")
    none = F.lit(None).cast("string")
    return spread(base.table(spark, sf, "events")).select(
        "event_id",
        F.when(kind == "view", number)
        .when(kind == "click", F.concat(F.lit("  "), number, F.lit(" ")))
        .when(kind == "purchase", F.concat(number, F.lit(".0")))
        .when(kind == "error", F.concat(F.lit("x"), number))
        .otherwise(F.lit("  "))
        .alias("int_text"),
        F.when(kind == "view", value)
        .when(kind == "click", F.concat(F.lit("R$ "), F.translate(value, ".", ",")))
        .when(kind == "purchase", F.concat(F.lit("1."), F.lpad(number, 3, "0"), F.lit(",50")))
        .when(kind == "error", F.lit("abc"))
        .otherwise(none)
        .alias("num_text"),
        F.when(kind == "view", F.col("ts").cast("string"))
        .when(kind == "click", F.date_format("ts", "dd/MM/yyyy"))
        .when(kind == "purchase", F.date_format("ts", "MM-dd-yyyy"))
        .when(kind == "error", F.lit("2024-02-30"))
        .otherwise(F.lit(""))
        .alias("date_text"),
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "click", F.concat_ws(" ", F.date_format("ts", "dd/MM/yyyy"), hour))
        .when(kind == "purchase", F.concat_ws("T", F.date_format("ts", "dd.MM.yyyy"), hour))
        .when(kind == "error", F.lit("2024-13-01 00:00:00"))
        .otherwise(none)
        .alias("time_text"),
    )


def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    col = F.col
    return dirty_events(spark, sf).select(
        "event_id",
        t.clean_text(col("int_text")).alias("clean"),
        t.to_int(col("int_text")).alias("as_int"),
        t.to_numeric(col("num_text")).cast("double").alias("as_dot"),
        t.to_numeric(col("num_text"), ",").cast("double").alias("as_comma"),
        t.to_numeric(col("num_text"), "auto").cast("double").alias("as_auto"),
        t.to_date(col("date_text")).alias("iso_date"),
        t.to_date(col("date_text"), "dmy").alias("dmy_date"),
        t.to_date(col("date_text"), "mdy").alias("mdy_date"),
        t.to_timestamp(col("time_text")).alias("iso_time"),
        t.to_timestamp(col("time_text"), "dmy").alias("dmy_time"),
    )


def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(base.table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", identifier_column(F.col("text"), F.col("doc_id")).alias("name"))


MESSY = ("Order Key", "orderKey", "ORDER  key!", "Preço Total (R$)", "2024 área m²", "___")


def normalize_headers(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders")
    messy = orders.select(
        F.col("o_orderkey").alias(MESSY[0]),
        F.col("o_custkey").alias(MESSY[1]),
        F.col("o_orderstatus").alias(MESSY[2]),
        F.col("o_totalprice").alias(MESSY[3]),
        F.year("o_orderdate").cast("bigint").alias(MESSY[4]),
        F.col("o_orderpriority").alias(MESSY[5]),
    )
    return messy.toDF(*normalize_columns(messy.columns))


def to_text_rows(spark: SparkSession, sf: str) -> DataFrame:
    return t.to_text_frame(base.table(spark, sf, "orders"))


def to_text_events(spark: SparkSession, sf: str) -> DataFrame:
    events = base.table(spark, sf, "events")
    typed = events.select(
        "event_id",
        "ts",
        (F.col("value") * 1000000).alias("big"),
        (F.col("value") / 100000).alias("small"),
        (F.col("value") > 50).alias("flag"),
        F.col("ts").cast("date").alias("day"),
        F.encode("event_type", "UTF-8").alias("raw"),
        F.struct(F.col("user_id").alias("user"), F.array("event_type", F.lit("a:b, c")).alias("tags"))
        .alias("nested"),
        F.col("value").cast("decimal(18,4)").alias("exact"),
    )
    rows = t.to_text_frame(typed)
    # Long fractions print differently between engines: both sides are read back as numbers.
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 9) for c in ("big", "small")})


def row_hashes(spark: SparkSession, sf: str) -> DataFrame:
    rows = base.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("seg"),
    )
    fields = ["c_custkey", "c_name", "c_nationkey", "balance", "seg"]
    return rows.select(
        "c_custkey",
        t.row_digest(fields).alias("digest"),
        F.length(t.row_hash(fields)).cast("bigint").alias("short_length"),
    )


def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a nested object, flattened one level deep."""
    k = t.json_path(F.col("props"), "k").cast("bigint")
    record = F.struct(
        F.col("event_id").alias("id"),
        F.struct(
            F.col("event_type").alias("kind"),
            F.struct(k.alias("k"), F.col("user_id").alias("user")).alias("sub"),
        ).alias("cat"),
        F.array(F.col("event_type"), F.col("user_id").cast("string")).alias("tags"),
        F.when(F.col("event_type") != "error", k).alias("v"),
    )
    rows = base.table(spark, sf, "events").select(record.alias("record"))
    return flatten_records(rows, "record", 1)


def json_records_path(spark: SparkSession, sf: str) -> DataFrame:
    """Event payloads ``{"data": {"items": [{"row": props}, ..]}}`` opened at ``data.items``."""
    kind = "struct<data:struct<items:array<struct<row:struct<k:bigint>, n:bigint>>>>"
    payload = F.concat(
        F.lit('{"data": {"items": [{"row": '), F.col("props"), F.lit(', "n": 1}, {"row": '),
        F.col("props"), F.lit(', "n": 2}]}}'),
    )
    docs = base.table(spark, sf, "events").select("event_id", F.from_json(payload, kind).alias("doc"))
    records = explode_path(docs.select("event_id", "doc.*"), "data.items", ("event_id",))
    return flatten_records(records, "record", 1, keep=("event_id",))


# Fixed cases of the filter language: operator -> (column, value, SQL condition).
FILTERS: dict[str, tuple[str, object, str]] = {
    "eq": ("kind", "click", "kind = 'click'"),
    "ne": ("kind", "click", "kind <> 'click'"),
    "in": ("kind", ["click", "purchase"], "kind IN ('click', 'purchase')"),
    "not_in": ("kind", ["view", "click"], "kind NOT IN ('view', 'click')"),
    "gt": ("amount", 30, "TRY_CAST(amount AS DOUBLE) > 30"),
    "gte": ("amount", 12.31, "TRY_CAST(amount AS DOUBLE) >= 12.31"),
    "lt": ("amount", 30, "TRY_CAST(amount AS DOUBLE) < 30"),
    "lte": ("amount", 12.31, "TRY_CAST(amount AS DOUBLE) <= 12.31"),
    "is_null": ("amount", None, "amount IS NULL"),
    "not_null": ("kind", None, "kind IS NOT NULL"),
    "regex": ("amount", r"[13579]\.\d5", r"regexp_matches(amount, '[13579]\.\d5')"),
    "not_regex": ("kind", "^[cv]", "NOT regexp_matches(kind, '^[cv]')"),
}


def _filter_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    column, value, _ = FILTERS[name]

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return dsl.filter_rows(base.text_events(spark, sf), column, name, value)

    return query


def dsl_chain(spark: SparkSession, sf: str) -> DataFrame:
    steps = [
        {"op": "filter", "column": "kind", "operator": "in", "value": ["click", "purchase"]},
        {"op": "filter", "column": "amount", "operator": "gte", "value": 10},
        {"op": "drop_columns", "columns": ["props", "not_there"]},
        {"op": "rename", "mapping": {"user_id": "person", "event_id": "code"}},
        {"op": "select_columns", "columns": ["person", "code", "amount"]},
    ]
    return dsl.apply_steps(base.text_events(spark, sf), steps)


def pick_column(spark: SparkSession, sf: str) -> DataFrame:
    """Columns found by pattern, typed; a pattern without a match gives a typed NULL."""
    rows = t.to_text_frame(base.table(spark, sf, "orders"))
    names = rows.columns
    key = dsl.require_column(names, ["^code$", "orderkey$"], "order key")
    return rows.select(
        t.typed_column(key, "bigint").alias("order_key"),
        t.typed_column(dsl.pick_column(names, ["^price", "total.*price"]), "numeric")
        .cast("double")
        .alias("price"),
        t.typed_column(dsl.pick_column(names, ["status"])).alias("status"),
        t.typed_column(dsl.pick_column(names, ["discount"]), "numeric")
        .cast("double")
        .alias("discount"),
        t.typed_column(dsl.pick_column(names, ["^nothing$"]), "int").alias("nothing"),
    )


def latest_partition_rows(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    user = F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" "))
    loads = base.table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", F.lit("  ")).otherwise(user).alias("part"),
        kind.alias("_source_file"),
        F.date_format("ts", "yyyy-MM-dd").alias("_batch_id"),
        F.col("ts").alias("_ingested_at"),
    )
    return latest_partition(loads, "part")


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Customers landed as two files with different columns; both cover the whole table."""
    customers = base.table(spark, sf, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    old = customers.where(building).select("c_custkey", "c_name", "c_acctbal")
    new = customers.where(~building).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return old.unionByName(new, allowMissingColumns=True)


QUERIES = {
    "safe_casts": safe_casts,
    "normalize_names": normalize_names,
    "normalize_headers": normalize_headers,
    "to_text_rows": to_text_rows,
    "to_text_events": to_text_events,
    "row_hashes": row_hashes,
    "json_flatten": json_flatten,
    "json_records_path": json_records_path,
    **{f"dsl_{name}": _filter_query(name) for name in FILTERS},
    "dsl_chain": dsl_chain,
    "pick_column": pick_column,
    "latest_partition": latest_partition_rows,
    "union_by_name": union_by_name,
}

DIRTY_SQL = r"""
dirty AS (
  SELECT event_id,
    CASE event_type WHEN 'view' THEN event_id::VARCHAR
      WHEN 'click' THEN '  ' || event_id::VARCHAR || ' ' WHEN 'purchase' THEN event_id::VARCHAR || '.0'
      WHEN 'error' THEN 'x' || event_id::VARCHAR ELSE '  ' END AS int_text,
    CASE event_type WHEN 'view' THEN value::DECIMAL(18,2)::VARCHAR
      WHEN 'click' THEN 'R$ ' || replace(value::DECIMAL(18,2)::VARCHAR, '.', ',')
      WHEN 'purchase' THEN '1.' || substr(lpad(event_id::VARCHAR, greatest(3, length(event_id::VARCHAR))::INTEGER, '0'), 1, 3) || ',50'
      WHEN 'error' THEN 'abc' END AS num_text,
    CASE event_type WHEN 'view' THEN ts::VARCHAR WHEN 'click' THEN strftime(ts, '%d/%m/%Y')
      WHEN 'purchase' THEN strftime(ts, '%m-%d-%Y') WHEN 'error' THEN '2024-02-30' ELSE '' END
      AS date_text,
    CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 'click' THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
      WHEN 'purchase' THEN strftime(ts, '%d.%m.%YT%H:%M:%S')
      WHEN 'error' THEN '2024-13-01 00:00:00' END AS time_text
  FROM events),
stripped AS (
  SELECT *, regexp_replace(trim(num_text), 'R\$|\s', '', 'g') AS bare,
    regexp_replace(date_text, '^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$', '\3-\2-\1') AS dmy,
    regexp_replace(date_text, '^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$', '\3-\1-\2') AS mdy,
    regexp_replace(time_text, '^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})[ T](.+)$', '\3-\2-\1 \4') AS dmyt
  FROM dirty)"""


def _date_guard(expr: str) -> str:
    return rf"CASE WHEN regexp_full_match({expr}, '\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN TRY_CAST({expr} AS DATE) END"


def _time_guard(expr: str) -> str:
    return rf"CASE WHEN regexp_matches({expr}, '^\d{{4}}-\d') THEN TRY_CAST({expr} AS TIMESTAMP) END"


_COMMA = "replace(replace(bare, '.', ''), ',', '.')"

ORACLE = {
    "safe_casts": f"""
WITH {DIRTY_SQL}
SELECT event_id, nullif(trim(int_text), '') AS clean,
  CASE WHEN regexp_full_match(trim(int_text), '[+-]?[0-9]+') THEN TRY_CAST(trim(int_text) AS BIGINT)
    END AS as_int,
  TRY_CAST(bare AS DOUBLE) AS as_dot, TRY_CAST({_COMMA} AS DOUBLE) AS as_comma,
  TRY_CAST(CASE WHEN contains(bare, ',') THEN {_COMMA} ELSE bare END AS DOUBLE) AS as_auto,
  {_date_guard("left(trim(date_text), 10)")} AS iso_date,
  {_date_guard("dmy")} AS dmy_date, {_date_guard("mdy")} AS mdy_date,
  {_time_guard("time_text")} AS iso_time, {_time_guard("dmyt")} AS dmy_time
FROM stripped""",
    "normalize_names": r"""
WITH a AS (SELECT doc_id, regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g') AS x FROM documents),
b AS (SELECT doc_id, lower(regexp_replace(x, '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS x FROM a),
c AS (SELECT doc_id, trim(regexp_replace(x, '[^a-z0-9]+', '_', 'g'), '_') AS x FROM b),
d AS (SELECT doc_id, CASE WHEN x = '' THEN 'col_' || (doc_id + 1) ELSE x END AS x FROM c)
SELECT doc_id, left(CASE WHEN regexp_matches(x, '^[0-9]') THEN 'c_' || x ELSE x END, 63) AS name FROM d""",
    "normalize_headers": """
SELECT o_orderkey AS order_key, o_custkey AS order_key_2, o_orderstatus AS order_key_3,
       o_totalprice AS preco_total_r, year(o_orderdate) AS c_2024_area_m2, o_orderpriority AS col_6
FROM orders""",
    "to_text_rows": """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
       o_totalprice::VARCHAR AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_orderpriority FROM orders""",
    "to_text_events": """
SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       round(value * 1000000, 9) AS big, round(value / 100000, 9) AS small,
       CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS flag, ts::DATE::VARCHAR AS day,
       lower(hex(event_type)) AS raw,
       '{"user": ' || user_id || ', "tags": ["' || event_type || '", "a:b, c"]}' AS nested,
       value::DECIMAL(18,4)::VARCHAR AS exact FROM events""",
    "row_hashes": r"""
SELECT c_custkey, sha256(c_custkey || chr(31) || c_name || chr(31) || c_nationkey || chr(31) ||
         c_acctbal::DECIMAL(18,2)::VARCHAR || chr(31) ||
         CASE WHEN c_mktsegment = 'MACHINERY' THEN chr(30) || '~' ELSE c_mktsegment END) AS digest,
       16::BIGINT AS short_length FROM customer""",
    "json_flatten": """
SELECT event_id::VARCHAR AS id, event_type AS cat_kind,
       '{"k": ' || json_extract_string(props, '$.k') || ', "user": ' || user_id || '}' AS cat_sub,
       '["' || event_type || '", "' || user_id || '"]' AS tags,
       CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS v FROM events""",
    "json_records_path": """
SELECT event_id, json_extract_string(props, '$.k') AS row_k, n::VARCHAR AS n
FROM events, (VALUES (1), (2)) v(n)""",
    **{
        f"dsl_{name}": f"WITH {base.TEXT_EVENTS_SQL} SELECT * FROM texts WHERE {test}"
        for name, (_, _, test) in FILTERS.items()
    },
    "dsl_chain": f"""
WITH {base.TEXT_EVENTS_SQL}
SELECT user_id AS person, event_id AS code, amount FROM texts
WHERE kind IN ('click', 'purchase') AND TRY_CAST(amount AS DOUBLE) >= 10""",
    "pick_column": """
SELECT o_orderkey AS order_key, o_totalprice AS price, o_orderstatus AS status,
       NULL::DOUBLE AS discount, NULL::INTEGER AS nothing FROM orders""",
    "latest_partition": """
WITH loads AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN '  ' ELSE ' ' || user_id || ' ' END AS part,
         event_type AS _source_file, strftime(ts, '%Y-%m-%d') AS _batch_id, ts AS _ingested_at
  FROM events),
wins AS (
  SELECT trim(part) AS p, _source_file AS f, _batch_id AS b FROM loads WHERE trim(part) <> ''
  QUALIFY row_number() OVER (PARTITION BY trim(part)
                             ORDER BY _ingested_at DESC, _source_file DESC, _batch_id DESC) = 1)
SELECT loads.* FROM loads JOIN wins ON trim(part) = p AND _source_file = f AND _batch_id = b""",
    "union_by_name": """
SELECT c_custkey, c_name, c_acctbal, NULL AS c_mktsegment, NULL AS c_nationkey
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT c_custkey, c_name, NULL, c_mktsegment, c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING'""",
}
