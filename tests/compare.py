"""Run queries beside their SQL oracle and compare names, row counts and values.

``python -m tests.compare SF_DIR [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(plain(r[i])) for i in order) for r in data)


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def compare(spark, con, sf: str, query, sql: str | None) -> tuple[str, float]:
    start = time.time()
    df = query(spark, sf)
    got = df.collect()
    seconds = time.time() - start
    if sql is None:
        return f"rows {len(got)}", seconds
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"COLUMNS {sorted(set(df.columns) ^ set(names))}", seconds
    a, b = rows(df.columns, got), rows(names, want)
    if a == b:
        return f"ok {len(got)}", seconds
    left, right = list((a - b).items())[:2], list((b - a).items())[:2]
    return (
        f"DIFF {len(got)} vs {len(want)} ({sum((a - b).values())})\n  {sorted(names)}"
        f"\n  spark {left}\n  sql   {right}",
        seconds,
    )


def main() -> None:
    import importlib

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    entry = importlib.import_module("__spark_entry__")
    from cohortlake.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf), entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            outcome, seconds = compare(spark, con, sf, query, oracles.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            outcome, seconds = f"ERROR {type(error).__name__} {str(error)[:700]}", 0.0
        print(f"{name:28s} {seconds:6.2f}s {outcome}", flush=True)


if __name__ == "__main__":
    main()
