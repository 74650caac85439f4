from __future__ import annotations

import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from cohortlake.functions import measures as m
from cohortlake.functions import text as t
from cohortlake.functions.names import identifier_column, normalize_columns, normalize_identifier
from cohortlake.sources.json_records import RecordsPathError, explode_path, flatten_records

NAMES = [
    ("Tree Height", 0, "tree_height"),
    ("crownWidth", 0, "crown_width"),
    ("Höhe & Façade", 0, "hohe_facade"),
    ("3rd ring", 0, "c_3rd_ring"),
    ("", 6, "col_7"),
    ("?!", 1, "col_2"),
    ("z" * 90, 0, "z" * 63),
    ("--bark-", 0, "bark"),
]


def test_identifiers_on_the_driver_and_as_data(spark):
    assert [normalize_identifier(n, i) for n, i, _ in NAMES] == [w for *_, w in NAMES]
    df = spark.createDataFrame([(n, i) for n, i, _ in NAMES], "name string, at int")
    rows = df.select(identifier_column(F.col("name"), F.col("at"))).collect()
    assert [r[0] for r in rows] == [w for *_, w in NAMES]


def test_repeated_names_are_numbered_within_the_limit():
    assert normalize_columns(["Age", "AGE", "age", "Age "]) == ["age", "age_2", "age_3", "age_4"]
    assert normalize_columns(["a_2", "a", "a"]) == ["a_2", "a", "a_3"]
    long = normalize_columns(["y" * 80, "y" * 80])
    assert [len(n) for n in long] == [63, 63] and long[1].endswith("_2")


def test_text_form_of_every_type(spark):
    row = (
        float("nan"), "\0oak\0", False, -7, 0.25, Decimal("3.10"), date(1999, 12, 31),
        datetime(1999, 12, 31, 23, 59, 8), datetime(1999, 12, 31, 23, 59, 8, 9), b"\xab\x00", {"k": [5]},
        1e20, 12345678.25, 1.5e-7, None,
    )
    schema = (
        "nan double, s string, b boolean, i int, d double, e decimal(10,2), dt date, ts timestamp, "
        "us timestamp, bin binary, js map<string,array<int>>, big double, mid double, tiny double, "
        "none bigint"
    )
    out = t.to_text_frame(spark.createDataFrame([row], schema)).first()
    assert list(out) == [
        None, "oak", "false", "-7", "0.25", "3.10", "1999-12-31", "1999-12-31 23:59:08",
        "1999-12-31 23:59:08.000009", "ab00", '{"k": [5]}', "1e+20", "12345678.25", "1.5e-07", None,
    ]


def test_casts_never_fail(spark):
    values = ["12", " 7 ", "1.0", "1e3", "abc", "", None, "R$ 1.234,50", "1234.5", "7,00"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    x = F.col("x")
    got = df.select(t.to_int(x), t.to_numeric(x), t.to_numeric(x, ","), t.to_numeric(x, "auto"))
    rows = [[None if v is None else float(v) for v in r] for r in got.collect()]
    assert [r[0] for r in rows] == [12, 7, None, None, None, None, None, None, None, None]
    assert [r[1] for r in rows] == [12, 7, 1, 1000, None, None, None, None, 1234.5, None]
    assert rows[7][2:] == [1234.5, 1234.5] and rows[8][2:] == [12345, 1234.5] and rows[9][3] == 7


@pytest.mark.parametrize(
    ("text", "fmt", "want"),
    [
        ("2024-02-29 10:00", "iso", date(2024, 2, 29)),
        ("2024-02-30", "iso", None),
        ("2024", "iso", None),
        ("31/12/2024", "dmy", date(2024, 12, 31)),
        ("12.31.2024", "mdy", date(2024, 12, 31)),
        ("31-12-2024", "mdy", None),
    ],
)
def test_dates(spark, text, fmt, want):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(t.to_date(F.col("x"), fmt)).first()[0] == want


def test_timestamps_and_local_time(spark):
    df = spark.createDataFrame([("05/01/2024 03:04:05", "2024-01-05T03:04:05")], "a string, b string")
    got = df.select(
        t.to_timestamp(F.col("a"), "dmy"),
        t.to_timestamp(F.col("b")),
        m.local_time(t.to_timestamp(F.col("b")), "America/Cuiaba"),
    ).first()
    assert got[0] == got[1] == datetime(2024, 1, 5, 3, 4, 5)
    assert got[2] == datetime(2024, 1, 4, 23, 4, 5)


def test_bands_labels_and_typed_columns(spark):
    df = spark.createDataFrame([(" sc ", "1"), ("6", "9"), ("3", None)], "band string, code string")
    rows = df.select(
        t.score_band(F.col("band")),
        t.band_label(t.score_band(F.col("band")), "none", "special"),
        t.code_label(t.to_int(F.col("code")), {1: "one"}),
        t.typed_column(None, "numeric"),
        t.typed_column("code", "int"),
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("SC", "special", "one", None, 1),
        (None, "none", None, None, 9),
        ("3", "3", None, None, None),
    ]
    assert rows.schema[3].dataType.simpleString() == "decimal(38,10)"


def test_published_rates_of_the_golden_rows(spark):
    cases = [(28719, 118979, 24.14), (1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (1, 800, 0.13), (5, 0, None)]
    df = spark.createDataFrame(cases, "num bigint, den bigint, want double")
    for row in df.withColumn("got", m.rate(F.col("num"), F.col("den"))).collect():
        assert row["got"] == row["want"]
    negative = spark.range(1).select(m.rate(F.lit(-1), F.lit(800)), m.rate(F.lit(None).cast("int"), F.lit(8)))
    assert list(negative.first()) == [-0.13, None]
    huge = spark.range(1).select(m.rate(F.lit(10**17 + 1), F.lit(2 * 10**17)))
    assert huge.first()[0] == 50.0


def test_masks_shares_and_guarded_correlation(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 9, 10, None)], "n int")
    assert [r[0] for r in df.select(m.mask_count(F.col("n"))).collect()] == [0, None, None, 10, None]
    pairs = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0), (4, None)], "x int, y double")
    got = pairs.agg(
        m.pearson(F.col("x"), F.col("y")), m.pearson(F.lit(1), F.col("y")), F.count("y")
    ).first()
    assert list(got) == [1.0, None, 3]
    shares = spark.createDataFrame([(3, 2), (1, 4), (1, 0), (None, 4)], "a int, b int")
    values = [r[0] for r in shares.select(m.share(F.col("a"), F.col("b"))).collect()]
    assert [None if v is None else float(v) for v in values] == [1.0, 0.25, None, None]


def test_weighted_percentage_falls_back_to_the_mean(spark):
    both = spark.createDataFrame([(21, 30, 70.0), (10, 25, 40.0), (5, 9, None)], "h int, n int, p double")
    pct = m.weighted_percentage(F.col("h"), F.col("n"), F.col("p"))
    assert float(both.agg(pct).first()[0]) == pytest.approx(100 * 31 / 55)
    no_hits = both.withColumn("h", F.lit(None).cast("int"))
    assert float(no_hits.agg(pct).first()[0]) == pytest.approx((70 * 30 + 40 * 25) / 55)


def test_flatten_and_paths(spark):
    raw = '{"id": 1, "cat": {"dep": "x", "sub": {"x": 1}}, "tags": ["a", "b"], "v": null}'
    kind = "struct<id:int, cat:struct<dep:string, sub:struct<x:int>>, tags:array<string>, v:string>"
    df = spark.createDataFrame([(raw,)], "j string").select(F.from_json("j", kind).alias("record"))
    row = flatten_records(df, "record", 1).first().asDict()
    assert row == {"id": "1", "cat_dep": "x", "cat_sub": '{"x": 1}', "tags": '["a", "b"]', "v": None}
    nested = df.select(F.struct(F.array("record").alias("items")).alias("data"))
    assert explode_path(nested, "data.items").count() == 1
    assert explode_path(nested, "data.items.0").count() == 1
    assert explode_path(nested, "absent").count() == 0
    with pytest.raises(RecordsPathError):
        explode_path(df.select("record.*"), "id")
    assert spark.range(1).select(t.json_path(F.lit(raw), "cat.sub.x"), t.json_path(F.lit(raw), "tags.1")).first()[:] == ("1", "b")


def test_row_hash_tells_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("x", "a")], "p string, q string")
    rows = [r[0] for r in df.select(t.row_hash(["p", "q"])).collect()]
    assert len(set(rows)) == 3 and all(len(r) == 16 for r in rows)


def test_rates_and_float_texts_of_random_values(spark):
    rng = random.Random(11)
    pairs = [(rng.randint(0, 10 ** rng.randint(1, 15)), rng.randint(1, 10 ** rng.randint(1, 15))) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    getcontext().prec = 60
    for r in df.select("a", "b", m.exact_rate(F.col("a"), F.col("b")).alias("x")).collect():
        assert r["x"] == (Decimal(100 * r["a"]) / r["b"]).quantize(Decimal("0.01"), ROUND_HALF_UP)
    floats = [round(rng.uniform(-1e9, 1e9), rng.randint(0, 4)) for _ in range(2000)]
    floats += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)]
    texts = t.to_text_frame(spark.createDataFrame([(x,) for x in floats], "x double")).collect()
    assert [float(r["x"]) for r in texts] == floats
    assert [r["x"] for r in texts[:2000]] == [repr(x) for x in floats[:2000]]
