from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.operators import checks, cohorts, consume, dsl, profiles, ranking
from cohortlake.operators.latest import latest_partition, latest_per_key


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def trees(spark):
    data = [
        ("oak", "north", "30.25", None),
        ("elm", "south", "7", "hollow"),
        (None, "north", "tall", "marked"),
        ("yew", None, None, "marked, old"),
        ("fir", "north", " 12 ", ""),
    ]
    return spark.createDataFrame(data, "tree string, site string, height string, note string")


@pytest.mark.parametrize(
    ("column", "op", "value", "want"),
    [
        ("site", "eq", "north", ["oak", None, "fir"]),
        ("site", "ne", "north", ["elm"]),
        ("tree", "in", ["elm", "fir", "ash"], ["elm", "fir"]),
        ("tree", "not_in", ["elm", "fir"], ["oak", "yew"]),
        ("height", "gt", 12, ["oak"]),
        ("height", "gte", "12", ["oak", "fir"]),
        ("height", "lt", 12, ["elm"]),
        ("height", "lte", 12.0, ["elm", "fir"]),
        ("note", "is_null", None, ["oak"]),
        ("note", "not_null", None, ["elm", None, "yew", "fir"]),
        ("note", "regex", "^mark", [None, "yew"]),
        ("note", "not_regex", "^mark", ["elm", "fir"]),
    ],
)
def test_filters(trees, column, op, value, want):
    assert [r["tree"] for r in dsl.filter_rows(trees, column, op, value).collect()] == want


def test_number_filters_ignore_what_only_looks_numeric(spark):
    texts = ["5", " 6 ", "7e0", "8d", "9f", "nan", "inf", "1_0", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "id string")
    assert [r[0] for r in dsl.filter_rows(df, "id", "gt", 4).collect()] == ["5", " 6 ", "7e0", "inf"]


def test_steps_in_order_and_errors(trees):
    steps = [
        {"op": "rename", "mapping": {"height": "metres", "site": "plot"}},
        {"op": "filter", "column": "metres", "operator": "gt", "value": 10},
        {"op": "select_columns", "columns": ["plot", "tree", "note"]},
        {"op": "drop_columns", "columns": ["note", "absent"]},
    ]
    assert rows(dsl.apply_steps(trees, steps)) == [("north", "oak"), ("north", "fir")]
    for bad in (
        {"op": "python", "code": "1"},
        {"op": "rename", "mapping": {"absent": "x"}},
        {"op": "select_columns", "columns": ["absent"]},
        {"op": "filter", "column": "absent", "operator": "eq", "value": 1},
        {"op": "filter", "column": "tree", "operator": "like", "value": 1},
    ):
        with pytest.raises(dsl.StepError):
            dsl.apply_steps(trees, [bad])
    with pytest.raises(dsl.StepError):
        dsl.require_column(["a"], ["^b$"], "key")


def test_exact_ntile_equals_the_window_even_with_one_hot_value(spark):
    rng = random.Random(7)
    data = [
        (rng.choice("abc"), 0 if rng.random() < 0.4 else rng.randint(0, 50), i) for i in range(997)
    ]
    df = spark.createDataFrame(data, "g string, v int, k int")
    order = [F.col("v").asc(), F.col("k").asc()]
    for partition in ([], ["g"]):
        got = ranking.exact_ntile(df, 4, order, partition, "q", ranges=7)
        window = Window.partitionBy(*partition).orderBy(*order)
        want = df.withColumn("q", F.ntile(4).over(window).cast("bigint"))
        assert sorted(rows(got)) == sorted(rows(want))
    few = ranking.exact_ntile(df.limit(3), 4, order, [], "q", ranges=2)
    assert sorted(r["q"] for r in few.collect()) == [1, 2, 3]


@pytest.mark.parametrize("most", [4, 50, 100_000])
@pytest.mark.parametrize("partition", [[], ["g"]])
def test_quantiles_by_narrowed_histograms(spark, most, partition):
    """Ties, skewed values, groups smaller than the buckets, values that differ beyond a double."""
    rows = [(g, v, k) for k, (g, v) in enumerate(
        [("a", round(Decimal(i % 7) / 7, 20)) for i in range(300)]
        + [("b", Decimal(10) ** (i % 30 - 15)) for i in range(211)]
        + [("c", Decimal(1)) for _ in range(90)]
        + [("c", Decimal("1.00000000000000000001")) for _ in range(30)]
        + [("d", Decimal(5)), ("d", Decimal(4)), ("e", Decimal(0))]
    )]
    df = spark.createDataFrame(rows, "g string, v decimal(38,20), k long").repartition(5)
    window = Window.partitionBy(*partition).orderBy("v", "k")
    want = {r["k"]: r["q"] for r in df.withColumn("q", F.ntile(4).over(window)).collect()}
    got = ranking.selected_ntile(df, 4, "v", "k", partition, "q", most)
    assert got.columns == ["g", "v", "k", "q"]
    assert {r["k"]: r["q"] for r in got.collect()} == want
    assert ranking.selected_ntile(df.limit(0), 4, "v", "k", partition, "q").count() == 0


def test_top_and_bottom_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 1, 1, 3])], "k int, v int")
    got = rows(ranking.top_and_bottom(df, "v", "k", 2))
    assert sorted(got) == [("bottom", 1, 3, 1), ("bottom", 2, 2, 1), ("top", 1, 0, 5), ("top", 2, 1, 5)]


def test_latest_version_replaces_only_its_partition(spark):
    data = [
        ("2019", "a.csv", "b1", 1, "old"),
        ("2020", "a.csv", "b1", 1, "kept"),
        (" 2019", "c.csv", "b2", 2, "new"),
        ("2019 ", "c.csv", "b2", 2, "new too"),
        (" ", "c.csv", "b2", 2, "blank"),
        (None, "c.csv", "b2", 2, "none"),
    ]
    schema = "ano string, _source_file string, _batch_id string, _ingested_at int, v string"
    got = latest_partition(spark.createDataFrame(data, schema), "ano")
    assert sorted(r["v"] for r in got.collect()) == ["kept", "new", "new too"]


def test_latest_row_per_key(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (2, 1, "c")], "k int, t int, v string")
    assert sorted(rows(latest_per_key(df, ["k"], [F.col("t")]))) == [(1, 3, "b"), (2, 1, "c")]


@pytest.fixture(scope="module")
def trajectory(spark):
    data = [
        # entity, mode, cohort, year, step, entrants, stayed, completed, dropped, excluded
        ("e1", "P", 2015, 2015, 1, 100, 90, 0, 10, 0),
        ("e1", "P", 2015, 2016, 2, 100, 75, 5, 9, 1),
        ("e1", "P", 2015, 2017, 3, 100, 55, 10, 10, 0),
        ("e1", "P", 2015, 2018, 4, 100, 40, 10, 4, 1),
        ("e2", "P", 2015, 2015, 1, 8, 8, 0, 0, 0),
        ("e2", "P", 2015, 2016, 2, 8, 5, 0, 3, 0),
        ("e3", "D", 2016, 2016, 1, 5, 5, 0, 0, 0),
    ]
    return spark.createDataFrame(
        data,
        "entity string, mode string, cohort int, ref_year int, step int, qt_entrants bigint, "
        "qt_stayed bigint, qt_completed bigint, qt_dropped bigint, qt_excluded bigint",
    )


def test_accumulation_milestone_and_report(trajectory):
    acc = cohorts.accumulate(trajectory)
    last = acc.where("entity = 'e1' and ref_year = 2018").first()
    assert (last["qt_dropped_acc"], last["qt_completed_acc"], last["qt_excluded_acc"]) == (33, 25, 2)
    assert (last["qt_base_acc"], last["last_year"]) == (98, 2018)
    snapshot = cohorts.milestone(acc, ["mode"])
    report = cohorts.milestone_report(snapshot, ["mode"]).collect()
    assert len(report) == 1
    row = report[0].asDict()
    assert (row["drop_rate_step"], row["completion_rate_step"]) == (33.67, 25.51)
    assert row["is_ranking_eligible"] and row["last_year"] == 2018
    early = {r["entity"]: r["has_step"] for r in snapshot.collect()}
    assert early == {"e1": True, "e2": False, "e3": False}


def test_curve_marks_every_tied_worst_year_and_masks(trajectory):
    curve = cohorts.curve(cohorts.accumulate(trajectory), "mode").orderBy("ref_year").collect()
    assert [(r["ref_year"], r["qt_entrants"], r["nu_entities"]) for r in curve] == [
        (2015, 108, 2), (2016, 108, 2), (2017, 100, 1), (2018, 100, 1),
    ]
    assert [r["is_worst_year"] for r in curve] == [False, True, False, False]
    assert [r["qt_completed"] for r in curve] == [0, None, 10, 10]
    assert curve[1]["drop_rate"] == 20.56 and curve[1]["yearly_drop_rate"] == 11.21


def test_area_label_of_missing_area(trajectory):
    df = trajectory.withColumn("area", F.when(F.col("entity") == "e1", "x"))
    got = cohorts.area_curve(cohorts.accumulate(df), "area", "mode", "none given")
    assert {r["area"] for r in got.collect()} == {"x"}
    all_areas = cohorts.area_curve(cohorts.accumulate(df), "area", "mode", "none given", min_cell=1)
    assert {r["area"] for r in all_areas.collect()} == {"x", "none given"}


def test_churn_lags_over_published_years_only(spark):
    data = [
        (2021, "n", 118979 - 28719, 0, 28719, 0),
        (2022, "n", 5, 0, 1, 0),
        (2023, "n", 90000, 500, 40000, 100),
    ]
    df = spark.createDataFrame(data, "y int, g string, e bigint, p bigint, l bigint, o bigint")
    got = cohorts.yearly_churn(df, "y", ["g"], "l", "e", "p", ["o"]).orderBy("y").collect()
    assert [r["y"] for r in got] == [2021, 2023]
    assert got[0]["churn_rate"] == 24.14 and got[0]["churn_change_pp"] is None
    assert got[1]["churn_change_pp"] == round(got[1]["churn_rate"] - 24.14, 2)
    assert got[1]["enrolled_change_pct"] == -0.29


def test_funnel_total_keeps_a_missing_group_apart(spark):
    data = [
        ("a", 100, 40, 30, 98, 30, 21, 70.0),
        ("a", 50, 10, 20, 50, 25, 10, 40.0),
        (None, 20, 5, 5, 20, None, None, None),
    ]
    schema = (
        "g string, qt_entrants bigint, qt_dropped_final bigint, qt_completed_final bigint, "
        "qt_base_final bigint, qt_participants bigint, qt_proficient bigint, pct_proficient double"
    )
    got = {r["g"]: r for r in profiles.funnel_with_total(spark.createDataFrame(data, schema), "g").collect()}
    assert set(got) == {"a", None, "Total"}
    assert got["Total"]["qt_entrants"] == 170 and got["Total"]["of_100_dropped"] == 32.74
    assert got["a"]["pct_proficient"] == 56.36
    assert got["a"]["of_100_proficient"] == round(33.78 * (3100 / 55) / 100, 2)
    assert got[None]["pct_proficient"] is None and got[None]["nu_with_exam"] == 0


def test_supply_gap_and_conditional_rate(spark):
    people = spark.createDataFrame([(1, "x", 1000), (1, "x", 1000), (2, "y", 500), (3, "z", 100)], "p int, n string, nu_population bigint")
    supply = spark.createDataFrame([(2023, "c1", 1, 40, 20), (2023, "c2", 3, 10, 5), (2022, "c9", 2, 9, 9)], "y int, e string, p int, s bigint, i bigint")
    got = {r["p"]: r for r in profiles.supply_gaps(people, supply, "p", "y", "e", "s", "i", "n").collect()}
    assert (got[1]["seats_per_100"], got[1]["i"], got[1]["entrants_per_100"]) == (2.0, 20, 1.0)
    assert got[2]["is_gap"] and got[2]["y"] == 2023 and got[2]["i"] == 0
    assert got[3]["i"] is None and got[3]["entrants_per_100"] is None and not got[3]["is_gap"]


def test_scale_is_repaired_from_the_greatest_value(spark):
    fractions = spark.createDataFrame([(0.5,), (1.0,), (None,)], "p double")
    assert rows(profiles.repair_scale(fractions, "p", "q")) == [(0.5, 50.0), (1.0, 100.0), (None, None)]
    percents = spark.createDataFrame([(0.5,), (70.0,)], "p double")
    assert rows(profiles.repair_scale(percents, "p", "q")) == [(0.5, 0.5), (70.0, 70.0)]


def test_checks_return_violations(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 20), (2, None, -1)], "k int, s string, qt_n int")
    assert rows(checks.unique_combination(df, ["k", "s"])) == [(1, "a", 2)]
    found = checks.run_row_checks(
        df,
        {
            "min": checks.min_value("qt_n"),
            "between": checks.between("qt_n", 0, 10),
            "null": checks.not_null("s"),
            "domain": checks.accepted_values("s", ["b"]),
            "cells": checks.small_cells(df.columns),
        },
    )
    assert dict(rows(found)) == {"min": 1, "between": 2, "null": 1, "domain": 2, "cells": 1}
    status = checks.suite([found, checks.count_violations("grain", checks.unique_combination(df, ["qt_n"]))])
    assert dict(rows(status.select("check", "status")))["grain"] == "pass"
    coverage = checks.join_coverage(df, "k", df.where("k = 1"), "k")
    assert rows(coverage) == [(2, 1, 0.5)]
    assert checks.coverage_below(coverage).count() == 1
    contract = T.StructType.fromDDL("k int, s string, qt_n bigint")
    assert checks.schema_differences(df, contract) == ["missing qt_n bigint", "unexpected qt_n int"]
    assert checks.schema_differences(df, df.schema) == []
    empty = df.where("false")
    assert rows(checks.sum_equal(df, "qt_n", empty, "qt_n")) == [(24, 0)]
    assert rows(checks.row_count_equal(df, df)) == []


def test_reading_steps(spark):
    df = spark.createDataFrame([(2015, 2016, 10.0, None), (2015, 2017, 20.0, 5.0), (2016, 2017, 1.0, 2.0)], "c int, r int, a double, b double")
    assert rows(consume.block_filters(df, {"c": "min", "absent": 1, "r": "all"}).select("r")) == [(2016,), (2017,)]
    assert consume.melt(df, ["a", "b"]).count() == 6
    assert rows(consume.headline(df, "c", "r")) == [(2015, 2017, 20.0, 5.0)]
    steps = consume.funnel_steps(df.where("c = 2015 and r = 2016"), {"a": "A", "b": "B"})
    assert [tuple(r)[2:] for r in steps.collect()] == [(0, "Enter", 100.0), (1, "A", 10.0)]
    same = consume.compare_counts({"t": df, "u": df}, {"t": df.limit(2)})
    assert sorted(rows(same)) == [("t", 3, 2, False), ("u", 3, None, False)]
