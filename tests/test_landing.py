from __future__ import annotations

import gzip
import io
import lzma
import os
import subprocess
import sys
import zipfile
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortlake.operators.latest import latest_partition
from cohortlake.plans.landing import Lake, LandingError, Source, VolumeCheck, profile
from cohortlake.plans.ops import optional_parquet
from cohortlake.sources import delimited
from cohortlake.sources.decoded import DecodeOptions
from cohortlake.streaming.incremental import land_available


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_append_loads_each_content_once(lake, landing):
    source = Source("felled", str(landing), essential=("season",))
    (landing / "a.csv").write_text("season,trees\nspring,14\nspring,9\n")
    assert lake.load(source)["rows_loaded"] == 2
    (landing / "b.csv").write_text("season,trees\nautumn,31\n")
    again = lake.load(source)
    assert (again["rows_loaded"], again["units_skipped"]) == (1, 1)
    (landing / "renamed copy.csv").write_text("season,trees\nautumn,31\n")
    idle = lake.load(source)
    assert (idle["rows_loaded"], idle["units_skipped"]) == (0, 3)
    assert rows(lake.bronze(source), "season", "trees") == [("autumn", "31"), ("spring", "14"), ("spring", "9")]
    hashes = lake.bronze(source).select(F.length("_row_hash")).distinct().collect()
    assert [h[0] for h in hashes] == [16]


def test_full_load_replaces_and_logs_new_columns(lake, landing):
    source = Source("drift", str(landing), strategy="full")
    (landing / "a.csv").write_text("id\n1\n")
    assert lake.load(source)["new_columns"] == ["id"]
    (landing / "a.csv").write_text("id,Bark Colour\n2,grey\n")
    assert lake.load(source)["new_columns"] == ["bark_colour"]
    assert rows(lake.bronze(source), "id", "bark_colour") == [("2", "grey")]
    log = lake.ops.read("schema_changes")
    assert rows(log, "column_name") == [("bark_colour",), ("id",)]


def test_full_load_never_empties_the_table(lake, landing):
    source = Source("keep", str(landing), strategy="full")
    (landing / "a.csv").write_text("id\n1\n")
    lake.load(source)
    (landing / "a.csv").write_text("id\n")
    with pytest.raises(LandingError, match="without rows"):
        lake.load(source)
    (landing / "a.csv").unlink()
    with pytest.raises(LandingError, match="nothing at"):
        lake.load(source)
    assert rows(lake.bronze(source), "id") == [("1",)]
    assert rows(lake.ops.read("ingestion_runs"), "status") == [("failed",), ("failed",), ("success",)]


def test_file_without_essential_column_stays_out(lake, landing):
    source = Source("plots", str(landing), essential=("plot", "girth"))
    for name, header in (("north", "plot,girth"), ("south", "plot,height"), ("west", "plot,girth")):
        (landing / f"{name}.csv").write_text(f"{header}\n{name}-1,4\n")
    with pytest.raises(LandingError, match="south.csv lacks essential columns .'girth'"):
        lake.load(source)
    assert rows(lake.bronze(source), "plot") == [("north-1",)]


@pytest.mark.parametrize(("action", "visible"), [("fail", 40), ("warn", 130)])
def test_an_unusual_volume_is_reported_or_refused(lake, landing, action, visible):
    check = VolumeCheck(lookback_runs=4, min_history=2, max_ratio=3.0, action=action)
    source = Source("census", str(landing), strategy="full", volume=check)
    for n in (38, 42, 40):
        (landing / "trees.csv").write_text("tree\n" + "fir\n" * n)
        assert lake.load(source)["warnings"] == []
    (landing / "trees.csv").write_text("tree\n" + "elm\n" * 130)
    if action == "fail":
        with pytest.raises(LandingError, match="130 rows against a median of 40"):
            lake.load(source)
    else:
        assert len(lake.load(source)["warnings"]) == 1
    assert lake.bronze(source).count() == visible
    event = lake.ops.read("data_quality_events").first()
    assert event["severity"] == {"fail": "error", "warn": "warning"}[action]
    assert '"ratio": 3.25' in event["detail"]


def test_steps_of_a_source(lake, landing):
    (landing / "heights.csv").write_text("Tree;Height;Soil\noak;30;clay\nelm;7;sand\nfir;12;\nyew;25;clay\n")
    steps = (
        {"op": "filter", "column": "height", "operator": "gte", "value": 10},
        {"op": "drop_columns", "columns": ["soil"]},
        {"op": "rename", "mapping": {"height": "metres"}},
    )
    source = Source("steps", str(landing), steps=steps)
    result = lake.load(source)
    assert (result["rows_extracted"], result["rows_filtered"], result["rows_loaded"]) == (4, 1, 3)
    assert lake.columns("steps") == ["tree", "metres"]
    assert rows(lake.bronze(source), "tree", "metres") == [("fir", "12"), ("oak", "30"), ("yew", "25")]


def test_dialects_encodings_and_title_lines(lake, landing):
    (landing / "a.csv").write_bytes("Höhe;Baum;Umfang\n0012;Weißdorn;0,75\n0013;Öl €;1\n".encode("cp1252"))
    (landing / "b.txt").write_bytes("hohe\tbaum\n0014\tΔέντρο\n".encode("utf-16"))
    (landing / "c d.csv").write_bytes(
        "Forest survey, spring\n\nHOHE;BAUM;UMFANG\n15;Eiche;2\n16;\"Ulme; \"\"alt\"\"\";3\n".encode("cp1252")
    )
    (landing / "e.csv.gz").write_bytes(gzip.compress(b"hohe,baum\n17,NULL\n18,\"tall\nand old\"\n"))
    (landing / "~$open.csv").write_text("hohe\n99\n")
    source = Source("dialects", str(landing), decode=DecodeOptions(skip_rows="auto"))
    lake.load(source)
    assert rows(lake.bronze(source), "hohe", "baum") == [
        ("0012", "Weißdorn"),
        ("0013", "Öl €"),
        ("0014", "Δέντρο"),
        ("15", "Eiche"),
        ("16", 'Ulme; "alt"'),
        ("17", "NULL"),
        ("18", "tall\nand old"),
    ]


def zipped(**members):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for name, text in members.items():
            z.writestr(f"deep/{name}.CSV", text)
        z.writestr("deep/readme.txt", "nothing")
    return blob.getvalue()


@pytest.mark.parametrize("line", ["3,4,", "5,6,,9", "5,6,7", '"5,5",6,"a,b"', ",,"])
@pytest.mark.parametrize("packed", [False, True])
def test_surplus_fields_stop_both_readers(lake, landing, line, packed):
    text = f"a,b\n1,2\n{line}\n"
    if packed:
        (landing / "wide.zip").write_bytes(zipped(wide=text))
    else:
        (landing / "wide.csv").write_text(text)
    with pytest.raises(Exception, match="wider than its header|fields under 2 headers"):
        lake.load(Source("wide", str(landing), decode=DecodeOptions(sep=",", member_pattern="*.csv")))
    assert lake.ops.read("file_manifest").count() == 0


def test_short_and_quoted_records_are_no_surplus(lake, landing):
    (landing / "a.csv").write_text('a,b\n1\n"x,y","say ""a,b"" twice"\n,\n')
    source = Source("short", str(landing), decode=DecodeOptions(sep=","))
    lake.load(source)
    got = {(r.a, r.b) for r in lake.bronze(source).collect()}
    assert got == {("1", None), ("x,y", 'say "a,b" twice'), (None, None)}


def test_packed_files_leave_plain_ones_to_the_native_reader(lake, landing, monkeypatch):
    (landing / "a.csv").write_text("tree,height\noak,30\n")
    (landing / "b.csv.xz").write_bytes(lzma.compress(b"tree,age\nelm,14\n"))
    (landing / "c.csv.gz").write_bytes(gzip.compress(b"tree,height\nfir,12\n"))
    (landing / "d.zip").write_bytes(zipped(d="tree,height\nyew,5\n"))
    seen = []
    native = delimited.read_layout
    monkeypatch.setattr(delimited, "read_layout", lambda spark, paths, *a, **k: seen.extend(paths) or native(spark, paths, *a, **k))
    source = Source("mixed", str(landing), decode=DecodeOptions(member_pattern="*.csv"))
    assert lake.load(source)["rows_loaded"] == 4
    assert {p.rsplit("/", 1)[1] for p in seen} == {"a.csv", "c.csv.gz"}
    got = {(r.tree, r.height, r.age) for r in lake.bronze(source).collect()}
    assert got == {("oak", "30", None), ("elm", None, "14"), ("fir", "12", None), ("yew", "5", None)}


def test_broken_json_is_named_and_not_recorded(lake, landing):
    (landing / "good.json").write_text('[{"v": 1}]')
    (landing / "cut.json").write_text('[{"v": 2}, {"v"')
    source = Source("j", str(landing), kind="json", strategy="append")
    with pytest.raises(Exception, match="cut.json|MALFORMED|Malformed"):
        lake.load(source)
    assert lake.ops.read("file_manifest").count() == 0
    (landing / "cut.json").write_text('[{"v": 2}, {"v": 3}]')
    lake.load(source)
    assert rows(lake.bronze(source), "v") == [("1",), ("2",), ("3",)]


def test_essential_columns_of_each_json_file(lake, landing):
    (landing / "a.json").write_text('[{"v": 1, "w": "x"}]')
    (landing / "b.json").write_text('[{"w": "y"}]')
    source = Source("j", str(landing), kind="json", essential=("v",))
    with pytest.raises(LandingError, match="b.json lacks essential columns"):
        lake.load(source)
    assert rows(lake.bronze(source), "v", "w") == [("1", "x")]


def test_settle_window_and_json(lake, landing):
    (landing / "p.json").write_text('{"data": {"items": [{"id": 1, "cat": {"dep": "x", "sub": {"y": 1}}}, {"id": 2}]}}')
    young = Source("j", str(landing), kind="json", records_path="data.items", min_age_seconds=3600)
    assert lake.load(young)["units_processed"] == 0
    source = replace(young, min_age_seconds=0, strategy="full")
    lake.load(source)
    assert rows(lake.bronze(source).na.fill("-"), "id", "cat_dep", "cat_sub") == [
        ("1", "x", '{"y": 1}'),
        ("2", "-", "-"),
    ]


def test_stream_skips_content_seen_under_another_name(lake, landing, tmp_path):
    source = Source("stream", str(landing))
    checkpoint = str(tmp_path / "checkpoint")
    (landing / "a.csv").write_text("tree\noak\nelm\n")
    land_available(lake, source, checkpoint)
    (landing / "again.csv").write_text("tree\noak\nelm\n")
    (landing / "b.csv").write_text("tree\nfir\n")
    (landing / "b2.csv").write_text("tree\nfir\n")
    land_available(lake, source, checkpoint)
    land_available(lake, source, checkpoint)
    assert rows(lake.bronze(source), "tree") == [("elm",), ("fir",), ("oak",)]


def test_stream_takes_settled_files_later_and_rewritten_ones_again(lake, landing, tmp_path):
    source = Source("stream", str(landing), min_age_seconds=3600)
    checkpoint = str(tmp_path / "checkpoint")
    file = landing / "a.csv"
    file.write_text("tree\noak\n")
    land_available(lake, source, checkpoint)
    assert lake.ops.read("file_manifest").count() == 0
    past = file.stat().st_mtime - 7200
    os.utime(file, (past, past))
    land_available(lake, source, checkpoint)
    assert rows(lake.bronze(source), "tree") == [("oak",)]
    file.write_text("tree\noak\nyew\n")
    os.utime(file, (past, past))
    land_available(lake, source, checkpoint)
    assert lake.ops.read("file_manifest").count() == 2
    assert ("yew",) in rows(lake.bronze(source), "tree")


def test_purge_and_profile(spark, lake, landing):
    (landing / "a.csv").write_text("id,x\n1,\n2,y\n")
    source = Source("p", str(landing))
    lake.load(source)
    views = {name: df.count() for name, df in lake.ops.views().items()}
    assert views == {"publications": 0, "runs": 1, "files": 1, "columns": 2}
    absent = optional_parquet(spark, str(landing / "nowhere"), "id string, n bigint")
    assert absent.count() == 0 and absent.columns == ["id", "n"]
    assert lake.ops.purge(0)["ingestion_runs"] == 1
    assert lake.ops.read("ingestion_runs").count() == 0
    found = rows(profile(lake.bronze(source).select("id", "x")), "column", "nu_rows", "nu_missing")
    assert found == [("id", 2, 0), ("x", 2, 1)]


def test_purge_drops_whole_appends_by_the_age_of_their_rows(lake):
    now = datetime.now(timezone.utc)
    for age in (0, 5, 40, 41):
        lake.ops.append("ingestion_runs", [{"run_id": str(age), "started_at": now - timedelta(days=age)}])
    mixed = [{"run_id": f"mixed{age}", "started_at": now - timedelta(days=age)} for age in (50, 2)]
    lake.ops.append("ingestion_runs", mixed)
    assert lake.ops.purge(30, ["ingestion_runs"]) == {"ingestion_runs": 2}
    assert rows(lake.ops.read("ingestion_runs"), "run_id") == [("0",), ("5",), ("mixed2",), ("mixed50",)]
    assert lake.ops.purge(30, ["ingestion_runs", "schema_changes"]) == {"ingestion_runs": 0, "schema_changes": 0}


WRITER = """
import sys
from datetime import datetime, timezone
from pyspark.sql import SparkSession
from cohortlake.plans.ops import Ops
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ops = Ops(spark, sys.argv[1])
print("ready", flush=True)
for i in range(12):
    ops.append("ingestion_runs", [{"run_id": f"other{i}", "started_at": datetime.now(timezone.utc)}])
spark.stop()
"""


def test_two_processes_append_and_purge_at_once(lake):
    """No append is lost, whoever commits or purges meanwhile."""
    old = datetime.now(timezone.utc) - timedelta(days=90)
    for i in range(3):
        lake.ops.append("ingestion_runs", [{"run_id": f"old{i}", "started_at": old}])
    other = subprocess.Popen([sys.executable, "-c", WRITER, lake.root], stdout=subprocess.PIPE, cwd=Path(__file__).parents[1])
    assert other.stdout.readline() == b"ready\n"
    removed = 0
    for i in range(12):
        lake.ops.append("ingestion_runs", [{"run_id": f"own{i}", "started_at": datetime.now(timezone.utc)}])
        removed += lake.ops.purge(30, ["ingestion_runs"])["ingestion_runs"]
    assert other.wait(timeout=120) == 0
    kept = {r["run_id"] for r in lake.ops.read("ingestion_runs").collect()}
    assert removed == 3 and kept == {f"{who}{i}" for who in ("own", "other") for i in range(12)}


def test_latest_versions_come_from_the_index(spark, lake, landing):
    source = Source("editions", str(landing), partition="season", decode=DecodeOptions(sep=","))
    (landing / "one.csv").write_text("season,tree\nspring,oak\n autumn ,elm\n,none\n")
    lake.load(source)
    (landing / "two.csv").write_text("season,tree\nspring,fir\nspring,yew\n")
    lake.load(source)
    (landing / "three.csv").write_text("season,tree\nwinter,ash\n")
    (landing / "four.csv").write_text("season,tree\nwinter,lime\n")
    lake.load(source)
    got = lake.latest(source)
    assert rows(got, "season", "tree") == [(" autumn ", "elm"), ("spring", "fir"), ("spring", "yew"), ("winter", "ash")]
    want = latest_partition(lake.bronze(source), "season")
    assert rows(got, "season", "tree") == rows(want, "season", "tree")
    # only folders of winning batches are scanned
    (landing / "five.csv").write_text("season,tree\n" + "".join(f"{s},new\n" for s in ("spring", "autumn", "winter")))
    lake.load(source)
    final = lake.latest(source)
    plan = final._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "tree" in line)
    assert "_batch_id" in scan.split("PartitionFilters")[1]
    assert {r["_batch_id"] for r in final.collect()} == {max(r["run_id"] for r in lake.ops.read("file_manifest").where("file_uri like '%five.csv'").collect())}
    assert rows(final, "tree") == [("new",)] * 3
    full = replace(source, name="whole", strategy="full")
    lake.load(full)
    assert rows(lake.latest(full), "season") == rows(latest_partition(lake.bronze(full), "season"), "season")
    with pytest.raises(ValueError, match="no partition column"):
        lake.latest(replace(source, partition=None))
