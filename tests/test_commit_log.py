"""Commits of several processes at once: publications, rollbacks and loads of the same files."""

from __future__ import annotations

import subprocess
import sys
import threading
from pathlib import Path
from types import SimpleNamespace

import pytest

from cohortlake.plans.commit_log import CommitLog
from cohortlake.plans.landing import Lake, Source
from cohortlake.plans.release import Publisher
from cohortlake.session import folder_of
from cohortlake.sources.decoded import DecodeOptions

PUBLISHER = """
import sys
from pyspark.sql import SparkSession
from cohortlake.plans.landing import Lake
from cohortlake.plans.release import Publisher
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
publisher = Publisher(Lake(spark, sys.argv[1]))
print("ready", flush=True)
for i in range(10):
    publisher.publish(f"other{i}", ["t"], [])
spark.stop()
"""


def test_a_number_is_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.head() == (0, None) and log.entries() == []
    assert log.update(lambda _: None) == (None, None)
    assert log.try_append(1, {"n": "ä"})
    assert not log.try_append(1, {"n": "b"})
    assert log.head() == (1, {"n": "ä"})
    seen = []

    def change(entry):
        seen.append(entry)
        if len(seen) == 1:  # another writer is faster
            assert log.try_append(2, {"n": "c"})
        return {"n": entry["n"] + "!"}

    assert log.update(change) == ({"n": "c"}, {"n": "c!"})
    assert seen == [{"n": "ä"}, {"n": "c"}] and log.entries() == [{"n": "ä"}, {"n": "c"}, {"n": "c!"}]
    assert not list((tmp_path / "log" / "_new").glob("*.json"))


def test_names_are_taken_once_without_links(spark, tmp_path):
    """The way of file systems that are not local: a rename that does not overwrite."""
    log = CommitLog(spark, str(tmp_path))
    files, first = folder_of(spark, str(tmp_path / "a"))
    second, target = (folder_of(spark, str(tmp_path / n))[1] for n in ("b", "000000000001.json"))
    for path, text in ((first, b'{"n": 1}'), (second, b'{"n": 2}')):
        out = files.create(path, False)
        out.write(bytearray(text))
        out.close()
    remote = SimpleNamespace(getScheme=lambda: "hdfs")
    log._name_once(remote, first, target)
    with pytest.raises(Exception, match="FileAlreadyExists"):
        log._name_once(remote, second, target)
    assert log.head() == (1, {"n": 1})


def test_two_processes_publish_at_once(spark, tmp_path):
    """Every publication has the one that was current before it as its previous version."""
    publisher = Publisher(Lake(spark, str(tmp_path)))
    command = [sys.executable, "-c", PUBLISHER, str(tmp_path)]
    other = subprocess.Popen(command, stdout=subprocess.PIPE, cwd=Path(__file__).parents[1])
    assert other.stdout.readline() == b"ready\n"
    for i in range(10):
        publisher.publish(f"own{i}", ["t"], [])
    publisher.publish("bad", ["t"], ["check: fail"])
    assert other.wait(timeout=120) == 0
    chain = publisher.log.entries()
    assert len(chain) == 20 and {e["current"] for e in chain} == {f"{who}{i}" for who in ("own", "other") for i in range(10)}
    assert [e["previous"] for e in chain] == [None, *[e["current"] for e in chain[:-1]]]
    assert [e["at"] for e in chain] == sorted({e["at"] for e in chain})
    records = publisher.ops.read("publications").where("status = 'published'").collect()
    assert {(r["version"], r["previous"]) for r in records} == {(e["current"], e["previous"]) for e in chain}
    assert publisher.release()[0].first()["version"] == chain[-1]["current"]
    outcome = publisher.rollback()
    assert (outcome["from"], outcome["to"]) == (chain[-1]["current"], chain[-2]["current"])
    assert publisher.pointer() == (chain[-2]["current"], chain[-1]["current"])


def test_two_loads_of_one_file_show_its_rows_once(spark, tmp_path, monkeypatch):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "one.csv").write_text("k,v\na,1\nb,2\n")
    (landing / "copy.csv").write_text("k,v\na,1\nb,2\n")
    source = Source("trees", str(landing), partition="k", decode=DecodeOptions(sep=","))
    meet, write = threading.Barrier(2), Lake._write

    def late(self, *args):
        meet.wait(timeout=120)  # both have read the manifest, none has recorded anything
        return write(self, *args)

    monkeypatch.setattr(Lake, "_write", late)
    lakes = [Lake(spark, str(tmp_path / "lake")) for _ in range(2)]
    threads = [threading.Thread(target=lake.load, args=(source,)) for lake in lakes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    lake = lakes[0]
    assert lake.ops.read("file_manifest").count() == 4
    shown = lake.bronze(source)
    assert sorted((r["k"], r["v"]) for r in shown.collect()) == [("a", "1"), ("a", "1"), ("b", "2"), ("b", "2")]
    assert shown.select("_batch_id").distinct().count() == 1
    assert sorted((r["k"], r["v"]) for r in lake.latest(source).collect()) == [("a", "1"), ("b", "2")]
    assert lake.load(source)["units_processed"] == 0
