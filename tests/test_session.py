from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cohortlake import session
from cohortlake.operators import ranking


def test_a_cluster_must_name_its_shared_folder():
    for master, refused in (("local", False), ("local[4]", False), ("yarn", True), ("local-cluster[2,1,512]", True), ("spark://h:7077", True)):
        bare = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))
        if refused:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                session.shared_dir(bare)
        else:
            assert os.path.isdir(session.shared_dir(bare))
        named = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs:///shared/"}, sparkContext=bare.sparkContext)
        assert session.shared_dir(named) == "hdfs:///shared"


def test_scratch_is_removed_on_request(spark):
    own = spark.newSession()
    written = session.cut_lineage(own.range(5), "scratch")
    paths = list(own._cohortlake_scratch)
    assert written.count() == 5 and [os.path.isdir(p) for p in paths] == [True]
    assert session.clear_scratch(own) == 1
    assert not any(map(os.path.exists, paths)) and session.clear_scratch(own) == 0


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANGE_ROWS", 10)
    seen = []
    frame = type(spark.range(0))
    ranged = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, n, *c: seen.append(n) or ranged(self, n, *c))
    rows = spark.range(95).selectExpr("id", "id % 3 as g")
    tiles = ranking.exact_ntile(rows, 4, [F.col("id")], ["g"], "tile").groupBy("g", "tile").count().collect()
    assert seen == [10]
    assert sorted(r["count"] for r in tiles) == [7] * 1 + [8] * 11
