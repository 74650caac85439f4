"""Session settings and shared-folder handling."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


_shipping = threading.Lock()


def build_session(app: str = "cohortlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; cluster settings win over none of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a session within one process (a local test) gets a temporary folder; on a cluster such a
    folder would be another one on every machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{master}: name a folder that all executors share in spark.checkpoint.dir")
    fallback = getattr(spark, "_cohortlake_dir", None)
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="cohortlake-")
        spark._cohortlake_dir = fallback
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/cohortlake/{label}-{uuid.uuid4().hex}"
    if not hasattr(spark, "_cohortlake_scratch"):
        spark._cohortlake_scratch = []
    spark._cohortlake_scratch.append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """A point in time for ``clear_scratch``: how much the session has written so far."""
    return len(getattr(spark, "_cohortlake_scratch", []))


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete what this session has written below the shared folder since a mark; no relation made from it
    can be read any more. To be called when a run's results are stored. Returns the number of paths."""
    held = getattr(spark, "_cohortlake_scratch", [])
    paths = held[since:]
    for name in paths:
        folder, path = folder_of(spark, name)
        folder.delete(path, True)
    del held[since:]
    return len(paths)


def folder_of(spark: SparkSession, name: str):
    """The file system of a path, and the path, as the JVM knows them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the written rows.

    Used where a relation feeds several branches, or where partition numbers must not change
    between two uses. The files outlive any executor, and Spark knows their true size: it
    broadcasts a later join side only when that size is below the session threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_together(calls: Mapping[str, Callable[[], Any]], at_once: int = 4) -> dict[str, Any]:
    """Independent actions submitted from a few threads, so that small jobs share the cluster.

    The value of a failed call is its exception; the caller decides what it means.
    """

    def attempt(call: Callable[[], Any]) -> Any:
        try:
            return call()
        except Exception as error:  # noqa: BLE001 - handed to the caller
            return error

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = {name: pool.submit(attempt, call) for name, call in calls.items()}
        return {name: future.result() for name, future in futures.items()}


def all_together(calls: Mapping[str, Callable[[], Any]], at_once: int = 4) -> dict[str, Any]:
    """The same where every call must succeed: the first failure is raised when all have ended."""
    results = run_together(calls, at_once)
    for value in results.values():
        if isinstance(value, Exception):
            raise value
    return results


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer partitions than cores, dealt out before heavy work per row.

    A large table has many partitions already and passes through unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per session.

    A cluster that installs it on every node needs nothing of this; adding it again is harmless.
    """
    with _shipping:
        if getattr(spark, "_cohortlake_shipped", False):
            return
        home = Path(__file__).resolve().parent
        bundle = Path(tempfile.mkdtemp(prefix="cohortlake-")) / "cohortlake.zip"
        with zipfile.ZipFile(bundle, "w") as archive:
            for source in sorted(home.rglob("*.py")):
                archive.write(source, source.relative_to(home.parent))
        spark.sparkContext.addPyFile(str(bundle))
        spark._cohortlake_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
