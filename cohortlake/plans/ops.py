"""Control relations: run log, file manifest, schema changes, quality events, publications."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortlake.operators.latest import latest_per_key
from cohortlake.session import folder_of

SCHEMAS = {
    "ingestion_runs": """
        run_id string, source string, kind string, load_strategy string, status string,
        started_at timestamp, finished_at timestamp, units_processed bigint, units_skipped bigint,
        rows_extracted bigint, rows_filtered bigint, rows_loaded bigint, rows_rejected bigint,
        group_id string, error string""",
    "file_manifest": """
        source string, sha256 string, file_uri string, file_size bigint, rows_loaded bigint,
        loaded_at timestamp, run_id string""",
    "file_index": """
        options string, file_uri string, length bigint, modified timestamp, sha256 string, is_split_safe boolean,
        encoding string, sep string, skip bigint, header array<string>, read_at timestamp""",
    "partition_values": """
        source string, column_name string, value string, file_uri string, run_id string, rows bigint,
        loaded_at timestamp""",
    "schema_changes": """
        source string, table_name string, column_name string, position bigint, change string,
        detected_at timestamp, run_id string""",
    "table_columns": "table_name string, column_name string, position bigint, run_id string",
    "data_quality_events": """
        source string, run_id string, check_name string, severity string, detail string,
        created_at timestamp""",
    "publications": """
        version string, status string, published_at timestamp, previous string, reason string,
        sources string, checks string""",
}
# Relations under retention and their time column.
RETAINED = {
    "ingestion_runs": "started_at",
    "schema_changes": "detected_at",
    "data_quality_events": "created_at",
}


def optional_parquet(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The relation at ``path``, or a typed empty one where none has arrived yet."""
    files, folder = folder_of(spark, path)
    if not files.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


class Ops:
    """Append-only Parquet relations below ``root``; one append is one commit.

    Every append is a folder of its own. It is written out of sight and then renamed to a name nobody else
    uses, so any number of processes may append at once, and none sees half of another's rows. The name
    starts with the newest time in its rows; retention deletes whole folders by it and rewrites nothing.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/ops/{name}"

    def read(self, name: str) -> DataFrame:
        """All rows of the appends made so far."""
        return optional_parquet(self.spark, self.path(name), SCHEMAS[name])

    def append(self, name: str, rows: Iterable[Mapping[str, Any]]) -> None:
        rows = list(rows)
        if rows:
            schema = T.StructType.fromDDL(SCHEMAS[name])
            columns = {
                f.name: pa.array([r.get(f.name) for r in rows], to_arrow_type(f.dataType))
                for f in schema.fields
            }
            times = [r[RETAINED[name]] for r in rows if name in RETAINED and r.get(RETAINED[name])]
            frame = self.spark.createDataFrame(pa.table(columns), schema).coalesce(1)
            self._commit(name, frame, max(times).timestamp() if times else time.time())

    def append_frame(self, name: str, rows: DataFrame) -> None:
        """Append rows Spark already holds; they do not pass through the driver."""
        schema = T.StructType.fromDDL(SCHEMAS[name])
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        self._commit(name, typed, time.time())

    def _commit(self, name: str, rows: DataFrame, newest: float) -> None:
        entry = f"{int(newest * 1e6):017d}-{uuid.uuid4().hex}"
        hidden, shown = f"{self.path(name)}/_new/{entry}", f"{self.path(name)}/{entry}"
        rows.write.parquet(hidden)
        files, target = folder_of(self.spark, shown)
        if not files.rename(folder_of(self.spark, hidden)[1], target):
            raise OSError(f"{shown} could not be committed")

    def views(self) -> dict[str, DataFrame]:
        """What an operator looks at: publications, runs, files per source, new columns."""
        return {
            "publications": newest(self.read("publications"), ["published_at"], 10),
            "runs": newest(self.read("ingestion_runs"), ["started_at"], 20),
            "files": self.read("file_manifest").orderBy("source", "file_uri"),
            "columns": self.read("schema_changes").orderBy(F.col("detected_at").desc()),
        }

    def purge(self, days: int, names: Iterable[str] = RETAINED) -> dict[str, int]:
        """Drop the appends whose rows are all older than ``days``; returns the rows dropped.

        An append that another process makes meanwhile is a folder of its own and stays.
        """
        edge = time.time() - days * 86400
        removed = {}
        for name in names:
            files, folder = folder_of(self.spark, self.path(name))
            found = files.listStatus(folder) if files.exists(folder) else []
            entries = [status.getPath() for status in found if status.getPath().getName()[0].isdigit()]
            old = [p for p in entries if int(p.getName().split("-")[0]) < int(edge * 1e6)]
            removed[name] = 0
            if old:
                schema = T.StructType.fromDDL(SCHEMAS[name])
                removed[name] = self.spark.read.schema(schema).parquet(*[p.toString() for p in old]).count()
            for path in old:
                files.delete(path, True)
        return removed


def purge_history(
    rows: DataFrame, column: str, days: int, now=None
) -> tuple[DataFrame, DataFrame]:
    """Rows inside the retention window, and a one-row count of removed and kept rows."""
    edge = (F.current_timestamp() if now is None else now) - F.make_dt_interval(F.lit(days))
    old = F.col(column) < edge
    counts = rows.agg(
        F.count_if(old).alias("removed"), F.count_if(~F.coalesce(old, F.lit(False))).alias("kept")
    )
    return rows.where(~F.coalesce(old, F.lit(False))), counts


def newest(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The ``n`` newest rows of a log."""
    return rows.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def current_manifest(manifest: DataFrame) -> DataFrame:
    """One row per source and content: a later load replaces the earlier entry."""
    return latest_per_key(
        manifest, ["source", "sha256"], [F.col("loaded_at"), F.col("run_id")]
    )


def volume_verdict(
    history: DataFrame,
    current: DataFrame,
    keys: list[str],
    value: str,
    order: str,
    lookback: int = 7,
    min_history: int = 3,
    min_ratio: float = 0.5,
    max_ratio: float = 3.0,
) -> DataFrame:
    """Current volume against the median of the newest ``lookback`` volumes of the same keys.

    ``history`` is cut to its newest rows per key by Spark's grouped limit before the median.
    """
    from cohortlake.operators.ranking import top_per_group

    recent = top_per_group(history, keys, [F.col(order).desc()], lookback)
    baseline = recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nu_history"), F.median(value).alias("baseline")
    )
    joined = current.join(baseline, keys, "left")
    volume, middle = F.col(value).cast("double"), F.col("baseline")
    ratio = F.when(middle > 0, volume / middle).when(volume == 0, F.lit(1.0))
    outside = F.when(middle == 0, volume > 0).otherwise(~ratio.between(min_ratio, max_ratio))
    enough = F.coalesce(F.col("nu_history"), F.lit(0)) >= min_history
    return joined.select(
        *current.columns,
        "nu_history",
        "baseline",
        ratio.alias("ratio"),
        F.when(~enough, "no history").when(outside, "outside").otherwise("ok").alias("verdict"),
    )
