"""Gates, publication, rollback and freshness of the published tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.measures import local_time
from cohortlake.plans.commit_log import CommitLog
from cohortlake.plans.landing import Lake, Source
from cohortlake.plans.ops import Ops
from cohortlake.session import all_together, clear_scratch, run_together, scratch_mark

# Check outcomes that stop a publication.
BLOCKING = ("error", "fail", "runtime error", "skipped")
ZONE = "America/Cuiaba"


def new_version() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:6]}"


# ---- gates as relations ----------------------------------------------------------------------


def orchestrated_results(runs: DataFrame, expected: DataFrame, group: Column) -> DataFrame:
    """Latest run of every expected source inside one orchestration, else ``missing``."""
    latest = (
        runs.where(group)
        .groupBy("source")
        .agg(F.max_by(F.struct("status", "run_id"), F.struct("started_at", "run_id")).alias("_run"))
    )
    return expected.join(latest, "source", "left").select(
        *expected.columns,
        F.coalesce(F.col("_run.status"), F.lit("missing")).alias("status"),
        F.col("_run.run_id").alias("run_id"),
    )


def source_problems(results: DataFrame, loaded: DataFrame) -> DataFrame:
    """Problems of required sources; no row means the gate is open.

    ``results``: source, required, status (NULL if not part of this run). ``loaded``: source,
    rows (NULL if the table does not exist), missing_columns.
    """
    joined = results.join(loaded, "source", "left")
    required = F.col("required")
    problems = F.array(
        F.when(required & F.col("status").isNotNull() & (F.col("status") != "success"),
               F.lit("load failed")),
        F.when(required & F.col("rows").isNull(), F.lit("no table")),
        F.when(required & (F.col("rows") == 0), F.lit("empty table")),
        F.when((F.size("missing_columns") > 0) & (F.col("rows") > 0), F.lit("essential columns")),
    )
    present = F.filter(problems, lambda p: p.isNotNull())
    return joined.select("source", F.explode(present).alias("problem"))


def check_problems(results: DataFrame) -> DataFrame:
    """Counts per status, and whether that status blocks, warns or passes."""
    effect = (
        F.when(F.col("status").isin(*BLOCKING), "block")
        .when(F.col("status") == "warn", "warn")
        .otherwise("pass")
    )
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("effect", effect)


def freshness(
    runs: DataFrame,
    manifest: DataFrame,
    built_at: Column,
    zone: str = ZONE,
    order: Sequence[str] = ("started_at", "run_id"),
) -> DataFrame:
    """Per source: last status and rows, last success in local time and UTC, files and rows held.

    All run-log questions are answered by one aggregate over the log.
    """
    success = F.col("status") == "success"
    newest = F.struct(*order)
    log = runs.groupBy("source").agg(
        F.max_by(F.struct("status", "rows_loaded", "rows_rejected"), newest).alias("_last"),
        F.max(F.when(success, F.col("finished_at"))).alias("_ok"),
        F.max_by(
            F.when(success & (F.col("rows_loaded") > 0), F.col("rows_loaded")),
            F.when(success & (F.col("rows_loaded") > 0), newest),
        ).alias("_filled"),
    )
    held = manifest.groupBy("source").agg(
        F.count(F.lit(1)).alias("_files"), F.sum("rows_loaded").alias("_rows")
    )
    return log.join(held, "source", "left").select(
        "source",
        F.col("_last.status").alias("last_status"),
        local_time(F.col("_ok"), zone).alias("last_success_local"),
        F.col("_ok").alias("last_success_utc"),
        F.col("_last.rows_loaded").alias("rows_last_run"),
        F.col("_last.rows_rejected").alias("rejected_last_run"),
        F.coalesce("_files", F.lit(0)).alias("nu_files"),
        F.coalesce("_rows", "_filled", F.lit(0)).alias("rows_held"),
        local_time(built_at, zone).alias("built_local"),
        F.lit(zone).alias("time_zone"),
    )


def latest_release(publications: DataFrame) -> DataFrame:
    """The newest published row."""
    columns = publications.columns
    newest = F.max_by(F.struct(*columns), F.struct("published_at", "version")).alias("_row")
    row = publications.where("status = 'published'").agg(newest).where("_row is not null")
    return row.select(*[f"_row.{c}" for c in columns])


# ---- publication -----------------------------------------------------------------------------


def _after(entry: Mapping[str, Any], now: datetime) -> datetime:
    """A time for the entry behind ``entry``: now, but later than that entry on whatever clock."""
    last = entry.get("at")
    return max(now, datetime.fromisoformat(last) + timedelta(microseconds=1)) if last else now


class Publisher:
    """Versioned Gold folders; the newest entry of a commit log says which one readers use.

    Publications and rollbacks of several processes stand one behind the other in that log: each names as
    its previous version the one that really was current before it.
    """

    def __init__(self, lake: Lake) -> None:
        self.lake, self.spark, self.ops = lake, lake.spark, Ops(lake.spark, lake.root)
        self.log = CommitLog(lake.spark, f"{lake.root}/ops/pointer")

    def path(self, version: str, table: str) -> str:
        return f"{self.lake.root}/gold/{version}/{table}"

    def pointer(self) -> tuple[str | None, str | None]:
        """The current version and the one before it."""
        entry = self.log.head()[1] or {}
        return entry.get("current"), entry.get("previous")

    def build(self, version: str, tables: Mapping[str, DataFrame]) -> None:
        """Write the candidate; nobody reads it before :meth:`publish` moves the pointer."""
        writes = {
            name: partial(df.write.mode("overwrite").parquet, self.path(version, name))
            for name, df in tables.items()
        }
        all_together(writes)

    def candidate(self, version: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(version, table))

    def publish(
        self,
        version: str,
        tables: Sequence[str],
        problems: Sequence[str],
        sources: Any = None,
        checks: Any = None,
    ) -> dict[str, Any]:
        """Problems or an empty candidate reject the version and keep the current one."""
        text = "; ".join(problems) or (None if tables else "empty candidate")
        reason = f"{text[:3980]} ... (cut)" if text and len(text) > 4000 else text
        now = datetime.now(timezone.utc)

        def successor(entry: dict[str, Any] | None) -> dict[str, Any] | None:
            if reason:
                return None
            entry = entry or {}
            return {"at": _after(entry, now).isoformat(), "current": version, "previous": entry.get("current")}

        before, after = self.log.update(successor)
        current = (before or {}).get("current")
        record = {
            "version": version,
            "status": "rejected" if reason else "published",
            "published_at": datetime.fromisoformat(after["at"]) if after else now,
            "previous": current,
            "reason": reason,
            "sources": json.dumps(sources or {}, ensure_ascii=False, default=str),
            "checks": json.dumps(checks or [], ensure_ascii=False, default=str),
        }
        self.ops.append("publications", [record])
        outcome = {"status": record["status"], "version": version, "reason": reason}
        return outcome | ({"kept": current} if reason else {"previous": current})

    def release(self) -> tuple[DataFrame, DataFrame]:
        """The newest published record with its checks, and the files behind that version: those that the
        manifest held when it was published. The manifest only grows, so nothing is copied."""
        record = latest_release(self.ops.read("publications"))
        known = self.ops.read("file_manifest")
        files = known.where(F.col("loaded_at") <= record.select("published_at").scalar())
        version = record.select("version").scalar()
        return record, files.select(version.alias("version"), "source", "sha256", "file_uri", "rows_loaded")

    def rollback(self) -> dict[str, Any]:
        """Swap current and previous; without a previous version nothing happens."""
        def swapped(entry: dict[str, Any] | None) -> dict[str, Any] | None:
            if not entry or entry["previous"] is None:
                return None
            at = _after(entry, datetime.now(timezone.utc)).isoformat()
            return {"at": at, "current": entry["previous"], "previous": entry["current"]}

        before, after = self.log.update(swapped)
        if after is None:
            return {"status": "noop", "reason": "no previous version"}
        return {"status": "rolled_back", "from": before["current"], "to": after["current"]}

    def read(self, table: str, version: str | None = None) -> DataFrame:
        """A published table; pass the version to read several tables from one snapshot."""
        version = version or self.pointer()[0]
        if version is None:
            raise LookupError("nothing is published yet")
        return self.candidate(version, table)


def source_gate(
    lake: Lake, sources: Sequence[Source], results: Mapping[str, str]
) -> tuple[list[str], dict[str, Any]]:
    """Gate over landed sources: problems and the number of rows and files behind each source."""
    spark = lake.spark
    expected = spark.createDataFrame(
        [(s.name, s.required, results.get(s.name)) for s in sources],
        "source string, required boolean, status string",
    )
    loaded, held = [], {}
    manifest = lake.ops.read("file_manifest").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    files = {r["source"]: r["n"] for r in manifest.collect()}
    for s in sources:
        columns = lake.columns(s.target)
        rows = lake.bronze(s).count() if columns else None
        missing = [c for c in s.essential if c not in columns]
        loaded.append((s.name, rows, missing))
        held[s.name] = {"rows": rows or 0, "files": files.get(s.name, 0), "required": s.required}
    state = spark.createDataFrame(
        loaded, "source string, rows bigint, missing_columns array<string>"
    )
    found = source_problems(expected, state).orderBy("source", "problem").collect()
    return [f"{p['source']}: {p['problem']}" for p in found], held


def run_pipeline(
    lake: Lake,
    sources: Sequence[Source],
    build,
    tests,
    export=None,
    skip_ingest_group: str | None = None,
    keep_shared: bool = False,
) -> dict[str, Any]:
    """Load all, gate the sources, build and test a candidate, publish it and export it.

    ``build(lake)`` returns the tables, ``tests(tables)`` one relation (check, status). What the run wrote
    to the shared folder in between is deleted at its end: the tables, the log and the export are all that stays.
    ``keep_shared`` leaves it, for a caller who goes on with relations made by ``build``.
    """
    mark = scratch_mark(lake.spark)
    try:
        return _pipeline(lake, sources, build, tests, export, skip_ingest_group)
    finally:
        if not keep_shared:
            clear_scratch(lake.spark, mark)


def _pipeline(
    lake: Lake, sources: Sequence[Source], build, tests, export, skip_ingest_group: str | None
) -> dict[str, Any]:
    version, publisher = new_version(), Publisher(lake)
    results: dict[str, str] = {}
    errors: dict[str, str] = {}
    if skip_ingest_group is None:
        # The run log keeps the errors of failed loads; the gate decides what they mean.
        runs = run_together({s.name: partial(lake.load, s) for s in sources})
        errors = {n: f"{type(r).__name__}: {r}" for n, r in runs.items() if isinstance(r, Exception)}
        results = {n: "failed" if n in errors else r["status"] for n, r in runs.items()}
    else:
        runs = lake.ops.read("ingestion_runs")
        expected = lake.spark.createDataFrame([(s.name,) for s in sources], "source string")
        latest = orchestrated_results(runs, expected, F.col("group_id") == skip_ingest_group)
        results = {r["source"]: r["status"] for r in latest.collect()}
    problems, held = source_gate(lake, sources, results)
    problems = [f"{p} ({errors[n]})" if (n := p.split(":")[0]) in errors else p for p in problems]
    summary: dict[str, Any] = {"version": version, "ingest": results, "problems": problems}
    names: list[str] = []
    checks: list[dict[str, Any]] = []
    if not problems:
        tables = build(lake)
        publisher.build(version, tables)
        names = sorted(tables)
        outcome = tests({n: publisher.candidate(version, n) for n in names})
        checks = [r.asDict() for r in outcome.orderBy("check").collect()]
        problems = [f"{c['check']}: {c['status']}" for c in checks if c["status"] in BLOCKING]
    summary["publication"] = publisher.publish(version, names, problems, held, checks)
    summary["checks"] = checks
    if summary["publication"]["status"] == "published" and export is not None:
        summary["export"] = export({n: publisher.read(n, version) for n in names}, version)
    return summary
