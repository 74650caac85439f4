"""Run logs, gates, history, volumes, suppression and drift on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.plans import export, landing, ops, release
from cohortlake.session import cut_lineage
from cohortlake.sources.files import settled
from cohortlake.workload import base
from cohortlake.workload.cohort_queries import ORACLE as COHORT_ORACLE
from cohortlake.workload.cohort_queries import accumulated, cohort_curve


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Successful loads as manifest entries; the units a run handled stand for its content."""
    return base.run_log(spark, sf).where("status = 'success'").select(
        "source",
        F.col("units").cast("string").alias("sha256"),
        F.concat(F.lit("file-"), F.col("run_id").cast("string")).alias("file_uri"),
        "rows_loaded",
        F.col("started_at").alias("loaded_at"),
        "run_id",
    )


def manifest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return ops.current_manifest(_manifest(spark, sf))


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    runs = base.run_log(spark, sf).withColumn("rows_rejected", F.lit(0).cast("bigint"))
    files = ops.current_manifest(_manifest(spark, sf)).where("source <> 'error'")
    built = F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")
    return release.freshness(runs, files, built)


def manifest_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files: those whose content an earlier source already holds are skipped."""
    docs = base.table(spark, sf, "documents")
    hashed = docs.select("doc_id", "source", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"))
    early = F.col("source").isin("src0", "src1", "src2", "src3")
    known = hashed.where(early).select("sha256").distinct()
    return hashed.where(~early).join(known, "sha256", "left_anti").select("doc_id", "sha256")


def settled_only(spark: SparkSession, sf: str) -> DataFrame:
    """Events as files still being written: only those older than a day at the cut-off time."""
    cutoff = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    ready = settled(F.col("ts"), 86400, cutoff)
    return base.table(spark, sf, "events").where(ready).select("event_id", "ts")


def volume_check(spark: SparkSession, sf: str) -> DataFrame:
    """Events per day and type as loads; the last day against the median of the days before."""
    daily = (
        base.table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("nu_rows"))
    )
    daily = cut_lineage(daily, "daily")
    last = daily.agg(F.max("day")).scalar()
    return ops.volume_verdict(
        daily.where(F.col("day") < last),
        daily.where(F.col("day") == last),
        ["source"],
        "nu_rows",
        "day",
    ).withColumn("ratio", F.round("ratio", 4))


def purge_history(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    kept, _ = ops.purge_history(base.table(spark, sf, "events"), "ts", 14, now)
    return kept.select("event_id", "ts", "event_type")


def purge_counts(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    _, counts = ops.purge_history(base.table(spark, sf, "events"), "ts", 14, now)
    return counts


def schema_drift_log(spark: SparkSession, sf: str) -> DataFrame:
    customers = base.table(spark, sf, "customer")
    old = customers.select("c_custkey", "c_name", "c_acctbal")
    new = customers.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return landing.column_changes(old, new)


def dry_run_profile(spark: SparkSession, sf: str) -> DataFrame:
    return landing.profile(base.text_events(spark, sf)).select("column", "nu_rows", "nu_missing")


def _expected(spark: SparkSession, sf: str) -> DataFrame:
    """Every event type is a source; one more is expected and never runs."""
    kinds = base.table(spark, sf, "events").select(F.col("event_type").alias("source")).distinct()
    never = spark.range(1).select(F.lit("never").alias("source"))
    return kinds.unionByName(never).withColumn("required", F.col("source") != "view")


def orchestrated(spark: SparkSession, sf: str) -> DataFrame:
    """The orchestration of the newest day: the last run of every expected source in it."""
    runs = base.run_log(spark, sf)
    newest = runs.agg(F.date_trunc("day", F.max("started_at")).cast("timestamp_ntz")).scalar()
    return release.orchestrated_results(runs, _expected(spark, sf), F.col("started_at") >= newest)


def source_gate(spark: SparkSession, sf: str) -> DataFrame:
    results = orchestrated(spark, sf).select("source", "required", "status")
    loaded = (
        base.run_log(spark, sf)
        .groupBy("source")
        .agg(F.sum(F.when(F.col("status") == "success", F.col("rows_loaded"))).alias("rows"))
        .withColumn(
            "missing_columns",
            F.when(F.col("source") == "click", F.array(F.lit("amount"))).otherwise(
                F.array().cast("array<string>")
            ),
        )
    )
    return release.source_problems(results, loaded)


def test_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Check outcomes of every run: failed loads fail, empty ones warn."""
    runs = base.run_log(spark, sf)
    status = (
        F.when(F.col("status") == "failed", "fail").when(F.col("rows_loaded") < 5, "warn")
    ).otherwise("pass")
    return release.check_problems(runs.select(status.alias("status")))


def _publications(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("status") == "success", "published").otherwise("rejected")
    return base.run_log(spark, sf).select(
        F.col("run_id").cast("string").alias("version"),
        status.alias("status"),
        F.col("started_at").alias("published_at"),
        F.col("source").alias("reason"),
    )


def publication_log(spark: SparkSession, sf: str) -> DataFrame:
    """The ten newest publications."""
    return ops.newest(_publications(spark, sf), ["published_at", "version"], 10)


def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty newest runs."""
    columns = ["source", "run_id", "status", "started_at", "rows_loaded", "units"]
    return ops.newest(base.run_log(spark, sf).select(*columns), ["started_at", "run_id"], 20)


def current_release(spark: SparkSession, sf: str) -> DataFrame:
    return release.latest_release(_publications(spark, sf))


def suppressed_export(spark: SparkSession, sf: str) -> DataFrame:
    """Cohort rows whose base passes, in total order, with masked counts."""
    rows = accumulated(spark, sf).select(
        "entity", "cohort", "ref_year", "qt_entrants", "qt_base_acc", "qt_dropped_acc"
    )
    kept = export.suppressed(rows, ["qt_entrants", "qt_base_acc"])
    return kept.orderBy(*kept.columns)


def export_leaks(spark: SparkSession, sf: str) -> DataFrame:
    rows = accumulated(spark, sf).select("qt_entrants", "qt_dropped_acc", "qt_completed_acc")
    return export.leak_counts(rows, export.keeps(["qt_entrants"]))


def published_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions published in turn, a third rejected, a rollback; read what is current."""
    from cohortlake.session import scratch_path

    publisher = release.Publisher(landing.Lake(spark, scratch_path(spark, "lake")))
    curve = cut_lineage(cohort_curve(spark, sf), "curve")
    publisher.build("v1", {"curve": curve})
    publisher.publish("v1", ["curve"], [])
    publisher.build("v2", {"curve": curve.where("step = 1")})
    publisher.publish("v2", ["curve"], [])
    publisher.publish("v3", [], ["check: fail"])
    publisher.rollback()
    return publisher.read("curve")


def exported_files(spark: SparkSession, sf: str) -> DataFrame:
    """The cohort curve exported and read back from its files."""
    from cohortlake.session import scratch_path

    exporter = export.Exporter(scratch_path(spark, "export"))
    spec = export.ExportTable("curve", base=("qt_entrants",))
    manifest = exporter.run([(spec, cohort_curve(spark, sf))])
    return export.read_exported(spark, manifest, "curve")


QUERIES = {
    "manifest_upsert": manifest_upsert,
    "freshness": freshness,
    "manifest_skip": manifest_skip,
    "settled_only": settled_only,
    "volume_check": volume_check,
    "purge_history": purge_history,
    "purge_counts": purge_counts,
    "schema_drift_log": schema_drift_log,
    "dry_run_profile": dry_run_profile,
    "orchestrated_results": orchestrated,
    "source_gate": source_gate,
    "test_gate": test_gate,
    "publication_log": publication_log,
    "current_release": current_release,
    "recent_runs": recent_runs,
    "suppressed_export": suppressed_export,
    "export_leaks": export_leaks,
    "published_snapshot": published_snapshot,
    "exported_files": exported_files,
}

_MANIFEST_SQL = f"""{base.RUNS_SQL},
manifest AS (
  SELECT source, units::VARCHAR AS sha256, 'file-' || run_id AS file_uri, rows_loaded,
         started_at AS loaded_at, run_id FROM runs WHERE status = 'success'
  QUALIFY row_number() OVER (PARTITION BY source, units ORDER BY started_at DESC, run_id DESC) = 1)"""
_ORCHESTRATED_SQL = f"""{base.RUNS_SQL},
expected AS (SELECT source, source <> 'view' AS required FROM (
  SELECT DISTINCT source FROM runs UNION ALL SELECT 'never')),
latest AS (SELECT * FROM runs
           WHERE started_at >= (SELECT date_trunc('day', max(started_at)) FROM runs)
           QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1),
orch AS (SELECT e.source, required, coalesce(l.status, 'missing') AS status, run_id
         FROM expected e LEFT JOIN latest l ON e.source = l.source)"""
_PUBLICATIONS_SQL = f"""{base.RUNS_SQL},
pubs AS (SELECT run_id::VARCHAR AS version,
                CASE WHEN status = 'success' THEN 'published' ELSE 'rejected' END AS status,
                started_at AS published_at, source AS reason FROM runs)"""

ORACLE = {
    "manifest_upsert": f"WITH {_MANIFEST_SQL} SELECT * FROM manifest",
    "freshness": f"""
WITH {_MANIFEST_SQL},
last_run AS (SELECT * FROM runs
             QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1),
ok AS (SELECT source, max(finished_at) AS at FROM runs WHERE status = 'success' GROUP BY 1),
files AS (SELECT source, count(*) AS n, sum(rows_loaded)::BIGINT AS r FROM manifest
          WHERE source <> 'error' GROUP BY 1),
filled AS (SELECT source, rows_loaded FROM runs WHERE status = 'success' AND rows_loaded > 0
           QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1)
SELECT u.source, u.status AS last_status, ok.at - INTERVAL 4 HOUR AS last_success_local,
       ok.at AS last_success_utc, u.rows_loaded AS rows_last_run, 0::BIGINT AS rejected_last_run,
       coalesce(files.n, 0) AS nu_files, coalesce(files.r, filled.rows_loaded, 0) AS rows_held,
       TIMESTAMP '2024-02-01 08:00:00' AS built_local, 'America/Cuiaba' AS time_zone
FROM last_run u LEFT JOIN ok ON ok.source = u.source LEFT JOIN files ON files.source = u.source
LEFT JOIN filled ON filled.source = u.source""",
    "manifest_skip": """
WITH h AS (SELECT doc_id, source, sha256(text) AS sha256 FROM documents)
SELECT doc_id, sha256 FROM h WHERE source NOT IN ('src0', 'src1', 'src2', 'src3')
  AND sha256 NOT IN (SELECT sha256 FROM h WHERE source IN ('src0', 'src1', 'src2', 'src3'))""",
    "settled_only": "SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-19 00:00:00'",
    "volume_check": """
WITH daily AS (SELECT event_type AS source, ts::DATE AS day, count(*) AS nu_rows FROM events GROUP BY 1, 2),
last_day AS (SELECT max(day) AS d FROM daily),
recent AS (SELECT source, nu_rows FROM daily, last_day WHERE day < d
           QUALIFY row_number() OVER (PARTITION BY source ORDER BY day DESC) <= 7),
b AS (SELECT source, count(*) AS nu_history, median(nu_rows) AS baseline FROM recent GROUP BY 1)
SELECT c.source, c.day, c.nu_rows, b.nu_history, b.baseline,
       round(c.nu_rows / b.baseline, 4) AS ratio,
       CASE WHEN coalesce(nu_history, 0) < 3 THEN 'no history'
            WHEN c.nu_rows / b.baseline NOT BETWEEN 0.5 AND 3.0 THEN 'outside' ELSE 'ok' END AS verdict
FROM daily c JOIN last_day ON c.day = d LEFT JOIN b ON b.source = c.source""",
    "purge_history": """
SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-17 00:00:00'""",
    "purge_counts": """
SELECT count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-17 00:00:00') AS removed,
       count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-17 00:00:00') AS kept FROM events""",
    "schema_drift_log": """
SELECT 'c_mktsegment' AS "column", 'column_added' AS change, count(c_mktsegment) AS filled FROM customer
UNION ALL SELECT 'c_nationkey', 'column_added', count(c_nationkey) FROM customer
UNION ALL SELECT 'c_acctbal', 'column_missing', count(c_acctbal) FROM customer""",
    "dry_run_profile": f"""
WITH {base.TEXT_EVENTS_SQL}
SELECT 'event_id' AS "column", count(*) AS nu_rows, count(*) - count(event_id) AS nu_missing FROM texts
UNION ALL SELECT 'kind', count(*), count(*) - count(kind) FROM texts
UNION ALL SELECT 'amount', count(*), count(*) - count(amount) FROM texts
UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id) FROM texts
UNION ALL SELECT 'props', count(*), count(*) - count(props) FROM texts""",
    "orchestrated_results": f"WITH {_ORCHESTRATED_SQL} SELECT * FROM orch",
    "source_gate": f"""
WITH {_ORCHESTRATED_SQL},
loaded AS (SELECT source, sum(rows_loaded) FILTER (WHERE status = 'success') AS r FROM runs GROUP BY 1),
j AS (SELECT o.*, l.r FROM orch o LEFT JOIN loaded l ON l.source = o.source)
SELECT source, 'load failed' AS problem FROM j WHERE required AND status <> 'success'
UNION ALL SELECT source, 'no table' FROM j WHERE required AND r IS NULL
UNION ALL SELECT source, 'empty table' FROM j WHERE required AND r = 0
UNION ALL SELECT source, 'essential columns' FROM j WHERE source = 'click' AND r > 0""",
    "test_gate": f"""
WITH {base.RUNS_SQL},
s AS (SELECT CASE WHEN status = 'failed' THEN 'fail' WHEN rows_loaded < 5 THEN 'warn' ELSE 'pass' END
             AS status FROM runs)
SELECT status, count(*) AS n,
       CASE status WHEN 'fail' THEN 'block' WHEN 'warn' THEN 'warn' ELSE 'pass' END AS effect
FROM s GROUP BY 1""",
    "publication_log": f"""
WITH {_PUBLICATIONS_SQL}
SELECT * FROM pubs ORDER BY published_at DESC, version DESC LIMIT 10""",
    "recent_runs": f"""
WITH {base.RUNS_SQL}
SELECT source, run_id, status, started_at, rows_loaded, units FROM runs
ORDER BY started_at DESC, run_id DESC LIMIT 20""",
    "current_release": f"""
WITH {_PUBLICATIONS_SQL}
SELECT * FROM pubs WHERE status = 'published' ORDER BY published_at DESC, version DESC LIMIT 1""",
    "suppressed_export": f"""
WITH {base.TRAJECTORY_SQL}
SELECT entity, cohort, ref_year, qt_entrants, qt_base_acc, qt_dropped_acc FROM acc
WHERE qt_entrants >= 10 AND qt_base_acc >= 10 ORDER BY ALL""",
    "export_leaks": f"""
WITH {base.TRAJECTORY_SQL}
SELECT count(*) FILTER (WHERE qt_entrants >= 10) AS kept,
       count(*) FILTER (WHERE qt_entrants < 10) AS suppressed, 0::BIGINT AS leak_qt_entrants,
       count(*) FILTER (WHERE qt_entrants >= 10 AND qt_dropped_acc BETWEEN 1 AND 9)
         AS leak_qt_dropped_acc,
       count(*) FILTER (WHERE qt_entrants >= 10 AND qt_completed_acc BETWEEN 1 AND 9)
         AS leak_qt_completed_acc
FROM acc""",
    "published_snapshot": COHORT_ORACLE["cohort_curve"],
    "exported_files": COHORT_ORACLE["cohort_curve"],
}
