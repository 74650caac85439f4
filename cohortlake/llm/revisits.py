"""Not-modified revisits resolved to the latest earlier full response of the same canonical URL.

An as-of join without a hot task: rows are range-partitioned by (URL, time), so one URL may fill many
partitions. Inside a partition a window looks back; what reaches over a partition's start comes from
a summary with one row per (URL, partition). Bodies never move: a resolved row names the record that
holds the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import cut_lineage, shuffle_partitions

#: Headers that a 304 may update in the stored response (RFC 9110, 15.4.5).
PERMITTED = (
    "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary",
)
#: Query parameters that only track the visitor.
TRACKING = "utm_[a-z]+|fbclid|gclid|sessionid|phpsessid|jsessionid|ref"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, ``www``/``m`` label and default port; path without trailing
    slash; tracking parameters and fragment gone, other parameters sorted. Null stays null."""
    bare = F.regexp_replace(F.trim(url), "(?i)^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^(www[0-9]*|m)[.]", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "[?](.*)$", 1)
    parts = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"(?i)^({TRACKING})(=|$)"))
    )
    tail = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
    return F.when(url.isNotNull(), F.concat(host, path, tail))


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ only in case the last in order wins."""
    entries = F.transform(
        F.array_sort(F.map_entries(headers)),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(
        F.transform(entries, lambda e, i: F.struct(e["key"], e["value"], i.alias("at"))),
        lambda e: ~F.exists(F.slice(entries, e["at"] + 2, F.size(entries)), lambda x: x["key"] == e["key"]),
    )
    pairs = F.transform(last, lambda e: F.struct(e["key"], e["value"]))
    return F.map_from_entries(F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit (kind ``revisit`` or status 304) of ``records``.

    ``records``: record_id long, url string, captured (timestamp or number), kind string, status int,
    headers map<string,string>; more columns are ignored, whatever their names. Result: ``record_id,
    url_key, captured, refers_to, outcome, headers``. ``outcome``:

    * ``resolved``: the strong ETag matches; without ETags on both sides, the Last-Modified date does;
      without either on the revisit, the latest earlier response stands as it is;
    * ``mismatch``: there is an earlier response, but a validator differs; ``refers_to`` is null;
    * ``no_response``: nothing earlier, or the revisit's URL or time is null.

    A full response is a record of kind ``response`` and status 200 with URL, time and id. At equal
    times the larger record_id is later, so it may answer only revisits with a larger id. Weak ETags
    (``W/``) match weakly, as RFC 9110 has it for 304. Headers of a resolved row are the stored ones
    updated by those that a 304 may carry; otherwise the revisit's own. Repeated rows give repeated
    results; an empty table gives none.
    """
    spark = records.sparkSession
    row = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("url")).alias("url_key"),
        F.col("captured").alias("captured"),
        ((F.col("kind") == "revisit") | (F.col("status") == 304)).alias("is_revisit"),
        ((F.col("kind") == "response") & (F.col("status") == 200)).alias("is_full"),
        _lower_keys(F.col("headers")).alias("headers"),
    )
    row = row.withColumn("is_revisit", F.coalesce("is_revisit", F.lit(False)))
    keyed = F.col("url_key").isNotNull() & F.col("captured").isNotNull() & F.col("record_id").isNotNull()
    row = row.withColumn("is_full", F.coalesce("is_full", F.lit(False)) & ~F.col("is_revisit") & keyed)
    row = row.where("is_revisit or is_full")
    # Rows without URL are dealt out by their id; they never match.
    dealt = row.repartitionByRange(shuffle_partitions(spark), "url_key", "captured", "record_id")
    placed = cut_lineage(dealt.withColumn("part", F.spark_partition_id()), "revisits")

    full = F.when(F.col("is_full"), F.struct(F.col("record_id").alias("id"), F.col("headers").alias("h")))
    # A partition holds at most one stretch of a URL, so these windows are as small as the ranges.
    here = Window.partitionBy("url_key", "part").orderBy("captured", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("before", F.last(full, ignorenulls=True).over(here)).where("is_revisit")
    ends = (
        placed.where("is_full")
        .groupBy("url_key", "part")
        .agg(F.max_by("record_id", F.struct("captured", "record_id")).alias("last_id"), F.max_by("headers", F.struct("captured", "record_id")).alias("last_h"))
    )
    # Only a URL's first revisits in a partition look further back, to the nearest partition before.
    open_parts = local.where("before is null and url_key is not null").select("url_key", "part").distinct()
    marks = ends.select("url_key", "part", F.struct(F.col("last_id").alias("id"), F.col("last_h").alias("h")).alias("end")).unionByName(
        open_parts.select("url_key", "part", F.lit(None).cast("struct<id:bigint,h:map<string,string>>").alias("end"))
    )
    back = Window.partitionBy("url_key").orderBy("part").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        marks.withColumn("carry", F.last("end", ignorenulls=True).over(back))
        .where("end is null")
        .select("url_key", "part", "carry")
    )
    both = local.join(carried, ["url_key", "part"], "left")
    found = F.coalesce("before", "carry")
    both = both.withColumn("stored", F.when(keyed, found))
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    own, old = F.col("headers"), F.col("stored.h")
    by_tag = F.when(own["etag"].isNotNull() & old["etag"].isNotNull(), weak(own["etag"]) == weak(old["etag"]))
    by_date = F.when(
        own["last-modified"].isNotNull() & old["last-modified"].isNotNull(),
        own["last-modified"] == old["last-modified"],
    )
    none = own["etag"].isNull() & own["last-modified"].isNull()
    fits = F.coalesce(by_tag, by_date, none)
    outcome = (
        F.when(F.col("stored").isNull(), "no_response").when(fits, "resolved").otherwise("mismatch")
    )
    update = F.map_filter(own, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(update, k)), update)
    done = both.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return done.select(
        "record_id",
        "url_key",
        "captured",
        F.when(good, F.col("stored.id")).alias("refers_to"),
        "outcome",
        F.when(good, merged).otherwise(own).alias("headers"),
    )
