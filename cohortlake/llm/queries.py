"""The operators as queries over the driver tables: thin, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import bpe_chunks, decontaminate, filter_audit, langid, lm_mixing, revisits, sentencepiece_fst, shared_ranking, simhash, suffix_dedup, tokencount, topk, toxicity
from cohortlake.llm.common import documents, ship_package, table, third


def captures(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a full response and as a later revisit of the same address.

    The response of page ``p`` is captured at ``p``, its revisit at ``p + 1000``. Pages whose canonical
    addresses agree answer each other's revisits. Each third page has no ETag, each seventh revisit
    carries a changed one, each fifth response is not a full one.
    """
    ship_package(spark)
    p = F.col("page_id")
    page = table(spark, sf, "pages").select("page_id", "url", F.md5("html").alias("digest"))
    tag = F.concat(F.lit('"'), "digest", F.lit('"'))
    date = F.concat(F.lit("day "), (p % 28).cast("string"))
    headers = F.map_from_arrays(
        F.array(F.lit("Content-Type"), F.lit("ETag"), F.lit("Last-Modified"), F.lit("Date")),
        F.array(F.lit("text/html"), F.when(p % 3 != 0, tag), date, p.cast("string")),
    )
    later = F.map_from_arrays(
        F.array(F.lit("Content-Type"), F.lit("etag"), F.lit("Last-Modified"), F.lit("Date")),
        F.array(
            F.lit("text/plain"),
            F.when((p % 3 != 0) & (p % 7 == 0), F.lit('"changed"')).when(p % 3 != 0, tag),
            F.when(p % 11 != 0, date),
            (p + 1000).cast("string"),
        ),
    )
    response = page.select(
        (p * 2).alias("record_id"), "url", p.alias("captured"), F.lit("response").alias("kind"),
        F.when(p % 5 == 0, 206).otherwise(200).alias("status"), headers.alias("headers"),
    )
    revisit = page.select(
        (p * 2 + 1).alias("record_id"), "url", (p + 1000).alias("captured"), F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"), later.alias("headers"),
    )
    return response.unionByName(revisit)


def op1_revisits(spark: SparkSession, sf: str) -> DataFrame:
    done = revisits.resolve_revisits(captures(spark, sf))
    return done.select(
        "record_id", "url_key", "captured", "refers_to", "outcome",
        F.col("headers")["date"].alias("date"), F.col("headers")["etag"].alias("etag"),
        F.col("headers")["content-type"].alias("content_type"),
    )


OP1_SQL = """
WITH bare AS (
  SELECT page_id, md5(html) AS digest, regexp_replace(trim(url), '(?i)^[a-z][a-z0-9+.-]*://|#.*$', '', 'g') AS b
  FROM pages
), keyed AS (
  SELECT page_id, digest,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), ':(80|443)$', ''), '^(www[0-9]*|m)[.]', '')
    || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(b, '[?](.*)$', 1), '&'), lambda x: x <> '' AND NOT
      regexp_matches(x, '(?i)^(utm_[a-z]+|fbclid|gclid|sessionid|phpsessid|jsessionid|ref)(=|$)'))) AS q FROM bare)
), stored AS (
  SELECT page_id * 2 AS id, url_key, page_id AS t, CASE WHEN page_id % 3 <> 0 THEN '"' || digest || '"' END AS etag,
    'day ' || (page_id % 28) AS changed
  FROM keyed WHERE page_id % 5 <> 0
), asked AS (
  SELECT page_id * 2 + 1 AS id, url_key, page_id + 1000 AS t,
    CASE WHEN page_id % 3 <> 0 THEN CASE WHEN page_id % 7 = 0 THEN '"changed"' ELSE '"' || digest || '"' END END AS etag,
    CASE WHEN page_id % 11 <> 0 THEN 'day ' || (page_id % 28) END AS changed
  FROM keyed
), found AS (
  SELECT a.*, s.id AS sid, s.etag AS setag, s.changed AS schanged,
    row_number() OVER (PARTITION BY a.id ORDER BY s.t DESC NULLS LAST, s.id DESC) AS n
  FROM asked a LEFT JOIN stored s ON s.url_key = a.url_key AND (s.t < a.t OR s.t = a.t AND s.id < a.id)
), judged AS (
  SELECT *, CASE WHEN sid IS NULL THEN 'no_response'
    WHEN coalesce(etag = setag, changed = schanged, etag IS NULL AND changed IS NULL) THEN 'resolved'
    ELSE 'mismatch' END AS outcome
  FROM found WHERE n = 1
)
SELECT id AS record_id, url_key, t AS captured, CASE WHEN outcome = 'resolved' THEN sid END AS refers_to, outcome,
  CAST(t AS VARCHAR) AS date, CASE WHEN outcome = 'resolved' THEN coalesce(etag, setag) ELSE etag END AS etag,
  CASE WHEN outcome = 'resolved' THEN 'text/html' ELSE 'text/plain' END AS content_type
FROM judged
"""


def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return sentencepiece_fst.encode_documents(documents(spark, sf, "doc_id", "text"), piece_model())


def op5_topk(spark: SparkSession, sf: str) -> DataFrame:
    ship_package(spark)
    vectors = topk.whole_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.where(F.col("id") % 20 == 0), vectors, k=20)


OP5_SQL = """
WITH whole AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.id AS query_id, c.id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.id <> c.id AND len(q.v) = len(c.v) WHERE q.id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf, "doc_id", "text"))


def piece_model() -> str:
    """Place of the tokenizer file on this machine; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf, "doc_id", "text"), piece_model())


def op6_lm_mixing(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.coalesce(third("doc_id", 5) == 1, F.lit(False))
    docs = documents(spark, sf, "doc_id", "text").withColumn("training", ~held_out)
    scored = lm_mixing.log_probabilities(docs)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text", "lang")
    held_out = F.coalesce(third("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs.where(third("doc_id", 4) != 2))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text")
    labels = table(spark, sf, "labels").where(third("doc_id", 4) != 2)
    lexicon, coefficients = toxicity.train(docs, labels)
    held_out = F.coalesce(third("doc_id", 4) == 2, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return toxicity.score(rows, lexicon, coefficients).select("doc_id", "held_out", "score", "predicted")


def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text")
    return decontaminate.contaminated_pairs(docs, table(spark, sf, "benchmark").select("item_id", "text"))


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf, "doc_id", "text"))


def op11_bpe_chunks(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    done = bpe_chunks.encode(documents(spark, sf, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_shared_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return shared_ranking.rank_documents(documents(spark, sf, "doc_id", "text"), table(spark, sf, "benchmark"))


OP12_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM texts WHERE len(terms) > 0
), held AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(size) AS size
  FROM (SELECT r, doc_id, unnest(terms) AS term, len(terms) AS size FROM texts) GROUP BY r, term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, totals WHERE term IN (SELECT term FROM asked) GROUP BY term
), valued AS (
  SELECT h.r, h.doc_id, h.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l))) AS v
  FROM held h JOIN weights USING (term), totals
), scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(v) AS BIGINT) AS score
  FROM asked JOIN valued USING (term) GROUP BY item_id, r
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.text_audit(documents(spark, sf, "doc_id", "text", "source"), table(spark, sf, "labels"))


OP13_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT t.doc_id, part,
    (CASE WHEN len(words) < 50 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) THEN 'E' ELSE '' END) AS fails,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts t LEFT JOIN (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id) l ON l.doc_id = t.doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), gone AS (
  SELECT part, fails, n, good, toxic, o,
    list_min(list_transform(string_split(fails, ''), lambda x: CASE WHEN x = '' THEN 9 ELSE instr(o, x) END)) AS hit
  FROM cells, orders
), stepped AS (
  SELECT part, o, s, substr(o, s, 1) AS l,
    sum(CASE WHEN coalesce(hit, 9) > s THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit = s THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit < s AND instr(fails, substr(o, s, 1)) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = substr(o, s, 1) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit = s THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM gone, (SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS s) GROUP BY part, o, s
)
SELECT part, o AS filter_order, s AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM stepped
"""


QUERIES = {
    "op1_revisits": op1_revisits,
    "op2_simhash": op2_simhash,
    "op3_token_counts": op3_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_topk": op5_topk,
    "op6_lm_mixing": op6_lm_mixing,
    "op7_langid": op7_langid,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_bpe_chunks": op11_bpe_chunks,
    "op12_shared_ranking": op12_shared_ranking,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {"op1_revisits": OP1_SQL, "op5_topk": OP5_SQL, "op12_shared_ranking": OP12_SQL, "op13_filter_audit": OP13_SQL}
