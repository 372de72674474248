"""Queries of stored tables, of repairs, and of calls to the outside, each with its DuckDB equivalent."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html
from ..functions import text as t
from ..functions.language import supported
from ..operators import ai, companies, dedupe, documents, geocode, legacy, links, liveness, probing, runs
from ..operators import store as tables
from ..schemas import AI_RESULT, SCRAPE_METRICS
from ..shared import cut, scratch
from . import adapters as a
from . import importing
from .adapters import AS_OF, HASHED, PARTS, STORED, hashed, parts
from .registered import query

def md5_of(c: str) -> F.Column:
    return F.md5(F.col(c)).alias(f"{c}_md5")


# Sinks


@query(f"""WITH {HASHED}, {PARTS}, n AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY dedup_hash ORDER BY arrival_idx) = 1), o AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY dedup_hash ORDER BY arrival_idx) = 1)
 SELECT dedup_hash, arrival_idx, md5(title) AS title_md5 FROM n UNION ALL SELECT dedup_hash, arrival_idx, md5(title) FROM o WHERE dedup_hash NOT IN (SELECT dedup_hash FROM n)""")
def upsert_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the store: the stored weeks, then the batch, which replaces rows of equal hashes."""
    batch, stored = (cut(x.select("dedup_hash", "arrival_idx", md5_of("title")), "rows") for x in parts(spark, sf_dir))
    s, order = tables.Store(spark, scratch(spark, "store"), 8), [F.col("arrival_idx")]
    s.merge("jobs", stored, "dedup_hash", order)
    s.merge("jobs", batch, "dedup_hash", order)
    return s.read("jobs")


@query(f"""WITH {HASHED}, {PARTS} SELECT dedup_hash, arrival_idx FROM s QUALIFY row_number() OVER (PARTITION BY dedup_hash ORDER BY arrival_idx) = 1
 UNION ALL (SELECT dedup_hash, arrival_idx FROM b WHERE dedup_hash NOT IN (SELECT dedup_hash FROM s) QUALIFY row_number() OVER (PARTITION BY dedup_hash ORDER BY arrival_idx) = 1)""")
def insert_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that only come in where their hash is not stored; what was added a second time adds nothing."""
    batch, stored = (cut(x.select("dedup_hash", "arrival_idx"), "rows") for x in parts(spark, sf_dir))
    s, order = tables.Store(spark, scratch(spark, "store"), 8), [F.col("arrival_idx")]
    s.merge("jobs", stored, "dedup_hash", order, absent=True)
    for _ in range(2):
        s.merge("jobs", batch, "dedup_hash", order, absent=True)
    return s.read("jobs")


@query(f"""WITH {HASHED}, n AS (SELECT name_normalized, arg_min(company_name, arrival_idx) AS first FROM hashed GROUP BY 1)
 SELECT name_normalized, CASE WHEN name_normalized < 'company 8' THEN 'old' ELSE first END AS name, CASE WHEN name_normalized < 'company 8' THEN 50.0 ELSE 80.0 END::DOUBLE AS trust_score, CASE WHEN name_normalized < 'company 8' THEN 7 ELSE 0 END::BIGINT AS total_jobs_seen FROM n""")
def upsert_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed(spark, sf_dir)
    old = rows.filter("name_normalized < 'company 8'").select("name_normalized").distinct()
    old = old.withColumns({"name": F.lit("old"), "company_id": F.sha1("name_normalized"), "trust_score": F.lit(50.0)} | {c: F.lit(7).cast("double" if c == "sum_quality_scores" else "long") for c in SCRAPE_METRICS})
    return companies.upsert_companies(old, rows).select("name_normalized", "name", "trust_score", "total_jobs_seen")


@query(f"WITH {HASHED} SELECT arrival_idx, CASE WHEN name_normalized < 'company 8' THEN sha1(name_normalized) END AS company_id FROM hashed")
def linked_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed(spark, sf_dir)
    known = rows.filter("name_normalized < 'company 8'").select("name_normalized", F.sha1("name_normalized").alias("company_id"))
    return links.linked_companies(rows.select("arrival_idx", "name_normalized"), known).select("arrival_idx", "company_id")


@query("SELECT lower(n_name) AS slug, CASE WHEN n_nationkey < 10 THEN n_nationkey % 2 = 0 ELSE true END AS enabled, 'new ' || n_name AS label FROM nation UNION ALL SELECT 'kept', false, 'old'")
def seeded_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, key = a.read(spark, sf_dir, "nation").withColumn("slug", F.lower("n_name")), F.col("n_nationkey")
    old = n.filter(key < 10).select("slug", (key % 2 == 0).alias("enabled"), F.lit("old").alias("label")).unionByName(spark.createDataFrame([("kept", False, "old")], "slug string, enabled boolean, label string"))
    return tables.seed(old, n.select("slug", F.lit(True).alias("enabled"), F.concat(F.lit("new "), "n_name").alias("label")), "slug").select("slug", "enabled", "label")


@query("SELECT lower(n_name) AS slug, CASE WHEN n_nationkey >= 15 THEN lower(n_name) ELSE n_name END AS name, n_nationkey % 3 <> 0 AND n_nationkey < 15 AS enabled, CASE WHEN n_nationkey % 3 = 0 OR n_nationkey >= 15 THEN 'failed' END AS disabled_reason FROM nation")
def disabled_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, key = a.read(spark, sf_dir, "nation").withColumn("slug", F.lower("n_name")), F.col("n_nationkey")
    stored = n.filter(key < 15).select("slug", F.col("n_name").alias("name"), F.lit(True).alias("enabled"), F.lit(None).cast("timestamp").alias("disabled_at"), F.lit(None).cast("string").alias("disabled_reason"))
    off = n.filter((key % 3 == 0) | (key >= 15)).select("slug", F.lit("failed").alias("reason"))
    return tables.disable(stored, off, a.as_of()).select("slug", "name", "enabled", "disabled_reason")


@query("SELECT text_md5, doc_id, n, kept FROM (SELECT doc_id, md5(text) AS text_md5, count(*) OVER (PARTITION BY text) AS n, max(doc_id) OVER (PARTITION BY text) AS kept FROM documents WHERE text IS NOT NULL) WHERE n > 1 AND doc_id <> kept")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document to be deleted, with the one that is kept for it."""
    return links.duplicate_ids(a.read(spark, sf_dir, "documents").select("doc_id", md5_of("text")), "text_md5", "doc_id")


@query("SELECT (SELECT count(*) FROM documents) - count(DISTINCT text) - count(*) FILTER (text IS NULL) AS deleted, count(DISTINCT text) + count(*) FILTER (text IS NULL) AS kept FROM documents")
def duplicates_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, deleted = links.without_duplicates(a.read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text")), "text", "doc_id")
    return deleted.crossJoin(kept.agg(F.count("*").alias("kept")))  # one row each


@query("SELECT user_id % 7 AS report, string_agg(event_id, ',' ORDER BY event_id) AS errors FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id % 7 ORDER BY event_id DESC) <= 100) GROUP BY 1")
def bounded_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = a.read(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("report"), F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("error"))
    return runs.bounded_errors(e, "report").select("report", F.array_join("errors", ",").alias("errors"))


@query("SELECT 'api' || user_id % 5 AS provider, CAST(ts AS DATE) AS period, CAST(sum(event_id % 3) AS BIGINT) AS used FROM events GROUP BY ALL")
def budget_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increments as appended rows, in two batches, and their sum."""
    e = a.read(spark, sf_dir, "events").select(F.concat(F.lit("api"), F.col("user_id") % 5).alias("provider"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 3).alias("n"))
    s, early = tables.Store(spark, scratch(spark, "store")), F.coalesce(F.hour("ts") < 12, F.lit(False))
    s.append("budget", e.filter(early))
    s.append("budget", e.filter(~early))
    return runs.budget_used(s.read("budget"))


@query("""WITH r AS (SELECT event_id, user_id % 5 AS p, row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) AS rn FROM events)
 SELECT event_id, 'api' || p AS provider, CAST((rn - 1) // 100 AS INT) AS page_no FROM r WHERE rn <= 250 - p * 40""")
def budgeted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are left of a month's budget of jobs, in pages of a hundred."""
    e = a.read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("api"), F.col("user_id") % 5).alias("provider"), F.col("event_id").alias("seq"))
    used = spark.range(5).select(F.concat(F.lit("api"), "id").alias("provider"), (F.col("id") * 40).alias("used"))
    return runs.within_budget(e, used).select("event_id", "provider", "page_no")


SOURCES = "s AS (SELECT user_id % 10 AS rid, user_id AS provider, count(*) AS fetched, sum(event_id % 20)::BIGINT AS passed, sum(event_id % 25)::BIGINT AS stored, sum(event_id % 3)::BIGINT AS url, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY ALL)"


@query(f"""WITH {SOURCES}, f AS (SELECT user_id % 10 AS rid, count(*) FILTER (event_type = 'view') AS url, count(*) FILTER (event_type = 'signup') AS dup, count(*) FILTER (event_type NOT IN ('view', 'signup')) AS other, avg(event_id % 97) AS ms FROM events GROUP BY 1)
 SELECT CAST(s.rid AS VARCHAR) AS run_id, count(*) AS total_sources, sum(fetched)::BIGINT AS total_fetched, sum(passed)::BIGINT AS total_passed_quality, sum(stored)::BIGINT AS total_upserted, any_value(f.dup) AS total_skipped_duplicate, sum(s.url)::BIGINT + any_value(f.url) AS total_url_invalid,
 sum(e)::BIGINT + any_value(f.other) AS total_failed_quality, round(any_value(f.ms), 6) AS avg_enrichment_ms, least(100, count(*))::BIGINT AS n_errors FROM s JOIN f USING (rid) GROUP BY s.rid""")
def import_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports folded from run records, single failures, times of model calls and errors."""
    e, i = a.read(spark, sf_dir, "events").withColumn("report_id", (F.col("user_id") % 10).cast("string")), F.col("event_id")
    is_error = F.count_if(F.col("event_type") == "error")
    sources = e.groupBy("report_id", F.col("user_id").alias("provider")).agg(
        F.count("*").alias("jobs_fetched"), F.sum(i % 20).alias("passed_quality_gate"), F.sum(i % 25).alias("jobs_stored"), F.sum(i % 3).alias("url_invalid_count"), F.lit(0).alias("jobs_duplicated"), F.lit(0).alias("soft_404_count"),
        F.create_map(F.lit("LOW_CONFIDENCE"), is_error).alias("failure_reasons"), F.lit(True).alias("connector_crashed"), F.lit("boom").alias("crash_reason"), F.min("ts").alias("started_at"),
    )
    failures = e.select("report_id", F.when(F.col("event_type") == "view", "URL_INVALID").when(F.col("event_type") == "signup", "DUPLICATE").otherwise(F.col("event_type")).alias("reason"), F.lit(1).alias("n"))
    started = e.select("report_id").distinct().select(F.col("report_id").alias("run_id"), a.as_of().alias("started_at"), F.lit("m").alias("ai_model"), F.lit("cli").alias("triggered_by"), F.array(F.lit("en")).alias("language_targets"))
    out = runs.finished_report(started, sources, failures, e.select("report_id", (i % 97).alias("ms")), e.limit(0).select("report_id", i.alias("seq"), F.lit("").alias("error")), a.as_of())
    names = ("total_sources", "total_fetched", "total_passed_quality", "total_upserted", "total_skipped_duplicate", "total_url_invalid", "total_failed_quality")
    return out.select("run_id", *names, F.round("avg_enrichment_ms", 6).alias("avg_enrichment_ms"), F.size("errors").cast("long").alias("n_errors"))


@query(f"""WITH {HASHED} SELECT source AS provider, count(*) AS jobs_stored, count(*) FILTER (arrival_idx % 6 = 1) AS url_invalid_count, round_even(coalesce(avg(arrival_idx % 80) FILTER (arrival_idx % 80 > 0), 0), 2) AS quality_score, count(*) FILTER (arrival_idx % 80 > 0) AS passed_quality_gate, CASE WHEN source < 'm' THEN 'failed' ELSE 'success' END AS status FROM hashed GROUP BY source""")
def source_run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, i = hashed(spark, sf_dir), F.col("arrival_idx")
    fetched = rows.groupBy("source").agg(F.count("*").alias("jobs_fetched")).withColumns({"crash_reason": F.when(F.col("source") < "m", "boom"), "failure_reason": F.when(F.col("source") < "m", "CONNECTOR_CRASH")})
    invalid = links.invalid_by_source(rows, rows.select("url", (i % 6 != 1).alias("is_valid")))
    out = runs.source_records(fetched, rows, invalid, rows.withColumn("quality_score", i % 80), a.as_of(), a.as_of())
    return out.select("provider", "jobs_stored", "url_invalid_count", "quality_score", "passed_quality_gate", "status")


@query("SELECT event_id, 'r' || user_id % 10 AS report_id, CASE WHEN user_id % 10 < 6 THEN 'model ' || user_id % 10 END AS report_model FROM events")
def runs_with_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = a.read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("r"), F.col("user_id") % 10).alias("report_id"))
    reports = spark.range(6).select(F.concat(F.lit("r"), "id").alias("run_id"), F.concat(F.lit("model "), "id").alias("model"))
    return links.runs_with_reports(e, reports)


OUTCOMES = "('rejected_prefilter', 'url_invalid', 'dedupe_hit', 'cross_source_hit', 'fuzzy_hit', 'new', 'new', 'new')"


@query("""WITH r AS (SELECT event_id, list_extract(['rejected_prefilter', 'url_invalid', 'dedupe_hit', 'cross_source_hit', 'fuzzy_hit', 'new', 'new', 'new'], CAST(event_id % 8 AS INT) + 1) AS o, event_id % 11 = 3 AS failed, event_id % 3 > 0 AS live, event_id % 5 = 0 AS prem, event_id % 7 = 0 AS pend FROM events)
 SELECT count(*) AS total, count(*) FILTER (o = 'rejected_prefilter') AS prefilter_rejected, count(*) FILTER (o = 'url_invalid') AS url_invalid, count(*) FILTER (o = 'dedupe_hit') AS dedupe_hit, count(*) FILTER (o = 'cross_source_hit') AS cross_source_hit, count(*) FILTER (o = 'fuzzy_hit') AS fuzzy_dup_flagged,
 count(*) FILTER (o = 'new' AND NOT failed) AS ai_classified, count(*) FILTER (o = 'new' AND failed) AS ai_unavailable, count(*) FILTER (o = 'new' AND NOT failed AND live AND NOT prem) AS gate_valid, count(*) FILTER (o = 'new' AND NOT failed AND live AND prem) AS gate_premium,
 count(*) FILTER (o = 'new' AND NOT failed AND NOT live) AS gate_rejected, count(*) FILTER (o = 'new') AS persisted, 0::BIGINT AS dry_run_skipped, count(*) FILTER (o = 'new' AND NOT failed AND live AND pend) AS geocode_pending FROM r""")
def stage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    names = ("rejected_prefilter", "url_invalid", "dedupe_hit", "cross_source_hit", "fuzzy_hit", "new", "new", "new")
    rows = a.read(spark, sf_dir, "events").select(
        F.element_at(F.array(*map(F.lit, names)), (i % 8 + 1).cast("int")).alias("outcome"), F.when(i % 11 == 3, "AI_CLASSIFICATION_FAILED").when(i % 3 == 0, "ZERO_SKILLS").alias("reject_reason"),
        F.when((i % 3 > 0) & (i % 11 != 3), "active").otherwise("rejected_quality").alias("status"), F.when(i % 5 == 0, "premium").otherwise("valid").alias("quality_tier"), (i % 7 == 0).alias("geocode_pending"),
    )
    return runs.stage_counters(rows)


@query("""WITH p AS (SELECT event_id, event_id % 17 = 0 AS nowhere, event_id % 13 = 0 AS failed, event_id % 3 AS k FROM events)
 SELECT count(*) AS total, count(*) FILTER (NOT nowhere) AS probed, count(*) FILTER (NOT nowhere AND NOT failed AND k = 0) AS expired, count(*) FILTER (NOT nowhere AND (failed OR k = 1)) AS transient, count(*) FILTER (NOT nowhere AND NOT failed AND k = 2) AS alive,
 count(*) FILTER (nowhere OR failed) AS error, count(*) FILTER (NOT nowhere) AS dry_run_skipped, 5::BIGINT AS max_age_expired FROM p""")
def expiry_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    none = F.lit(None).cast("boolean")
    verdict = F.struct(F.when(i % 13 == 0, none).when(i % 3 == 0, True).when(i % 3 == 1, none).otherwise(False).alias("expired"), F.when(i % 13 == 0, "PROBE_ERROR").alias("reason"))
    return liveness.expiry_counters(a.read(spark, sf_dir, "events").select(F.when(i % 17 != 0, "u").otherwise("").alias("url"), verdict.alias("verdict")), 5, True)


@query(f"WITH {STORED} SELECT job_id, CASE WHEN job_id % 4 = 1 THEN 'expired' ELSE status END AS status, CASE WHEN job_id % 4 = 1 THEN 'EXPIRED_404' END AS reject_reason, CASE WHEN job_id % 4 <> 3 THEN TIMESTAMP '{AS_OF}' ELSE last_probed_at END AS last_probed_at FROM stored")
def applied_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("job_id")
    jobs = a.stored_jobs(spark, sf_dir).withColumns({"url": F.concat(F.lit("https://x/"), i), "reject_reason": F.lit(None).cast("string")})
    verdict = F.struct(F.when(i % 4 == 1, True).when(i % 4 == 2, False).alias("expired"), F.when(i % 4 == 1, "EXPIRED_404").alias("reason"))
    seen = jobs.filter(i % 4 != 3).select("url", verdict.alias("verdict"))
    out = liveness.apply_verdicts(jobs, seen, a.as_of())
    return out.select("job_id", "status", "reject_reason", F.col("last_probed_at").cast("timestamp_ntz").alias("last_probed_at"))


# Joins


@query("SELECT page_id, page_id % 5 IN (1, 2) AS url_invalid, CASE page_id % 5 WHEN 1 THEN 'http_404' WHEN 2 THEN 'http_410' WHEN 3 THEN 'ok' END AS url_reason FROM pages")
def observed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several observations of a url the first in order of their values counts; a url without any is valid."""
    i = F.col("page_id")
    pages = a.read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://x/"), i).alias("url"))
    code = lambda c: F.when(i % 5 == 1, 404).when(i % 5 == 2, 410).otherwise(c)
    seen = pages.filter(i % 5 != 4).filter(i % 5 != 0).select("url", code(200).alias("status_code"), "url", F.lit(0).alias("n_redirects"), F.lit(None).cast("string").alias("error_kind")).toDF("url", "status_code", "final_url", "n_redirects", "error_kind")
    return importing.with_observations(pages, seen.unionByName(seen.withColumn("status_code", F.lit(500)))).select("page_id", "url_invalid", "url_reason")


@query("SELECT doc_id FROM documents WHERE doc_id % 50 > 0 AND doc_id % 3 = 0")
def graded_by_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    jobs = a.read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("u"), i).alias("url"), (i % 50).alias("quality_score"))
    return links.graded_by_urls(jobs, jobs.filter(i % 3 == 0)).select("doc_id")


@query("SELECT source, count(*) FILTER (doc_id % 4 = 0) AS url_invalid_count FROM documents GROUP BY 1")
def invalid_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    rows = a.read(spark, sf_dir, "documents").select("source", F.concat(F.lit("u"), i).alias("url"), i)
    return links.invalid_by_source(rows.unionByName(rows), rows.filter(i % 3 != 1).select("url", (i % 4 != 0).alias("is_valid")).unionByName(rows.select("url", (i % 4 != 0).alias("is_valid"))))


@query("SELECT url, min(event_id) AS arrival_idx FROM (SELECT event_id, CASE WHEN user_id % 9 = 0 THEN '' ELSE 'u' || user_id END AS url FROM events) WHERE url <> '' GROUP BY 1")
def distinct_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    return links.distinct_urls(a.read(spark, sf_dir, "events").select(F.when(u % 9 == 0, "").otherwise(F.concat(F.lit("u"), u)).alias("url"), F.col("event_id").alias("arrival_idx")))


@query("SELECT count(*) AS total, count(*) FILTER (event_id % 3 = 0) AS invalid, count(*) FILTER (event_id % 3 <> 0) AS valid FROM events")
def validity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.validity_counts(a.read(spark, sf_dir, "events").select((F.col("event_id") % 3 != 0).alias("is_valid")))


@query("SELECT event_type AS reason, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) AS INT) AS rank FROM events GROUP BY 1")
def most_common_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.most_common(a.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("reason")).agg(F.count("*").alias("n")))


@query(f"WITH {STORED} SELECT count(*) FILTER (status = 'valid') AS valid, count(*) FILTER (status = 'premium') AS premium FROM stored")
def old_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.old_status_counts(a.stored_jobs(spark, sf_dir))


# Expressions


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') END AS iso, CASE WHEN event_id % 5 <> 0 THEN epoch(CAST(ts AS TIMESTAMP))::BIGINT END AS seconds FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events WHERE ts IS NOT NULL)")
def parsed_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO texts with a zone or a Z, and seconds; what is neither is null."""
    i, ts = F.col("event_id"), F.date_trunc("second", F.col("ts").cast("timestamp"))
    raw = F.when(i % 4 == 0, "garbage").when(i % 4 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    sec = F.when(i % 5 == 0, "x").otherwise(F.unix_timestamp(ts).cast("string"))
    out = a.read(spark, sf_dir, "events").filter("ts is not null")
    return out.select("event_id", F.date_format(t.parse_iso(raw), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.unix_timestamp(t.epoch_timestamp(sec)).alias("seconds"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '<p>a</p><b>' || doc_id || '</b>' ELSE 'plain ' || doc_id END AS cleaned, '<h2>T</h2><h3>' || doc_id || '</h3><h2>U</h2><p>x</p>' AS headings FROM documents")
def cleaned_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media and scripts go from descriptions; headings start at the second level, go down one at a time, and empty elements go."""
    i = F.col("doc_id").cast("string")
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<p>a<script>x<b>y</b></script></p><img src='i'><figure><b>c</b></figure><b>"), i, F.lit("</b><style>z</style>"))).otherwise(F.concat(F.lit("plain "), i))
    heads = F.concat(F.lit("<h1>T</h1><h5>"), i, F.lit("</h5><p> </p><h2>U</h2><div><span></span></div><p>x</p>"))
    return a.read(spark, sf_dir, "documents").select("doc_id", html.clean_description(raw).alias("cleaned"), html.normalize_html(heads).alias("headings"))


@query("SELECT doc_id, 'Head ' || doc_id || chr(10) || chr(10) || trim(repeat('Some words of number ' || doc_id || '. ', 30)) AS description, CASE WHEN doc_id % 2 = 0 THEN 'logo' || doc_id || '.png' END AS logo_url FROM documents")
def main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest container with enough text, without navigation, and the logo that stands before any of its text."""
    i = F.col("doc_id").cast("string")
    logo = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<img src='logo"), i, F.lit(".png'>"))).otherwise("")
    body = F.repeat(F.concat(F.lit("Some words of number "), i, F.lit(". ")), 30)
    page = F.concat(F.lit("<html><body><nav>menu</nav><div class='content'><p>short</p></div><main>"), logo, F.lit("<p>Head "), i, F.lit("</p><p>"), body, F.lit("</p></main><aside>side</aside><footer>foot</footer></body></html>"))
    return a.read(spark, sf_dir, "documents").select("doc_id", html.extract_content(page).alias("c")).select("doc_id", "c.description", "c.logo_url")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang WHEN doc_id % 4 = 1 THEN source WHEN doc_id % 4 = 2 THEN 'x' ELSE '' END AS picked FROM documents")
def first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id") % 4
    return a.read(spark, sf_dir, "documents").select("doc_id", t.first_text(F.when(i == 0, F.concat(F.lit(" "), "lang", F.lit("\t"))).when(i == 1, "  "), F.when(i == 1, F.col("source")), F.when(i == 2, "x"), F.when(i == 0, "late")).alias("picked"))


@query("SELECT doc_id, doc_id % 3 <> 1 AS ok FROM documents")
def supported_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared language that is known is trusted, whatever the text; others are told from the text."""
    i = F.col("doc_id") % 3
    declared, text = F.when(i == 0, "EN").when(i == 1, "ja"), F.when(i == 2, "the work of the team is in the office and it is good for all of us").otherwise("日本語の求人です。")
    return a.read(spark, sf_dir, "documents").select("doc_id", supported(declared, text).alias("ok"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'PREFILTER_' ELSE '' END || 'PREFILTER_X' AS dummy, doc_id % 3 = 0 AS dns, doc_id % 4 IN (1, 2) AS geo, doc_id % 5 = 0 AS relevant, doc_id % 600 = 429 OR doc_id % 600 >= 500 AS retry FROM documents")
def small_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reason codes, errors of name lookup, points on the globe, titles of interest, statuses that may be tried again."""
    i = F.col("doc_id")
    code = t.prefilter_code(F.when(i % 2 == 0, "PREFILTER_X").otherwise("X"))
    dns = liveness.dns_error(F.when(i % 3 == 0, "[Errno -2] Name or SERVICE not known").when(i % 3 == 1, "timed out"))
    geo = t.geo_point_valid(F.when(i % 4 == 0, 181.0).when(i % 4 < 3, 9.2), F.lit(45.1))
    return a.read(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.when(i % 2 == 0, "PREFILTER_").otherwise(""), code).alias("dummy"), dns.alias("dns"), geo.alias("geo"),
        t.relevant_title(F.when(i % 5 == 0, "Senior DEVELOPER").otherwise("Nurse"), ["engineer", "develop"]).alias("relevant"), liveness.retryable(i % 600).alias("retry"),
    )


@query("SELECT page_id, CASE WHEN page_id % 4 < 2 THEN page_id % 90 + 0.5 END::DOUBLE AS lat, CASE WHEN page_id % 4 < 2 THEN 'Name ' || page_id END AS formatted_address, CASE page_id % 4 WHEN 0 THEN 'Town' WHEN 1 THEN 'City' END AS city, CASE WHEN page_id % 4 < 2 THEN 'IT' END AS country FROM pages")
def geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of JSON answers: without a point, or with one off the globe, there is none."""
    i = F.col("page_id")
    text = F.format_string('[{"lat":"%s","lon":"%s","display_name":"Name %s","address":{%s,"country_code":"it"}}]', (i % 90 + 0.5).cast("string"), F.when(i % 4 == 2, "x").otherwise("9.25"), i.cast("string"), F.when(i % 4 == 0, '"town":"Town","village":"V"').otherwise('"city":"City","town":"Town"'))
    found = a.read(spark, sf_dir, "pages").select("page_id", geocode.answer(F.when(i % 4 == 3, "[]").otherwise(text), F.lit("address")).alias("g"))
    return found.select("page_id", "g.lat", "g.formatted_address", "g.city", "g.country")


@query("SELECT CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 > 0 ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0') LIMIT 50")
def geocode_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    jobs = a.read(spark, sf_dir, "documents").select(i.cast("string").alias("key"), F.lpad(i.cast("string"), 12, "0").alias("o"), (i % 3 == 0).alias("geocode_pending"), F.when(i % 5 > 0, "Rome").alias("location_raw"))
    return geocode.candidates(jobs, "o").select("key")


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'array' WHEN 1 THEN 'string' WHEN 2 THEN 'number' WHEN 3 THEN 'null' WHEN 4 THEN 'array' ELSE 'boolean' END AS kind, CASE doc_id % 6 WHEN 0 THEN 'Rome' WHEN 1 THEN 'Paris' WHEN 2 THEN CAST(doc_id AS VARCHAR) WHEN 5 THEN 'True' END AS city FROM documents""")
def repaired_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    raw = F.when(i % 6 == 0, '["Rome","Oslo"]').when(i % 6 == 1, '"Paris"').when(i % 6 == 2, i.cast("string")).when(i % 6 == 3, "null").when(i % 6 == 4, "[]").otherwise("true")
    return a.read(spark, sf_dir, "documents").select("doc_id", legacy.kind(raw).alias("kind"), legacy.city(raw).alias("city"))


@query("SELECT event_id, CASE WHEN event_id % 8 < 7 THEN CASE WHEN event_id % 8 < 5 THEN ts ELSE date_trunc('day', ts) END END AS repaired FROM (SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts FROM events WHERE ts IS NOT NULL)")
def repaired_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven formats of dates that were stored as text."""
    i, ts = F.col("event_id"), F.date_trunc("second", F.col("ts").cast("timestamp"))
    formats = ["yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "EEE, dd MMM yyyy HH:mm:ss +0200", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyy-MM-dd", "d MMM yyyy"]
    raw = F.coalesce(*(F.when(i % 8 == k, F.date_format(ts, f.replace("+0200", "'+0200'"))) for k, f in enumerate(formats)), F.lit("some day"))
    return a.read(spark, sf_dir, "events").filter("ts is not null").select("event_id", legacy.repaired_date(raw).cast("timestamp_ntz").alias("repaired"))


@query("SELECT count(*) FILTER (doc_id % 4 = 0 OR doc_id % 6 = 0) AS scanned, count(*) FILTER (doc_id % 4 = 0 OR doc_id % 6 = 0) AS fixed, (SELECT count(*) FROM documents) AS clean FROM documents")
def mojibake_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged titles and companies repaired in place; a second sweep finds nothing."""
    i = F.col("doc_id")
    rows = a.read(spark, sf_dir, "documents").select("doc_id", F.when(i % 4 == 0, "dÃ©veloppeur").otherwise("plain").alias("title"), F.when(i % 6 == 0, "CafÃ©").otherwise(None).alias("company_name"))
    swept = cut(legacy.repair_texts(rows), "swept")
    again = legacy.repair_texts(swept.drop("scanned", "fixed"))
    return legacy.sweep_counts(swept).crossJoin(again.agg(F.count_if(~F.col("scanned")).alias("clean")))  # one row each


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Rome' ELSE 'Old' END AS city, CASE WHEN doc_id % 5 = 0 THEN doc_id WHEN doc_id % 3 = 0 THEN 5 END AS salary_min, CASE doc_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE false END AS remote FROM documents""")
def merged_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older answers of a model, coerced, over a posting's own values."""
    i = F.col("doc_id")
    answer = {"city_json": F.when(i % 2 == 0, '["Rome"]').otherwise('""'), "salary_min": F.when(i % 3 == 0, "5").otherwise("5.7"), "salary_max": F.lit("x"), "remote": F.when(i % 4 == 0, True).when(i % 4 == 1, False), "is_remote": F.when(i % 4 == 2, True)}
    rows = a.read(spark, sf_dir, "documents").select("doc_id", F.lit("Old").alias("city"), F.when(i % 5 == 0, i).alias("salary_min"), F.lit(None).cast("long").alias("salary_max"), F.lit(False).alias("remote"), *(c.alias(f"ai_{n}") for n, c in legacy.coerced_answer(answer).items()))
    return legacy.merged_answer(rows, ("city", "salary_min", "salary_max", "remote")).select("doc_id", "city", "salary_min", "remote")


@query("SELECT doc_id, 'l' || doc_id AS link FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT min(doc_id), 'l' || (doc_id - doc_id % 3) FROM documents WHERE doc_id % 2 = 1 AND 'l' || (doc_id - doc_id % 3) NOT IN (SELECT 'l' || doc_id FROM documents WHERE doc_id % 2 = 0) GROUP BY 2")
def inserted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by link: stored ones stay, of new links the first row comes in."""
    i, docs = F.col("doc_id"), a.read(spark, sf_dir, "documents")
    stored = docs.filter(i % 2 == 0).select("doc_id", F.concat(F.lit("l"), i).alias("link"))
    batch = docs.filter(i % 2 == 1).select("doc_id", F.concat(F.lit("l"), i - i % 3).alias("link"))
    return legacy.insert_by_link(stored, links.new_links(batch, stored), [i])


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'logo' ELSE CASE WHEN n_nationkey < 10 THEN 'old' END END AS logo, CASE WHEN n_nationkey % 3 = 0 THEN 'new' ELSE CASE WHEN n_nationkey < 10 THEN 'site' END END AS website, 80.0::DOUBLE AS trust FROM nation")
def named_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = a.read(spark, sf_dir, "nation"), F.col("n_nationkey")
    none = F.lit(None).cast("string")
    fields = {c: none for c in legacy.COMPANY_FIELDS}
    stored = n.filter(k < 10).select(F.col("n_name").alias("name"), F.lit("old").alias("logo"), F.lit("old").alias("logo_url"), *(c.alias(f) for f, c in (fields | {"website": F.lit("site")}).items()), *(F.lit(v).alias(c) for c, v in legacy.COMPANY_DEFAULTS.items()))
    batch = n.select(F.col("n_name").alias("name"), none.alias("logo"), F.when(k % 2 == 0, "logo").otherwise("").alias("logo_url"), *(c.alias(f) for f, c in (fields | {"website": F.when(k % 3 == 0, "new").otherwise("")}).items()), k.alias("o"))
    return legacy.upsert_named_companies(stored, batch, F.col("o")).select("name", "logo", "website", F.col("trustScore").alias("trust"))


@query("SELECT DISTINCT CASE WHEN n_nationkey % 4 = 0 THEN 'Unknown' ELSE 'Level ' || n_nationkey % 4 END AS level FROM nation UNION SELECT 'Old'")
def seniority_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return legacy.upsert_levels(spark.createDataFrame([("Old",), ("Unknown",)], "level string"), a.read(spark, sf_dir, "nation").select(F.when(k % 4 > 0, F.concat(F.lit("Level "), k % 4)).when(k % 8 == 0, "").alias("level")))


# Documents

CODEC = """SELECT doc_id, 'https://x/' || doc_id AS url, CASE WHEN doc_id % 3 = 0 THEN 'City' WHEN doc_id % 3 = 1 THEN 'Flat' END AS city, CASE WHEN doc_id % 3 <> 2 THEN 'Raw' END AS location_raw, CASE WHEN doc_id % 5 = 0 THEN 'senior' ELSE 'unknown' END AS seniority,
 CASE WHEN doc_id % 4 = 0 THEN 90 ELSE doc_id % 50 END::INT AS quality_score, CASE WHEN doc_id % 4 = 0 THEN 'premium' WHEN doc_id % 4 = 1 THEN 'valid' END AS quality_tier, lang AS language, CASE WHEN doc_id % 7 = 0 THEN 'expired' ELSE 'active' END AS status, 'Company' AS company_name, 0 AS n_skills FROM documents"""


@query(CODEC)
def document_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the older layout and of the flat one as typed postings, and after a second trip through a document."""
    i = F.col("doc_id")
    place = F.struct(F.lit("Raw").alias("raw"), F.lit("City").alias("city"), F.lit("C").alias("country"), F.lit("F").alias("formatted_address"), F.lit(None).cast(documents.POINT).alias("geo"))
    score = F.struct(F.lit(90).alias("quality_score"), F.lit("premium").alias("quality_tier"), F.lit(False).alias("geocode_pending"))
    rows = a.read(spark, sf_dir, "documents").select(
        i.cast("string").alias("external_id"), F.when(i % 2 == 0, F.concat(F.lit("https://x/"), i)).otherwise("").alias("url"), F.concat(F.lit("https://x/"), i).alias("link"), F.when(i % 3 == 0, place).alias("location"), F.when(i % 3 == 1, "Flat").alias("city"),
        F.when(i % 4 == 0, score).alias("quality"), (i % 50).cast("int").alias("quality_score"), F.when(i % 4 == 1, "valid").when(i % 4 == 2, "nonsense").alias("quality_tier"), F.when(i % 5 == 0, "senior").when(i % 5 == 1, "guru").alias("seniority"),
        F.col("lang").alias("language"), F.when(i % 7 == 0, "expired").when(i % 7 == 1, "odd").alias("status"), F.struct(F.lit("Company").alias("name"), F.lit("company").alias("name_normalized"), F.lit(None).cast("string").alias("logo"), F.lit("").alias("id")).alias("company"),
    )
    typed = documents.from_document(rows).withColumn("location_raw", F.when(i_of("external_id") % 3 == 1, "Raw").otherwise(F.col("location_raw")))
    again = documents.from_document(documents.to_document(typed))
    return again.select(i_of("external_id").alias("doc_id"), "url", "city", "location_raw", "seniority", "quality_score", "quality_tier", "language", "status", "company_name", F.size("technical_skills").alias("n_skills"))


def i_of(c: str) -> F.Column:
    return F.col(c).cast("long")


# Model


@query("SELECT prompt_id, version FROM (VALUES ('extract', 'v1'), ('triage', 'v1'), ('spam_check', 'v1')) v(prompt_id, version)")
def prompt_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ai.prompt_registry(spark).select("prompt_id", "version")


@query("""SELECT doc_id, 'TITLE: ' || source || chr(10) || 'COMPANY: ' || lang || chr(10) || 'DESCRIPTION:' || chr(10) || substr(text, 1, 1500) AS triage, length('TITLE: ' || source || chr(10) || 'COMPANY: ' || chr(10) || 'LOCATION: here' || chr(10) || 'DESCRIPTION:' || chr(10) || substr(text, 1, 4000))::INT AS spam_chars,
 CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'IMPORTANT: mind' || chr(10) ELSE '' END || 'POSTING:' AS freeform FROM documents WHERE text IS NOT NULL""")
def built_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts without the schema that ends them: descriptions are cut at 1500 and 4000 characters."""
    c = F.col
    bare = lambda p: F.split_part(p, F.lit("\n\nAnswer in JSON of this schema:\n{\"type\""), F.lit(1))
    free = ai.freeform_prompt(c("text"), F.when(c("doc_id") % 2 == 0, "mind"))
    return a.read(spark, sf_dir, "documents").filter("text is not null").select("doc_id", bare(ai.triage_prompt(c("source"), c("lang"), c("text"))).alias("triage"), F.length(bare(ai.spam_prompt(c("source"), F.lit(None).cast("string"), F.lit("here"), c("text")))).alias("spam_chars"), F.regexp_extract(free, "(?s)^(.*?POSTING:)", 1).alias("freeform"))


def answer(confidence: float) -> str:
    return json.dumps({"skills": ["x"], "seniority": "senior", "confidence": confidence})


def fast_model(prompt: str) -> tuple[str, str]:
    """A model for the query: sure of some requests, unsure of others, and broken for some."""
    n = int(prompt.rsplit(" ", 1)[1])
    if n % 10 == 7:
        raise ValueError("refused")
    if n % 10 == 8:
        return "no json", "small"
    return answer(0.9 if n % 2 == 0 else 0.3), "small"


def struct_model(prompt: str) -> tuple[str, str]:
    n = int(prompt.rsplit(" ", 1)[1])
    if n % 10 == 3:
        raise ValueError("refused")
    return answer(0.5 if n % 10 == 5 else 0.95), "large"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return a.read(spark, sf_dir, "documents").select(F.concat(F.lit("k"), i).alias("cache_key"), F.concat(F.lit("request "), i).alias("prompt"))


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of an earlier run for some requests; some cannot be read any more."""
    i = F.col("doc_id")
    rows = a.read(spark, sf_dir, "documents").filter(i % 6 == 0)
    return rows.select(F.concat(F.lit("k"), i).alias("cache_key"), F.when(i % 12 == 0, answer(0.8)).otherwise("torn").alias("content"), F.lit("old").alias("model"), F.lit("FAST").alias("tier"), F.lit(0.8).alias("confidence"))


@query("SELECT 'k' || doc_id AS cache_key FROM documents WHERE doc_id % 12 <> 0")
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = requests(spark, sf_dir)
    return ai.misses(asked.unionByName(asked), recorded(spark, sf_dir)).select("cache_key")


ROUTED = """r AS (SELECT doc_id, doc_id % 12 = 0 AS hit, doc_id % 10 AS d FROM documents)"""


@query(f"""WITH {ROUTED} SELECT 'k' || doc_id AS cache_key, CASE WHEN hit THEN 'old' WHEN d % 2 = 0 THEN 'small' ELSE 'large' END AS model, CASE WHEN hit OR d % 2 = 0 THEN 'FAST' ELSE 'STRUCT' END AS tier, CASE WHEN NOT hit AND d % 2 = 1 THEN 'FAST' END AS escalated_from,
 CASE WHEN hit THEN 0.8 WHEN d % 2 = 0 THEN 0.9 WHEN d = 5 THEN 0.5 ELSE 0.95 END::DOUBLE AS confidence FROM r WHERE hit OR d NOT IN (7, 8, 3)""")
def routed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached answers, answers of the small model, and of the large one where the small was unsure; a large one's failure leaves none."""
    done, _ = ai.route(requests(spark, sf_dir), recorded(spark, sf_dir), {"FAST": fast_model, "STRUCT": struct_model}, sleep=no_wait)
    return done.select("cache_key", "model", "tier", "escalated_from", F.col("output.confidence").alias("confidence"))


@query(f"""WITH {ROUTED}, c AS (SELECT 'FAST' AS tier, d, d = 7 AS refused, d = 8 AS torn FROM r WHERE NOT hit UNION ALL SELECT 'STRUCT', d, d = 3, false FROM r WHERE NOT hit AND d % 2 = 1 AND d <> 7)
 SELECT tier, count(*) AS n, CAST(sum(CASE WHEN torn THEN 3 ELSE 1 END) AS BIGINT) AS attempts, count(*) FILTER (refused) AS refused, count(*) FILTER (torn) AS torn FROM c GROUP BY 1""")
def model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls by tier: an answer that cannot be read is asked for three times, a refusal is final, and both leave a row."""
    _, log = ai.route(requests(spark, sf_dir), recorded(spark, sf_dir), {"FAST": fast_model, "STRUCT": struct_model}, sleep=no_wait)
    return log.groupBy("tier").agg(F.count("*").alias("n"), F.sum("attempts").alias("attempts"), F.count_if(F.col("error").startswith("ValueError")).alias("refused"), F.count_if(F.col("error").startswith("invalid")).alias("torn"))


def no_wait(seconds: float) -> None:
    """A clock for calls that need no pause."""


@query("SELECT 'k' || event_id AS cache_key FROM events ORDER BY ts DESC NULLS LAST, 'k' || event_id LIMIT 4096")
def evicted_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results used last, as many as the cache holds."""
    return ai.evict(a.read(spark, sf_dir, "events").select(F.concat(F.lit("k"), "event_id").alias("cache_key"), F.col("ts").alias("last_used"))).select("cache_key")


# Probes


def page_client(method: str, url: str) -> probing.Reply:
    """A client without a network: what it answers is told by the number that ends a url."""
    n = int(url.rsplit("/", 1)[1])
    if n % 11 == 0:
        raise probing.ProbeError("dns")
    if n % 11 == 1:
        raise probing.ProbeError("redirect_loop")
    if n % 7 == 0 and method == "HEAD":
        return probing.Reply(405)
    if n % 7 == 0:
        return probing.Reply(200, url)
    if n % 5 == 0:
        return probing.Reply(404, url)
    if n % 5 == 1:
        return probing.Reply(200, "https://x.example.com/jobs", 1)
    return probing.Reply(301 if n % 5 == 2 else 200, url, location="https://x/job-not-found" if n % 3 == 0 else "https://x/else", body="gone now" if n % 2 == 0 else "still here")


PROBED = "p AS (SELECT page_id AS n, 'https://x.example.com/' || page_id AS url FROM pages)"


@query(f"""WITH {PROBED} SELECT url, CASE WHEN n % 11 = 0 THEN 'dns_error' WHEN n % 11 = 1 THEN 'transient' WHEN n % 7 = 0 THEN 'ok' WHEN n % 5 = 0 THEN 'http_404' WHEN n % 5 = 1 THEN 'redirect_to_root' ELSE 'ok' END AS reason FROM p""")
def observed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct urls of a table asked by a client, dealt out by host, and the verdicts on what it saw."""
    urls = a.read(spark, sf_dir, "pages").select(F.concat(F.lit("https://x.example.com/"), "page_id").alias("url"))
    seen = probing.observe_urls(urls.unionByName(urls), page_client, 4)
    return seen.select("url", liveness.url_verdict()["reason"].alias("reason"))


@query(f"""WITH {PROBED} SELECT url, CASE WHEN n % 11 = 0 THEN 'PROBE_ERROR' WHEN n % 11 = 1 THEN 'EXPIRED_REDIRECT_LOOP' WHEN n % 7 = 0 THEN NULL WHEN n % 5 = 0 THEN 'EXPIRED_404' WHEN n % 5 = 1 THEN NULL WHEN n % 5 = 2 THEN CASE WHEN n % 3 = 0 THEN 'EXPIRED_REDIRECT' END
 WHEN n % 2 = 0 THEN 'EXPIRED_PATTERN' END AS reason FROM p""")
def probed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes for expiry with a body where the page is there; the phrases of a source tell that it is gone."""
    urls = a.read(spark, sf_dir, "pages").select(F.concat(F.lit("https://x.example.com/"), "page_id").alias("url"), F.lit("board").alias("source"))
    seen = probing.probe_jobs(urls, page_client, 0.0, 4)
    return seen.select("url", liveness.expiry_verdict({"board": ["gone now"]})["reason"].alias("reason"))


def address_service(address: str) -> str | None:
    if address.endswith("3"):
        raise ValueError("no answer")
    return f"[{address}]"


@query("SELECT 'City ' || n_nationkey % 7 AS address, CASE WHEN n_nationkey % 7 <> 3 THEN '[City ' || n_nationkey % 7 || ']' END AS payload, CASE WHEN n_nationkey % 7 = 3 THEN 'no answer' END AS error FROM nation GROUP BY n_nationkey % 7")
def looked_up_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address is looked up once, through one task; a failure is a row."""
    jobs = a.read(spark, sf_dir, "nation").select(F.concat(F.lit(" City "), F.col("n_nationkey") % 7).alias("location_raw"))
    return probing.look_up(geocode.addresses(jobs), address_service, 0.0)


@query("SELECT 'k' || doc_id AS cache_key, 'x' AS skill, 'senior' AS seniority, 0.8::DOUBLE AS ai_confidence, false AS remote FROM documents WHERE doc_id % 12 = 0")
def mapped_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a classification from recorded answers."""
    rows = ai.classified(ai.usable_results(recorded(spark, sf_dir).select(*(c.split()[0] for c in AI_RESULT.split(", ")))))
    return rows.select("cache_key", F.get("skills", F.lit(0)).alias("skill"), "seniority", "ai_confidence", F.coalesce("remote", F.lit(False)).alias("remote"))
