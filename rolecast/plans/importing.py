"""The import: postings and recorded observations in, new tables and reports out, as one dataflow.

Outcomes are a column; counters are aggregates over it.  The resolution, which runs in Python, is written once and read by
all that follows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import ai, companies, dedupe, gate, links, liveness, prefilter, resolve, runs
from ..operators.store import Store, disable
from ..schemas import SCRAPE_METRICS
from ..shared import cut


@dataclass
class Imported:
    """Lazy results of an import; a caller writes what it wants to keep."""

    resolved: DataFrame  # a row a posting, with its outcome
    jobs: DataFrame  # new rows
    merged: DataFrame  # stored rows after merges
    changed: DataFrame  # the new rows, and those that merges changed
    counters: DataFrame  # rows by outcome
    stages: DataFrame  # the fourteen counters
    company_metrics: DataFrame
    results: DataFrame  # answers of the model that are new
    failures: DataFrame  # reason and n of all that was not taken


def with_observations(postings: DataFrame, observations: DataFrame) -> DataFrame:
    """Adds url_invalid and url_reason; a url that was not observed counts as valid.  Of several observations of a url the
    first in order of their values counts."""
    one = dedupe.keep_first(observations, ["url"], [F.col(c) for c in ("status_code", "error_kind", "final_url", "n_redirects")])
    seen = one.select("url", liveness.url_verdict().alias("_v"))
    return postings.join(seen, "url", "left").withColumns({"url_invalid": F.coalesce(~F.col("_v.is_valid"), F.lit(False)), "url_reason": F.col("_v.reason")}).drop("_v")


def run(postings: DataFrame, stored: DataFrame, observations: DataFrame, results: DataFrame, as_of: str, calls: dict[str, Callable] | None = None, dry_run: bool = False) -> Imported:
    """``stored`` has the columns of hashed postings and ids below the batch's; ``results`` are recorded model answers, and
    ``calls``, functions by tier, answer what they do not."""
    now = F.lit(as_of).cast("timestamp")
    rows = with_observations(dedupe.with_hashes(prefilter.prefilter(postings, now)), observations)
    outcomes = resolve.resolve(rows, stored, as_of)
    resolved = cut(rows.join(outcomes, "arrival_idx"), "resolved")
    new = resolved.filter("outcome = 'new'")
    c = F.col
    key = t.cache_key("extract", "v1", t.classify_payload(c("title"), c("company_name"), c("location_raw"), c("original_language"), c("description"), c("source_hints")))
    asked = new.withColumn("cache_key", key)
    if calls:
        prompts = asked.select("cache_key", ai.prompt(c("title"), c("company_name"), c("location_raw"), c("original_language"), c("description"), c("source_hints"), ai.get_prompt("extract", "v1")[1]).alias("prompt"))
        answers, log = ai.route(prompts, results, calls)
        fresh = log.filter("content is not null").select("cache_key", "content", "model", "tier", F.lit(None).cast("double").alias("confidence"))
    else:
        answers, fresh = ai.usable_results(results).select("cache_key", "output", "model"), results.limit(0)
    asked = asked.join(answers.select("cache_key", "output", "model"), "cache_key", "left")
    known = gate.evaluate(ai.classified(asked.filter("output is not null").drop("salary_min", "salary_max", "currency")), c("company_name"), c("description"))
    unknown = asked.filter("output is null").withColumns({"status": F.lit("rejected_quality"), "reject_reason": F.lit("AI_CLASSIFICATION_FAILED"), "quality_score": F.lit(0)})
    dead = resolved.filter("inserted and outcome <> 'new'").withColumns({"status": F.when(c("outcome") == "url_invalid", "expired").otherwise("rejected_prefilter"), "reject_reason": F.when(c("outcome") == "url_invalid", F.concat(F.lit("URL_INVALID:"), c("url_reason"))).otherwise(t.prefilter_code(c("prefilter_reason")))})
    jobs = known.unionByName(unknown, allowMissingColumns=True).unionByName(dead, allowMissingColumns=True)
    targets = stored.unionByName(jobs, allowMissingColumns=True)
    hits = resolved.filter("target_idx is not null")
    touched = hits.select(c("target_idx").alias("arrival_idx")).unionByName(jobs.select("arrival_idx")).distinct()
    merged = dedupe.merge_same_source(dedupe.merge_cross_source(targets, hits.filter("outcome <> 'dedupe_hit'")), hits.filter("outcome = 'dedupe_hit'"))
    outcome = F.coalesce(c("status_outcome"), c("outcome"))
    graded = known.select("arrival_idx", F.coalesce("quality_tier", F.lit("gate_rejected")).alias("status_outcome")).unionByName(unknown.select("arrival_idx", F.lit("ai_unavailable").alias("status_outcome")))
    counters = resolved.join(graded, "arrival_idx", "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
    ends = ("arrival_idx", "status", "quality_tier", "reject_reason", "geocode_pending")
    ended = known.select(*ends).unionByName(unknown.select("arrival_idx", "status", F.lit(None).cast("string").alias("quality_tier"), "reject_reason", F.lit(False).alias("geocode_pending")))
    staged = resolved.select("arrival_idx", "outcome", "prefilter_reason").join(ended, "arrival_idx", "left")
    reason = (
        F.when(c("outcome") == "rejected_prefilter", t.prefilter_code(c("prefilter_reason"))).when(c("outcome") == "url_invalid", "URL_INVALID").when(c("outcome") == "dedupe_hit", "DUPLICATE")
        .when((c("outcome") == "new") & (c("status") != "active"), c("reject_reason"))
    )
    failures = staged.select(reason.alias("reason")).filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    return Imported(resolved, jobs, merged, merged.join(touched, "arrival_idx", "left_semi"), counters, runs.stage_counters(staged, dry_run), companies.metrics(known), fresh, failures)


COMPANY = "name_normalized string, name string, company_id string, trust_score double, " + ", ".join(f"{c} {'double' if c == 'sum_quality_scores' else 'long'}" for c in SCRAPE_METRICS)
PROVIDER = "slug string, name string, enabled boolean, disabled_at timestamp, disabled_reason string"


def record(tables: Store, done: Imported, fetched: DataFrame, run_id: str, as_of: str, model: str = "", languages: tuple[str, ...] = (), by: str = "cli") -> dict[str, int]:
    """Write all tables of an import to the store, and return the versions.

    Postings are merged by their hash, which touches the buckets of changed rows only; companies get their first name and
    this run's metrics; each source gets a run record, all together a report; and a provider whose last runs all failed
    is switched off.
    """
    spark, now = tables.spark, F.lit(as_of).cast("timestamp")
    read = lambda name, schema: tables.read(name) if tables.exists(name) else spark.createDataFrame([], schema)
    out = {}
    changed = cut(done.changed, "changed")
    taken = done.resolved.filter("outcome = 'new'").select("name_normalized", "company_name", "arrival_idx")
    stored = companies.upsert_companies(read("companies", COMPANY), taken)
    firms = cut(companies.update_stored(stored, done.company_metrics).select(*(c.split()[0] for c in COMPANY.split(", "))), "companies")
    out["companies"] = tables.merge("companies", firms.join(taken.select("name_normalized").distinct(), "name_normalized", "left_semi"), "name_normalized", [F.col("name")])
    out["jobs"] = tables.merge("jobs", links.linked_companies(changed, firms.select("name_normalized", "company_id")), "dedup_hash", [F.col("arrival_idx")])
    if done.results.columns:
        out["ai_results"] = tables.append("ai_results", done.results)
    verdicts = done.resolved.groupBy("url").agg((~F.bool_or("url_invalid")).alias("is_valid"))
    invalid = links.invalid_by_source(done.resolved, verdicts)
    source_runs = cut(runs.source_records(fetched, done.resolved, invalid, tables.read("jobs"), now, now, run_id, ",".join(languages)), "runs")
    out["import_runs"] = tables.append("import_runs", source_runs)
    started = spark.createDataFrame([(run_id, model, by, list(languages))], "run_id string, ai_model string, triggered_by string, language_targets array<string>").withColumn("started_at", now)
    nothing = lambda schema: spark.createDataFrame([], schema)
    report = runs.finished_report(started, source_runs, done.failures.withColumn("report_id", F.lit(run_id)), nothing("report_id string, ms double"), nothing("report_id string, seq long, error string"), now)
    out["import_reports"] = tables.append("import_reports", report)
    history = tables.read("import_runs").withColumn("id", F.col("report_id"))
    off = runs.should_disable(history).filter("should_disable").join(runs.failure_streak(history), "provider")
    reasons = off.select(F.col("provider").alias("slug"), F.concat(F.lit("switched off after "), F.col("streak").cast("string"), F.lit(" failed runs in a row")).alias("reason"))
    out["providers"] = tables.merge("providers", cut(disable(read("providers", PROVIDER), reasons, now), "providers"), "slug", [F.col("name")])
    return out
