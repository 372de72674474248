"""Command line over the operators: ``python -m rolecast.cli import|expire|geocode|reindex|repair|stats|duplicates --root ROOT ...``.

External effects come as files: payloads and observations that other tools have landed.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reports
from .operators import dedupe, geocode, legacy, links, liveness, prefilter, stats
from .operators.store import Store
from .plans import importing
from .schemas import AI_RESULT, PROBE_OBSERVATION, RAW_JOB, SUPPORTED_LANGUAGES, URL_OBSERVATION
from .shared import cut
from .sources import payloads, registry


class Lines(logging.Formatter):
    """A JSON object a line, with the id of the run."""

    def __init__(self, run_id: str) -> None:
        super().__init__()
        self.run_id = run_id

    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"event": record.getMessage(), "level": record.levelname.lower(), "run_id": self.run_id, **getattr(record, "fields", {})}, default=str)


def run_log(run_id: str) -> logging.Logger:
    log = logging.getLogger("rolecast")
    handler = logging.StreamHandler(sys.stderr)
    handler.setFormatter(Lines(run_id))
    log.handlers, log.propagate = [handler], False
    log.setLevel(logging.INFO)
    return log


def optional(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)


def do_import(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    paths = dict(p.partition("=")[::2] for p in a.payload)
    names = [r["name"] for r in registry.chosen(spark.createDataFrame([(n,) for n in paths], "name string"), a.connectors).collect()]
    tables = Store(spark, a.root)
    stored = tables.read("jobs") if tables.exists("jobs") else None
    # Stored rows come before the batch in the order of arrival.
    top = stored.agg(F.coalesce(F.max("arrival_idx"), F.lit(-1))).first()[0] + 1 if stored is not None else 0
    budget = tables.read("budget") if tables.exists("budget") else spark.createDataFrame([], "provider string, ts timestamp, n long")

    def read(n: str) -> DataFrame:
        return payloads.to_raw_jobs(registry.metered(payloads.canonical(payloads.read_payload(spark, n, paths[n]), n), n, budget, a.as_of))

    parts, fetched = registry.isolated(sorted(names, key=list(paths).index), read, spark)
    labels = {n: payloads.SOURCES[n].extra.get("source", n) for n in names}
    fetched = fetched.replace(labels, subset=["source"])
    batch = payloads.union_all(list(parts.values()), a.limit_each, a.limit, top) if parts else spark.createDataFrame([], RAW_JOB)
    batch = cut(batch, "batch")
    if stored is None:
        stored = dedupe.with_hashes(prefilter.prefilter(batch, F.lit(a.as_of).cast("timestamp"))).withColumn("url_invalid", F.lit(False)).limit(0)
    results = tables.read("ai_results") if tables.exists("ai_results") else None
    given = optional(spark, a.results, AI_RESULT)
    done = importing.run(batch, stored, optional(spark, a.observations, URL_OBSERVATION), given if results is None else given.unionByName(results), a.as_of, dry_run=a.dry_run)
    if not a.dry_run:
        spent = fetched.filter(F.col("source").isin(*(labels[n] for n in names if n in registry.METERED)))
        if not spent.isEmpty():
            back = {v: k for k, v in labels.items()}
            tables.append("budget", spent.select(F.col("source").alias("provider"), F.lit(a.as_of).cast("timestamp").alias("ts"), F.col("jobs_fetched").alias("n")).replace(back, subset=["provider"]))
        importing.record(tables, done, fetched, uuid.uuid4().hex, a.as_of, languages=SUPPORTED_LANGUAGES)
    if a.report:
        facts = {"as of": a.as_of, "dry run": a.dry_run, "sources": len(names)}
        reports.write_text(spark, a.report, reports.markdown("Import", facts, {"Stages": done.stages, "Sources": fetched, "Reasons": links.most_common(done.failures)}))
    return done.counters


def do_expire(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    tables, now = Store(spark, a.root), F.lit(a.as_of).cast("timestamp")
    jobs = tables.read("jobs")
    old = jobs.filter(liveness.max_age_expired(now)).count()
    aged = liveness.expire_by_age(jobs, now)
    due = cut(liveness.probe_candidates(aged, now, "dedup_hash", a.limit or liveness.BATCH).select("url"), "due")
    first = dedupe.keep_first(optional(spark, a.observations, PROBE_OBSERVATION), ["url"], [F.col(c) for c in ("head_status", "error_kind", "location", "body")])
    seen = first.join(due, "url", "left_semi").select("url", liveness.expiry_verdict().alias("verdict"))
    if not a.dry_run:
        tables.write("jobs", liveness.apply_verdicts(aged, seen, now))
    return liveness.expiry_counters(seen, old, a.dry_run)


def do_geocode(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    tables = Store(spark, a.root)
    jobs = tables.read("jobs")
    due = geocode.addresses(geocode.candidates(jobs, "dedup_hash", a.limit or geocode.BATCH))
    answers = optional(spark, a.observations, "address string, payload string").join(due, "address", "left_semi")
    out = geocode.apply_answers(jobs, answers)
    if not a.dry_run:
        tables.write("jobs", out)
    return out.agg(F.count_if(F.col("location_geo").isNotNull()).alias("located"), F.count_if("geocode_pending").alias("pending"))


def do_reindex(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Make the keys unique again: of rows with the same hash the newest stays."""
    tables = Store(spark, a.root)
    rows, deleted = links.without_duplicates(tables.read("jobs"), "dedup_hash", "arrival_idx")
    deleted = cut(deleted, "deleted")
    if not a.dry_run:
        tables.write("jobs", rows)
    return deleted


def do_repair(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Repair texts that were decoded wrongly; a second run finds nothing to fix."""
    tables = Store(spark, a.root)
    swept = cut(legacy.repair_texts(tables.read("jobs")), "swept")
    if not a.dry_run:
        tables.write("jobs", swept.drop("scanned", "fixed"))
    return legacy.sweep_counts(swept)


def do_stats(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    jobs = Store(spark, a.root).read("jobs")
    return stats.status_histogram(jobs).unionByName(stats.totals(jobs).unpivot([], ["total", "active", "expired", "never_probed"], "status", "n"))


def do_duplicates(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return dedupe.duplicate_groups(Store(spark, a.root).read("jobs"), ["title", "company_name"])


COMMANDS = {"import": do_import, "expire": do_expire, "geocode": do_geocode, "reindex": do_reindex, "repair": do_repair, "stats": do_stats, "duplicates": do_duplicates}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rolecast")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--payload", action="append", default=[], help="SOURCE=PATH, repeatable")
    p.add_argument("--observations")
    p.add_argument("--results")
    p.add_argument("--as-of", default="2024-01-01 00:00:00")
    p.add_argument("--limit", type=int)
    p.add_argument("--limit-each", type=int)
    p.add_argument("--connectors", default="", help="names of sources, separated by commas; none: all")
    p.add_argument("--report", help="path of a Markdown report")
    p.add_argument("--health", help="path of a health file")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("rolecast").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    log = run_log(uuid.uuid4().hex)
    log.info("started", extra={"fields": {"command": a.command}})
    try:
        found = COMMANDS[a.command](spark, a).collect()
        if a.health:
            reports.health(spark, a.health, a.command, {"rows": [r.asDict() for r in found]}, a.as_of)
    except Exception as e:
        log.error("failed", extra={"fields": {"command": a.command, "error": type(e).__name__, "message": str(e)[:500]}})
        return 1
    for r in found:
        print(json.dumps(r.asDict(), default=str))
    log.info("done", extra={"fields": {"command": a.command, "rows": len(found)}})
    return 0


if __name__ == "__main__":
    sys.exit(main())
