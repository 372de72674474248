"""Totals over stored postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LIVE_STATUSES


def status_histogram(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(F.coalesce("status", F.lit("null")).alias("status")).agg(F.count("*").alias("n"))


def totals(jobs: DataFrame) -> DataFrame:
    """One pass for all four."""
    return jobs.agg(F.count("*").alias("total"), F.count_if(F.col("status").isin(*LIVE_STATUSES)).alias("active"), F.count_if(F.col("status") == "expired").alias("expired"), F.count_if(F.col("last_probed_at").isNull()).alias("never_probed"))


def outcome_counters(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("outcome").agg(F.count("*").alias("n"))


def language_source_rollup(jobs: DataFrame) -> DataFrame:
    return jobs.rollup("lang", "source").agg(F.count("*").alias("n"))


def migrate_status(jobs: DataFrame) -> DataFrame:
    """The two older statuses become active with a tier."""
    old = F.col("status").isin("valid", "premium")
    return jobs.withColumns({"quality_tier": F.when(old, F.col("status")).otherwise(F.col("quality_tier")), "status": F.when(old, "active").otherwise(F.col("status"))})
