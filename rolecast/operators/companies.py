"""Company roll-ups: metrics of a run, trust scores, and the merge with what is stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.quality import items
from ..schemas import SCRAPE_METRICS

# Weights of the trust score, its value for the unknown, and the description length that counts in full.
WEIGHTS = {"quality": 25, "passed": 15, "salary": 20, "skills": 15, "premium": 10, "seniority": 10, "description": 5}
UNSEEN, FULL_DESCRIPTION = 80.0, 2000


def metrics(jobs: DataFrame) -> DataFrame:
    """Eight sums a company, of name_normalized, status, quality_score, quality_tier, salaries, skills, seniority and description."""
    return jobs.groupBy("name_normalized").agg(
        F.count("*").alias("total_jobs_seen"), F.count_if(F.col("status") == "active").alias("total_jobs_passed"), F.sum(F.col("quality_score").cast("double")).alias("sum_quality_scores"),
        F.count_if(F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()).alias("jobs_with_salary"), F.count_if(items(F.col("technical_skills")) > 0).alias("jobs_with_skills"),
        F.count_if(F.col("quality_tier") == "premium").alias("premium_count"), F.count_if(F.coalesce(F.col("seniority"), F.lit("")).isin("", "unknown") == F.lit(False)).alias("jobs_with_seniority"),
        F.sum(F.length(t.text("description"))).cast("long").alias("sum_description_length"),
    )


def trust_score() -> Column:
    """0 to 100, one decimal, from the columns of ``SCRAPE_METRICS``."""
    n = F.greatest("total_jobs_seen", F.lit(1))
    rate = lambda c: F.col(c) / n
    terms = {
        "quality": F.col("sum_quality_scores") / n / 100.0, "passed": rate("total_jobs_passed"), "salary": rate("jobs_with_salary"), "skills": rate("jobs_with_skills"),
        "premium": rate("premium_count"), "seniority": rate("jobs_with_seniority"), "description": F.least(rate("sum_description_length") / FULL_DESCRIPTION, F.lit(1.0)),
    }
    total = reduce(lambda a, b: a + b, (terms[k] * w for k, w in WEIGHTS.items()))
    return F.when(F.col("total_jobs_seen") == 0, UNSEEN).otherwise(F.bround(F.least(F.lit(100.0), F.greatest(F.lit(0.0), total)), 1))


def combine(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new metrics summed; the sums are mergeable, so history is never read again."""
    names = ["name_normalized", *SCRAPE_METRICS]
    merged = old.select(*names).unionByName(new.select(*names)).groupBy("name_normalized").agg(*(F.sum(c).alias(c) for c in SCRAPE_METRICS))
    return merged.withColumn("trust_score", trust_score())


def update_stored(companies: DataFrame, new: DataFrame) -> DataFrame:
    """Stored companies with this run's metrics added and the score computed again; unknown companies are not added."""
    run = new.select("name_normalized", *(F.col(c).alias(f"_{c}") for c in SCRAPE_METRICS))
    joined = companies.join(run, "name_normalized", "left")
    seen = F.col(f"_{SCRAPE_METRICS[0]}").isNotNull()
    summed = joined.withColumns({c: F.coalesce(c, F.lit(0)) + F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in SCRAPE_METRICS})
    return summed.withColumn("trust_score", F.when(seen, trust_score()).otherwise(F.col("trust_score"))).drop(*(f"_{c}" for c in SCRAPE_METRICS))


def upsert_companies(companies: DataFrame, batch: DataFrame) -> DataFrame:
    """New companies of a batch with their first name, the default score and zero counters; stored ones stay as they are."""
    named = batch.groupBy("name_normalized").agg(F.min_by("company_name", "arrival_idx").alias("_name"))
    out = companies.join(named, "name_normalized", "full_outer")
    return out.withColumns({"name": F.coalesce("name", "_name"), "company_id": F.coalesce("company_id", F.sha1("name_normalized")), "trust_score": F.coalesce("trust_score", F.lit(UNSEEN)), **{c: F.coalesce(c, F.lit(0)) for c in SCRAPE_METRICS}}).drop("_name")
