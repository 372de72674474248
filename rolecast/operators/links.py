"""Joins between stored tables: postings with their company, urls with verdicts, runs with reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linked_companies(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Postings with the ``company_id`` of their normalised company, null where it is not stored."""
    keys = companies.groupBy("name_normalized").agg(F.min("company_id").alias("company_id"))
    return jobs.drop("company_id").join(keys, "name_normalized", "left")


def graded_by_urls(jobs: DataFrame, urls: DataFrame) -> DataFrame:
    """Postings of a set of urls that have a score."""
    return jobs.filter("quality_score > 0").join(urls.select("url"), "url", "left_semi")


def distinct_urls(df: DataFrame) -> DataFrame:
    """Each url once, without empty ones, with the place of its first posting."""
    return df.filter("url <> ''").groupBy("url").agg(F.min("arrival_idx").alias("arrival_idx"))


def invalid_by_source(postings: DataFrame, verdicts: DataFrame) -> DataFrame:
    """How many urls of a source are invalid; a url counts once a source, and sources without any have 0."""
    dead = verdicts.groupBy("url").agg(F.bool_and("is_valid").alias("is_valid"))
    seen = postings.select("source", "url").distinct().join(dead, "url", "left")
    return seen.groupBy("source").agg(F.count_if(~F.coalesce("is_valid", F.lit(True))).alias("url_invalid_count"))


def validity_counts(verdicts: DataFrame) -> DataFrame:
    """How many urls of a batch are valid and invalid."""
    return verdicts.agg(F.count("*").alias("total"), F.count_if(~F.col("is_valid")).alias("invalid"), F.count_if("is_valid").alias("valid"))


def runs_with_reports(runs: DataFrame, reports: DataFrame) -> DataFrame:
    """Run records with the report they belong to; runs without one stay, the report's fields null."""
    r = reports.select(F.col("run_id").alias("report_id"), *(F.col(c).alias(f"report_{c}") for c in reports.columns if c != "run_id"))
    return runs.join(r, "report_id", "left")


def most_common(counts: DataFrame, reason: str = "reason", n: str = "n") -> DataFrame:
    """Reasons by falling count; equal counts in order of the reason."""
    return counts.withColumn("rank", F.row_number().over(_falling(reason, n)))


def _falling(reason: str, n: str):
    from pyspark.sql import Window

    return Window.orderBy(F.desc(n), reason)  # one row a reason: a handful


def duplicate_ids(df: DataFrame, field: str, id_col: str) -> DataFrame:
    """Of values that several rows have, a row for each that is to go: ``field``, its id, ``n`` rows in all, and ``kept``, the newest one's id.

    Rows of a value are counted before the shuffle and joined back, so no value needs all its ids in one place.  Rows that repeat the newest id stay.
    """
    groups = df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.count("*").alias("n"), F.max(id_col).alias("kept")).filter("n > 1")
    return df.join(groups, field).filter(F.col(id_col) != F.col("kept")).select(field, id_col, "n", "kept")


def without_duplicates(df: DataFrame, field: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the newest row of every value of ``field`` (all rows without a value), and the number of rows deleted."""
    from .dedupe import newest_kept

    marked = newest_kept(df, field, id_col)
    return marked.filter("kept").drop("kept"), marked.agg(F.count_if(~F.col("kept")).alias("deleted"))


def new_links(batch: DataFrame, stored: DataFrame, link: str = "link") -> DataFrame:
    """Rows whose link is not stored; a row without a link is never a duplicate."""
    known = stored.filter(F.col(link) != "").select(link).distinct()
    return batch.join(known, link, "left_anti").select(*batch.columns)


def one_of(name: Column, wanted: str) -> Column:
    """Whether a name is in a list separated by commas, whatever the case; an empty list allows all."""
    names = [n.strip().lower() for n in wanted.split(",") if n.strip()]
    return F.lower(name).isin(*names) if names else F.lit(True)
