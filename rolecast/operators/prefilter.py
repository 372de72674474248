"""The rule prefilter: the first rule that a posting breaks, in a column ``prefilter_reason`` (null: passed)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.language import supported

# Sentinels and bounds of the rules.
NO_COMPANY = ("", "unknown", "n/a", "none")
LEAST_CHARS, MOST_DAYS = 200, 60


def prefilter(df: DataFrame, as_of: Column, detect: Callable[[Column], Column] | None = None) -> DataFrame:
    """Built-in rules come first; the language of a text is detected only where they passed and none is declared, by ``detect`` (that
    of :mod:`profiles`, for one)."""
    missing = F.lit("MISSING_REQUIRED_FIELDS")
    cheap = F.coalesce(
        F.when(t.strip(t.text("title")) == "", missing),
        F.when(F.lower(t.strip(t.text("company_name"))).isin(*NO_COMPANY), missing),
        F.when(~t.url_valid(F.col("url")), missing),
        F.when(t.closed_url(F.col("url")), F.lit("CLOSED_LISTING")),
        F.when(F.col("posted_at").isNull(), missing),
        F.when(F.col("posted_at") < as_of - F.expr(f"INTERVAL {MOST_DAYS} DAYS"), F.lit("EXPIRED_LISTING")),
        F.when(F.length(t.text("description")) < LEAST_CHARS, F.lit("DESCRIPTION_TOO_SHORT")),
    )
    left = F.col("_cheap").isNull()
    foreign = F.when(left & ~supported(F.col("original_language"), F.when(left, t.text("description")), detect), F.lit("LANGUAGE_NOT_SUPPORTED"))
    spam = F.when(t.spam_title(F.col("title")), F.lit("SUSPECTED_SPAM"))
    return df.withColumn("_cheap", cheap).withColumn("prefilter_reason", F.coalesce("_cheap", foreign, spam)).drop("_cheap")


def funnel(df: DataFrame) -> DataFrame:
    """Rows by source and reason, ``PASS`` for those that passed."""
    return df.groupBy("source", F.coalesce("prefilter_reason", F.lit("PASS")).alias("reason")).agg(F.count("*").alias("n"))


def source_funnel(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n_raw"), F.count_if(F.col("prefilter_reason").isNull()).alias("n_passed"), F.count_if(F.col("prefilter_reason").isNotNull()).alias("n_rejected"))
