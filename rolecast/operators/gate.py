"""The quality gate over classified postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quality as q


def evaluate(df: DataFrame, company: Column, description: Column) -> DataFrame:
    """Adds quality_score, reject_reason, status, quality_tier and geocode_pending."""
    out = df.withColumns({"quality_score": q.quality_score(description), "reject_reason": q.gate_reason(company, description)})
    passed = F.col("reject_reason").isNull()
    added = {"status": F.when(passed, "active").otherwise("rejected_quality"), "quality_tier": F.when(passed, F.when(q.premium(), "premium").otherwise("valid"))}
    if "location_raw" in df.columns:
        placed = F.col("location_geo").isNotNull() if "location_geo" in df.columns else F.lit(False)
        added["geocode_pending"] = F.coalesce(F.col("location_raw") != "", F.lit(False)) & ~placed
    return out.withColumns(added)
