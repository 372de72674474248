"""Stored documents: a flat layout, the older nested one, and the typed posting that both stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SUPPORTED_LANGUAGES, VOCABULARY

POINT = "struct<type:string,coordinates:array<double>>"
#: Counters that others own; a new document has zeros.
COUNTERS = ("views_count", "clicks_count", "likes_count", "dislikes_count", "comments_count")
TIERS, STATUSES = ("valid", "premium"), ("active", "valid", "premium", "expired", "closed", "rejected_prefilter", "rejected_quality")
#: Columns of a typed posting that a document holds under the same name.
SAME = "source string, external_id string, dedup_hash string, cross_source_hash string, title string, title_normalized string, description string, description_md string, first_seen_at timestamp, last_seen_at timestamp, expires_at timestamp, last_probed_at timestamp, reject_reason string, city string, country string, formatted_address string, technical_skills array<string>, skills array<string>, languages_required array<string>, requirements array<string>, benefits array<string>, quality_flags array<string>, cv_drop_score double, ai_confidence double, ai_model string, salary_min long, salary_max long, currency string, salary_period string"
#: The older layout: a location, and a score, as structs of their own.
NESTED = f"location struct<raw:string,city:string,country:string,formatted_address:string,geo:{POINT}>, quality struct<quality_score:int,quality_tier:string,geocode_pending:boolean>"


def _have(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _typed() -> list[tuple[str, str]]:
    return [(x.split(" ", 1)[0], x.split(" ", 1)[1]) for x in SAME.split(", ")]


def to_document(jobs: DataFrame) -> DataFrame:
    """Typed postings as flat documents.  The url and the date have a second name for older readers, the company is a
    struct, and the score is there both flat and as a struct."""
    get = lambda n, k="string": _have(jobs, n, k)
    quality = F.struct(get("quality_score", "int").alias("quality_score"), get("quality_tier").alias("quality_tier"), F.coalesce(get("geocode_pending", "boolean"), F.lit(False)).alias("geocode_pending"))
    company = F.struct(get("company_name").alias("name"), get("name_normalized").alias("name_normalized"), get("company_logo").alias("logo"), get("company_id").alias("id"))
    return jobs.select(
        get("url").alias("url"), get("url").alias("link"), *(get(n, k).alias(n) for n, k in _typed()), get("language").alias("language"), get("posted_at", "timestamp").alias("posted_at"), get("posted_at", "timestamp").alias("published_at"),
        get("status").alias("status"), F.coalesce(get("enriched_by_ai", "boolean"), F.lit(False)).alias("enriched_by_ai"), get("company_id").alias("company_id"), company.alias("company"),
        get("location_raw").alias("location"), get("location_raw").alias("location_raw"), get("location_geo", POINT).alias("location_geo"), *(get(n).alias(n) for n in VOCABULARY),
        F.coalesce(get("remote_mode").isin("hybrid", "remote"), F.lit(False)).alias("remote"), get("quality_score", "int").alias("quality_score"), get("quality_tier").alias("quality_tier"), quality.alias("quality"),
        *(F.coalesce(get(n, "int"), F.lit(0)).alias(n) for n in COUNTERS),
    )


def from_document(docs: DataFrame) -> DataFrame:
    """Documents of either layout as typed postings.

    A location that is a struct is the older layout, and its fields count; else the flat ones do.  Fields of the struct
    of the score come before the flat ones.  A word outside its vocabulary becomes the default.
    """
    get = lambda n, k="string": _have(docs, n, k)
    inside = lambda n: dict(docs.dtypes).get(n, "").startswith("struct")
    at = {"location_raw": get("location"), "city": get("city"), "country": get("country"), "formatted_address": get("formatted_address"), "location_geo": get("location_geo", POINT)}
    if inside("location"):
        old = F.col("location").isNotNull()
        at = {n: F.when(old, F.col(f"location.{ {'location_raw': 'raw', 'location_geo': 'geo'}.get(n, n) }")).otherwise(get(n, POINT if n == "location_geo" else "string")) for n in at}
    at["location_geo"] = F.when(F.size(at["location_geo"]["coordinates"]) > 0, at["location_geo"])
    nested = lambda n, k: F.coalesce(F.col(f"quality.{n}"), get(n, k)) if inside("quality") else get(n, k)
    tier = nested("quality_tier", "string")
    words = {n: F.when(get(n).isin(*allowed), get(n)).otherwise(F.lit(default).cast("string")) for n, (allowed, default) in VOCABULARY.items()}
    lists = {n: F.coalesce(get(n, k), F.array().cast(k)) for n, k in _typed() if k == "array<string>"}
    texts = {n: F.coalesce(get(n), F.lit("")) for n in ("dedup_hash", "cross_source_hash", "source", "title", "title_normalized", "description", "ai_model")}
    numbers = {n: F.coalesce(get(n, "double"), F.lit(0.0)) for n in ("cv_drop_score", "ai_confidence")}
    company = {a: F.col(f"company.{b}") if inside("company") else F.lit(None).cast("string") for a, b in (("company_name", "name"), ("name_normalized", "name_normalized"), ("company_logo", "logo"), ("company_id", "id"))}
    company |= {n: F.coalesce(company[n], F.lit("")) for n in ("company_name", "name_normalized")} | {"company_id": F.nullif(company["company_id"], F.lit(""))}
    fields = {n: get(n, k) for n, k in _typed()} | texts | lists | numbers | at | words | company | {
        "url": F.coalesce(F.nullif(get("url"), F.lit("")), get("link"), F.lit("")), "posted_at": F.coalesce(get("posted_at", "timestamp"), get("published_at", "timestamp")),
        "language": F.when(get("language").isin(*SUPPORTED_LANGUAGES), get("language")).otherwise("other"), "status": F.when(get("status").isin(*STATUSES), get("status")).otherwise("active"),
        "enriched_by_ai": F.coalesce(get("enriched_by_ai", "boolean"), F.lit(False)), "quality_score": F.coalesce(nested("quality_score", "int"), F.lit(0)).cast("int"),
        "quality_tier": F.when(tier.isin(*TIERS), tier), "geocode_pending": F.coalesce(nested("geocode_pending", "boolean"), F.lit(False)),
    } | {n: F.coalesce(get(n, "int"), F.lit(0)) for n in COUNTERS}
    return docs.select(*(c.alias(n) for n, c in fields.items()))
