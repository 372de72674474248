"""Loaders and repairs of older tables: mixed types, strings for dates, damaged texts, rows keyed by link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .dedupe import keep_first
from .store import insert_absent

#: What a company has when it is first seen, and the fields that an upsert may renew.
COMPANY_DEFAULTS = {"trustScore": 80.0, "totalRatings": 0, "totalLikes": 0, "totalDislikes": 0}
COMPANY_FIELDS = ("description", "website", "industry", "size", "location")
#: The texts that the sweep for wrongly decoded text looks at.
TEXTS = ("title", "description", "company_name", "location_raw")


def kind(value: Column) -> Column:
    """The type of a JSON value that came as text: array, object, string, number, boolean or null."""
    v = F.schema_of_variant(F.try_parse_json(value))
    low = F.lower(v)
    return (
        F.when(v.isNull() | (low == "void"), "null").when(low.startswith("array"), "array").when(low.startswith("object"), "object")
        .when(low == "string", "string").when(low == "boolean", "boolean").otherwise("number")
    )


def city(value: Column) -> Column:
    """A city as text from a JSON value: of an array the first element, of another type what it reads as."""
    v, k = F.try_parse_json(value), kind(value)
    scalar = lambda path: F.try_variant_get(v, path, "string")
    return F.when(k == "array", scalar("$[0]")).when(k == "null", F.lit(None)).when(k == "boolean", F.initcap(scalar("$"))).otherwise(scalar("$"))


def repaired_date(value: Column) -> Column:
    """A date that was stored as text, null if it has none of the known formats."""
    return t.parse_legacy(value, F.lit(None).cast("timestamp"))


def truthy(c: Column) -> Column:
    """The value, null if it is empty."""
    return F.nullif(c, F.lit(""))


def coerced_answer(answer: dict[str, Column]) -> dict[str, Column]:
    """Older model answers: ``city_json``, ``salary_min``, ``salary_max``, ``remote`` and ``is_remote``, as columns of their types."""
    whole = lambda c: F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).try_cast("long"))
    return {"city": city(answer["city_json"]), "salary_min": whole(answer["salary_min"]), "salary_max": whole(answer["salary_max"]), "remote": F.coalesce(answer["is_remote"], answer["remote"], F.lit(False))}


def merged_answer(jobs: DataFrame, names: tuple[str, ...], prefix: str = "ai_") -> DataFrame:
    """Values of an answer (columns with ``prefix``) replace a posting's, but a salary that the source gave stays, and no
    empty city or country replaces one."""
    keep = ("salary_min", "salary_max")
    pick = {n: F.coalesce(n, prefix + n) if n in keep else F.coalesce(truthy(F.col(prefix + n)), F.col(n)) if n in ("city", "country") else F.coalesce(prefix + n, n) for n in names}
    return jobs.withColumns(pick).drop(*(prefix + n for n in names))


def insert_by_link(stored: DataFrame, batch: DataFrame, order: list[Column]) -> DataFrame:
    """Stored rows and those of a batch whose link is new, of each link the first."""
    return insert_absent(stored, batch, "link", order)


def upsert_named_companies(stored: DataFrame, batch: DataFrame, order: Column) -> DataFrame:
    """Companies by name: fields that a batch states replace the stored ones, of several rows the last that states a field;
    new companies get the defaults.  Either of two names of the logo stands for both."""
    logo = F.coalesce(truthy(F.col("logo")), truthy(F.col("logo_url")))
    rows = batch.filter("name <> ''").withColumns({"logo": logo, "logo_url": logo} | {c: truthy(F.col(c)) for c in COMPANY_FIELDS})
    fields = ("logo", "logo_url", *COMPANY_FIELDS)
    last = rows.groupBy("name").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_{c}") for c in fields))
    out = stored.join(last, "name", "full_outer")
    renewed = {c: F.coalesce(f"_{c}", c) for c in fields}
    return out.withColumns(renewed | {c: F.coalesce(F.col(c), F.lit(v)) for c, v in COMPANY_DEFAULTS.items()}).drop(*(f"_{c}" for c in fields))


def upsert_levels(stored: DataFrame, levels: DataFrame) -> DataFrame:
    """The dimension of seniority levels with new ones added; an empty level is ``Unknown``."""
    named = levels.select(F.coalesce(truthy(F.col("level")), F.lit("Unknown")).alias("level"))
    return stored.select("level").unionByName(named).distinct()


def old_status_counts(jobs: DataFrame) -> DataFrame:
    """How many rows still have the two older statuses."""
    return jobs.agg(F.count_if(F.col("status") == "valid").alias("valid"), F.count_if(F.col("status") == "premium").alias("premium"))


def damaged_rows(df: DataFrame, columns: tuple[str, ...] = TEXTS) -> Column:
    """Whether any of the texts holds the sign of text decoded wrongly."""
    out = F.lit(False)
    for c in columns:
        if c in df.columns:
            out = out | F.coalesce(F.contains(c, F.lit("Ã")), F.lit(False))
    return out


def repair_texts(df: DataFrame, columns: tuple[str, ...] = TEXTS) -> DataFrame:
    """Damaged rows with their texts repaired, and ``scanned`` and ``fixed``: whether a row is damaged, and whether that changed it.
    Rows without damage are untouched, so a second sweep finds nothing more to fix."""
    own = [c for c in columns if c in df.columns]
    out = df.withColumn("scanned", damaged_rows(df, columns)).withColumns({f"_{c}": t.fix_mojibake(F.when(F.col("scanned"), F.col(c))) for c in own})
    changed = F.lit(False)
    for c in own:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = out.withColumn("fixed", F.col("scanned") & changed)
    return out.withColumns({c: F.when(F.col("scanned"), F.col(f"_{c}")).otherwise(F.col(c)) for c in own}).drop(*(f"_{c}" for c in own))


def sweep_counts(swept: DataFrame) -> DataFrame:
    return swept.agg(F.count_if("scanned").alias("scanned"), F.count_if("fixed").alias("fixed"))


def first_of_link(df: DataFrame, order: list[Column]) -> DataFrame:
    return keep_first(df, ["link"], order)
