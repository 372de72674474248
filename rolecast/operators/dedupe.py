"""Duplicates as set operations: keep-first, hash hits, and the two merge rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..shared import cut
from .similarity import alike, in_order

# The window and the similarity of fuzzy duplicates.
FUZZY_DAYS, FUZZY_LEAST = 14, 92.0


def with_hashes(df: DataFrame) -> DataFrame:
    """Adds normalised title and company and the two hashes."""
    out = df.withColumns({"title_normalized": t.normalize_text(t.text("title")), "name_normalized": t.normalize_text(t.text("company_name"))})
    title, name = F.col("title_normalized"), F.col("name_normalized")
    return out.withColumns({"dedup_hash": t.dedup_hash(title, name, t.text("source")), "cross_source_hash": t.cross_source_hash(title, name)})


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order; rows with a null key are dropped.

    The minimum is aggregated before the shuffle, so a key with very many rows is no burden.
    """
    rank, row = [o.alias(f"_{i}") for i, o in enumerate(order)], F.struct(*df.columns).alias("row")
    if any("map<" in kind or kind == "variant" for _, kind in df.dtypes):  # such rows have no order of their own
        first = F.min_by(row, F.struct(*rank)).alias("row")
    else:
        first = F.min(F.struct(*rank, row))["row"].alias("row")
    return df.dropna(subset=key).groupBy(*key).agg(first).select("row.*")


def newest_kept(df: DataFrame, field: str, id_col: str) -> DataFrame:
    """Adds ``kept``: whether a row has the largest id of its field's value; rows without a value are all kept."""
    newest = df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.max(id_col).alias("_newest"))
    return df.join(newest, field, "left").withColumn("kept", F.col(field).isNull() | (F.col(id_col) == F.col("_newest"))).drop("_newest").select(*df.columns, "kept")


def duplicate_groups(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def set_resolution(df: DataFrame) -> DataFrame:
    """Outcome of every row (``arrival_idx``, ``source``) where none is rejected: of a cross-source hash the first arrival is new,
    later rows of its source hit it, and those of other sources hit across sources, unless their own source came there before.

    First arrivals are aggregates, which are combined before the shuffle, and are joined back.  Hashes are computed once, in Python
    for some titles, and written; only they, ids and sources are read again.
    """
    rows = cut(df.select("arrival_idx", "source", "cross_source_hash"), "hashes")
    first = rows.groupBy("cross_source_hash").agg(F.min(F.struct("arrival_idx", "source")).alias("f"))
    joined = rows.join(first, "cross_source_hash")
    outcome = F.when(F.col("arrival_idx") == F.col("f.arrival_idx"), "new").when(F.lower("source") == F.lower("f.source"), "dedupe_hit").otherwise("cross_source_hit")
    return joined.withColumn("outcome", outcome).withColumn("target_idx", F.col("f.arrival_idx")).drop("f")


def cross_source_hits(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``batch`` with the first stored row of the same hash and another source.

    Of a hash only its first arrival, and the first of another source than that one's, can be it: two aggregates that combine before
    the shuffle, by source first, so a hash with very many rows is one row of the join.
    """
    each = stored.filter("cross_source_hash is not null and source is not null").groupBy("cross_source_hash", "source").agg(F.min(F.struct("arrival_idx", "dedup_hash")).alias("m"))
    entry = F.struct(F.col("m.arrival_idx").alias("idx"), F.col("m.dedup_hash").alias("hash"), "source")
    two = each.groupBy("cross_source_hash").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, 2).alias("t"))  # an entry a source
    other = F.when(F.col("t")[0]["source"] != F.col("source"), F.col("t")[0]).otherwise(F.get("t", F.lit(1)))
    met = batch.select("arrival_idx", "cross_source_hash", "source").join(two, "cross_source_hash").withColumn("hit", other).filter("hit is not null and source is not null")
    return met.select("arrival_idx", F.col("hit.hash").alias("target_hash"), F.col("hit.idx").alias("target_idx"))


def fuzzy_keys(df: DataFrame, company: Column, title: Column, **more: Column) -> DataFrame:
    """What a fuzzy comparison needs of a row: ``block``, its company, ``key``, the words of its title in order, and ``more``."""
    return df.select(company.alias("block"), in_order(title).alias("key"), *(c.alias(name) for name, c in more.items()))


def asked(df: DataFrame, **more: Column) -> DataFrame:
    """Rows as they look for others: company and title in lower case."""
    return fuzzy_keys(df, F.lower(t.strip(t.text("company_name"))), F.lower(t.strip(t.text("title"))), **more)


def fuzzy_pairs(batch: DataFrame, stored: DataFrame, as_of: Column, days: int = FUZZY_DAYS, least: float = FUZZY_LEAST, earlier: bool = False) -> DataFrame:
    """Pairs of the same company and different sources whose titles are alike; bounded in time.

    Distinct titles are joined by what alike ones must share (:mod:`similarity`), and pairs of them then with their rows.
    With ``earlier``, only stored rows that arrived before a row are its targets.
    """
    recent = stored.filter(F.col("posted_at") >= as_of - F.expr(f"INTERVAL {days} DAYS"))
    b = cut(asked(batch, source=F.col("source"), arrival_idx=F.col("arrival_idx")), "asked")
    s = cut(fuzzy_keys(recent, F.col("name_normalized"), F.col("title_normalized"), s_source=F.col("source"), target_idx=F.col("arrival_idx")), "recent")
    pairs = alike(b, s, least)
    met = b.join(pairs.withColumnRenamed("a", "key"), ["block", "key"]).drop("key").join(s.withColumnRenamed("key", "b"), ["block", "b"]).filter(F.col("source") != F.col("s_source"))
    if earlier:
        met = met.filter(F.col("target_idx") < F.col("arrival_idx"))
    return met.select("arrival_idx", "target_idx")


def merge_same_source(target: DataFrame, hits: DataFrame) -> DataFrame:
    """Refresh targets by (target_idx, posted_at): earliest date, times seen.  Needs ``arrival_idx`` in the target."""
    delta = hits.groupBy(F.col("target_idx").alias("arrival_idx")).agg(F.min("posted_at").alias("_posted"), F.count("*").alias("_seen"))
    earliest = F.when(F.col("posted_at").isNotNull(), F.least("posted_at", F.coalesce("_posted", "posted_at")))
    return target.join(delta, "arrival_idx", "left").withColumn("posted_at", earliest).withColumn("seen_count", _seen(target)).drop("_posted", "_seen")


def _seen(target: DataFrame) -> Column:
    before = F.coalesce("seen_count", F.lit(0)) if "seen_count" in target.columns else F.lit(0)
    return (before + F.coalesce("_seen", F.lit(0))).cast("long")


def merge_cross_source(target: DataFrame, hits: DataFrame) -> DataFrame:
    """As above, and the longest description (the earliest of equals, the target's first) and the widest salary."""
    delta = hits.groupBy(F.col("target_idx").alias("arrival_idx")).agg(
        F.min("posted_at").alias("_posted"), F.count("*").alias("_seen"), F.min("salary_min").alias("_min"), F.max("salary_max").alias("_max"),
        F.max_by("description", F.struct(F.length(t.text("description")), -F.col("arrival_idx"))).alias("_text"),
    )
    out = target.join(delta, "arrival_idx", "left")
    longer = F.length(F.col("_text")) > F.length(t.text("description"))
    return out.withColumns({
        "posted_at": F.when(F.col("posted_at").isNotNull(), F.least("posted_at", F.coalesce("_posted", "posted_at"))),
        "description": F.when(longer, F.col("_text")).otherwise(F.col("description")),
        "salary_min": F.least("salary_min", "_min"), "salary_max": F.greatest("salary_max", "_max"), "seen_count": _seen(target),
    }).drop("_posted", "_seen", "_min", "_max", "_text")
