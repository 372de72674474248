"""Order-dependent duplicate resolution of a batch against stored rows.

A row is rejected, of a dead url, a hit on a hash, a hit across sources, a fuzzy hit, or new, in this order, and sees
what earlier rows of the batch left behind.

Rows can only matter to each other through equal hashes or through titles that are alike within a company.  So titles are joined by
similarity first (:mod:`similarity`); hashes that these links connect are a component, and the rows of each component are
folded in order of arrival, components apart from each other.  A company with very many postings is spread over tasks.

Of a hash with very many rows the fold needs a few only.  A rejected row matters if it is the first with its hash; a live row
if it is the first, or the first that is older than the horizon, as that takes its target out of the window.  All others follow
from the fold: after the row that was inserted under their hash they hit that, before it they hit across sources what
the first one hit.  Only where that one is a fuzzy hit, whose target may change, all live rows of its component are folded.

Edge cases: null titles, companies and sources are as in :mod:`dedupe`; a null date is never in the window and changes none; an empty batch
has no outcomes; rows that repeat an ``arrival_idx`` are not expected.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import lcs, sorted_tokens
from ..shared import cut, drop, kept
from .dedupe import FUZZY_DAYS, FUZZY_LEAST, asked, fuzzy_keys
from .similarity import alike, components

COLUMNS = "arrival_idx long, name_normalized string, title_normalized string, title string, company_name string, source string, dedup_hash string, cross_source_hash string, posted_at timestamp, prefilter_reason string, url_invalid boolean, stored boolean"
RESULT = "arrival_idx long, outcome string, target_idx long, inserted boolean"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def fold(rows: Iterable[dict], horizon: pd.Timestamp, least: float = FUZZY_LEAST) -> list[tuple[int, str, int | None, bool]]:
    """Outcomes of rows in order of arrival; stored rows come first and only take part as targets."""
    by_hash: dict[str, dict] = {}
    across: dict[str, list[dict]] = defaultdict(list)  # the first row of each source, by hash across sources
    titles: dict[tuple[str, str], list[dict]] = defaultdict(list)  # inserted rows by company and words of the title
    out, turn = [], 0

    def insert(r: dict) -> bool:
        nonlocal turn
        if r["dedup_hash"] in by_hash:
            return False
        by_hash[r["dedup_hash"]] = r
        if all(k["source"] != r["source"] for k in across[r["cross_source_hash"]]):
            across[r["cross_source_hash"]].append(r)
        r["turn"], turn = turn, turn + 1
        titles[r["name_normalized"] or "", sorted_tokens(r["title_normalized"] or "")].append(r)
        return True

    def first_alike(r: dict) -> dict | None:
        """The row inserted first that is of another source, recent, of the company, and alike."""
        company, key = (r["company_name"] or "").lower().strip(), sorted_tokens((r["title"] or "").lower().strip())
        best = None
        for (block, other), held in titles.items():
            if block != company or best is not None and held[0]["turn"] > best["turn"]:
                continue
            fits = next((k for k in held if k["source"] != r["source"] and pd.notna(k["posted_at"]) and k["posted_at"] >= horizon), None)
            n = len(key) + len(other)
            if fits is not None and (best is None or fits["turn"] < best["turn"]) and (key == other or n and 200.0 * min(len(key), len(other)) >= least * n and 200.0 * lcs(key, other) / n >= least):
                best = fits
        return best

    for r in rows:
        if r["stored"]:
            insert(r)
            continue
        if r["prefilter_reason"] or r["url_invalid"]:
            out.append((r["arrival_idx"], "rejected_prefilter" if r["prefilter_reason"] else "url_invalid", None, insert(r)))
            continue
        outcome, target = "dedupe_hit", by_hash.get(r["dedup_hash"])
        if target is None:
            outcome, target = "cross_source_hit", next((k for k in across.get(r["cross_source_hash"], ()) if k["source"] != r["source"]), None)
        if target is None:
            outcome, target = "fuzzy_hit", first_alike(r)
        if target is None:
            insert(r)
            out.append((r["arrival_idx"], "new", None, True))
        else:
            if pd.notna(r["posted_at"]) and pd.notna(target["posted_at"]) and r["posted_at"] < target["posted_at"]:
                target["posted_at"] = r["posted_at"]
            out.append((r["arrival_idx"], outcome, target["arrival_idx"], False))
    return out


def dead() -> Column:
    return (F.coalesce("prefilter_reason", F.lit("")) != "") | F.coalesce("url_invalid", F.lit(False))


def conflicts(rows: DataFrame, least: float) -> DataFrame:
    """``cross_source_hash`` and ``component`` of hashes that others may matter to; all others are on their own.

    The nodes are hashes.  Those with the same words under a company, or the same other hash, link to the smallest of them,
    and titles that are alike link the smallest hashes that have them.
    """
    c = F.col("cross_source_hash")
    targets = fuzzy_keys(rows, F.coalesce("name_normalized", F.lit("")), F.coalesce("title_normalized", F.lit("")), c=c).distinct()
    live = asked(rows.filter(~F.col("stored") & ~dead()), c=c).distinct()
    (targets, targets_path), (live, live_path) = kept(targets, "targets"), kept(live, "live")
    pairs = alike(live, targets, least)
    of = lambda df: df.groupBy("block", "key").agg(F.min("c").alias("m"))
    met = pairs.join(of(live).select("block", F.col("key").alias("a"), F.col("m").alias("ca")), ["block", "a"]).join(of(targets).select("block", F.col("key").alias("b"), F.col("m").alias("cb")), ["block", "b"])
    links = met.select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    for df in (targets, live):
        links = links.unionByName(df.join(of(df), ["block", "key"]).select(F.col("c").alias("a"), F.col("m").alias("b")))
    hashes = rows.select("dedup_hash", c.alias("c")).distinct()
    links = links.unionByName(hashes.join(hashes.groupBy("dedup_hash").agg(F.min("c").alias("m")), "dedup_hash").select(F.col("c").alias("a"), F.col("m").alias("b")))
    found = components(links).select(F.col("id").alias("cross_source_hash"), "component")  # written
    for path in (targets_path, live_path):
        drop(rows.sparkSession, path)
    return found


def folded(rows: DataFrame, horizon: pd.Timestamp, least: float) -> DataFrame:
    """``RESULT`` of the fold of each component's rows (``COLUMNS`` and ``component``); a partition holds many components, and
    of each it keeps the rows that were inserted only."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rest = None, []

        def done(rows: list[dict]) -> pd.DataFrame:
            found = fold(rows, horizon, least)
            return pd.DataFrame(found, columns=["arrival_idx", "outcome", "target_idx", "inserted"]).astype({"target_idx": "Int64", "inserted": bool})

        for pdf in frames:
            out = []
            for r in pdf.to_dict("records"):
                if r["component"] != held and rest:
                    out.append(done(rest))
                    rest = []
                held = r["component"]
                rest.append(r)
            if out:
                yield pd.concat(out)
        if rest:
            yield done(rest)

    ordered = rows.repartition("component").sortWithinPartitions("component", F.desc("stored"), "arrival_idx")
    return ordered.select(*NAMES, "component").mapInPandas(run, RESULT)


def resolve(batch: DataFrame, stored: DataFrame, as_of: str, days: int = FUZZY_DAYS, least: float = FUZZY_LEAST) -> DataFrame:
    """``RESULT`` for each row of ``batch``; both inputs have the columns of ``COLUMNS`` but ``stored``, and the ids of
    stored rows, ``arrival_idx``, come before those of the batch."""
    horizon = pd.Timestamp(as_of) - pd.Timedelta(days=days)
    keys = batch.select("name_normalized").unionByName(asked(batch).select(F.col("block").alias("name_normalized"))).distinct()
    both = batch.withColumn("stored", F.lit(False)).select(*NAMES).unionByName(stored.join(keys, "name_normalized", "left_semi").withColumn("stored", F.lit(True)).select(*NAMES))
    rows, rows_path = kept(both, "rows")
    linked = conflicts(rows, least)
    old = F.col("posted_at") < F.lit(horizon.isoformat(" ")).cast("timestamp")
    order, live = F.struct(~F.col("stored"), "arrival_idx"), ~F.col("stored") & ~dead()
    marks = rows.groupBy("dedup_hash").agg(F.min(F.when(~live, order)).alias("first_dead"), F.min(F.when(live, order)).alias("first_live"), F.min(F.when(live & old, order)).alias("first_old"))
    is_one = lambda *names: F.coalesce(F.greatest(*(F.coalesce(F.col(n) == order, F.lit(False)) for n in names)), F.lit(False))
    marked = rows.join(marks, "dedup_hash").join(linked, "cross_source_hash", "left").withColumns({"component": F.coalesce("component", "cross_source_hash"), "_live": live, "_first": is_one("first_live", "first_live"), "_needed": is_one("first_dead", "first_live", "first_old")})
    marked = cut(marked.drop("first_dead", "first_live", "first_old"), "marked")
    drop(rows.sparkSession, rows_path)
    sizes = marked.filter("_needed").groupBy("component").agg(F.count("*").alias("_n"))
    needed = marked.filter("_needed").join(sizes, "component")
    alone = needed.filter("_n = 1 and not stored").select(
        "arrival_idx", F.when(F.coalesce("prefilter_reason", F.lit("")) != "", "rejected_prefilter").when(F.coalesce("url_invalid", F.lit(False)), "url_invalid").otherwise("new").alias("outcome"),
        F.lit(None).cast("long").alias("target_idx"), F.lit(True).alias("inserted"),
    )
    first = cut(alone.unionByName(folded(needed.filter("_n > 1"), horizon, least)), "folded")
    rest = marked.filter("not _needed and not stored")
    return first if rest.isEmpty() else with_followers(marked, rest, first, horizon, least)


def with_followers(marked: DataFrame, rest: DataFrame, first: DataFrame, horizon: pd.Timestamp, least: float) -> DataFrame:
    """``first``, the fold of the needed rows, and what follows from it for the ``rest``.

    Components are folded again, with all their live rows, where the first live row of a hash with more of them is a fuzzy hit, or
    hits across sources before a rejected row is inserted under the hash.
    """
    begun = marked.filter("_first").select("dedup_hash", "component", "arrival_idx").join(first.select("arrival_idx", "outcome", F.col("target_idx").alias("before")), "arrival_idx")
    held = marked.select("arrival_idx", "dedup_hash").join(first.filter("inserted").select("arrival_idx"), "arrival_idx", "left_semi")
    open_ = begun.filter("outcome = 'fuzzy_hit'").select("dedup_hash", "component").unionByName(begun.filter("outcome = 'cross_source_hit'").join(held.select("dedup_hash"), "dedup_hash", "left_semi").select("dedup_hash", "component"))
    open_ = cut(open_.join(rest.filter("_live").select("dedup_hash"), "dedup_hash", "left_semi").select("component").distinct(), "open")
    known = first
    if not open_.isEmpty():
        again = cut(folded(marked.filter("_needed or _live").join(open_, "component", "left_semi"), horizon, least), "again")
        known = cut(first.join(again.select("arrival_idx"), "arrival_idx", "left_anti").unionByName(again), "known")
        rest = rest.join(again.select("arrival_idx"), "arrival_idx", "left_anti")
    inserted = marked.select("arrival_idx", "dedup_hash").join(known.filter("inserted").select("arrival_idx"), "arrival_idx", "left_semi")
    by = inserted.unionByName(marked.filter("stored").select("arrival_idx", "dedup_hash")).groupBy("dedup_hash").agg(F.min("arrival_idx").alias("by"))
    joined = rest.join(by, "dedup_hash", "left").join(begun.select("dedup_hash", "before"), "dedup_hash", "left")
    after = F.coalesce(F.col("by") < F.col("arrival_idx"), F.lit(False))
    outcome = F.when(F.coalesce("prefilter_reason", F.lit("")) != "", "rejected_prefilter").when(F.coalesce("url_invalid", F.lit(False)), "url_invalid").when(after, "dedupe_hit").otherwise("cross_source_hit")
    target = F.when(F.col("_live"), F.when(after, F.col("by")).otherwise(F.col("before")))
    return known.unionByName(joined.select("arrival_idx", outcome.alias("outcome"), target.alias("target_idx"), F.lit(False).alias("inserted")))
