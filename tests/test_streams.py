"""Streams of postings: similar ones against all earlier rows, ingestion whose batches run again."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolecast.functions.fuzzy import token_sort_ratio
from rolecast.operators import store
from rolecast.streaming import postings as streaming

NOW = datetime(2024, 3, 5)
SCHEMA = "name_normalized string, title_normalized string, source string, arrival_idx long, posted_at timestamp"


def first_similar(rows, days=14):
    out = {}
    for company, title, source, i, at in rows:
        fits = [j for c, t, s, j, seen in rows if j < i and c == company and s != source and seen >= at - timedelta(days=days) and token_sort_ratio(t, title) >= 92]
        out[i] = min(fits, default=None)
    return out


def random_rows(rng, n):
    titles = ["senior software engineer backend", "senior software engineer - backend", "backend engineer senior software", "nurse", "nurses", "data engineer", "data engineers", "", "a", "x" * 40, "x" * 41]
    return [(rng.choice(["acme", "acme", "other"]), rng.choice(titles), rng.choice("abc"), i, NOW + timedelta(hours=rng.randrange(24 * 40))) for i in range(n)]


@pytest.mark.parametrize("slices", [1, 4])
def test_similar_postings_equal_all_pairs(spark, slices):
    """Dates in any order within the window, so that what is late still has to be found."""
    rows = random_rows(random.Random(slices), 90)
    rows = [(c, t, s, i, NOW + timedelta(hours=8 * i) - (at - NOW) / 4) for c, t, s, i, at in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = {r["arrival_idx"]: r["target_idx"] for r in streaming.similar_to_completion(df, slices).collect()}
    assert got == first_similar(rows) and any(v is not None for v in got.values())


def test_dates_that_begin_again_are_not_late(spark):
    """Dates that go back by more than the window in each slice: every posting is compared, none is dropped as late."""
    rows = [("acme", f"senior data engineer {'ab'[i % 2]} in rome", "abc"[i % 3], i, NOW + timedelta(days=i % 8 * 6)) for i in range(32)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {r["arrival_idx"]: r["target_idx"] for r in streaming.similar_to_completion(df).collect()} == first_similar(rows)


def test_rows_without_a_date_or_at_all(spark):
    df = spark.createDataFrame([("acme", "nurse", "a", 1, None), ("acme", None, "a", 2, NOW), (None, "nurse", "b", 3, NOW), ("acme", "nurse", "b", 4, NOW)], SCHEMA)
    got = {r["arrival_idx"]: r["target_idx"] for r in streaming.similar_to_completion(df, 1).collect()}
    assert got.get(4, 0) is None and set(got.values()) == {None}
    assert streaming.similar_to_completion(df.limit(0)).collect() == []


def test_a_repeated_batch_is_known_by_its_number(spark, tmp_path):
    """A transformation that makes new keys each time: only the number tells that a batch has run before."""
    s = store.Store(spark, f"file://{tmp_path}/t", 4)
    for k in range(3):
        spark.createDataFrame([(f"k{k}", k)], "k string, v int").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    fresh = lambda df: df.withColumn("k", F.expr("uuid()"))
    for turn in range(2):
        stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
        streaming.ingest(stream, s, "t", "k", fresh, f"file://{tmp_path}/ck{turn}").awaitTermination()
        assert s.read("t").count() == 3 and s.done("t", ("t", 2)) and not s.done("t", ("t", 3))
    version = s.version("t")
    assert s.merge("t", spark.createDataFrame([("x", 1)], "k string, v int"), "k", [F.col("k")], absent=True, mark=("t", 1)) == version
    assert s.merge("t", spark.createDataFrame([("x", 1)], "k string, v int"), "k", [F.col("k")], absent=True, mark=("other", 1)) == version + 1
    assert streaming.every(4) == {"processingTime": "14400 seconds"}


def test_ingestion_of_slices(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as v")
    got = streaming.ingest_to_completion(df.repartition(3), "id", 5)
    assert sorted(map(tuple, got.collect())) == [(i, i % 7) for i in range(100)]
    assert streaming.ingest_to_completion(df.limit(0), "id").count() == 0
