"""Running sums in two levels against plain ones, with groups of any size, nulls and ties."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolecast.operators import runs
from rolecast.operators.running import running

NOW = datetime(2024, 3, 5)


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_running_sums(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.choice([0, 1, 5, None, 40])) for i in rng.sample(range(1000), 400)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["seq"]: r["before"] for r in running(spark.createDataFrame(rows, "g string, seq long, v int"), [F.col("g")], ["seq"], F.col("v")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {s: sum(v or 0 for h, t, v in rows if h == g and t < s) for g, s, _ in rows}


def test_a_hot_group_is_many_ranges(spark):
    """All rows are of one group, and no task sees more than a share of them."""
    df = spark.range(4000).selectExpr("'one' as provider", "id as seq")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running(df, [F.col("provider")], ["seq"], F.lit(1)).withColumn("p", F.spark_partition_id())
        per = [r["n"] for r in out.groupBy("p").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per) == 4000 and max(per) < 3000


def test_equal_places_are_numbered_once(spark):
    df = spark.createDataFrame([("p", 1)] * 7 + [("p", 2)] * 3, "provider string, seq int")
    assert sorted(r["before"] for r in running(df, [F.col("provider")], ["seq"], F.lit(1)).collect()) == list(range(10))
    assert running(df.limit(0), [F.col("provider")], ["seq"], F.lit(1)).collect() == []


def test_daily_and_monthly_budgets(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("pq"), NOW + timedelta(hours=rng.randrange(24 * 60)), rng.randrange(40)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, provider string, ts timestamp, n int").repartition(4)
    before = lambda r, same: [x for x in rows if x[1] == r[1] and same(x[2]) == same(r[2]) and (x[2], x[0]) < (r[2], r[0])]
    got = {r["id"]: r["allowed"] for r in runs.daily_allowed(df, 3).collect()}
    assert got == {r[0]: len(before(r, lambda t: t.date())) < 3 for r in rows} and not all(got.values())
    got = {r["id"]: r["taken"] for r in runs.monthly_budget(df, 500).collect()}
    assert got == {r[0]: max(0, min(r[3], 500 - sum(x[3] for x in before(r, lambda t: (t.year, t.month))))) for r in rows}


def test_salary_error_of_either_end(spark):
    rows = [(100, 110, 200, 150), (None, 5, 300, 300), (100, None, None, None), (None, None, None, 7), (50, 20, None, 9)]
    r = runs.salary_error(spark.createDataFrame(rows, "expected_min int, actual_min int, expected_max long, actual_max long")).first()
    assert (r["n"], r["mae"]) == (4, (10 + 50 + 0 + 30) / 4)
    r = runs.salary_error(spark.createDataFrame([(None, 1, 2, None)], "expected_min int, actual_min int, expected_max int, actual_max int")).first()
    assert (r["n"], r["mae"]) == (0, None)
