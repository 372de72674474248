"""Arranged tables: what filters on dates and states read, by the metrics of the plan's scans."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolecast.operators import layout

START = datetime(2023, 1, 1)


def scans(df):
    """Files and rows that a query's scans read; it is run for that."""
    df.collect()
    seen = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        else:
            if name == "FileSourceScanExec":
                seen.append((node.metrics().apply("numFiles").value(), node.metrics().apply("numOutputRows").value()))
            for i in range(node.children().size()):
                walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return tuple(map(sum, zip(*seen)))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('arranged')}/t"
    rows = [(i, ("active", "expired", "closed", None)[i % 4], None if i % 10 == 0 else START + timedelta(hours=3 * i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, status string, at timestamp")
    layout.arrange(df, path, "at", ["status"], 8)
    return path, rows


def test_a_filter_on_dates_reads_its_months(spark, table):
    path, rows = table
    whole, _ = scans(layout.read(spark, path))
    for limit, null in (("2023-01-20 05:00:00", False), ("2023-03-01 00:00:00", True), ("2022-01-01 00:00:00", True), ("2030-01-01 00:00:00", False)):
        at = datetime.fromisoformat(limit)
        found = layout.before(layout.read(spark, path), "at", limit, null)
        assert found.columns == ["id", "status", "at"]
        assert sorted(r["id"] for r in found.collect()) == [i for i, _, t in rows if (t is None and null) or (t is not None and t < at)]
        files, _ = scans(found)
        months = {t.strftime("%Y-%m") for _, _, t in rows if t is not None and t < at} | ({layout.NONE} if null else set())
        assert files < whole / 3 or len(months) > 6


def test_a_state_is_found_by_statistics(spark, table):
    """Within a month rows lie in order of their state, so row groups of others are not read."""
    path, rows = table
    january = layout.before(layout.read(spark, path), "at", "2023-02-01 00:00:00")
    files, n = scans(january.filter("status = 'closed'"))
    _, every = scans(january)
    assert 0 < n <= every and sorted(r["id"] for r in january.filter("status = 'closed'").collect()) == [i for i, s, t in rows if s == "closed" and t is not None and t < datetime(2023, 2, 1)]
    assert "EqualTo(status,closed)" in january.filter("status = 'closed'")._jdf.queryExecution().toString()


def test_nothing_to_arrange(spark, tmp_path):
    layout.arrange(spark.createDataFrame([(1, "x", None)], "id long, status string, at timestamp"), f"file://{tmp_path}/t", "at", ["status"])
    t = layout.read(spark, f"file://{tmp_path}/t")
    assert layout.before(t, "at", "2023-01-01 00:00:00").count() == 0 and layout.before(t, "at", "2023-01-01 00:00:00", True).count() == 1
    assert t.agg(F.max("_month")).first()[0] == layout.NONE
