"""Every registered query with SQL, against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from rolecast.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Queries without SQL, and the test that compares each with a plain version.
ELSEWHERE = {"html_main_content": "test_main_content.py::test_main_content_of_the_pages"}


def test_queries_without_sql_have_a_test():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == set(ELSEWHERE)
    for place in ELSEWHERE.values():
        file, _, name = place.partition("::")
        assert f"def {name}(" in (Path(__file__).parent / file).read_text()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return float(v) if isinstance(v, int) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    got = df.collect()
    sql = catalogue.oracle_sql().get(name)
    if not sql:
        assert name in ELSEWHERE, f"{name} has neither SQL nor a test of its own"
        return
    expected = duck.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows(df.columns, got) == rows(expected.columns, expected.fetchall())
