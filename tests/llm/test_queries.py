"""The registered queries themselves: against SQL, brute force and the library, on small tables with odd rows and on empty ones."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rolecast.llm import common, oracle, packing, queries, sharding

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long", "embeddings": "vec_id long, embedding array<float>, label int", "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string", "labels": "doc_id long, quality int, toxic int", "conversations": "conv_id long, turn long, role string, text string",
}
T = "words that many texts share again and again "


def write(spark, path, tables):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(tables.get(name, []), schema).coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    texts = [T * 3, None, "", " \t\n ", "one", "one two", "ONE Two", "x" * 5000, T * 3, "  odd spaces \x85 here", "Ünïcode İstanbul ß 😀 " * 4]
    for i in range(40):
        words = list(base)
        for at in rng.integers(0, 60, i % 5):
            words[at] = f"z{i}"
        texts.append(" ".join(words))
    docs = [(i + 1, t, ("en", "de", "fr", "es")[i % 4], "s", len(t or "")) for i, t in enumerate(texts)]
    v = rng.normal(size=(30, 16))
    near = [*v[:20], *(v[:10] + rng.normal(size=(10, 16)) * 0.2), *v[:5], *v[20:]]
    vectors = [(i, [float(x) for x in e], 0) for i, e in enumerate(near)] + [(100, None, 0), (101, [], 0), (102, [0.0] * 16, 0), (103, [float("nan")] * 16, 0), (104, [1.0, None], 0), (105, [1.0, 2.0], 0)]
    pages = [(i, f"https://a/{i}", h) for i, h in enumerate(["<p>" + T * 4, None, "", "short", "<p>" + T * 4, "short", "é" * 60, "é" * 60])] + [(50, "u" * 20_000, "<p>long url " + T * 3)]
    said = [(1, 0, "user", "a # b"), (1, 1, "assistant", "c\\<d>\nE: f"), (2, 0, "system", None), (2, 1, "user", ""), (2, 2, "assistant", "</turn>"), (2, 3, "assistant", "more 😀")]
    labels = [(i, i % 2, 0) for i in range(1, 45)]
    return write(spark, tmp_path_factory.mktemp("small"), {"documents": docs, "embeddings": vectors, "pages": pages, "conversations": said, "labels": labels, "benchmark": [(1, "What is the capital of that country over there, please tell me now?")]})


@pytest.fixture(scope="module")
def duck():
    def connect(path):
        con = duckdb.connect()
        for name in SCHEMAS:
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'" if not path.startswith("/root/testdata") else f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
        return con

    return connect


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("where", ["small", "/root/testdata/sf0.001"])
def test_query_equals_sql(spark, duck, request, name, where):
    path = request.getfixturevalue("small") if where == "small" else where
    df, want = queries.queries()[name](spark, path), duck(path).sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    assert got == sorted(want.project(", ".join(sorted(df.columns))).fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, tmp_path, name):
    path = write(spark, tmp_path, {})
    assert queries.queries()[name](spark, path).count() == (1 if name == "op4_chat_format" else 0)


def test_sharding_query(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in common.read(spark, small, "documents").collect()}
    rows = queries.op5_sharding(spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(16)}
    assert all(v == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_packing_query_against_the_library(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path(spark))
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in common.read(spark, small, "documents").collect()}
    rows = queries.op9_packing(spark, small).collect()
    seen = {i: [0] * len(x) for i, x in ids.items()}
    for r in rows:
        own = ids[r["doc_id"]]
        part = own[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        for k in range(r["start"], r["start"] + r["length"]):
            seen[r["doc_id"]][k] += 1
    assert all(x == 1 for own in seen.values() for x in own)
    for pieces in packing.sequences(rows):
        at = 0
        for r in pieces:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and (at == 2048 or not at & (at - 1))


@pytest.mark.parametrize(("name", "id_col", "flag"), [("op8_quality_crf", 5, 0), ("op10_language_id", 4, 2)])
def test_scores_of_every_document(spark, small, name, id_col, flag):
    rows = queries.queries()[name](spark, small).collect()
    assert len(rows) == 51 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % id_col == flag) for r in rows)
    if flag:
        assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {2, 3, 4}


def test_main_text_and_benchmark_queries(spark, small):
    rows = {r["page_id"]: r for r in queries.op1_html_extract(spark, small).collect()}
    assert len(rows) == 9 and rows[0]["text"] == (T * 4).strip() and rows[1]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert queries.op7_decontamination(spark, small).count() == 0


def test_repeated_rows_are_spread(spark):
    df = spark.range(5000).selectExpr("7L doc_id", "'the same text' text").unionByName(spark.range(300).selectExpr("id doc_id", "cast(id % 3 as string) text"))
    numbered = common.numbered_copies(df, most=100)
    assert numbered.groupBy("doc_id", "text").count().orderBy("doc_id", "text").collect() == df.groupBy("doc_id", "text").count().orderBy("doc_id", "text").collect()
    hot = numbered.filter("doc_id = 7 and text = 'the same text'")
    assert hot.agg(F.count_distinct("_copy")).first()[0] == 5000 and hot.agg(F.max("_copy")).first()[0] == 4999
    assert numbered.filter("text <> 'the same text' and _copy <> 0").count() == 0
    rows = sharding.shuffle_into_shards(df, bucket_bytes=20_000)
    assert rows.count() == 5300 and rows.select(F.spark_partition_id()).distinct().count() > 1
    again = sharding.shuffle_into_shards(df.repartition(7), bucket_bytes=20_000)
    assert rows.exceptAll(again).count() == 0


def test_starts_of_buckets_in_two_levels(spark):
    rng = np.random.default_rng(1)
    counts = {int(b): int(n) for b, n in zip(rng.choice(500, 200, replace=False), rng.integers(1, 9, 200), strict=True)}
    found, total = sharding.bucket_starts(spark.createDataFrame(list(counts.items()), "_bucket long, n long"), grouped=7)
    at, want = 0, {}
    for b in sorted(counts):
        want[b] = at
        at += counts[b]
    assert {r["_bucket"]: r["first"] for r in found.collect()} == want and total == at


def test_shards_are_written_in_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("id doc_id", "cast(id as string) text")
    sharding.write_shards(sharding.shuffle_into_shards(df, shards=4, bucket_bytes=4096), f"file://{tmp_path}/shards", 6)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    assert back.count() == 1000 and back.select("shard").distinct().count() == 4
    for shard in range(4):
        files = sorted(p for p in (tmp_path / "shards" / f"shard={shard}").glob("*.parquet"))
        slots = [r["slot"] for f in files for r in spark.read.parquet(f"file://{f}").collect()]
        assert slots == list(range(250))


def test_numbers_of_sequences_stay_in_range():
    for group in (0, 1 << 24, (1 << 35) - 1):
        assert packing.first_sequence(group) + (1 << packing.WITHIN) <= 1 << 63
    assert packing.first_sequence(5) + (1 << packing.WITHIN) == packing.first_sequence(6)


def test_oracle_names_are_queries():
    assert set(queries.oracle_sql()) <= set(queries.queries()) and oracle.OP2
