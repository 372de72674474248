"""The pipeline's stages on odd rows: nulls, blanks, repeated rows and ids, columns named like results, no rows at all."""

from __future__ import annotations

import numpy as np
import pytest

p = pytest.importorskip("corpus_pipeline")
from rolecast.llm.common import read, store  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, item_ids int, Covered string"


def rows():
    rng = np.random.default_rng(5)
    words = ["river", "stone", "under", "bridge", "walks", "quietly", "morning", "people", "garden", "letters", "window", "winter", "another", "company", "always", "never"]
    text = lambda: " ".join(rng.choice(words, 60)).capitalize() + "."
    shared = text()
    docs = [(1, shared), (2, shared), (2, shared), (3, text()), (3, text()), (4, None), (5, ""), (6, " \n "), (None, text()), (None, text()), (7, "12 34 !!"), (8, text())]
    return [(i, t, "en", "s", len(t or ""), f"own {i}", "mine", i, "yes") for i, t in docs]


def test_each_stage_keeps_columns_and_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    for k, (name, stage) in enumerate(p.STAGES[:4]):
        out, _ = store(stage(spark, docs, SF), f"edge{k}")
        assert out.columns == docs.columns, name
        assert {(r["doc_id"], r["score"], r["lang_pred"], r["item_ids"], r["Covered"]) for r in out.collect()} <= {(r["doc_id"], r["score"], r["lang_pred"], r["item_ids"], r["Covered"]) for r in docs.collect()}
        assert not {4, 5, 6} & {r["doc_id"] for r in out.collect()} or k > 0
    kept = p.near_copies(spark, docs, SF)
    found = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    want = {(r[0] or 0, r[1] or "") for r in rows()} - {(2, rows()[1][1])}
    assert found == sorted(want)


def test_unique_text_of_a_shared_id_stays(spark):
    """An id with a near copy of another document and a text of its own: only the copy goes."""
    rng = np.random.default_rng(6)
    words = [f"word{i}" for i in range(400)]
    a, b, c = (list(rng.choice(words, 80)) for _ in range(3))
    docs = [(1, " ".join(a)), (5, " ".join([*a, "x"])), (5, " ".join(b)), (9, " ".join(c)), (7, " ".join([*b, "y"])), (3, " ".join([*c, "z"])), (9, " ".join(c)), (None, " ".join(a))]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "", "", 0, "") for i, t in docs], SCHEMA)
    found = sorted((r["doc_id"] or 0, r["text"]) for r in p.near_copies(spark, df, SF).collect())
    assert found == sorted([(0, docs[7][1]), docs[0], docs[2], docs[5]])


def test_empty_tables_pass_through(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in p.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_whole_run_on_the_smallest_tables(spark):
    out = p.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)
    assert read(spark, SF, "documents").count() >= out.select("doc_id").distinct().count()
