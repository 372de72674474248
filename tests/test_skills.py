"""Skills against a lexicon of any size, with terms of several words."""

from __future__ import annotations

import random

import pytest

from rolecast.functions import skills

LINES = "# notes\nPython\n  Machine   Learning \n\nmachine learning\nC++\nnatural language processing\nE2E\n"


@pytest.fixture
def lexicon(spark, tmp_path):
    (tmp_path / "terms.txt").write_text(LINES + "\n".join(f"term {i}" for i in range(600)))
    return skills.lexicon_from(spark, f"file://{tmp_path}/terms.txt")


def test_lexicon_of_a_file(lexicon):
    got = {r["term"]: r["n_words"] for r in lexicon.filter("not term rlike '^term [0-9]+$'").collect()}
    assert got == {"python": 1, "machine learning": 2, "c++": 1, "natural language processing": 3, "e2e": 1}
    assert lexicon.count() == 605


@pytest.mark.parametrize("most", [10, 20_000])
def test_split_as_a_set_and_as_a_join(spark, lexicon, most):
    terms = {r["term"] for r in lexicon.collect()}
    rng = random.Random(most)
    rows = [(i, [rng.choice([" Python", "Machine Learning", "talking", "TERM 5", "term 600", "", "C++ ", "c", None]) for _ in range(rng.randrange(12))]) for i in range(60)] + [(100, None), (101, [])]
    got = {r["id"]: (r["technical"], r["other"]) for r in skills.split(spark.createDataFrame(rows, "id long, s array<string>"), "s", lexicon, "id", most).collect()}
    for i, s in rows:
        want = (None, None) if s is None else ([x for x in s if x is not None and x.strip().lower() in terms], [x for x in s if x is not None and x.strip().lower() not in terms])
        assert got[i] == want, i


def test_split_by_nothing(spark, lexicon):
    df = spark.createDataFrame([(1, ["a", None])], "id long, s array<string>")
    r = skills.split(df, "s", lexicon.limit(0), "id").first()
    assert (r["technical"], r["other"]) == ([], ["a"])


def test_mentions_equal_a_search(spark, lexicon):
    terms = {r["term"] for r in lexicon.collect()}
    rng = random.Random(4)
    words = ["Python", "machine", "Learning", "natural", "language", "processing", "term", "5", "17", "c++", "x"]
    rows = [(i, rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=rng.randrange(30)))) for i in range(80)] + [(100, None), (101, ""), (102, "machine\t learning")]
    got = {(r["id"], r["term"]): r["n"] for r in skills.mentions(spark.createDataFrame(rows, "id long, t string"), "t", lexicon, "id").collect()}
    want = {}
    for i, t in rows:
        w = (t or "").lower().split()
        for n in (1, 2, 3):
            for k in range(len(w) - n + 1):
                term = " ".join(w[k : k + n])
                if term in terms:
                    want[i, term] = want.get((i, term), 0) + 1
    assert got == want and (102, "machine learning") in got
    assert skills.mentions(spark.createDataFrame(rows, "id long, t string"), "t", lexicon.limit(0), "id").count() == 0
