"""The similarity join against all pairs, components against union-find, hits against all rows of a hash."""

from __future__ import annotations

import random

import pytest

from rolecast.functions.fuzzy import sorted_tokens, token_sort_ratio
from rolecast.operators import dedupe
from rolecast.operators import similarity as sim


def changed(rng, text, most):
    chars = list(text)
    for _ in range(rng.randrange(most + 1)):
        at = rng.randrange(len(chars) + 1)
        if rng.random() < 0.5:
            chars.insert(at, rng.choice("abc xyé😀"))
        elif at < len(chars):
            del chars[at]
    return "".join(chars)


def titles(rng, n):
    words = ["senior", "software", "engineer", "data", "backend", "lead", "nurse", "(m/f)", "aaaa", "é", "a", "b", "ab", "😀😀"]
    base = [" ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(n // 5)] + ["", " ", "aaaaaa", "aaaaaaa", "abcdef", "abcdefg", "x" * 200]
    return base + [changed(rng, rng.choice(base), 5) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_alike_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    left, right = ([(rng.choice("xy"), sorted_tokens(t)) for t in titles(rng, 250)] for _ in range(2))
    frame = lambda rows: spark.createDataFrame([*rows, ("x", None), (None, "abcdefgh")], "block string, key string")
    got = sorted(map(tuple, sim.alike(frame(left), frame(right), 92.0).select("block", "a", "b").collect()))
    want = sorted({(b, x, y) for b, x in set(left) for c, y in set(right) if b == c and (x == y or x and y and token_sort_ratio(x, y) >= 92)})
    assert got == want and any(x != y for _, x, y in got)


def test_few_candidates_meet(spark):
    """Titles of one company, ten of which are alike each: few others meet."""
    rng = random.Random(9)
    letters = "abcdefghijklmnoprstuvw"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(3, 9)))
    rows = []
    for _ in range(200):
        base = " ".join(sorted(word() for _ in range(6)))
        rows += [("acme", base[:k] + "z" + base[k:]) for k in rng.sample(range(len(base)), 10)]
    df = spark.createDataFrame(rows, "block string, key string")
    found = sim.alike(df, df, 92.0).filter("a <> b").count()
    assert found >= 200 * 50 and sim.candidates(sim.sides(df, df), 92.0).count() <= 5 * found


def test_texts_that_meet_are_told_apart_before_the_shuffle(spark):
    """Titles of one company in few syllables, so that most share pairs of neighbours: few of those that are not alike are handed on."""
    rng = random.Random(4)
    syllables = ["th", "an", "er", "in", "on", "re", "at", "en", "ti", "es", "or", "st"]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(9))[:60] for _ in range(230)]
    rows = [("acme", sorted_tokens(t)) for t in texts + [t[:7] + "x" + t[7:] for t in texts[:30]]]
    df = spark.createDataFrame(rows, "block string, key string")
    found = {(r["a"], r["b"]) for r in sim.alike(df, df, 92.0).filter("a <> b").collect()}
    assert found == {(x, y) for _, x in rows for _, y in rows if x != y and token_sort_ratio(x, y) >= 92} and len(found) >= 40
    assert sim.candidates(sim.sides(df, df), 92.0).count() <= 10 * len(rows)


def test_lengths_that_the_bound_allows():
    """What a text may lack is a bound for every other length and any place of the edits."""
    rng = random.Random(3)
    pairs = lambda t: [t[i : i + 2] for i in range(len(t) - 1)]
    for _ in range(3000):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(6, 60)))
        b = changed(rng, a, 6)
        if not b or token_sort_ratio(a, b) < 92 or sorted_tokens(b) != b or sorted_tokens(a) != a:
            continue
        left, right = pairs(a), pairs(b)
        shared = 0
        for g in left:
            if g in right:
                right.remove(g)
                shared += 1
        n, share = len(a), 0.46
        fewest = n * share / (1 - share)
        lack = int(2 * (n - share * (n + fewest)) + (fewest - share * (n + fewest)) + 1e-6) + 1
        assert len(left) - shared <= lack and len(left) - lack >= sim.SHARED


def test_too_low_a_ratio_is_refused(spark):
    df = spark.createDataFrame([("x", "y")], "block string, key string")
    with pytest.raises(ValueError, match="differ so much"):
        sim.alike(df, df, 80.0)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components(spark, kind):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 100)] + [(5, 5)]
    name = (lambda i: i) if kind == "long" else (lambda i: f"{i:05}")
    links = [(name(a), name(b)) for a, b in links]
    root = {x: x for pair in links for x in pair if pair[0] != pair[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = dict(map(tuple, sim.components(spark.createDataFrame(links, f"a {kind}, b {kind}")).collect()))
    assert got == {x: find(x) for x in root}
    assert sim.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_first_hit_of_another_source(spark):
    rng = random.Random(2)
    row = lambda i: (i, rng.choice("hijk"), rng.choice("abc"), f"d{i}")
    stored, batch = [row(i) for i in range(30)], [row(i) for i in range(100, 140)] + [(200, None, "a", "x"), (201, "none", "a", "x")]
    schema = "arrival_idx long, cross_source_hash string, source string, dedup_hash string"
    got = sorted(map(tuple, dedupe.cross_source_hits(spark.createDataFrame(batch, schema), spark.createDataFrame([*stored, (31, None, "b", "z")], schema)).select("arrival_idx", "target_hash", "target_idx").collect()))
    want = []
    for i, h, s, _ in batch:
        hit = next(((d, j) for j, g, t, d in stored if g == h and t != s), None)
        want += [(i, *hit)] if hit else []
    assert got == sorted(want)


def test_what_is_no_longer_read_is_freed(spark):
    """Resolution leaves its outcome, what that is made of, and nothing else in the shared folder."""
    from pyspark.sql import functions as F

    from rolecast.operators import dedupe, resolve
    from rolecast.shared import RUN, hadoop, shared_dir

    def there():
        fs, path = hadoop(spark, f"{shared_dir(spark)}/{RUN}")
        return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()

    rows = [(i, f"senior data engineer {'abc'[i % 3]} in rome", f"Company {i % 2}", f"s{i % 4}") for i in range(24)]
    df = dedupe.with_hashes(spark.createDataFrame(rows, "arrival_idx long, title string, company_name string, source string"))
    df = df.withColumns({"posted_at": F.lit("2024-01-20").cast("timestamp"), "prefilter_reason": F.lit(None).cast("string"), "url_invalid": F.lit(False)})
    before = there()
    out = resolve.resolve(df, df.limit(0), "2024-01-29 00:00:00")
    left = {name.rsplit("-", 1)[0] for name in there() - before}
    assert not left & {"rows", "targets", "live", "keys", "postings", "components"} and sum(n.startswith("links") for n in there() - before) == 1
    assert out.count() == 24


def test_resolution_hands_on_few_titles(spark, monkeypatch):
    """As the fold of all rows in order, and of the titles of a company that meet few are handed on."""
    import pandas as pd
    from pyspark.sql import functions as F

    from rolecast.operators import resolve

    rng, seen, meeting = random.Random(6), [], sim.meeting
    syllables = ["th", "an", "er", "in", "on", "re", "at", "en", "ti", "es", "or", "st"]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(9))[:60] for _ in range(200)]
    rows = [(i, t, "acme", f"s{i % 3}") for i, t in enumerate(texts + [t[:7] + "x" + t[7:] for t in texts[:20]] + texts[:20])]
    df = dedupe.with_hashes(spark.createDataFrame(rows, "arrival_idx long, title string, company_name string, source string"))
    df = df.withColumns({"posted_at": F.lit("2024-01-20").cast("timestamp"), "prefilter_reason": F.lit(None).cast("string"), "url_invalid": F.lit(False)})

    def watched(met, least):
        found = meeting(met, least)
        seen.append(found.count())
        return found

    monkeypatch.setattr(sim, "meeting", watched)
    got = sorted(map(tuple, resolve.resolve(df, df.limit(0), "2024-01-29 00:00:00").select("arrival_idx", "outcome", "target_idx", "inserted").collect()))
    whole = df.withColumn("stored", F.lit(False)).orderBy("arrival_idx").toPandas().to_dict("records")
    assert got == sorted(resolve.fold(whole, pd.Timestamp("2024-01-15"))) and {"new", "fuzzy_hit", "cross_source_hit"} <= {r[1] for r in got}
    assert len(seen) == 1 and seen[0] <= 10 * len(rows)
