"""Language profiles against counting trigrams in dictionaries."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolecast.functions import profiles
from rolecast.operators import prefilter

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and the other things that it has seen ", "de": "der schnelle braune fuchs springt über den faulen hund und die anderen dinge die er sah ", "xx": "日本語の求人です。東京の会社で働くエンジニアを募集します。"}


def grams(text):
    return Counter(text[i : i + 3] for i in range(len(text) - 2))


def plain(rows, top):
    counts = {}
    for lang, text in rows:
        if lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(grams(text.lower()))
    out = {}
    for lang, c in counts.items():
        total = sum(c.values())
        out[lang] = {g: round(math.log(n / total) * 1000) for g, n in sorted(c.items(), key=lambda x: (-x[1], [ord(y) for y in x[0]]))[:top]}
    return out


def best(found, text):
    c = grams(text.lower())
    if not c or not found:
        return "other", 0
    sums = {lang: sum(n * p.get(g, profiles.MISSING) for g, n in c.items()) for lang, p in found.items()}
    lang = min(sums, key=lambda x: (-sums[x], x))
    known = sum(n for g, n in c.items() if g in found[lang])
    return (lang if 100 * known >= profiles.KNOWN * sum(c.values()) else "other"), sums[lang]


@pytest.mark.parametrize("top", [20, 3000])
def test_profiles_and_languages(spark, top):
    rng = random.Random(top)
    cut = lambda t: (t * 3)[(a := rng.randrange(80)) : a + rng.randrange(160)]
    rows = [(lang, cut(t)) for lang, t in TEXTS.items() for _ in range(15)] + [(None, "x" * 9), ("en", None), ("de", ""), ("de", "ab")]
    table = profiles.profiles(spark.createDataFrame(rows, "lang string, text string").repartition(4), top)
    text = lambda g: "".join(chr(int(g) >> s & (1 << 21) - 1) for s in (42, 21, 0))
    got = {}
    for r in table.collect():
        got.setdefault(r["lang"], {})[text(r["gram"])] = r["weight"]
    want = plain(rows, top)
    assert got == want
    found = profiles.Profiles.of(table)
    asked = [cut(rng.choice(list(TEXTS.values()))).upper() for _ in range(60)] + ["", "a", "ab", "abc", None, "12345 67890 12345", "😀" * 9]
    df = spark.createDataFrame(list(enumerate(asked)), "i int, t string")
    detected = {r["i"]: (r["f"]["lang"], r["f"]["score"]) for r in df.select("i", profiles.detector(found)(F.col("t")).alias("f")).collect()}
    assert detected == {i: best(want, t or "") for i, t in enumerate(asked)}


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "".join(random.Random(1).choice("abc ") for _ in range(1000))
    whole = profiles.trigrams(text)
    monkeypatch.setattr(profiles, "PIECE", 64)
    pieces = profiles.trigrams(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces, strict=True))


def test_nothing_to_learn_from(spark):
    table = profiles.profiles(spark.createDataFrame([("en", None), (None, "text")], "lang string, text string"))
    assert profiles.Profiles.of(table).detect("some text") == ("other", 0.0, 0)


def test_rare_trigrams_of_a_profile_are_known(spark):
    """Of much text, the last trigrams of a profile weigh as much as missing ones, or less."""
    code = lambda g: sum(ord(c) << s for c, s in zip(g, (42, 21, 0), strict=True))
    rows = [("en", code("abc"), profiles.MISSING), ("en", code("bcd"), profiles.MISSING - 500), ("de", code("xyz"), -10)]
    found = profiles.Profiles.of(spark.createDataFrame(rows, "lang string, gram long, weight long"))
    assert found.detect("abc") == ("other", 0.0, profiles.MISSING)  # equal sums: the first by name
    assert found.detect("bcd") == ("other", 0.0, profiles.MISSING)
    alone = profiles.Profiles.of(spark.createDataFrame(rows[:2], "lang string, gram long, weight long"))
    assert alone.detect("abc") == ("en", 1.0, profiles.MISSING)
    assert alone.detect("abcd") == ("en", 1.0, 2 * profiles.MISSING - 500)


def test_prefilter_takes_a_detector(spark):
    found = profiles.Profiles.of(profiles.profiles(spark.createDataFrame([(k, t * 9) for k, t in TEXTS.items()], "lang string, text string")))
    rows = [(1, TEXTS["en"] * 4, None), (2, TEXTS["xx"] * 9, None), (3, TEXTS["xx"] * 9, "en")]
    df = spark.createDataFrame([(i, "Title", "Co", "https://x.example.com", d, lang) for i, d, lang in rows], "i int, title string, company_name string, url string, description string, original_language string").withColumn("posted_at", F.lit("2024-03-01").cast("timestamp"))
    got = {r["i"]: r["prefilter_reason"] for r in prefilter.prefilter(df, F.lit("2024-03-05").cast("timestamp"), profiles.detector(found)).collect()}
    assert got == {1: None, 2: "LANGUAGE_NOT_SUPPORTED", 3: None}
