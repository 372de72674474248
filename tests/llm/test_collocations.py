"""Collocations against counting every phrase in a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rolecast.llm import collocations as col

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest, top, percent):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = defaultdict(int)
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered[p[i : i + size]], a)
        found = []
        for p, a in candidates.items():
            if 100 * covered[p] >= percent * a:
                continue
            score, cut = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        out += [(lang, k + 1, t.decode(), -a, left, right, n[lang], -s) for k, (s, a, t, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def check(spark, rows, least=3, longest=4, top=2000, percent=80, **more):
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, key string").repartition(3)
    got = sorted(tuple(r) for r in col.collocations(df, least, longest, top, percent, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == plain(rows, least, longest, top, percent)
    return got


def texts(rng, n, vocabulary):
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    phrases = [rng.choices(vocabulary, k=rng.randrange(2, 6)) for _ in range(12)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(40)):
            words += rng.choice(phrases) if rng.random() < 0.3 else rng.choices(vocabulary, weights)
            words[-1] += rng.choice(["", "", "", "", ".", ",", "\n", "!", " ?"])
        out.append((rng.choice(["en", "de", None, "und", ""]), rng.choice([" ", "\t", "  "]).join(words)))
    return out


VOCABULARY = ["The", "of", "and", "é", "ÀB", "x\x85y", "\xa0", "z\x00", "😀", "-", *(f"w{i}" for i in range(40))]


def test_random_texts(spark):
    rows = texts(random.Random(1), 250, VOCABULARY)
    assert len({r[0] for r in check(spark, rows)}) == 4
    check(spark, rows, least=2, longest=3, top=7, percent=50)


def test_many_blocks_and_ranges(spark, monkeypatch):
    for name, value in {"RANGE": 50, "NUMBERED": 7, "SAMPLED": 3, "CHUNK": 64, "OPEN": 400}.items():
        monkeypatch.setattr(col, name, value)
    check(spark, texts(random.Random(2), 200, VOCABULARY), block=150)


def test_odd_texts(spark):
    rows = [("en", None), ("en", ""), ("en", " \t. ,\n"), (None, None), ("de", "a b " * 50), ("de", "a b c d e " * 30 + "."), ("en", "one two"), ("en", "one. two"), ("fr", "x " * 100)]
    assert check(spark, rows, least=30)


def test_ties_go_to_the_smaller_bytes(spark):
    rows = [("en", f"{w} {w}b.") for w in ["é", "z", "Z", "a", "😀", "ｚ"] for _ in range(4)]
    got = check(spark, rows, top=3)
    assert [r[2] for r in got] == ["z zb", "a ab", "é éb"]


def test_empty_table(spark):
    check(spark, [])
    check(spark, [("en", "few words only")])


def test_radix_order_is_stable_and_of_rows():
    rng = np.random.default_rng(5)
    for n, high in ((0, 5), (1, 5), (300, 3), (300, 2**32)):
        keys = rng.integers(0, high, (n, 3), dtype=np.uint32)
        assert col.radix_order(keys).tolist() == sorted(range(n), key=lambda i: tuple(keys[i]))


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_packed_ids(n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert (col.unpacked(col.packed(ids)) == ids).all()


def test_pieces_are_broken_where_no_phrase_can_be():
    ids = np.array([1, 2, 3, 4, 0, 5, 6, 0], dtype=np.uint32)
    pairs = np.array([1, 1, 0, 0, 0, 1, 0, 0], dtype=bool)  # 1 2 and 2 3 and 5 6
    assert col.broken(ids, pairs, 2).tolist() == [1, 2, 3, 0]
    assert col.broken(ids, ids > 0, 1).tolist() == [1, 2, 3, 4, 0, 5, 6, 0]
    overlap = np.array([1, 1, 0, 1, 1, 0, 0], dtype=bool)
    assert col.broken(np.arange(1, 8, dtype=np.uint32), overlap, 3).tolist() == [1, 2, 3, 4, 0, 4, 5, 6, 7, 0]
