"""Order MinHash against a plain version that holds every word in a dictionary, and what its likeness means."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rolecast.llm import order_minhash as omh

FULL = 2**64 - 1


def mix(x):
    x = (x ^ x >> 30) * int(omh.MIX) & FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & FULL
    return x ^ x >> 31


def word(cps):
    """The hash of a run of code points, from the hashes of its halves."""
    have, h = 1, [c + 1 for c in cps]
    while have < len(cps):
        more = min(have, len(cps) - have)
        h = [(h[i] * int(omh.FACTOR) + h[i + more]) & FULL for i in range(len(h) - more)]
        h = [x ^ x >> 32 for x in h]
        have += more
    return h[0] * int(omh.MIX) & FULL


def plain(text):
    cps = [ord(c) for c in text]
    k = min(omh.K, len(cps))
    seen, names = Counter(), []
    for i in range(len(cps) - k + 1 if cps else 0):
        run = tuple(cps[i : i + k])
        x = (word(run) + seen[run] * int(omh.TURN)) & FULL
        seen[run] += 1
        x = x * int(omh.FACTOR) & FULL
        x = (x ^ x >> 32) * int(omh.MIX) & FULL
        names.append(x >> 32)
    out = []
    for mask, factor in zip(*(c.tolist() for c in omh.constants())):
        best = sorted(((n ^ mask) * factor & 0xFFFFFFFF, i) for i, n in enumerate(names))[: omh.TUPLE]
        h = 0
        for value, _ in sorted(best, key=lambda v: v[1]):
            h = mix((h * int(omh.FACTOR) + value + 1) & FULL)
        out.append(max(h >> 48, 1) if best else 0)
    return "".join(f"{x:04x}" for x in out)


def texts(rng, n, most=60):
    return ["".join(rng.choice("abcde é😀") for _ in range(rng.randrange(most))) for _ in range(n)]


def test_equals_plain_version():
    rng = random.Random(1)
    for t in ["", "a", "abcdef", "abcdefg", "aaaaaaaaaaaaaaaaaaaa", "\x00" * 40, "ab" * 2000, *texts(rng, 60)]:
        assert omh.fingerprint(t) == plain(t), t


def test_texts_of_several_blocks():
    text = "".join(random.Random(2).choice("abcdefghij") for _ in range(3 * omh.BLOCK + 17))
    assert omh.fingerprint(text) == plain(text)
    whole = omh.smallest(omh.numbered(omh.words(omh.points(text))), 0)
    assert (omh.smallest(omh.numbered(omh.words(omh.points(text))), 0, block=100) == whole).all()


def test_shared_start_is_read_once():
    rng = random.Random(3)
    for a, b in zip(texts(rng, 80), texts(rng, 80)):
        for other in (a[: len(a) // 2] + b, a, "", a + a):
            got = omh.selected_both(a, other)
            assert (got[0] == omh.selected(a)).all() and (got[1] == omh.selected(other)).all()


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_likeness_follows_edits_and_order():
    rng = random.Random(4)
    falls, moved, apart = [], [], []
    for _ in range(40):
        text = prose(rng, 300)
        marks = [omh.likeness(omh.fingerprint(text), omh.fingerprint(text[: len(text) - cut] + prose(rng, 300)[:cut])) for cut in (0, len(text) // 20, len(text) // 5, len(text) // 2)]
        assert marks[0] == 1.0
        falls.append(marks)
        half = len(text) // 2
        moved.append(omh.likeness(omh.fingerprint(text), omh.fingerprint(text[half:] + text[:half])))
        apart.append(omh.likeness(omh.fingerprint(text), omh.fingerprint(prose(rng, 300))))
    mean = np.mean(falls, axis=0)
    assert all(x - y > 0.1 for x, y in zip(mean, mean[1:])), mean
    assert 0.3 < np.mean(moved) < 0.7, "the same words, half of the pairs in another order"
    assert max(apart) < 0.05


def brute(rows):
    """Results of rows (doc_id, text): the next id falling, a null one last, round again; its smallest text counts."""
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0), reverse=True)
    least = {i: min(t or "" for j, t in rows if j == i) for i in ids}
    follows = dict(zip(ids, ids[1:] + ids[:1]))
    out = []
    for i, t in rows:
        text, after = t or "", least[follows[i]]
        n = len(text) // 3
        ed = text[: len(text) - n] + after[:n]
        f = omh.fingerprint(text)
        out.append((i, len(text), hashlib.sha256(ed.encode()).hexdigest(), f, omh.fingerprint(ed), omh.likeness(f, omh.fingerprint(ed)), omh.likeness(f, omh.fingerprint(after))))
    return sorted(out, key=repr)


ODD = [(5, "a text of some words here"), (5, None), (5, "a text of some words here"), (9, ""), (None, "without an id, but a text"), (None, "another"), (-3, "é😀" * 30), (2**62, "x" * 50), (7, "a text of some words here, too")]


@pytest.mark.parametrize("range_bytes", [40, 10**9])
def test_query_equals_brute_force(spark, range_bytes):
    rng = random.Random(6)
    rows = ODD + [(rng.randrange(10_000), prose(rng, rng.randrange(30))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, part string, n_chars int").repartition(3)
    assert sorted(map(tuple, omh.with_edits(df, range_bytes).collect()), key=repr) == brute(rows)


def test_an_id_of_very_many_rows(spark):
    rows = [(1, "first " * 5), (3, "third " * 5), (None, "null " * 6)] + [(2, f"copy {i % 7} of many rows") for i in range(400)] + [(None, "n" * 20)] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, omh.with_edits(df, 500, hot=20).collect()), key=repr) == brute(rows)


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(4, "a single text")], "doc_id long, text string")
    assert list(map(tuple, omh.with_edits(one).collect())) == brute([(4, "a single text")])
    assert omh.with_edits(one.filter("doc_id = 0")).collect() == []
    assert list(map(tuple, omh.with_edits(one.selectExpr("cast(null as long) doc_id", "text")).collect())) == brute([(None, "a single text")])
