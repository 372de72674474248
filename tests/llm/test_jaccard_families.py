"""Families of the n-gram Jaccard join: groups of near copies with members that do not link with their head."""

from __future__ import annotations

import numpy as np
import pytest

from rolecast.llm import jaccard_join as J


def edited(rng: np.random.Generator, words: list[str], edits: int) -> list[str]:
    out = list(words)
    for at in rng.integers(0, len(out), edits):
        out[at] = f"x{rng.integers(0, 1 << 20)}" if rng.random() < 0.7 else words[int(rng.integers(0, len(words)))]
    for _ in range(int(rng.integers(0, 4))):
        del out[int(rng.integers(0, len(out)))]
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 90)])
@pytest.mark.parametrize("far_head", [0, 6])
def test_differences_of_linked_sets_meet_in_their_prefixes(n, percent, far_head):
    rng = np.random.default_rng([n, percent, far_head])
    base, shingle = [f"w{i}" for i in range(120)], J.Shingler(n)
    texts = [edited(rng, base, far_head), *(edited(rng, base, int(e)) for e in rng.integers(0, 14, 150))]
    sets = [shingle(" ".join(t)) for t in texts]
    shingles, counts = np.unique(np.concatenate(sets), return_counts=True)
    frequent = J.Frequent(shingles[counts > 1], counts[counts > 1])

    def links(x, y):
        both = len(np.intersect1d(x, y))
        return 100 * both >= percent * (len(x) + len(y) - both)

    head, rest = sets[0], [x for x in sets[1:] if not np.array_equal(x, sets[0])]
    near = [links(x, head) for x in rest]
    told = [J.difference(x, head, is_near, frequent, percent) for x, is_near in zip(rest, near, strict=True)]
    checked = 0
    for i, x in enumerate(rest):
        for j in range(i):
            if near[i] and near[j] or np.array_equal(x, rest[j]) or not links(x, rest[j]):
                continue
            (sa, ia, ma, pa), (sb, _, mb, pb) = sorted((told[i], told[j]), key=lambda t: t[0])
            sides = [(pa[:ia], pb)] if sa < sb else [(pa[:ia], pb), (told[i][3][: told[i][1]], told[j][3]), (told[j][3][: told[j][1]], told[i][3])]
            assert all(len(np.intersect1d(a, b)) >= min(ma, mb) for a, b in sides)
            checked += 1
    assert checked > 10


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_a_large_group_with_outsiders_equals_brute_force(spark, n, percent):
    rng = np.random.default_rng(n)
    base = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(edited(rng, base, int(e)))) for i, e in enumerate(rng.integers(0, 14, (200, 3)).min(axis=1) * 2, start=1)]
    rows += [(1000 + i, rows[i][1]) for i in range(5)] + [(2000, None), (2001, ""), (2002, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_join(df, n, percent).collect()}
    assert found == J.brute_force(rows, n, percent, str.split)
    sizes = {c: sum(x == c for x in found.values()) for c in set(found.values())}
    assert max(sizes.values()) > J.LARGE and sum(v == 1 for v in sizes.values()) > 10  # a group and those around it
