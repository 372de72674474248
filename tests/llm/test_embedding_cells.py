"""Recall and chance of the lattice cells that are chosen by the number of vectors."""

from __future__ import annotations

import numpy as np
import pytest

from rolecast.llm import embed_dedup as e


def meets(a: np.ndarray, b: np.ndarray, c: e.Cells) -> np.ndarray:
    """Whether pairs of rows meet in any table."""
    out = np.zeros(len(a), dtype=bool)
    for (own_a, near_a), (own_b, near_b) in zip(e.cells(a, c.tables, c.blocks, e.PROBES, c.scale), e.cells(b, c.tables, c.blocks, e.PROBES, c.scale), strict=True):
        out |= (own_a == own_b) | (near_a == own_b[:, None]).any(axis=1) | (near_b == own_a[:, None]).any(axis=1)
    return out


@pytest.mark.parametrize("cells", [c for _, c in e.LADDER])
@pytest.mark.parametrize("dim", [64, 200])
def test_recall_at_the_threshold_on_each_rung(cells, dim):
    rng = np.random.default_rng(dim)
    a = e.unit_rows(rng.normal(size=(800, dim)))
    g = rng.normal(size=a.shape)
    g = e.unit_rows(g - (g * a).sum(axis=1, keepdims=True) * a)
    assert meets(a, 0.95 * a + np.sqrt(1 - 0.95**2) * g, cells).mean() > 0.99
    other = e.unit_rows(rng.normal(size=(4000, dim)))
    assert meets(np.repeat(a[:20], 200, axis=0), other, cells).mean() <= 3 * cells.chance + 1e-3


def test_cells_by_number_of_vectors():
    assert e.cells_for(0) == e.cells_for(40_000) == e.LADDER[0][1] and e.cells_for(40_001) == e.LADDER[1][1] and e.cells_for(10**10) == e.LADDER[2][1]


@pytest.mark.parametrize("dim", [64, 200])
def test_recall_and_chance_of_the_cells_of_every_input(dim):
    rng = np.random.default_rng(dim + 1)
    a = e.unit_rows(rng.normal(size=(2000, dim)))
    g = rng.normal(size=a.shape)
    g = e.unit_rows(g - (g * a).sum(axis=1, keepdims=True) * a)
    assert meets(a, 0.95 * a + np.sqrt(1 - 0.95**2) * g, e.CELLS).mean() > 0.99
    other, met = e.unit_rows(rng.normal(size=(20_000, 64))), 0
    for own, probed in e.cells(other, 4, e.CELLS.blocks, e.PROBES, e.CELLS.scale):
        cells, n = np.unique(own, return_counts=True)
        at = np.searchsorted(cells, probed.ravel()).clip(max=len(cells) - 1)
        met += int((n * (n - 1) // 2).sum() + n[at][cells[at] == probed.ravel()].sum())
    assert met * e.CELLS.tables / 4 <= 20_000 * 19_999 / 2 * 4 * e.CELLS.chance + 3 * e.CELLS.tables / 4


def test_links_do_not_depend_on_what_else_is_there(spark, monkeypatch):
    """The same pair, alone and among others, whatever cells a number of vectors would call for."""
    monkeypatch.setattr(e, "LADDER", ((3, e.Cells(1, 3, 500.0, 0.0)), (None, e.LADDER[0][1])))
    rng = np.random.default_rng(4)
    x = e.unit_rows(rng.normal(size=(8, 64)))
    x[1] = x[0] + 0.02 * x[2]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    of = lambda rows: {r["vec_id"]: tuple(r) for r in e.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    few, many = of(rows[:2]), of(rows)
    assert few == {k: many[k] for k in few} and few[1] == (1, 1, 0, False)
