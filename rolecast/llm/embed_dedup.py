"""Near-duplicate embeddings by lattice hashing.

In each of some tables a unit vector is projected at random to some blocks of eight dimensions, scaled, and every
block is decoded to the nearest point of the E8 lattice; the points name the vector's cell.  A vector also probes the
``PROBES`` cells that it is next closest to, found by adding the lattice's minimal vectors to one block.  Vectors that
meet, one in its own cell and one in its own or a probed one, are candidates, and a pair links if its cosine, in double
precision, is at least ``threshold``.

Recall against brute force is above 0.99 at the threshold itself (``tests/llm``); it rises with ``tables`` and ``probes`` and
falls with ``scale`` and ``blocks``, which thin out the cells.  Every row is indexed and nothing is fitted.  Candidates among
unrelated vectors grow with the square of their number, so the cells (``CELLS``) are so fine that even of hundreds of millions none
meets more than about 25 others by chance.  They are the same for every input: whether two vectors link does not depend on what
else is there.

Equal vectors are joined through one representative first, so a vector with many copies is hashed once.  Only ids are
in the cells; cells with many vectors are dealt out by adaptive execution.

Edge cases: a vector that is null, empty, zero or holds null or non-finite components links with nothing and is a component
of its own; vectors of different lengths never link; a null ``vec_id`` links with nothing and has no component;
rows that repeat a ``vec_id`` count as vectors of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .components import connected_components

#: The coarsest cells: tables, blocks and scale; and probed cells a vector and table.
TABLES, BLOCKS, SCALE, PROBES, SEED = 10, 2, 4.2, 6, 8


@dataclass(frozen=True)
class Cells:
    tables: int
    blocks: int
    scale: float
    chance: float  # that two unrelated vectors of 64 dimensions meet in any of the tables, as measured


#: The cells of every input, unless the caller states others.
CELLS = Cells(28, 3, 5.0, 5e-8)
#: Up to how many distinct vectors other cells would do, for a caller that states them; nothing here chooses by the input's size.
LADDER = ((40_000, Cells(TABLES, BLOCKS, SCALE, 6e-4)), (6_000_000, Cells(16, 3, 4.2, 4e-6)), (None, Cells(40, 3, 5.5, 7e-8)))


def cells_for(n: int) -> Cells:
    return next(c for most, c in LADDER if most is None or n <= most)


def nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: round, and where the sum is odd round the worst coordinate the other way."""
    p = np.rint(y)
    d = y - p
    rows, worst = np.arange(len(y)), np.abs(d).argmax(axis=1)
    odd = p.sum(axis=1) % 2 != 0
    p[rows, worst] += np.where(odd, np.where(d[rows, worst] >= 0, 1.0, -1.0), 0.0)
    return p


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by a half: the nearer of the two points."""
    a, b = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


@cache
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


@cache
def projections(dim: int, tables: int, blocks: int) -> np.ndarray:
    """tables x dim x 8 blocks, with orthogonal columns where there is room; lengths keep the mean distance in a block of unit scale."""
    rng, width = np.random.default_rng([SEED, dim]), 8 * blocks
    out = []
    for _ in range(tables):
        g = rng.normal(size=(dim, width))
        out.append(np.linalg.qr(g)[0] * np.sqrt(dim / 64) if dim >= width else g / 8)
    return np.array(out)


def mix(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name for each row of lattice points."""
    doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    h = np.full(len(doubled), (salt * 0x9E3779B97F4A7C15 + 1) % (1 << 64), dtype=np.uint64)
    for k in range(doubled.shape[1]):
        h = (h ^ doubled[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cells(unit: np.ndarray, tables: int, blocks: int, probes: int, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every table the vectors' own cells, and the probed ones (vectors x probes)."""
    dim, near = unit.shape[1], minimal_vectors()
    for t, p in enumerate(projections(dim, tables, blocks)):
        y = unit @ p * scale
        parts = [nearest_e8(y[:, 8 * k : 8 * k + 8]) for k in range(blocks)]
        point = np.hstack(parts)
        # Squared distance to a neighbour less that to the own point is 2 - 2 r.v.
        gain = np.hstack([(y[:, 8 * k : 8 * k + 8] - parts[k]) @ near.T for k in range(blocks)])
        best = np.argpartition(-gain, probes, axis=1)[:, :probes] if probes else np.empty((len(y), 0), dtype=int)
        salt = t * 100_003 + dim
        probed = []
        for k in range(best.shape[1]):
            moved, block = point.copy(), best[:, k] // len(near)
            for b in range(blocks):
                own = block == b
                moved[own, 8 * b : 8 * b + 8] += near[best[own, k] % len(near)]
            probed.append(mix(moved, salt))
        yield mix(point, salt), np.stack(probed, axis=1) if probed else np.empty((len(y), 0), dtype=np.int64)


def vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and values, in double precision, of a list column by the lists' length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, out = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), {}
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(int)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        out[int(dim)] = rows, flat[starts[rows][:, None] + np.arange(int(dim))]
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares stay in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding: str = "embedding") -> F.Column:
    e = F.col(embedding)
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & sound & F.exists(e, lambda x: x != 0), F.lit(False))


def near_pairs(reps: DataFrame, threshold: float, tables: int, blocks: int, probes: int, scale: float) -> DataFrame:
    """Pairs (a, b), a < b, of ``reps`` (id, embedding), whose ids differ, with a cosine of ``threshold`` or more."""

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in vectors(b.column(1)).values():
                ids = b.column(0).take(pa.array(rows)).to_numpy()
                unit = unit_rows(x)
                for own, probed in cells(unit, tables, blocks, probes, scale):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, probed.ravel()])), pa.array(np.concatenate([ids, np.repeat(ids, probed.shape[1])])), pa.array(np.arange(own.size + probed.size) < own.size)], names=["cell", "id", "own"])

    entries, _ = store(reps.mapInArrow(hash_rows, "cell long, id long, own boolean"), "cells")
    home = entries.filter("own").select("cell", F.col("id").alias("h"))
    guests = entries.select("cell", F.col("id").alias("g"), "own")
    met = home.join(guests, "cell").filter("h <> g and (not own or h < g)")
    pairs = met.select(F.least("h", "g").alias("a"), F.greatest("h", "g").alias("b")).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = vectors(b.column(2)), vectors(b.column(3))
            keep = np.zeros(len(b), dtype=bool)
            for dim, (rows, x) in one.items():
                if dim in two and np.array_equal(rows, two[dim][0]):
                    keep[rows] = np.einsum("ij,ij->i", unit_rows(x), unit_rows(two[dim][1])) >= threshold
            yield b.select(["a", "b"]).filter(pa.array(keep))

    one = reps.select(F.col("id").alias("a"), F.col("embedding").alias("ea"))
    two = reps.select(F.col("id").alias("b"), F.col("embedding").alias("eb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ea", "eb").mapInArrow(verify, "a long, b long")


def embedding_links(df: DataFrame, threshold: float = 0.95, probes: int = PROBES, cells: Cells = CELLS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``df`` with ``vec_id`` and ``embedding``.

    ``cells`` are the same for every number of vectors, so a pair's link is a matter of the pair alone.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn("same", F.when(usable() & F.col("vec_id").isNotNull(), F.md5(F.col("embedding").cast("string"))))
    groups = rows.filter("same is not null").groupBy("same").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # Ids may repeat, and hashes collide: groups get a number of their own when they are written.
    reps, _ = store(groups.withColumn("id", F.monotonically_increasing_id()), "groups")
    links, _ = store(near_pairs(reps.select("id", "embedding"), threshold, cells.tables, cells.blocks, probes, cells.scale), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = reps.select(F.col("id").alias("b"), "copies")
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "id")
    names = reps.select("id", "vec_id")
    named = links.join(names.toDF("a", "va"), "a").join(names.toDF("b", "vb"), "b").select(F.col("va").alias("a"), F.col("vb").alias("b"))
    found = connected_components(named).withColumnRenamed("id", "vec_id")
    by_group = reps.select("same", "id", "vec_id", "copies").join(linked, "id", "left").join(found, "vec_id", "left")
    by_group = by_group.select("same", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    out = rows.select("vec_id", "same").join(by_group, "same", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
