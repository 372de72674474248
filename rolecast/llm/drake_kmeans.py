"""Centroid clustering with Drake's adaptive bounds, exact in integers.

Vectors are turned into integers, floor(``SCALE`` * x).  Every vector keeps its nearest centroids in order, an upper bound of
its distance to the first, a lower bound for each of the others, and one remainder bound for all centroids that it does not
list.  When centroids have moved, the upper bound grows by the move of its centroid, lower bounds shrink by the moves of theirs,
and the remainder by the largest move.  While the upper bound is strictly below all others, the vector is not
looked at again.  Else its own distance is computed; if the bounds from some place of the list on are above that, only the
places before it are measured and put in order, and if not even the remainder is, all centroids are.  How many places are
listed adapts: the next round keeps as many as this one needed.

Distances are compared as exact integers, so that ties go to the smaller number; bounds are doubles with a margin for their
rounding.  Vectors and their bounds are written and read again each round, which shuffles nothing; sums of components are
added up in a task and then by Spark, and the driver holds the centroids only.

Edge cases: vectors that are null, of another length, or with null or non-finite components are left out; rows that repeat a
``vec_id`` count as vectors of their own (as a start, those of equal hashes are ordered by their components); vectors
with a null ``vec_id`` are kept, and start a cluster only where too few others do; with fewer vectors than clusters each starts
one; an empty table gives an empty result; components too large for exact doubles are computed as Python integers, without
bounds; a distance or a sum beyond 64 bits is given as the largest long; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, slices, store

WIDTH, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Components up to this size have distances that doubles hold exactly; of larger integers this many bits are summed at a time.
EXACT, LIMB = 2**21, 60
MOST_LONG = 2**63 - 1
#: Bounds are moved apart by this share of themselves, far more than the rounding of a few additions.
MARGIN = 1e-9


@dataclass(frozen=True)
class Centroids:
    at: list[list[int]]
    moved: list[float] | None = None  # how far each is from where it was a round ago; None if there are no bounds yet

    def exact(self) -> np.ndarray | None:
        """As doubles, unless they are too large."""
        return np.array(self.at, dtype=np.float64) if all(abs(x) <= EXACT for c in self.at for x in c) else None


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): doubles where all results are small, Python integers otherwise."""
    x = values.astype(np.float64)
    if not len(x) or np.abs(x).max() <= EXACT / SCALE:
        return np.floor(x * SCALE)
    whole = lambda v: int(v) * SCALE if abs(v) >= 2**53 else math.floor(v * SCALE)
    return np.array([[whole(v) for v in row] for row in x.tolist()], dtype=object)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, n x k; ``centroids`` are k x width or, for own ones of each vector, n x k x width."""
    if centroids.ndim == 2 and x.dtype != object:
        return (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None] - 2 * (x @ centroids.T)
    if centroids.ndim == 2:
        centroids = centroids[None]
    diff = x[:, None, :] - centroids
    return (diff * diff).sum(axis=2)


@dataclass
class Bounds:
    """``near``: n x (b + 1) centroids, the own one first; ``bound``: its upper bound, the lower bounds of the others, the remainder's."""

    near: np.ndarray
    bound: np.ndarray

    def cut(self, b: int) -> Bounds:
        """With ``b`` listed places; what is no longer listed joins the remainder."""
        if b >= self.near.shape[1] - 1:
            return self
        rest = self.bound[:, b + 1 :].min(axis=1, keepdims=True)
        return Bounds(self.near[:, : b + 1], np.concatenate([self.bound[:, : b + 1], rest], axis=1))


def scan(x: np.ndarray, at: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """Distances to all centroids: the bounds, and the distance to the nearest."""
    d = squared(x, at)
    order = np.argsort(d, axis=1, kind="stable")  # of equal distances the smaller number
    near = order[:, : b + 1].astype(np.int32)
    if d.dtype == object:  # no bounds
        bound = np.full((len(x), b + 2), -np.inf)
        bound[:, 0] = np.inf
        return Bounds(near, bound), np.take_along_axis(d, order[:, :1], axis=1)[:, 0]
    root = np.sqrt(np.take_along_axis(d, order, axis=1))
    rest = root[:, b + 1 : b + 2] if root.shape[1] > b + 1 else np.full((len(x), 1), np.inf)
    return Bounds(near, np.concatenate([root[:, : b + 1], rest], axis=1)), root[:, 0]


def advance(x: np.ndarray, at: np.ndarray, moved: np.ndarray, old: Bounds) -> tuple[Bounds, int, int]:
    """New bounds after the centroids' moves, the places that any certified vector needed, and how many distances were computed."""
    near, bound, b = old.near.copy(), old.bound.copy(), old.near.shape[1] - 1
    bound[:, 0] = (bound[:, 0] + moved[near[:, 0]]) * (1 + MARGIN) + MARGIN
    bound[:, 1 : b + 1] = (bound[:, 1 : b + 1] - moved[near[:, 1:]]) * (1 - MARGIN) - MARGIN
    bound[:, b + 1] = (bound[:, b + 1] - moved.max()) * (1 - MARGIN) - MARGIN
    least = bound[:, 1:].min(axis=1)
    open_ = np.flatnonzero(~(bound[:, 0] < least))
    seen, places = len(open_), 0
    if not len(open_):
        return Bounds(near, bound), 0, 0
    own = squared(x[open_], at[near[open_, :1]])[:, 0]
    bound[open_, 0] = np.sqrt(own) * (1 + MARGIN)
    # The first place from which all bounds are above the own distance; b + 2 if the remainder's is not.
    above = bound[open_, 1:] > bound[open_, :1]
    first = b + 2 - np.logical_and.accumulate(above[:, ::-1], axis=1).sum(axis=1)
    for q in range(2, b + 2):
        rows = open_[first == q]
        if not len(rows):
            continue
        places, seen = max(places, q - 1), seen + len(rows) * (q - 1)
        d, ids = squared(x[rows], at[near[rows, :q]]), near[rows, :q]
        order = np.lexsort((ids, d), axis=1)
        near[rows, :q] = np.take_along_axis(ids, order, axis=1)
        root = np.sqrt(np.take_along_axis(d, order, axis=1))
        bound[rows, 0], bound[rows, 1:q] = root[:, 0] * (1 + MARGIN), root[:, 1:] * (1 - MARGIN)
    rows = open_[first == b + 2]
    if len(rows):
        places, seen = b, seen + len(rows) * len(at)
        found, _ = scan(x[rows], at, b)
        near[rows], bound[rows] = found.near, found.bound
    return Bounds(near, bound), places, seen


def assigned(x: np.ndarray, c: Centroids, at: np.ndarray | None, old: Bounds | None, b: int) -> tuple[Bounds, int, int]:
    """The bounds of vectors for where the centroids are now."""
    if at is not None and x.dtype != object and old is not None and c.moved is not None and np.isfinite(c.moved).all():
        return advance(x, at, np.array(c.moved), old.cut(b))
    exact = at if at is not None and x.dtype != object else np.array(c.at, dtype=object)
    return scan(x if exact.dtype != object else x.astype(int).astype(object) if x.dtype != object else x, exact, b)[0], b, len(x) * len(c.at)


def rows_of(values: np.ndarray) -> pa.ListArray:
    flat = pa.array(np.ascontiguousarray(values).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def table_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def step(vectors: DataFrame, c: Centroids, b: int, width: int) -> DataFrame:
    """One assignment of all vectors: adds or replaces their bounds."""
    names, kinds = vectors.columns, dict(vectors.dtypes)
    known = "near" in names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = c.exact()
        for batch in slices(batches):
            x = quantised(table_of(batch.column(1), width))
            old = None
            if known:
                near = batch.column(2)
                per = len(near.flatten()) // max(1, len(near))
                old = Bounds(table_of(near, per), table_of(batch.column(3), per + 1))
            new, places, seen = assigned(x, c, at, old, b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows_of(new.near.astype(np.int32)), rows_of(new.bound), pa.array(np.full(len(batch), places, np.int32)), pa.array(np.where(np.arange(len(batch)) == 0, seen, 0).astype(np.int64))], names=["vec_id", "embedding", "near", "bound", "places", "seen"])

    return vectors.select(*([*names[:2], "near", "bound"] if known else names)).mapInArrow(run, f"vec_id {kinds['vec_id']}, embedding {kinds['embedding']}, near array<int>, bound array<double>, places int, seen long")


def sums(state: DataFrame, width: int) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Vectors of each centroid, and the exact sums of their components; added up by task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for batch in slices(batches):
            x, own = quantised(table_of(batch.column(0), width)), batch.column(1).to_numpy()
            for k in np.unique(own):
                mine = x[own == k]
                part = mine.astype(np.int64).sum(axis=0).tolist() if mine.dtype != object else mine.sum(axis=0).tolist()
                held = total.setdefault(int(k), [0] * (width + 1))
                total[int(k)] = [p + q for p, q in zip(held, [*part, len(mine)], strict=True)]
        out = []
        for k, values in total.items():
            for at, v in enumerate(values):
                power = 0
                while True:  # limbs, so that Spark can add up numbers of any size
                    high, low = v >> LIMB, v & (1 << LIMB) - 1
                    out.append((k, at, power, v if high in (0, -1) else low))
                    if high in (0, -1):
                        break
                    v, power = high, power + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(col), kind) for col, kind in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "at", "power", "total"])

    parts = state.selectExpr("embedding", "near[0] as cluster").mapInArrow(run, "cluster int, at int, power int, total long")
    count, total = {}, {}
    for r in parts.groupBy("cluster", "at", "power").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():  # clusters x components
        held = total.setdefault(r["cluster"], [0] * (width + 1))
        held[r["at"]] += int(r["total"]) << LIMB * r["power"]
    for k, values in total.items():
        count[k] = values.pop()
    return count, total


def distance(a: list[int], b: list[int]) -> float:
    d = sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    return math.sqrt(d) * (1 + MARGIN) if d < 2**1000 else math.inf


def renewed(c: Centroids, count: dict[int, int], total: dict[int, list[int]]) -> Centroids:
    """Centroids at the floored means of their vectors; empty ones stay."""
    at = [[s // count[k] for s in total[k]] if count.get(k) else old for k, old in enumerate(c.at)]
    return Centroids(at, [distance(new, old) for new, old in zip(at, c.at, strict=True)])


def sound(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """``vec_id`` and ``embedding`` of the vectors that count."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select("vec_id", "embedding").filter(F.coalesce((F.size(e) == width) & finite, F.lit(False)))


def starts(vectors: DataFrame, k: int) -> Centroids:
    """The vectors whose ids have the smallest hashes."""
    h = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(h.asc_nulls_last(), "embedding").limit(k).collect()
    x = quantised(np.array([r["embedding"] for r in rows], dtype=np.float64).reshape(len(rows), len(rows[0]["embedding"]) if rows else 0))
    return Centroids([[int(v) for v in row] for row in x.tolist()])


def drake_kmeans(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, log: list | None = None) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` of every vector that counts.

    ``log`` takes (places listed, distances computed) of every assignment.
    """
    spark = df.sparkSession
    vectors = sound(df, width)
    c = starts(vectors, k)
    if not c.at:
        return spark.createDataFrame([], f"vec_id {dict(df.dtypes)['vec_id']}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    b, path = max(1, len(c.at) // 4) if len(c.at) > 1 else 0, None
    for turn in range(rounds + 1):
        state, new = store(step(vectors, c, b, width), "clusters")
        if path:
            drop(spark, path)
        vectors, path = state, new
        used = state.agg(F.max("places"), F.sum("seen")).first()
        if log is not None:
            log.append((b, used[1]))
        if turn:  # never fewer than half of what it began with
            b = min(b, max(used[0], max(1, len(c.at) // 8) if b else 0))
        if turn < rounds:
            c = renewed(c, *sums(state, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, at = c.exact(), np.array(c.at, dtype=object)
        for batch in slices(batches):
            x, own = quantised(table_of(batch.column(1), width)), batch.column(2).to_numpy()
            fast = exact is not None and x.dtype != object
            diff = x - exact[own] if fast else (x.astype(int).astype(object) if x.dtype != object else x) - at[own]
            d = (diff * diff).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([min(int(v), MOST_LONG) for v in d.tolist()], pa.int64())], names=["vec_id", "cluster", "distance"])

    out = vectors.selectExpr("vec_id", "embedding", "near[0] as cluster").mapInArrow(run, f"vec_id {dict(df.dtypes)['vec_id']}, cluster int, distance long")
    per = {r["cluster"]: int(r["d"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digest = lambda values: hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()
    whole = min(sum(per.values()), MOST_LONG)
    side = spark.createDataFrame([(n, min(per.get(n, 0), MOST_LONG), whole, digest(v)) for n, v in enumerate(c.at)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
