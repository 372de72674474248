"""Document fingerprints by order MinHash, which follow the edit distance of texts.

A text's words are its runs of ``K`` code points, each with the number of its earlier occurrences, so that repeats count.  For
each of ``SKETCHES`` random orders the ``TUPLE`` smallest of them are selected, put back into the order in which they stand in
the text, and hashed: a component of the fingerprint is equal in two texts if they agree on the selected words and on their
order.  The likeness of two fingerprints is the share of equal components; it is 1 for equal texts, and falls with
every insertion, deletion and move.

:func:`with_edits` also fingerprints the text whose last third is replaced by the start of the next document.  Next is by falling
``doc_id``, first after last.  Documents are dealt out to ranges of ids, and the first document of a range goes to
the range before as well, so a task reads its documents in order and never holds more than a document and its neighbour.  The part
of a text that the edit leaves is fingerprinted once for both.

Edge cases: a null text is empty; an empty text has a fingerprint of zeros, which is like that of empty texts only; a text of
fewer than ``K`` code points is one word, of fewer than ``TUPLE`` words its tuples are shorter; a text must fit into a task with
some sixty bytes for each of its code points; repeated rows, and rows that share a ``doc_id``, all have the next document of their id, and where several rows have
the next id, its smallest text counts, a null one as empty; a null ``doc_id`` comes after all others; a single document is its own next; an
empty table gives an empty result; an id that very many rows share is dealt out over tasks; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MOST_BROADCAST, slices, store, tasks

K, TUPLE, SKETCHES, SEED = 6, 2, 64, 13
#: Words that are hashed at a time; texts' bytes a range of ids is to have; rows of an id beyond which they are dealt out.
BLOCK, RANGE_BYTES, HOT = 2048, 4_000_000, 1000
EMPTY, NONE, HALF, FACTOR = np.uint32(0xFFFFFFFF), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(32), np.uint64(0x9E3779B97F4A7C15)
MIX, TURN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xD6E8FEB86659FD93)


@cache
def constants(sketches: int = SKETCHES) -> tuple[np.ndarray, np.ndarray]:
    """What makes a random order of 32-bit words of each sketch: a mask and an odd factor."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 2**32, sketches, dtype=np.uint32), rng.integers(0, 2**31, sketches, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


@cache
def workspace(sketches: int, block: int) -> np.ndarray:
    """Memory for the orders of a block of words; new pages for every block would cost more than the work on them."""
    return np.empty(sketches * block, dtype=np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le" if sys.byteorder == "little" else "utf-32-be", "replace"), dtype=np.uint32)


def words(cp: np.ndarray, k: int = K) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` code points; of a shorter text, one of the whole."""
    if not len(cp):
        return np.empty(0, dtype=np.uint64)
    k = min(k, len(cp))
    h, have = cp.astype(np.uint64), 1
    h += np.uint64(1)
    while have < k:  # twice as many at a time, with an overlap at the last
        more = min(have, k - have)
        ahead = h[more:]
        h = h[: len(h) - more] * FACTOR
        h += ahead
        h ^= h >> HALF
        have += more
    return h * MIX  # so that the high bits, by which they are compared, depend on all code points


def numbered(h: np.ndarray) -> np.ndarray:
    """32-bit names of the words with the number of their earlier occurrences."""
    n = len(h)
    places, bits = np.arange(n, dtype=np.uint64), np.uint64(max(1, n.bit_length()))
    packed = h >> bits << bits
    packed |= places
    packed.sort()
    high = packed >> bits
    again = np.flatnonzero(high[1:] == high[:-1]) + 1
    if len(again):
        first = places.copy()
        first[again] = 0
        turn = again.astype(np.uint64) - np.maximum.accumulate(first)[again]
        h[(packed[again] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] += turn * TURN
    h *= FACTOR
    h ^= h >> HALF
    h *= MIX
    return (h >> HALF).astype(np.uint32)


def smallest(names: np.ndarray, at: int, size: int = TUPLE, block: int = BLOCK) -> np.ndarray:
    """The ``size`` smallest of each order among words that start at place ``at`` of a text: values in the high halves of 64 bits,
    places in the low ones, so that of equal values the earlier place counts; ``NONE`` where there are too few."""
    mask, factor = constants()
    rows, chosen, space = np.arange(len(mask)), [np.full((len(mask), size), NONE)], workspace(len(mask), block)
    for i in range(0, len(names), block):
        own = names[i : i + block]
        h = np.bitwise_xor(own[None], mask[:, None], out=space[: len(mask) * len(own)].reshape(len(mask), -1))
        h *= factor[:, None]
        found = np.full((len(mask), size), NONE)
        for j in range(min(size, len(own))):
            best = h.argmin(axis=1)
            found[:, j] = (h[rows, best].astype(np.uint64) << HALF) | (best + (at + i)).astype(np.uint64)
            h[rows, best] = EMPTY
        chosen.append(found)
        if len(chosen) == 64:
            chosen = [merged(*chosen)]
    return merged(*chosen)


def merged(*parts: np.ndarray) -> np.ndarray:
    """The smallest of selections from disjoint places."""
    return np.sort(np.concatenate(parts, axis=1), axis=1)[:, : parts[0].shape[1]]


def signature(chosen: np.ndarray) -> np.ndarray:
    """16 bits of each sketch's selection in the order of the text; 0 of an empty text."""
    h = np.zeros(len(chosen), dtype=np.uint64)
    for turned in np.sort((chosen << HALF) | (chosen >> HALF), axis=1).T:  # by place
        h = np.where(turned == NONE, h, mixed(h * FACTOR + (turned & np.uint64(EMPTY)) + np.uint64(1)))
    return np.where(chosen[:, 0] == NONE, 0, np.maximum(h >> np.uint64(48), 1)).astype(np.uint16)


def selected(text: str) -> np.ndarray:
    return smallest(numbered(words(points(text))), 0)


def selected_both(text: str, other: str) -> tuple[np.ndarray, np.ndarray]:
    """The selections of two texts; words that both start with are read once."""
    a, b = numbered(words(points(text))), numbered(words(points(other)))
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    same = int(differ[0]) if len(differ) else n
    shared = smallest(a[:same], 0)
    return merged(shared, smallest(a[same:], same)), merged(shared, smallest(b[same:], same))


def fingerprint(text: str | None) -> str:
    return hexadecimal(signature(selected(text or "")))


def hexadecimal(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal components of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(t), dtype=">u2") for t in (a, b))
    return float((x == y).mean())


def edited(text: str, after: str) -> str:
    """The text whose last third is replaced by as much of the start of the next one, or all of that."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows that come by range and rising id: the next document of a row is the one of the id before.

    Columns: the range, its slice, whether a row comes from another range, ``doc_id``, ``text``, whether the row has no result of its own.
    """
    place, before, rep = None, None, None  # the range; (text, selection) of the id before and of the current id
    for batch in slices(batches, 256):
        rows, chosen = [], []
        for part, piece, turn, doc, text, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (part, piece) != place[:2] if place else True:
                rep = None
            text = text or ""
            new = rep is None or (turn, doc) != place[2:]
            if new:
                before, place = rep, (part, piece, turn, doc)
            if guest:
                if new:
                    rep = text, selected(text)
                continue
            other = edited(text, before[0])
            pair = selected_both(text, other)
            if new:
                rep = text, pair[0]
            rows.append((doc, len(text), hashlib.sha256(other.encode("utf-8", "replace")).hexdigest()))
            chosen += [*pair, before[1]]
        if not rows:
            continue
        sig = signature(np.concatenate(chosen)).reshape(len(rows), 3, -1)
        ids, n, digest = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digest), pa.array([hexadecimal(x) for x in sig[:, 0]]), pa.array([hexadecimal(x) for x in sig[:, 1]]), pa.array((sig[:, 0] == sig[:, 1]).mean(axis=1)), pa.array((sig[:, 0] == sig[:, 2]).mean(axis=1))],
            names=[c.split()[0] for c in RESULT.split(", ")],
        )


def range_of(bounds: list[int]) -> Column:
    """How many of the sorted bounds are below the id, -1 for a null id; looked for in blocks of bounds first, then within one."""
    each = max(1, int(len(bounds) ** 0.5))
    below = lambda values: F.size(F.filter(values, lambda b: b < F.col("doc_id")))
    block = below(F.lit(bounds[each - 1 :: each]).cast("array<long>"))
    inside = F.slice(F.lit(bounds).cast("array<long>"), block * each + 1, F.lit(each))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(block * each + below(inside)).cast("int")


def with_edits(df: DataFrame, range_bytes: int = RANGE_BYTES, hot: int = HOT) -> DataFrame:
    """``RESULT`` for every row of ``doc_id`` and ``text``."""
    spark = df.sparkSession
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if not rows:
        return spark.createDataFrame([], RESULT)
    count = tasks(spark, size or 0, range_bytes)
    ids = docs.select("doc_id")
    steps = [k / count for k in range(1, count)]
    found = ids.agg(F.percentile_approx("doc_id", steps, max(10_000, 20 * count)).alias("b")).first()["b"] if steps else None
    # An id with more rows than a range's share is a range of its own, which is cut into slices; there are no more such than ranges.
    share = max(hot, rows // count)
    many = {r["doc_id"]: r["n"] for r in ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > share).collect()}
    bounds = sorted({*(found or ()), *(i for i in many if i is not None), *(i - 1 for i in many if i is not None and i > -(2**63))})
    dealt = docs.withColumn("part", range_of(bounds))
    last = sorted((r["part"], r["doc_id"]) for r in dealt.groupBy("part").agg(F.max("doc_id").alias("doc_id")).collect())
    slices_of = {next(p for p, d in last if d == i): -(-n // share) for i, n in many.items()}
    # The last document of each range is a guest in the one above, and the very last one in the lowest.
    goes = [(d, last[(k + 1) % len(last)][0], int(k + 1 < len(last))) for k, (_, d) in enumerate(last)]
    goes = [(d, part, piece, turn) for d, part, turn in goes for piece in range(slices_of.get(part, 1))]
    guests = spark.createDataFrame(goes, "doc_id long, part int, piece int, turn int")
    guests = F.broadcast(guests) if len(goes) <= MOST_BROADCAST else guests
    same = docs["doc_id"].eqNullSafe(guests["doc_id"])
    texts = docs.join(guests.select("doc_id").distinct(), same, "left_semi").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    texts, _ = store(texts, "last-of-range")
    guests = guests.join(texts, guests["doc_id"].eqNullSafe(texts["doc_id"])).select("part", "piece", "turn", texts["doc_id"], "text", F.lit(True).alias("guest"))
    piece = F.lit(0)
    for part, n in slices_of.items():
        piece = F.when(F.col("part") == part, (F.rand(SEED) * n).cast("int")).otherwise(piece)
    own = dealt.select("part", piece.alias("piece"), F.lit(1).alias("turn"), "doc_id", "text", F.lit(False).alias("guest"))
    rows_in = own.unionByName(guests).repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 4)), "part", "piece")
    return rows_in.sortWithinPartitions("part", "piece", "turn", F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit(""))).mapInArrow(chain, RESULT)
