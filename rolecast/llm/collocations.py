"""Phrase collocations by sorted n-grams of word ids.

Texts are read once and written as blocks of some hundred thousand words, each with its own small dictionary.  Words that
are frequent in their language get ids over all blocks (a join of the blocks' dictionaries with the counts), and pieces of
text are broken at all other words.  Then, for phrases of 2, 3, ... words:

* a task packs the n-grams of a block into keys of four bytes a word, sorts them by radix (16 bits a pass), and counts runs;
* the sorted runs are cut at splitters, which a sample of blocks gives, and each range of keys goes to one task, which sorts
  what blocks have sent by radix again, adds up the counts of runs, and keeps keys that are frequent;
* a block gets a bit back for each of its keys, and breaks its pieces where an n-gram is not frequent, as no longer phrase with
  it can be.  So longer n-grams are made of frequent ones only, and nothing grows with the vocabulary but the tables
  that Spark joins.

Blocks carry word ids in byte planes, compressed; hot words and phrases cost one entry a block.  Cuts of a phrase, and
phrases inside others, are joins on the keys.  Scores are computed in decimals of 38 digits.

Edge cases: a null text is empty; a null language is ``und``; an empty table gives an empty result; a very long text is read in
chunks, but belongs to one block; repeated rows count each; a byte FF, which UTF-8 does not have, ends a piece; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, slices, store, tasks

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
#: Words of a block and of all languages' open blocks; bytes of a text read at a time; keys a range is to have; sampled blocks, and sampled keys a range.
BLOCK, OPEN, CHUNK, RANGE, SAMPLED, POINTS = 500_000, 2_000_000, 1 << 20, 1_000_000, 64, 20
#: Frequent words numbered together.
NUMBERED = 50_000

# What ends a piece becomes FF, capital letters become small.
ENDS = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes.maketrans(ENDS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\xff" * len(ENDS) + b"abcdefghijklmnopqrstuvwxyz")


def packed(ids: np.ndarray) -> bytes:
    """Ids as four planes of bytes, compressed, behind their number."""
    planes = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(ids).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.Codec("zstd").decompress(data[8:], decompressed_size=4 * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, n).T).view("<u4")[:, 0].astype(np.uint32)


class Words(defaultdict):
    """Numbers words from 1 in order of appearance; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__()
        self.default_factory = self.__len__
        self[b"\xff"] = 0
        self.runs: list[np.ndarray] = []
        self.held = 0

    def add(self, text: bytes) -> None:
        text, at = text.translate(BYTES), 0
        while at < len(text):
            end = text.find(b" ", at + CHUNK)
            end = len(text) if end < 0 else end
            found = text[at:end].replace(b"\xff", b" \xff ").split()
            self.runs.append(np.fromiter(map(self.__getitem__, found), np.uint32, len(found)))
            self.held += len(found)
            at = end
        self.runs.append(np.zeros(1, np.uint32))


def blocks(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """``block``, ``lang``, ``n`` words, ``words`` of the block and their ``counts``, and ``ids``, places in ``words`` from 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Words] = {}
        number = TaskContext.get().partitionId() << 32

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal number
            w = open_.pop(lang)
            ids, words = np.concatenate(w.runs), [x for x in w if x != b"\xff"]
            counts = np.bincount(ids, minlength=len(words) + 1)[1:]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number - 1]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([words], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64())), pa.array([packed(ids)], pa.binary())],
                names=["block", "lang", "n", "words", "counts", "ids"],
            )

        for batch in slices(batches, 256):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if len(text.as_buffer()) == 0:
                    continue
                w = open_.get(lang)
                if w is None:
                    w = open_[lang] = Words()
                w.add(text.as_py())
                if w.held >= block:
                    yield closed(lang)
            if sum(w.held for w in open_.values()) >= OPEN:
                for lang in list(open_):
                    yield closed(lang)
        for lang in list(open_):
            yield closed(lang)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    rows = df.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text)
    return rows.mapInArrow(run, "block long, lang string, n long, words array<binary>, counts array<long>, ids binary")


def dictionary(read: DataFrame, least: int) -> tuple[DataFrame, str]:
    """``id`` from 1, ``lang``, ``word`` and ``f`` of the frequent words; numbered in hashed groups."""
    spark = read.sparkSession
    each = read.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counted = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).filter(F.col("f") >= least)
    frequent, path = store(counted, "frequent-words")
    groups = frequent.count() // NUMBERED + 1
    group = F.pmod(F.xxhash64("lang", "word"), F.lit(groups)).cast("int").alias("group")
    frequent = frequent.select("lang", "word", "f", group)
    sizes = {r["group"]: r["count"] for r in frequent.groupBy("group").count().collect()}
    starts, at = [], 0
    for g in range(groups):
        starts.append((g, at))
        at += sizes.get(g, 0)
    starts = F.broadcast(spark.createDataFrame(starts, "group int, start long"))  # one row for 50,000 words
    place = F.row_number().over(Window.partitionBy("group").orderBy("lang", "word"))
    numbered, own = store(frequent.join(starts, "group").select((F.col("start") + place).alias("id"), "lang", "word", "f"), "dictionary")
    drop(spark, path)
    return numbered, own


def by_block(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, list[pa.RecordBatch]]]:
    """Of rows sorted by block whose first has the block's ``ids`` (column 1): the block, its ids, and its other rows."""
    block, ids, rest = None, None, []
    for batch in rows:
        own = batch.column(0).to_numpy()
        if not len(own):
            continue
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(i, j - i)
            if own[i] != block:
                if block is not None:
                    yield block, ids, rest
                block, ids, rest = int(own[i]), part.column(1)[0].as_py(), []
                part = part.slice(1)
            if len(part):
                rest.append(part)
    if block is not None:
        yield block, ids, rest


def block_row(block: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([int(np.count_nonzero(ids))]), pa.array([packed(ids)], pa.binary())], names=["block", "n", "ids"])


def encoded(read: DataFrame, words: DataFrame) -> DataFrame:
    """``block``, ``n`` and ``ids``, now those of the dictionary; runs of a single word are left out."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, rest in by_block(rows):
            ids = unpacked(data)
            names = np.zeros(int(ids.max()) + 1, np.uint32)
            for part in rest:
                names[part.column(2).to_numpy()] = part.column(3).to_numpy()
            ids = broken(names[ids], names[ids] > 0, 1)
            if len(ids):
                yield block_row(block, ids)

    places = read.select("block", "lang", F.posexplode("words").alias("at", "word")).join(words.select("id", "lang", "word"), ["lang", "word"])
    both = read.select("block", "ids", F.lit(0).alias("at"), F.lit(0).cast("long").alias("id")).unionByName(places.select("block", F.lit(None).cast("binary").alias("ids"), (F.col("at") + 1).alias("at"), "id"))
    return both.repartition("block").sortWithinPartitions("block", "at").mapInArrow(run, "block long, n long, ids binary")


def broken(ids: np.ndarray, frequent: np.ndarray, size: int) -> np.ndarray:
    """Runs of words, with a 0 behind each, of which every ``size`` neighbours are frequent and which have more words than
    that; ``frequent`` tells it of those that start at a place."""
    edge = np.diff(np.concatenate([[0], frequent.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # starts of frequent ones in a row
    long_ = end - start >= 2
    start, n = start[long_], (end - start)[long_] + size  # words, and a place for the 0
    if not len(start):
        return np.empty(0, np.uint32)
    past = np.cumsum(n)
    out = ids[np.minimum(np.arange(past[-1]) + np.repeat(start - (past - n), n), len(ids) - 1)].copy()
    out[past - 1] = 0
    return out


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of rows of 32-bit columns, the first the highest, by stable passes over 16 bits; passes without effect are left out."""
    order = None
    for column in range(keys.shape[1] - 1, -1, -1):
        for shift in (0, 16):
            digit = (keys[:, column] >> np.uint32(shift)).astype(np.uint16)
            if len(digit) and (digit[0] == digit).all():
                continue
            turn = np.argsort(digit if order is None else digit[order], kind="stable")  # of 16 bits numpy sorts by radix
            order = turn if order is None else order[turn]
    return np.arange(len(keys)) if order is None else order


def starts_of_runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return np.flatnonzero(new)


@dataclass
class Runs:
    """The distinct n-grams of a block in order, how often each occurs, and the places where they start, in their order."""

    keys: np.ndarray
    counts: np.ndarray
    places: np.ndarray


def grams(ids: np.ndarray, size: int) -> Runs:
    n = max(0, len(ids) - size + 1)
    whole = np.ones(n, dtype=bool)
    for k in range(size):
        whole &= ids[k : k + n] > 0
    places = np.flatnonzero(whole)
    keys = np.stack([ids[places + k] for k in range(size)], axis=1) if len(places) else np.empty((0, size), np.uint32)
    order = radix_order(keys)
    keys, places = keys[order], places[order]
    first = starts_of_runs(keys)
    return Runs(keys[first], np.diff(np.append(first, len(keys))), places)


def key_bytes(keys: np.ndarray) -> bytes:
    """Fixed width, in the order of the bytes."""
    return keys.astype(">u4").tobytes()


def from_bytes(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, ">u4").reshape(-1, size).astype(np.uint32)


def splitters(coded: DataFrame, size: int, ranges: int) -> list[bytes]:
    """Keys that cut the n-grams into about so many ranges of equal size, from the blocks with the smallest hashes.

    They steer the balance only.  The sample has no more keys than the one by which Spark itself cuts ranges.
    """
    if ranges < 2:
        return []
    chosen = [r["block"] for r in coded.select("block").orderBy(F.xxhash64("block"), "block").limit(SAMPLED).collect()]
    sample = coded.filter(F.col("block").isin(chosen))
    step = max(1, sample.agg(F.sum("n")).first()[0] // min(POINTS * ranges, 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                keys = grams(unpacked(data), size).keys[step // 2 :: step].astype(">u4")
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary())], names=["key"])

    keys = sorted(bytes(r["key"]) for r in sample.select("ids").mapInArrow(run, "key binary").collect())
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def range_cuts(keys: np.ndarray, cuts: list[bytes], size: int) -> np.ndarray:
    """Where each range starts among sorted keys."""
    both = np.concatenate([np.frombuffer(b"".join(cuts), ">u4").reshape(-1, size).astype(np.uint32), keys])
    place = np.empty(len(both), np.int64)
    place[radix_order(both)] = np.arange(len(both))  # stable: a splitter comes before its equals
    return place[: len(cuts)] - np.arange(len(cuts))


SENT = "block long, part int, n int, keys binary, counts binary"
COUNTED = "block long, part int, n int, keys binary, counts binary, bits binary"


def sent_runs(coded: DataFrame, size: int, cuts: list[bytes]) -> DataFrame:
    """The counted n-grams of every block, a row for each range of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = grams(unpacked(data), size)
                edges = np.concatenate([[0], range_cuts(found.keys, cuts, size), [len(found.keys)]])
                parts = np.flatnonzero(edges[1:] > edges[:-1])
                pieces = [(edges[p], edges[p + 1]) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(parts), block, np.int64)), pa.array(parts.astype(np.int32)), pa.array([int(j - i) for i, j in pieces], pa.int32()),
                     pa.array([key_bytes(found.keys[i:j]) for i, j in pieces], pa.binary()), pa.array([found.counts[i:j].astype("<i8").tobytes() for i, j in pieces], pa.binary())],
                    names=[c.split()[0] for c in SENT.split(", ")],
                )

    return coded.select("block", "ids").mapInArrow(run, SENT)


def counted_ranges(sent: DataFrame, size: int, least: int, answer: bool) -> DataFrame:
    """Of each range of keys one row without a block, with the frequent ones and their counts, and for each block a row of bits
    that tell which of the keys it sent are frequent."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())

    def total(part: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        blocks_, n = [r[0] for r in rows], [r[2] for r in rows]
        keys = np.concatenate([from_bytes(r[3], size) for r in rows])
        counts = np.concatenate([np.frombuffer(r[4], "<i8") for r in rows])
        rows.clear()
        order = radix_order(keys)
        keys = keys[order]
        first = starts_of_runs(keys)
        sums = np.add.reduceat(counts[order], first)
        kept = sums >= least
        out = [(None, part, int(kept.sum()), key_bytes(keys[first][kept]), sums[kept].astype("<i8").tobytes(), None)] if kept.any() else []
        if answer:
            flags = np.empty(len(order), dtype=bool)
            flags[order] = np.repeat(kept, np.diff(np.append(first, len(keys))))
            at = 0
            for block, m in zip(blocks_, n, strict=True):
                out.append((block, part, m, None, None, np.packbits(flags[at : at + m]).tobytes()))
                at += m
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in COUNTED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[1] != part and rows:
                    yield from total(part, rows)
                part = row[1]
                rows.append(row)
        if rows:
            yield from total(part, rows)

    return sent.sortWithinPartitions("part", "block").mapInArrow(run, COUNTED)


def shortened(coded: DataFrame, answers: DataFrame, size: int) -> DataFrame:
    """Blocks whose pieces are broken where an n-gram is not frequent."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, rest in by_block(rows):
            ids = unpacked(data)
            found, flags = grams(ids, size), []
            for part in rest:
                for m, bits in zip(part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                    flags.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=m).astype(bool))
            frequent = np.zeros(len(ids), dtype=bool)
            if flags:
                frequent[found.places] = np.repeat(np.concatenate(flags), found.counts)
            ids = broken(ids, frequent, size)
            if len(ids):
                yield block_row(block, ids)

    both = coded.select("block", "ids", F.lit(-1).alias("part"), F.lit(0).alias("n"), F.lit(None).cast("binary").alias("bits")).unionByName(
        answers.select("block", F.lit(None).cast("binary").alias("ids"), "part", "n", "bits")
    )
    return both.repartition("block").sortWithinPartitions("block", "part").mapInArrow(run, "block long, n long, ids binary")


def phrases(ranges: DataFrame, size: int) -> DataFrame:
    """``key`` and ``a`` of the frequent n-grams, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                column = pa.Array.from_buffers(pa.binary(4 * size), len(keys) // (4 * size), [None, pa.py_buffer(keys)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([column, pa.array(np.frombuffer(counts, "<i8"))], names=["key", "a"])

    return ranges.filter("block is null").select("keys", "counts").mapInArrow(run, "key binary, a long")


def words_in(key: str = "key") -> Column:
    return (F.octet_length(key) / 4).cast("int")


def frequent_phrases(coded: DataFrame, least: int, longest: int) -> DataFrame:
    """``key`` and ``a`` of all phrases of 2 to ``longest`` words that occur so often."""
    spark, found, path = coded.sparkSession, [], None
    for size in range(2, longest + 1):
        total = coded.agg(F.sum("n")).first()[0] or 0
        ranges = max(1, int(total // RANGE), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")) if total > RANGE // 10 else 1)
        sent = sent_runs(coded, size, splitters(coded, size, ranges)).repartition(tasks(spark, ranges, 4), "part")
        counted, _ = store(counted_ranges(sent, size, least, size < longest), f"phrases{size}")
        found.append(phrases(counted, size))
        if size < longest:
            coded, new = store(shortened(coded, counted.filter("block is not null"), size), f"blocks{size}")
            if path:
                drop(spark, path)
            path = new
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    out, _ = store(out, "phrases")
    return out


def whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """``lang``, ``l``, ``r`` and ``score`` of every phrase: of its cuts the one of the lowest score, and of such the first."""
    single = words.select(F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("part"), "f", "lang")
    parts = single.unionByName(found.select(F.col("key").alias("part"), F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")))
    cuts = found.select("key", "a", F.explode(F.sequence(F.lit(1), words_in() - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("substring(key, 1, 4 * cut)"), "right": F.expr("substring(key, 4 * cut + 1)")})
    left = cuts.join(parts.select(F.col("part").alias("left"), F.col("f").alias("l"), "lang"), "left")
    both = left.join(parts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    both = both.withColumn("score", F.expr(f"cast({2 * 10**6} as decimal(38,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = both.groupBy("key").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"), F.max("a").alias("a"), F.max("lang").alias("lang"))  # the first word's entry has the language
    return best.select("key", "lang", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), F.col("m.score").cast("long").alias("score"))


def uncovered(found: DataFrame, longest: int, percent: int) -> DataFrame:
    """Phrases that lie in no longer one that occurs ``percent`` of their times."""
    inside = F.expr(f"flatten(transform(sequence(2, {max(2, longest - 1)}), n -> if(n < size, transform(sequence(0, size - n), i -> substring(key, 4 * i + 1, 4 * n)), cast(array() as array<binary>))))")
    parts = found.select("key", "a", words_in().alias("size")).filter("size > 2").select("a", F.explode(inside).alias("key"))
    most = parts.groupBy("key").agg(F.max("a").alias("longer"))
    return found.join(most, "key", "left").filter(F.col("longer").isNull() | (whole(F.col("longer")) * 100 < whole(F.col("a")) * percent)).select("key", "a")


def collocations(df: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = COVERED, block: int = BLOCK) -> DataFrame:
    """Of each language the ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    spark = df.sparkSession
    read, path = store(blocks(df, block), "blocks")
    words, _ = dictionary(read, least)
    totals = read.groupBy("lang").agg(F.sum("n").alias("n"))
    totals, _ = store(totals, "totals")
    coded, _ = store(encoded(read, words), "coded")
    drop(spark, path)
    found = frequent_phrases(coded, least, longest)
    kept = uncovered(found, longest, percent)
    best = scored(found, words).join(kept.select("key"), "key", "left_semi")
    high = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = best.withColumn("_rank", F.rank().over(high)).filter(F.col("_rank") <= top).drop("_rank")  # equals at the end stay until the words are known
    best, _ = store(best, "best")
    ids = best.select("key", F.explode(F.sequence(F.lit(0), words_in() - 1)).alias("at")).withColumn("id", F.expr("cast(conv(hex(substring(key, 4 * at + 1, 4)), 16, 10) as long)"))
    spelled = ids.join(words.select("id", "word"), "id").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    text = F.concat_ws(" ", F.transform("w", lambda x: x["word"].cast("string"))).alias("phrase")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = best.join(spelled.select("key", text), "key").withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
