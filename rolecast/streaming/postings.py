"""Structured Streaming: deduplicated counts by day, incremental ingestion into versioned tables, similar postings of two weeks."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.fuzzy import lcs
from ..operators.dedupe import FUZZY_DAYS, FUZZY_LEAST
from ..operators.similarity import SHORT, in_order, lacking
from ..operators.store import Store
from ..shared import cut, shared_dir

CHECKPOINTS = "stream-checkpoints"


def shared(spark: SparkSession, name: str) -> str:
    """A folder for a stream's state beside the session's checkpoints."""
    return f"{shared_dir(spark)}/{CHECKPOINTS}/{name}"


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """A folder, or one file, of Parquet as a stream; its schema is that of the files."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else spark.readStream.schema(schema).parquet(path)


def deduplicated(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Each key once within the delay; state older than that goes."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def daily_counts(stream: DataFrame, ts: str = "ts", by: str = "event_type") -> DataFrame:
    """Counts in tumbling days."""
    w = F.window(ts, "1 day")
    return stream.groupBy(w.alias("w"), by).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), by, "n")


def span_of(spark: SparkSession, path: str, ts: str = "ts") -> int:
    """Days between the first and the last event that is there."""
    return spark.read.parquet(path).agg(F.coalesce(F.datediff(F.max(F.col(ts).cast("timestamp")), F.min(F.col(ts).cast("timestamp"))), F.lit(0))).first()[0]


def daily_counts_to_completion(spark: SparkSession, path: str, delay: str | None = None) -> DataFrame:
    """All that is there now, through the stream: deduplicated, counted by day, read back from what it wrote.

    Files may come in any order, so without a ``delay`` it spans what is there; a stream that goes on states one, and
    forgets what is older.  An empty input gives an empty result.
    """
    name = f"daily-{uuid.uuid4().hex}"
    out, delay = shared(spark, f"{name}-out"), delay or f"{span_of(spark, path) + 1} days"
    stream = read_stream(spark, path).withColumn("ts", F.col("ts").cast("timestamp")).filter("ts is not null")
    counts = daily_counts(deduplicated(stream, "event_id", "ts", delay))
    spark.createDataFrame([], "day date, event_type string, n long").write.mode("overwrite").parquet(out)
    query = (
        counts.writeStream.outputMode("complete").option("checkpointLocation", shared(spark, name)).trigger(availableNow=True)
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    )
    query.awaitTermination()
    return spark.read.schema("day date, event_type string, n long").parquet(out)


def ingest(stream: DataFrame, store: Store, table: str, key: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str, trigger: dict | None = None, name: str | None = None):
    """Start a query that adds each micro-batch's new keys to a table.

    Only the buckets that a batch falls into are written.  The version that a batch makes holds the batch's number under the
    stream's ``name`` (the table's, if none is given), in one commit with its rows, so a batch that runs again is not even
    computed, whatever keys it would have.  ``trigger`` is that of ``writeStream``; the default takes what is there and ends.
    """
    name = name or table

    def add(batch: DataFrame, number: int) -> None:
        if not store.done(table, (name, number)):
            store.merge(table, cut(transform(batch), "batch"), key, [F.col(key)], absent=True, mark=(name, number))

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def parts_of(df: DataFrame, order: str, slices: int) -> Iterator[DataFrame]:
    """That many slices of ``df`` by ``order``, the first ones first."""
    marks = df.agg(F.percentile_approx(order, [k / slices for k in range(1, slices)], 10_000).alias("m")).first()["m"] or []
    for low, high in zip([None, *marks], [*marks, None], strict=True):
        part = df if low is None else df.filter(F.col(order) > low)
        yield part if high is None else part.filter(F.col(order) <= high)


def in_slices(df: DataFrame, order: str, slices: int, name: str) -> str:
    """A folder with the rows of ``df`` as they might come in: that many slices by ``order``, files of a later one written later."""
    path = shared(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    for part in parts_of(df, order, slices):
        part.write.mode("append").parquet(path)
    return path


def every(hours: float) -> dict:
    """The trigger of a sweep that runs again and again."""
    return {"processingTime": f"{int(hours * 3600)} seconds"}


DAY = 86_400_000
#: A company's parts of titles are dealt out to so many groups, which are the units of state.
SLOTS = 16
HIT = "arrival_idx long, target_idx long"
#: Letters that most titles have; pairs with others come first in the order of prefixes, which may be any.
COMMON = "etaoinsr "


def blocks(stream: DataFrame, least: float = FUZZY_LEAST) -> DataFrame:
    """A row of ``stream`` (``name_normalized``, ``title_normalized``, ``source``, ``arrival_idx``, ``posted_at``) for each slot that
    the ``parts`` of its title fall into, with these: the numbered pairs of neighbouring characters in its prefix, of which two titles
    that are alike share one (:mod:`similarity`).  Rows without a date, a company or a title are left out."""
    rows = stream.select(F.col("name_normalized").alias("block"), in_order(F.col("title_normalized")).alias("key"), "source", "arrival_idx", F.col("posted_at").cast("timestamp").alias("posted_at"))
    n = F.length("key")
    sorted_pairs = F.array_sort(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substr("key", i, F.lit(2))))
    rows = rows.filter("posted_at is not null and block is not null and key is not null")
    rows = rows.withColumn("pairs", F.explode(F.array(sorted_pairs)))  # a row as before; the pairs are made once, not for each of them
    turn = lambda g, i: (i - F.array_position("pairs", g)).cast("int")
    common = lambda g: F.length(g) - F.length(F.translate(g, COMMON, ""))
    numbered = F.transform("pairs", lambda g, i: F.struct(common(g).alias("c"), F.xxhash64(g, turn(g, i)).alias("h"), F.concat(g, turn(g, i).cast("string")).alias("g")))
    prefix = F.transform(F.slice(F.array_sort(numbered), F.lit(1), lacking(n, least) + 1), lambda x: x["g"])
    slot = lambda part: F.pmod(F.xxhash64(part), F.lit(SLOTS)).cast("int")
    rows = rows.withColumn("parts", F.when(n < SHORT, F.array(F.concat(F.lit("="), "key"))).otherwise(prefix)).drop("pairs")
    dealt = rows.withColumn("slot", F.explode(F.array_distinct(F.transform("parts", slot))))
    return dealt.withColumn("parts", F.array_join(F.filter("parts", lambda part: slot(part) == F.col("slot")), "\n"))


#: Classes of characters (by code point) that are counted to tell titles apart; titles are held in so many entries of a group's state.
CLASSES, BUCKETS = 32, 16


def counted(titles: list[str]) -> np.ndarray:
    """How often each title has characters of each class, at most 100 times."""
    points, of = np.frombuffer("".join(titles).encode("utf-32-le", "surrogatepass"), "<u4"), np.repeat(np.arange(len(titles)), [len(t) for t in titles])
    return np.minimum(np.bincount(of * CLASSES + points % CLASSES, minlength=len(titles) * CLASSES), 100).astype("int8").reshape(-1, CLASSES)


def near(titles: dict[str, str], asked: Iterable[str], least: float) -> dict[str, list[str]]:
    """For each of ``asked`` those of ``titles`` (with their parts, a line each) that share a part and are alike, itself too.

    Only where counts of characters differ by no more than may be inserted and deleted is a longest common subsequence made."""
    names, by_part = list(titles), defaultdict(list)
    for k, parts in enumerate(titles.values()):
        for part in parts.split("\n"):
            by_part[part].append(k)
    members, counts, lengths = {part: np.array(ks) for part, ks in by_part.items()}, counted(names), np.array([len(t) for t in names])
    at, out = {t: k for k, t in enumerate(names)}, {}
    for title in asked:
        k = at[title]
        met = np.concatenate([members[part] for part in titles[title].split("\n")])
        total = lengths[met] + len(title)
        fits = 200.0 * np.minimum(lengths[met], len(title)) >= least * total
        met, total = met[fits], total[fits]
        few = np.abs(counts[met] - counts[k]).sum(1, dtype="int64") <= (100 - least) * total / 100 + 1e-6
        out[title] = [names[j] for j in np.unique(met[few]) if j == k or 200.0 * lcs(names[j], title) >= least * (len(names[j]) + len(title))]
    return out


class Similar(StatefulProcessor):
    """Of a company and some of the parts of its titles: the titles that came with one of them, by source, each with arrivals and dates.

    Only dates that are later than those of all earlier arrivals are held, as no other can be the first in a window.  Rows may be
    ``delay`` days older than the newest one; what is older than the window before that goes with the next rows or, by a timer on
    event time, without any.
    """

    def __init__(self, days: int, least: float, delay: int) -> None:
        self.span, self.least, self.reach = days * DAY, least, (days + delay) * DAY

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.titles = handle.getMapState("titles", "bucket int", "titles array<string>, parts array<string>, sources array<string>, ids array<long>, times array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held: dict[str, dict] = {}  # by title and source the arrivals and their dates
        titles, changed, out = {}, set(), []
        for _, v in self.titles.iterator():
            for title, parts, source, i, at in zip(*v, strict=True):
                titles[title] = parts
                ids, times = held.setdefault(title, {}).setdefault(source, ([], []))
                ids.append(i)
                times.append(at)
        new = pd.concat(list(rows)).sort_values("arrival_idx")
        titles |= dict(zip(new["key"], new["parts"], strict=True))
        alike = near(titles, new["key"].unique(), self.least)
        for i, title, source, at in zip(new["arrival_idx"], new["key"], new["source"], new["posted_at"], strict=True):
            now, best = int(at.timestamp() * 1000), None
            for other in alike[title]:
                for theirs, (ids, times) in held.get(other, {}).items():
                    k = bisect_left(times, now - self.span) if theirs != source else len(times)
                    if k < len(times) and (best is None or ids[k] < best):
                        best = ids[k]
            out.append((i, best))
            ids, times = held.setdefault(title, {}).setdefault(source, ([], []))
            if not times or now > times[-1]:
                ids.append(int(i))
                times.append(now)
                changed.add(crc32(title.encode()) % BUCKETS)
        newest = max(times[-1] for mine in held.values() for _, times in mine.values())
        self.store(held, titles, changed, newest - self.reach)
        # One timer a day at most; one that rings while something newer is held does nothing.
        self.handle.registerTimer(max(newest + self.reach, timerValues.getCurrentWatermarkInMs()) // DAY * DAY + DAY)
        yield pd.DataFrame(out, columns=["arrival_idx", "target_idx"]).astype({"target_idx": "Int64"})

    def store(self, held: dict[str, dict], titles: dict[str, str], changed: set[int], oldest: int) -> None:
        """Write the buckets of titles in which something came or went; rows that are late may still look back from the watermark."""
        kept = defaultdict(list)
        for title, mine in held.items():
            bucket = crc32(title.encode()) % BUCKETS
            for source, (ids, times) in mine.items():
                first = bisect_left(times, oldest)
                if first:
                    changed.add(bucket)
                kept[bucket] += [(title, titles[title], source, *x) for x in zip(ids[first:], times[first:], strict=True)]
        for bucket in changed:
            if kept[bucket]:
                self.titles.updateValue((bucket,), tuple(map(list, zip(*kept[bucket], strict=True))))
            else:
                self.titles.removeKey((bucket,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if all(max(v[-1]) + self.reach < expiredTimerInfo.getExpiryTimeInMs() for _, v in self.titles.iterator()):
            self.titles.clear()
        return iter(())

    def close(self) -> None:
        pass


def similar(stream: DataFrame, days: int = FUZZY_DAYS, least: float = FUZZY_LEAST, delay: int | None = None) -> DataFrame:
    """:data:`HIT` for each posting of a stream and each slot of its title: the first posting of the same company and another source
    that came before, was posted no more than ``days`` days earlier, and has a similar title; null if there is none.  Postings that
    are more than ``delay`` days (``days``, if not given) older than the newest one of earlier micro-batches are dropped.

    A company with very many postings is spread over ``SLOTS`` groups of the parts of their titles.  Needs the RocksDB state store.
    """
    delay = days if delay is None else delay
    dealt = blocks(stream, least).withWatermark("posted_at", f"{delay} days").groupBy("block", "slot")
    return dealt.transformWithStateInPandas(Similar(days, least, delay), HIT, "append", "eventtime")


def write_similar(stream: DataFrame, path: str, checkpoint: str, days: int = FUZZY_DAYS, trigger: dict | None = None, delay: int | None = None):
    """Start a query that writes :data:`HIT`, a row a posting, a folder a micro-batch; one that runs again replaces its folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy("arrival_idx").agg(F.min("target_idx").alias("target_idx")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    spark, name = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:  # the query has taken its settings when it is started
        return similar(stream, days, delay=delay).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def similar_to_completion(postings: DataFrame, slices: int = 4, days: int = FUZZY_DAYS, delay: int | None = None) -> DataFrame:
    """:data:`HIT` of postings that come in as a stream, in slices by ``arrival_idx``, a micro-batch each.

    Dates may come in any order, so without a ``delay`` in days it spans what is there and nothing is dropped as late; a stream
    that goes on states one, and forgets what is older.
    """
    spark, name = postings.sparkSession, f"similar-{uuid.uuid4().hex}"
    rows = cut(postings.select("name_normalized", "title_normalized", "source", "arrival_idx", "posted_at"), "postings")
    source, out = shared(spark, f"{name}-in"), shared(spark, f"{name}-out")
    if delay is None:
        delay = 1 + rows.agg(F.coalesce(F.datediff(F.max("posted_at"), F.min("posted_at")), F.lit(0))).first()[0]
    spark.createDataFrame([], HIT).write.parquet(f"{out}/batch=none")
    for part in parts_of(rows, "arrival_idx", slices):
        part.write.mode("append").parquet(source)
        write_similar(spark.readStream.schema(rows.schema).parquet(source), out, shared(spark, name), days, delay=delay).awaitTermination()
    return spark.read.schema(HIT).parquet(out).select("arrival_idx", "target_idx")


def ingest_to_completion(df: DataFrame, key: str, slices: int = 4, again: int = 2) -> DataFrame:
    """The table of rows that come in as a stream in slices by ``key``; the stream begins ``again`` times from its start."""
    spark, name = df.sparkSession, f"ingest-{uuid.uuid4().hex}"
    source, store = in_slices(df, key, slices, "rows"), Store(spark, shared(spark, f"{name}-tables"))
    files = max(1, len(spark.read.parquet(source).inputFiles()) // slices)
    for turn in range(again):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(source)
        ingest(stream, store, "rows", key, lambda batch: batch, shared(spark, f"{name}-{turn}")).awaitTermination()
    return store.read("rows") if store.exists("rows") else df.limit(0)
