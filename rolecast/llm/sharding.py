"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into memory-sized buckets by a seeded hash; pass two shuffles every bucket by
Fisher-Yates.  The buckets one after the other are a random permutation of the corpus.  It is cut into shards whose
row counts differ by one at most (law ``rows``); the place in the shard is the ``slot``.  Same rows, seed and bucket
size give the same shards whatever the input's files or partitions are.

Buckets keep their size however large the corpus is.  Where a bucket starts is a running sum over the buckets before it,
in two levels: the driver sees one count for ``GROUPED`` buckets, and the sums within these are a window.

Edge cases: a null text or ``doc_id`` is hashed as such; equal rows fall into the same bucket, in any order, which cannot
be told apart, but rows that repeat very often are numbered and spread over all buckets; an empty table gives an empty
result; columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered_copies, store, tasks

SHARDS, SEED, BUCKET_BYTES, GROUPED = 16, 97, 8 << 20, 1024


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of ``range(n)``: each place swaps with a random one not yet passed."""
    order = np.arange(n)
    picks = rng.integers(0, np.arange(n, 0, -1)) if n else []
    for i, j in enumerate(picks):
        order[i], order[i + j] = order[i + j], order[i]
    return order


def bucket_starts(counts: DataFrame, grouped: int = GROUPED) -> tuple[DataFrame, int]:
    """``_bucket`` and ``first``, the rows of all buckets before it, of ``counts`` (_bucket, n); and the number of all rows."""
    counts, _ = store(counts.select("_bucket", F.floor(F.col("_bucket") / grouped).alias("_group"), "n"), "counts")
    before, at = [], 0
    for r in counts.groupBy("_group").agg(F.sum("n").alias("n")).orderBy("_group").collect():
        before.append((r["_group"], at))
        at += r["n"]
    sums = counts.sparkSession.createDataFrame(before, "_group long, before long")
    w = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("within", F.coalesce(F.sum("n").over(w), F.lit(0)))
    return within.join(sums, "_group").select("_bucket", (F.col("before") + F.col("within")).cast("long").alias("first")), at


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED, key: tuple[str, ...] = ("doc_id", "text"), bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``df`` with ``shard`` and ``slot``."""
    df = df.drop("shard", "slot")
    spark, names = df.sparkSession, df.columns
    total = df.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 64).alias("n")).first()["n"] or 0
    buckets = int(total // bucket_bytes) + 1
    hashed = F.xxhash64(F.lit(seed), *key, "_copy")
    rows = numbered_copies(df).withColumn("_hash", hashed).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("long"))
    first, n = bucket_starts(rows.groupBy("_bucket").agg(F.count("*").alias("n")))
    starts = np.array([s * (n // shards) + min(s, n % shards) for s in range(shards + 1)])

    def shuffle(table: pa.Table, first: pa.Table) -> pa.Table:
        # Rows come in the order in which the scatter ended; a known one is needed before the shuffle.
        table = table.sort_by([("_hash", "ascending"), *((c, "ascending") for c in key)])
        order = fisher_yates(len(table), np.random.default_rng([seed, first["_bucket"][0].as_py()]))
        at = first["first"][0].as_py() + np.arange(len(table))
        shard = np.searchsorted(starts, at, side="right") - 1
        table = table.select(names).take(pa.array(order))
        return table.append_column("shard", pa.array(shard.astype("int32"))).append_column("slot", pa.array(at - starts[shard]))

    schema = T.StructType([*df.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    parts = tasks(spark, total, 2 * bucket_bytes)
    scattered, first = rows.drop("_copy").repartition(parts, "_bucket"), first.repartition(parts, "_bucket")
    return scattered.groupBy("_bucket").cogroup(first.groupBy("_bucket")).applyInArrow(shuffle, schema)


def write_shards(sharded: DataFrame, path: str, files: int) -> None:
    """Write shards as folders; the files of a shard, in the order of their names, hold its slots in order."""
    sharded.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
