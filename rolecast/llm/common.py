"""Helpers shared by the corpus operators: tables, shared scratch space, repeated rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import drop, scratch

__all__ = ["drop", "held", "numbered_copies", "read", "scratch", "slices", "store", "tasks"]

#: Rows that repeat more often are dealt out as copies with numbers; a table of so many rows of a few numbers is broadcast.
COPIES, MOST_BROADCAST = 1000, 100_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def store(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    # Nobody looks for the file that marks success, and on a local file system each file that the driver makes forks it.
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def numbered_copies(df: DataFrame, most: int = COPIES) -> DataFrame:
    """``df`` with ``_copy``, which numbers rows that repeat more than ``most`` times in all columns, and is 0 for others.

    Such rows are counted before the shuffle and made anew from the count, ``most`` at a time, so no task has to hold
    them all, and their numbers do not depend on files or partitions.
    """
    spark, columns = df.sparkSession, df.columns
    h = F.xxhash64(*columns)
    hot = df.groupBy(h.alias("_h")).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select("_h")
    if hot.isEmpty():
        return df.withColumn("_copy", F.lit(0).cast("long"))
    hot, _ = store(hot, "repeated-rows")
    side = F.broadcast(hot) if hot.count() <= MOST_BROADCAST else hot
    marked = df.withColumn("_h", h)
    single = marked.join(side, "_h", "left_anti").drop("_h").withColumn("_copy", F.lit(0).cast("long"))
    groups, _ = store(marked.join(side, "_h", "left_semi").groupBy(*columns).agg(F.count("*").alias("_n")), "repeated-groups")
    parts = tasks(spark, groups.agg(F.sum("_n")).first()[0], 20 * most)
    ranges = groups.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(most).cast("long"))).alias("_from")).repartition(parts, h, "_from")
    copies = ranges.select(*columns, F.explode(F.sequence("_from", F.least(F.col("_from") + most, F.col("_n")) - 1)).alias("_copy"))
    return single.unionByName(copies)


def release() -> None:
    """Give freed memory back to the system, where that can be asked for; a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024, group: str = "") -> Iterator[pa.RecordBatch]:
    """Batches in slices of so many rows, so that few texts at a time become Python's.  What a worker has kept from stages
    of other groups goes before."""
    forget(group)
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)
    release()


HELD: dict[tuple[str, str], Any] = {}


def forget(group: str) -> None:
    """Drop what is kept for other groups."""
    if left := [k for k in HELD if k[0] != group]:
        for key in left:
            del HELD[key]
        release()


def held(name: str, make: Callable[[], Any], group: str = "", most: int = 2) -> Any:
    """An object that a Python worker keeps from task to task.  Those of other groups, which an earlier stage has left, go
    first, and of so many of a group the oldest."""
    key = group, name
    if key not in HELD:
        forget(group)
        while len(HELD) >= most:
            del HELD[next(iter(HELD))]
        HELD[key] = make()
    return HELD[key]


def tasks(spark: SparkSession, units: float, each: float) -> int:
    """Partitions for ``units`` of work at ``each`` a task, no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(units / each) + 1)
