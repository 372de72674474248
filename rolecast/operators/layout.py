"""Layout of stored tables for the columns that sweeps filter on.

A table is partitioned by the month of a date column, null dates by themselves, and within a month dealt out to ranges of the
other columns and sorted, so that a filter reads the folders of its months only, and of their files the row groups whose
statistics allow a match.  A hot month is as many files as its ranges.  There is no index beside the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NONE = "none"


def month(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit(NONE))


def arrange(df: DataFrame, path: str, date: str, then: list[str], files: int | None = None) -> None:
    """Write ``df`` by the month of ``date`` and in ranges of ``then``, the columns of equality first; ``files`` bounds the ranges."""
    keyed = df.withColumn("_month", month(date))
    order = ["_month", *then, date]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("_month").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def before(df: DataFrame, date: str, limit: str, or_null: bool = False) -> DataFrame:
    """Rows of an arranged table with ``date`` before a time (a literal, so that its month is known when the files are chosen)."""
    at = F.lit(limit).cast("timestamp")
    own = (F.col("_month") <= F.date_format(at, "yyyy-MM")) & (F.col("_month") != NONE) & (F.col(date) < at)
    return df.filter(own | ((F.col("_month") == NONE) & F.col(date).isNull()) if or_null else own).drop("_month")
