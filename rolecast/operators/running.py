"""Running sums over groups of any size, in two levels.

Rows are dealt out to ranges of (group, order) and written; each range is summed by group; the sums of the ranges before it are
one small window (a row a range and group); and within a range a window is no larger than the range.  So a group that
holds most of the rows is as many tasks as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut


def running(df: DataFrame, by: list[Column], order: list[str], value: Column, name: str = "before") -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all earlier rows of the group, 0 for the first.

    Earlier is by ``order``; rows that are equal in it follow each other in any order.  Null groups are groups, null values count as 0.
    """
    keyed = df.withColumns({"_by": F.struct(*(c.alias(f"k{i}") for i, c in enumerate(by))), "_value": F.coalesce(value, F.lit(0))})
    ranged = cut(keyed.repartitionByRange("_by", *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("_by", "_range").agg(F.sum("_value").alias("_sum"))
    ahead = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_by", "_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_by", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    both = ranged.join(sums, ["_by", "_range"])
    return both.withColumn(name, F.col("_ahead") + F.coalesce(F.sum("_value").over(inside), F.lit(0))).select(*df.columns, name)
