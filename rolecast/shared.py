"""The folder that driver and executors share, and tables in it that cut the lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

RUN = f"rolecast-{uuid.uuid4().hex}"
_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Only a local master may go without: there a temporary folder is as good."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="rolecast-"))
    return _LOCAL[0]


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Java objects."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop(spark: SparkSession, path: str) -> None:
    with suppress(Exception):
        fs, p = hadoop(spark, path)
        fs.delete(p, True)


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; it goes when the driver ends, or with :func:`drop`."""
    path = f"{shared_dir(spark)}/{RUN}/{tag}-{uuid.uuid4().hex[:12]}"
    atexit.register(drop, spark, path)
    return path


def kept(df: DataFrame, tag: str = "cut") -> tuple[DataFrame, str]:
    """``df`` written and read back, and its path: it is computed once, and what follows survives lost executors.  Once nothing
    that is still to run reads it, :func:`drop` frees its disk."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, tag: str = "cut") -> DataFrame:
    """As :func:`kept`, for as long as the driver runs."""
    return kept(df, tag)[0]
