"""Sessions for local work; on a cluster the engine takes the session it is given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "rolecast", cores: int | None = None) -> SparkSession:
    cores = cores or os.cpu_count() or 1
    conf = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
