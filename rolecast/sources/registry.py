"""Where payloads come from: the registry of boards, fixtures, budgets, and sources as Spark data sources."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyspark.errors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as t
from ..operators import runs
from ..operators.links import one_of
from . import payloads


def boards(spark: SparkSession, path: str, system: str) -> DataFrame:
    """``name`` and ``slug`` of the companies that a registry file lists under a system; none if it does not name it."""
    schema = f"`{system}` array<struct<name:string,slug:string>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode(system).alias("b")).select("b.name", "b.slug").filter("slug <> ''").distinct()


def with_company(records: DataFrame, listed: DataFrame, slug: str = "_slug") -> DataFrame:
    """Payload records of a board with the company's name from the registry; records of unlisted boards go.

    ``_company``, which the projections of these sources read, is the listed name, or the slug where that is empty.
    """
    names = listed.groupBy("slug").agg(F.min("name").alias("_name")).withColumnRenamed("slug", slug)
    return records.drop("_company").join(names, slug).withColumn("_company", F.coalesce(F.nullif("_name", F.lit("")), F.col(slug))).drop("_name")


def fixtures(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Documents of a folder, one a file, in order of the files' names (``n``)."""
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{folder.rstrip('/')}/*.json").withColumn("file", F.col("_metadata.file_path"))
    names = sorted(r["file"] for r in rows.select("file").distinct().collect())
    order = spark.createDataFrame([(f, i) for i, f in enumerate(names)], "file string, n long")
    return rows.join(F.broadcast(order), "file").drop("file")


def chosen(sources: DataFrame, wanted: str) -> DataFrame:
    """Sources (``name``) that a list separated by commas names; an empty list names all."""
    return sources.filter(one_of(F.col("name"), wanted))


def isolated(names: list[str], read: Callable[[str], DataFrame], spark: SparkSession) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each source read on its own: what could be read, and a row a source with how many postings came, or why none did.

    A source that breaks is counted here, while it is read, so it cannot break what reads the others later.
    """
    parts, rows = {}, []
    for name in names:
        try:
            df = read(name)
            rows.append((name, df.count(), None))
            parts[name] = df
        except (pyspark.errors.PySparkException, OSError, ValueError) as e:
            rows.append((name, 0, f"{type(e).__name__}: {e}"[:500]))
        except Exception as e:
            if "py4j" not in type(e).__module__:
                raise
            rows.append((name, 0, str(e)[:500]))
    log = spark.createDataFrame(rows, "source string, jobs_fetched long, crash_reason string")
    return parts, log.withColumn("failure_reason", F.when(F.col("crash_reason").isNotNull(), t.failure_class(F.col("crash_reason"))))


def parsed(raw: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Records (``source``, ``record``, a JSON text) as ``payloads.canonical`` takes them, without those that are torn; and a row a
    source: how many came whole (``jobs_fetched``) and torn (``n_torn``), and why it failed, if none came whole.

    Both are plans: no source is read to find out whether it breaks, and a torn record is a row like any other.  A null or empty
    record is torn; a field of another type than it should have is null, and its record torn, too.
    """
    shape = payloads.SOURCES[kind].record
    fields = shape if isinstance(shape, str) else shape.simpleString()[len("struct<") : -1]
    found = raw.withColumn("_r", F.from_json("record", f"{fields}, _torn string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"}))
    found = found.withColumn("_whole", F.coalesce(F.col("_r").isNotNull() & F.col("_r._torn").isNull() & (F.trim("record") != ""), F.lit(False)))
    log = found.groupBy("source").agg(F.count_if("_whole").alias("jobs_fetched"), F.count_if(~F.col("_whole")).alias("n_torn"))
    log = log.withColumn("crash_reason", F.when(F.col("jobs_fetched") == 0, F.format_string("%d torn records", "n_torn")))
    return found.filter("_whole").drop("_whole", "record"), log.withColumn("failure_reason", F.when(F.col("crash_reason").isNotNull(), t.failure_class(F.col("crash_reason"))))


#: Sources whose jobs a month are limited.
METERED = ("active_jobs_db", "workday_jobs", "startup_jobs")


def metered(postings: DataFrame, name: str, budget: DataFrame, as_of: str) -> DataFrame:
    """The first postings of a source, as many as its budget of the month has left; other sources are not limited.

    ``budget`` has the increments (provider, ts, n) so far.
    """
    if name not in METERED:
        return postings
    month = F.date_trunc("month", F.lit(as_of).cast("timestamp"))
    used = runs.budget_used(budget.filter(F.date_trunc("month", "ts") == month), "month").select("provider", "used")
    rows = postings.withColumns({"provider": F.lit(name), "seq": F.col("arrival_idx")})
    return runs.within_budget(rows, used).select(*postings.columns)


class Pages(InputPartition):
    def __init__(self, request: dict) -> None:
        self.request = request


class BoardReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[Pages]:
        return [Pages(r) for r in json.loads(self.options["requests"])]

    def read(self, partition: Pages) -> Iterator[tuple]:
        fetch = load(self.options["fetch"])
        for n, record in enumerate(fetch(partition.request)):
            yield json.dumps(partition.request, sort_keys=True), n, json.dumps(record)


def load(name: str) -> Callable[[dict], Iterator[dict]]:
    """A function by ``module:name``; it is looked up where it runs."""
    import importlib

    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


class BoardSource(DataSource):
    """Records of a connector: ``spark.read.format("board")`` with ``fetch``, the name of a function from a request to
    records, and ``requests``, a JSON list of requests, which are read in a task each."""

    @classmethod
    def name(cls) -> str:
        return "board"

    def schema(self) -> str:
        return "request string, seq int, record string"

    def reader(self, schema) -> BoardReader:  # noqa: ANN001
        return BoardReader(dict(self.options))


def records(raw: DataFrame, source: str) -> DataFrame:
    """Records of :class:`BoardSource` in the shape that ``payloads.canonical`` takes."""
    s = payloads.SOURCES[source]
    return raw.select(F.from_json("record", s.record).alias("_r"))
