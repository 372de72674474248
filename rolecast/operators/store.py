"""Versioned tables on plain Parquet: an upsert writes the buckets that it touches and a new manifest beside the old ones.

A version is a manifest, which names a folder for each bucket; the newest one counts.  It gets its name by a rename that
fails if another writer was first, so of two writers of one version one must try again, and a reader sees a whole version
or the one before.  Rows are dealt to buckets by a hash of the table's key, so an upsert reads and writes no other buckets.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import hadoop
from .dedupe import keep_first

BUCKETS, KEPT = 64, 2


class Conflict(RuntimeError):
    """Another writer made the version first."""


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with their key; of several new ones the first in ``order`` counts."""
    fresh = keep_first(new, [key], order)
    return fresh.unionByName(old.join(fresh.select(key), key, "left_anti"), allowMissingColumns=True)


def insert_absent(old: DataFrame, new: DataFrame, key: str, order: list[Column], unique: str | None = None) -> DataFrame:
    """``old`` and those new rows whose key is not stored; with ``unique``, of each of its values the first row only."""
    fresh = keep_first(new, [key], order).join(old.select(key), key, "left_anti")
    if unique:
        fresh = keep_first(fresh, [unique], order).join(old.select(unique).dropna(), unique, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def seed(catalogue: DataFrame, defaults: DataFrame, key: str, keep: tuple[str, ...] = ("enabled",)) -> DataFrame:
    """A catalogue with its defaults renewed; what operators set (``keep``) stays."""
    d = defaults.select(*(F.col(c).alias(c if c == key else f"_{c}") for c in defaults.columns))
    out = catalogue.join(d, key, "full_outer")
    pick = {c: F.coalesce(c, f"_{c}") if c in keep else F.coalesce(f"_{c}", c) for c in defaults.columns if c != key}
    return out.withColumns(pick).drop(*(f"_{c}" for c in defaults.columns if c != key))


def disable(providers: DataFrame, reasons: DataFrame, now: Column) -> DataFrame:
    """Providers with those of ``reasons`` (slug, reason) switched off; unknown ones are added, so that no default revives them."""
    r = reasons.select("slug", F.col("reason").alias("_reason"))
    out = providers.join(r, "slug", "full_outer")
    off = F.col("_reason").isNotNull()
    return out.withColumns({
        "name": F.coalesce("name", "slug"), "enabled": F.when(off, False).otherwise(F.col("enabled")), "disabled_at": F.when(off, now).otherwise(F.col("disabled_at")),
        "disabled_reason": F.when(off, F.col("_reason")).otherwise(F.col("disabled_reason")),
    }).drop("_reason")


class Store:
    """Tables under a root that Hadoop's file system reaches."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # Manifests

    def versions(self, table: str) -> list[int]:
        fs, p = hadoop(self.spark, f"{self.root}/{table}/versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def version(self, table: str) -> int:
        return max(self.versions(table), default=0)

    def exists(self, table: str) -> bool:
        return self.version(table) > 0

    def manifest(self, table: str, version: int | None = None) -> dict:
        fs, p = hadoop(self.spark, f"{self.root}/{table}/versions/{version or self.version(table)}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _commit(self, table: str, version: int, manifest: dict) -> None:
        jvm, folder = self.spark.sparkContext._jvm, f"{self.root}/{table}/versions"
        fs, temporary = hadoop(self.spark, f"{folder}/{uuid.uuid4().hex}.tmp")
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{version}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(temporary, final, options)
        except Exception as e:
            fs.delete(temporary, False)
            raise Conflict(f"{table} has a version {version} already") from e
        self._forget(table, version)

    def _forget(self, table: str, version: int) -> None:
        """Older versions go, and the folders that no newer one names."""
        known = self.versions(table)
        kept = [v for v in known if v > version - KEPT]
        used = {f for v in kept for f in self.manifest(table, v)["folders"].values()}
        for v in known:
            if v not in kept:
                for folder in set(self.manifest(table, v)["folders"].values()) - used:
                    fs, p = hadoop(self.spark, f"{self.root}/{table}/data/{folder}")
                    fs.delete(p, True)
                fs, p = hadoop(self.spark, f"{self.root}/{table}/versions/{v}")
                fs.delete(p, False)

    # Tables

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        m = self.manifest(table)
        folders = sorted({f for b, f in m["folders"].items() if buckets is None or int(b) in buckets})
        schema = _schema(m["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{table}/data/{f}" for f in folders))

    def write(self, table: str, df: DataFrame) -> int:
        """A new version with these rows only."""
        now, name = self.version(table), uuid.uuid4().hex
        df.write.parquet(f"{self.root}/{table}/data/{name}")
        self._commit(table, now + 1, {"key": None, "schema": df.schema.json(), "folders": {"0": name}})
        return now + 1

    def append(self, table: str, df: DataFrame) -> int:
        """A new version with these rows besides those of the last one, which are not written again."""
        if not self.exists(table):
            return self.write(table, df)
        now, m, name = self.version(table), self.manifest(table), uuid.uuid4().hex
        df.select(*_schema(m["schema"]).names).write.parquet(f"{self.root}/{table}/data/{name}")
        spare = max((int(b) for b in m["folders"]), default=-1) + 1
        self._commit(table, now + 1, m | {"key": None, "folders": m["folders"] | {str(spare): name}})
        return now + 1

    def done(self, table: str, mark: tuple[str, int]) -> bool:
        """Whether the table holds the batch of a stream (its name and the batch's number) or a later one of it."""
        return self.exists(table) and self.manifest(table).get("marks", {}).get(mark[0], -1) >= mark[1]

    def merge(self, table: str, new: DataFrame, key: str, order: list[Column], absent: bool = False, mark: tuple[str, int] | None = None) -> int:
        """A new version in which rows of ``new`` replace those with their key, or with ``absent`` add only new keys.

        Buckets that no row of ``new`` falls into are taken over as they are.  ``new`` is read twice, so it should be stored.
        With ``mark``, the version says which batch of a stream it holds; one that it holds already changes nothing.
        """
        place = F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        now = self.version(table)
        m = self.manifest(table) if now else {"key": key, "schema": new.schema.json(), "folders": {}}
        marks = m.get("marks", {})
        if mark:
            if marks.get(mark[0], -1) >= mark[1]:
                return now
            marks = marks | {mark[0]: mark[1]}
        touched = sorted(r[0] for r in new.filter(F.col(key).isNotNull()).select(place).distinct().collect())
        if now and not touched:
            return now
        if m["key"] != key:  # written without buckets: all rows are dealt out now
            touched, before = list(range(self.buckets)), self.read(table) if now else None
        else:
            before = self.read(table, touched) if now else None
        if before is None:
            before = new.limit(0)
        rows = insert_absent(before, new, key, order) if absent else upsert(before, new, key, order)
        name = uuid.uuid4().hex
        dealt = rows.withColumn("_bucket", place).repartition(len(touched) or 1, "_bucket")
        dealt.write.partitionBy("_bucket").parquet(f"{self.root}/{table}/data/{name}")
        fs, p = hadoop(self.spark, f"{self.root}/{table}/data/{name}")
        there = [n.partition("=")[2] for n in (f.getPath().getName() for f in fs.listStatus(p)) if n.startswith("_bucket=")]
        folders = {b: f for b, f in m["folders"].items() if int(b) not in touched} | {b: f"{name}/_bucket={b}" for b in there}
        self._commit(table, now + 1, {"key": key, "schema": rows.schema.json(), "folders": folders, "marks": marks})
        return now + 1

    def drop(self, table: str, confirm: bool = False) -> None:
        if not confirm:
            raise ValueError("dropping a table needs confirm=True")
        fs, p = hadoop(self.spark, f"{self.root}/{table}")
        fs.delete(p, True)

    def recreate(self, table: str, df: DataFrame, confirm: bool = False) -> int:
        """Drop a table and make it anew from ``df``, which must not read it."""
        self.drop(table, confirm)
        return self.write(table, df)


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))
