"""From documents to packed training sequences.

Stages, in order: quality classifier, language identification, n-gram Jaccard join, benchmark decontamination,
packing.  Every stage is written as Parquet to the shared folder and read again by the next.

Edge cases: a document whose text is null, empty or blank goes in the first stage, one without a letter in the second; of
repeated rows one stays, and rows that share an id but not the text are documents of their own, which go or stay each by its text; documents with a null id are compared with nothing and stay; further columns are handed on whatever their names
are; an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecast.llm import quality_crf
from rolecast.llm.common import MOST_BROADCAST, read, store
from rolecast.llm.decontaminate import contamination
from rolecast.llm.jaccard_join import jaccard_join
from rolecast.llm.langid import floors, identify
from rolecast.llm.langid import learn as learn_languages
from rolecast.llm.packing import pack_documents
from rolecast.llm.queries import fold, tokenizer_path

#: A document stays from this quality score on, and with a language score that is so far on the way from the floor to 1.
#: Held-out scores of sf0.01 and sf0.1 lie above that but for 1 of 2,748; the two learned families of two languages have a floor of 0.25.
LEAST_QUALITY, CLEAR_LANGUAGE = 0.3, 0.25
#: Near copies: word shingles of this length, linked from this similarity on.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


#: Rows of a batch between Spark and Python.  A task holds batches of whole documents outside the heap, one on the way there and one back.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound what tasks of this session hand to Python at once, unless the session has a smaller bound."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def own_columns(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *names: str) -> DataFrame:
    """What ``work`` keeps of ``docs``, with all of its columns as they were, also those named like results of ``work``."""
    aside = {c: f"_own_{c}" for c in docs.columns if c.lower() in names}
    return work(docs.withColumnsRenamed(aside)).select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores below ``LEAST_QUALITY`` go, and so do empty ones."""
    small_batches(spark)
    model = quality_crf.learn(docs, read(spark, sf_dir, "labels").select("doc_id", "quality").filter(fold(5) != 0))
    return own_columns(docs, lambda d: quality_crf.score(d, model).filter(F.col("score") >= LEAST_QUALITY), "score")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or of no clear language go."""
    small_batches(spark)
    model = learn_languages(docs.select("doc_id", "text", "lang").filter(fold(4) != 2))
    least = F.lit(0.0)
    for lang, floor in floors(model).items():
        least = F.when(F.col("lang_pred") == lang, floor + CLEAR_LANGUAGE * (1 - floor)).otherwise(least)
    return own_columns(docs, lambda d: identify(d, model).filter((F.col("lang_pred") != "und") & (F.col("score") >= least)), "lang_pred", "score")


def small(df: DataFrame) -> DataFrame:
    """A stored table of ids, for broadcast if it is small."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def once(docs: DataFrame) -> DataFrame:
    """Each distinct (``doc_id``, ``text``) as ``row``, with a ``number`` in the order of ids; stored, as the numbers depend on the
    ranges that Spark draws."""
    rows = docs.filter("doc_id is not null").groupBy("doc_id", "text").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return store(ordered.select(F.monotonically_increasing_id().alias("number"), "row"), "numbered")[0]


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; documents without an id all do.

    The join tells documents by their ids; where ids repeat, it is given numbers of the distinct pairs of id and text.
    """
    small_batches(spark)
    again = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    if again.isEmpty():
        groups = jaccard_join(docs, SHINGLE_WORDS, SIMILAR_PERCENT).filter("doc_id is not null and doc_id <> component_id")
        gone, _ = store(groups.select("doc_id"), "gone")
        return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    numbered = once(docs)
    groups = jaccard_join(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), SHINGLE_WORDS, SIMILAR_PERCENT)
    gone, _ = store(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("number")), "gone")
    return numbered.join(small(gone), "number", "left_anti").select("row.*").unionByName(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return own_columns(docs, lambda d: contamination(d, read(spark, sf_dir, "benchmark")).filter("size(item_ids) = 0"), "item_ids", "covered")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack_documents(docs, tokenizer_path(spark))


STAGES = [("quality classifier", quality), ("language ID", language), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontamination), ("packing", packing)]
#: Models, similarity groups and packing have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs, _ = store(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
