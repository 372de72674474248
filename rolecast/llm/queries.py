"""Registered queries of the corpus operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read


def tokenizer_path(spark: SparkSession) -> str:
    """The vocabulary file; ``rolecast.tokenizer.path`` of the session overrides the installed one."""
    import public_tokenizers

    return spark.conf.get("rolecast.tokenizer.path", None) or str(public_tokenizers.path("word_bpe_49k.json"))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(read(spark, sf_dir, "pages"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import embedding_links

    return embedding_links(read(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_join

    return jaccard_join(read(spark, sf_dir, "documents"), n=3, percent=90)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import digests, format_conversations

    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return digests(format_conversations(rows.unionByName(probe)))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shuffle_into_shards

    text = F.coalesce("text", F.lit(""))
    sharded = shuffle_into_shards(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return sharded.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip

    return archive_round_trip(spark, read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return contamination(docs, read(spark, sf_dir, "benchmark")).filter("size(item_ids) > 0").select("doc_id", "item_ids", "covered")


def fold(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is in no fold."""
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % parts


def op8_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_crf import learn, score

    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs, read(spark, sf_dir, "labels").select("doc_id", "quality").filter(fold(5) != 0))
    return score(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify, learn

    docs = read(spark, sf_dir, "documents")
    model = learn(docs.select("doc_id", "text", "lang").filter(fold(4) != 2))
    return identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(spark))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(read(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .drake_kmeans import drake_kmeans

    return drake_kmeans(read(spark, sf_dir, "embeddings"))


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .order_minhash import with_edits

    return with_edits(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    """SQL where it can state the result; models, hashed orders and packing are tested against brute force."""
    from . import oracle

    return {"op2_embedding_dedup": oracle.OP2, "op3_jaccard_join": oracle.OP3, "op4_chat_format": oracle.OP4, "op6_warc": oracle.OP6, "op11_collocations": oracle.OP11, "op12_centroid_clustering": oracle.OP12}
