"""Views of the driver tables in the shapes of the engine: postings from documents, stored jobs from orders, runs from events.

Each view exists twice, as a DataFrame and as the DuckDB query that the oracle uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedupe

#: A text in a language that is not supported, which some postings have.
FOREIGN = "日本語の求人です。"
AS_OF, AS_OF_ORDERS = "2024-03-05 00:00:00", "1998-08-02 00:00:00"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_of(text: str = AS_OF) -> F.Column:
    return F.lit(text).cast("timestamp")


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = read(spark, sf_dir, "documents"), F.col("doc_id")
    foreign = i % 70 == 9
    t0 = F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 60)
    return d.select(
        i.alias("arrival_idx"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/job/"), i.cast("string"), F.when(i % 40 == 7, "?closedJob=True").otherwise("")).alias("url"),
        F.when(i % 50 == 3, F.upper(F.replace(t0, F.lit("ß"), F.lit("ss")))).otherwise(t0).alias("title"),
        F.when(i % 60 == 11, "N/A").otherwise(F.concat(F.lit("Company "), F.substring(F.sha1(F.substring(t0, 1, 12)), 1, 2))).alias("company_name"),
        F.when(foreign, F.repeat(F.lit(FOREIGN), 40)).otherwise(F.col("text")).alias("description"), "source", F.when(foreign, "ja").otherwise(F.col("lang")).alias("original_language"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), (i % 1000).cast("int"))).alias("posted_at"),
        (30000 + (i % 50) * 1000).cast("long").alias("salary_min"), (30000 + (i % 50) * 1000 + (i % 7) * 1000).cast("long").alias("salary_max"),
    )


RAW_JOBS = """raw_jobs AS (SELECT doc_id AS arrival_idx, 'https://' || source || '.example.com/job/' || doc_id || CASE WHEN doc_id % 40 = 7 THEN '?closedJob=True' ELSE '' END AS url,
 CASE WHEN doc_id % 50 = 3 THEN upper(replace(t0, 'ß', 'ss')) ELSE t0 END AS title, CASE WHEN doc_id % 60 = 11 THEN 'N/A' ELSE 'Company ' || substr(sha1(substr(t0, 1, 12)), 1, 2) END AS company_name,
 CASE WHEN doc_id % 70 = 9 THEN repeat('日本語の求人です。', 40) ELSE text END AS description, source, CASE WHEN doc_id % 70 = 9 THEN 'ja' ELSE lang END AS original_language, TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 1000 AS INT)) AS posted_at,
 30000 + (doc_id % 50) * 1000 AS salary_min, 30000 + (doc_id % 50) * 1000 + (doc_id % 7) * 1000 AS salary_max
 FROM (SELECT *, substr(split_part(text, chr(10), 1), 1, 60) AS t0 FROM documents))"""

NORM = r"trim(regexp_replace(lower(regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')), '\s+', ' ', 'g'))"
HASHED = RAW_JOBS + f""", hashed AS (SELECT *, sha1(title_normalized || '|' || name_normalized || '|' || lower(source)) AS dedup_hash, sha1(title_normalized || '|' || name_normalized) AS cross_source_hash
 FROM (SELECT *, {NORM.format('title')} AS title_normalized, {NORM.format('company_name')} AS name_normalized FROM raw_jobs))"""


#: Rows of the first weeks count as stored, later ones as the batch.
BETWEEN = "2024-01-21 00:00:00"
PARTS = f"b AS (SELECT * FROM hashed WHERE posted_at >= TIMESTAMP '{BETWEEN}'), s AS (SELECT * FROM hashed WHERE posted_at < TIMESTAMP '{BETWEEN}')"


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.with_hashes(raw_jobs(spark, sf_dir))


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The batch and what is stored."""
    rows, day = hashed(spark, sf_dir), F.lit(BETWEEN).cast("timestamp")
    return rows.filter(F.col("posted_at") >= day), rows.filter(F.col("posted_at") < day)


def classified_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with a made-up classification from their id."""
    i = F.col("arrival_idx")
    pick = lambda names, by: F.element_at(F.array(*map(F.lit, names)), (i / by).cast("long").cast("int") % len(names) + 1)
    cut = lambda names, n: F.slice(F.array(*map(F.lit, names)), 1, n.cast("int"))
    return raw_jobs(spark, sf_dir).withColumns({
        "technical_skills": cut(("python", "sql", "spark", "docker", "kafka", "aws"), i % 7), "seniority": pick(("junior", "mid", "senior", "unknown", "lead"), 1), "employment_type": pick(("full_time", "contract", "unknown"), 5),
        "remote_mode": pick(("remote", "hybrid", "onsite", "unknown"), 3), "ai_confidence": (i % 21) / 20.0, "quality_flags": cut(("clear_jd", "has_requirements", "vague", "has_benefits", "boilerplate"), i % 6),
        "requirements": cut(("a", "b"), i % 3), "benefits": cut(("c", "d"), (i / 3).cast("long") % 3), "cv_drop_score": (i % 11) / 10.0,
        "salary_min": F.when(i % 4 != 1, F.col("salary_min")), "salary_max": F.when(i % 5 != 2, F.col("salary_max")),
    })


def _pick(names: tuple[str, ...], by: int) -> str:
    return f"list_extract([{', '.join(f"'{n}'" for n in names)}], CAST((arrival_idx // {by}) % {len(names)} AS INT) + 1)"


def _cut(names: tuple[str, ...], n: str) -> str:
    return f"list_slice([{', '.join(f"'{x}'" for x in names)}], 1, CAST({n} AS INT))"


CLASSIFIED = RAW_JOBS + f""", classified AS (SELECT * REPLACE (CASE WHEN arrival_idx % 4 <> 1 THEN salary_min END AS salary_min, CASE WHEN arrival_idx % 5 <> 2 THEN salary_max END AS salary_max),
 {_cut(('python', 'sql', 'spark', 'docker', 'kafka', 'aws'), 'arrival_idx % 7')} AS technical_skills, {_pick(('junior', 'mid', 'senior', 'unknown', 'lead'), 1)} AS seniority, {_pick(('full_time', 'contract', 'unknown'), 5)} AS employment_type,
 {_pick(('remote', 'hybrid', 'onsite', 'unknown'), 3)} AS remote_mode, (arrival_idx % 21) / 20.0::DOUBLE AS ai_confidence, {_cut(('clear_jd', 'has_requirements', 'vague', 'has_benefits', 'boilerplate'), 'arrival_idx % 6')} AS quality_flags,
 {_cut(('a', 'b'), 'arrival_idx % 3')} AS requirements, {_cut(('c', 'd'), '(arrival_idx // 3) % 3')} AS benefits, (arrival_idx % 11) / 10.0::DOUBLE AS cv_drop_score FROM raw_jobs)"""


def stored_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as stored jobs: a status, a date, and a last probe that some never had."""
    i, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    status = F.when(i % 9 == 0, None).otherwise(F.element_at(F.array(*map(F.lit, ("active", "valid", "premium", "expired", "closed"))), (i % 5 + 1).cast("int")))
    return read(spark, sf_dir, "orders").select(i.alias("job_id"), status.alias("status"), day.alias("posted_at"), F.when(i % 3 != 0, day + F.make_dt_interval((i % 90).cast("int"))).alias("last_probed_at"))


STORED = """stored AS (SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 9 <> 0 THEN list_extract(['active', 'valid', 'premium', 'expired', 'closed'], CAST(o_orderkey % 5 AS INT) + 1) END AS status,
 CAST(o_orderdate AS TIMESTAMP) AS posted_at, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 90 AS INT)) END AS last_probed_at FROM orders)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("provider"), F.col("ts").cast("timestamp").alias("started_at"), F.col("value").alias("ms"), F.when(F.col("event_type").isin("error", "signup", "view"), "failed").otherwise("success").alias("status"))


RUNS = "runs AS (SELECT event_id AS id, user_id AS provider, CAST(ts AS TIMESTAMP) AS started_at, value AS ms, CASE WHEN event_type IN ('error', 'signup', 'view') THEN 'failed' ELSE 'success' END AS status FROM events)"
