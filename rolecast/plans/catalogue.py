"""Queries of the engine's own operators over the driver tables, each with its DuckDB equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, quality, skills
from ..functions import profiles as language_profiles
from ..functions import text as t
from ..operators import ai, companies, dedupe, gate, layout, liveness, prefilter, resolve, runs, stats
from ..shared import scratch
from ..streaming import postings as streaming
from . import adapters as a
from .adapters import AS_OF, AS_OF_ORDERS, CLASSIFIED, HASHED, NORM, PARTS, RAW_JOBS, RUNS, STORED, hashed, parts
from .registered import QUERIES, SQL, Query, query

def queries() -> dict[str, Query]:
    from . import catalogue_sources, catalogue_tables  # noqa: F401 - they register theirs

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalogue_sources, catalogue_tables  # noqa: F401

    return dict(SQL)


# Projection and prefilter

PREFILTER = RAW_JOBS + f""", checked AS (SELECT *, CASE WHEN trim(title) = '' OR lower(trim(company_name)) IN ('', 'unknown', 'n/a', 'none') OR NOT regexp_matches(url, '^(?i:https?)://[^/?#]+') THEN 'MISSING_REQUIRED_FIELDS'
 WHEN url LIKE '%?closedJob=True' THEN 'CLOSED_LISTING' WHEN posted_at IS NULL THEN 'MISSING_REQUIRED_FIELDS' WHEN posted_at < TIMESTAMP '{AS_OF}' - INTERVAL 60 DAYS THEN 'EXPIRED_LISTING'
 WHEN length(description) < 200 THEN 'DESCRIPTION_TOO_SHORT' WHEN original_language NOT IN ('en', 'it', 'es', 'de', 'fr', 'pt') THEN 'LANGUAGE_NOT_SUPPORTED' WHEN len(regexp_split_to_array(trim(title), '\\s+')) >= 5 AND title = upper(title) AND regexp_matches(title, '\\pL') THEN 'SUSPECTED_SPAM' END AS reason FROM raw_jobs)"""


@query(f"WITH {RAW_JOBS} SELECT arrival_idx, url, title, company_name, source, original_language, salary_min, salary_max, length(description) AS n_chars FROM raw_jobs WHERE url <> '' AND title <> '' AND company_name <> '' AND source <> ''")
def canonical_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = a.raw_jobs(spark, sf_dir).filter("url <> '' and title <> '' and company_name <> '' and source <> ''")
    salary = {c: t.to_salary(F.col(c).cast("string")) for c in ("salary_min", "salary_max")}
    return jobs.withColumns(salary).select("arrival_idx", "url", "title", "company_name", "source", "original_language", "salary_min", "salary_max", F.length("description").cast("long").alias("n_chars"))


@query(f"WITH {PREFILTER} SELECT source, coalesce(reason, 'PASS') AS reason, count(*) AS n FROM checked GROUP BY ALL")
def prefilter_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefilter.funnel(prefilter.prefilter(a.raw_jobs(spark, sf_dir), a.as_of()))


@query(f"WITH {PREFILTER} SELECT arrival_idx, reason AS prefilter_reason FROM checked")
def prefilter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefilter.prefilter(a.raw_jobs(spark, sf_dir), a.as_of()).select("arrival_idx", "prefilter_reason")


@query(f"WITH {PREFILTER} SELECT source, count(*) AS n_raw, count(*) FILTER (reason IS NULL) AS n_passed, count(*) FILTER (reason IS NOT NULL) AS n_rejected FROM checked GROUP BY 1")
def source_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefilter.source_funnel(prefilter.prefilter(a.raw_jobs(spark, sf_dir), a.as_of()))


@query(f"WITH {RAW_JOBS} SELECT arrival_idx, len(regexp_split_to_array(trim(title), '\\s+')) >= 5 AND title = upper(title) AND regexp_matches(title, '\\pL') AS is_spam FROM raw_jobs")
def spam_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.raw_jobs(spark, sf_dir).select("arrival_idx", t.spam_title(F.col("title")).alias("is_spam"))


@query(f"WITH {RAW_JOBS} SELECT arrival_idx, lower(regexp_extract(url, '[?&]closedJob=([^&#]*)', 1)) = 'true' AS is_closed FROM raw_jobs")
def closed_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.raw_jobs(spark, sf_dir).select("arrival_idx", t.closed_url(F.col("url")).alias("is_closed"))


@query("SELECT page_id, regexp_matches(url, '^(?i:https?)://[^/?#]+') AS is_valid, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host FROM pages")
def url_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.read(spark, sf_dir, "pages").select("page_id", t.url_valid(F.col("url")).alias("is_valid"), t.url_host(F.col("url")).alias("host"))


# Text and hashes


@query(f"SELECT doc_id, md5({NORM.format('text')}) AS folded FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.read(spark, sf_dir, "documents").select("doc_id", F.md5(t.normalize_text(F.col("text"))).alias("folded"))


@query(f"WITH {HASHED} SELECT arrival_idx, dedup_hash FROM hashed")
def dedup_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.with_hashes(a.raw_jobs(spark, sf_dir)).select("arrival_idx", "dedup_hash")


@query(f"WITH {HASHED} SELECT arrival_idx, cross_source_hash FROM hashed")
def cross_source_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.with_hashes(a.raw_jobs(spark, sf_dir)).select("arrival_idx", "cross_source_hash")


@query(f"WITH {RAW_JOBS} SELECT arrival_idx, sha256('extract' || chr(0) || 'v1' || chr(0) || title || chr(0) || company_name || chr(0) || '' || chr(0) || original_language || chr(0) || description || chr(0) || 'skills=' || source) AS cache_key FROM raw_jobs")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    payload = t.classify_payload(c("title"), c("company_name"), F.lit(None).cast("string"), c("original_language"), c("description"), F.create_map(F.lit("skills"), "source"))
    return a.raw_jobs(spark, sf_dir).select("arrival_idx", t.cache_key("extract", "v1", payload).alias("cache_key"))


DAMAGED = "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN text || ' dÃ©veloppeur' ELSE text END AS text FROM documents"


@query(f"SELECT doc_id, contains(text, 'Ã') OR contains(text, 'â€') AS damaged FROM ({DAMAGED})")
def mojibake_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" dÃ©veloppeur"))).otherwise(F.col("text"))
    return a.read(spark, sf_dir, "documents").select("doc_id", t.has_mojibake(text).alias("damaged"))


@query(r"SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN text WHEN regexp_matches(text, '^[\x00-\x7F]*$') THEN text || ' développeur' ELSE text || ' dÃ©veloppeur' END AS fixed FROM documents")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text, repaired where all of it can be read as UTF-8: letters with accents that are right already cannot."""
    text = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" dÃ©veloppeur"))).otherwise(F.col("text"))
    return a.read(spark, sf_dir, "documents").select("doc_id", t.fix_mojibake(text).alias("fixed"))


@query("SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS iso, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, CAST(NULL AS TIMESTAMP) AS other, CAST(date_trunc('second', ts) AS TIMESTAMP) AS local FROM events")
def posted_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, parse = F.col("ts").cast("timestamp"), lambda c: t.parse_posted(c).cast("timestamp_ntz")
    return a.read(spark, sf_dir, "events").select("event_id", parse(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso"), parse(F.date_format(ts, "yyyy-MM-dd")).alias("day"), parse(F.date_format(ts, "dd/MM/yyyy")).alias("other"), parse(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("local"))


@query("SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS rfc, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events WHERE ts IS NOT NULL")
def legacy_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    rfc = F.concat(F.lit("Mon, "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    ms = (ts.cast("double").cast("long") * 1000).cast("string")
    return a.read(spark, sf_dir, "events").filter("ts is not null").select("event_id", t.parse_legacy(rfc, a.as_of()).cast("timestamp_ntz").alias("rfc"), t.epoch_auto(ms).cast("long").alias("seconds"))


@query("SELECT event_id, list_extract(['RATE_LIMIT_429', 'TIMEOUT', 'AUTH_ERROR', 'NOT_FOUND', 'NETWORK_ERROR', 'CONNECTOR_CRASH', 'RATE_LIMIT_429'], CAST(event_id % 7 AS INT) + 1) AS bucket FROM events")
def failure_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All buckets; a text that fits several falls into the first."""
    texts = ("HTTP 429: Too Many Requests", "read timed out", "403 Forbidden", "Not Found", "DNS failure", "boom", "connection closed: rate limit")
    message = F.element_at(F.array(*map(F.lit, texts)), (F.col("event_id") % 7 + 1).cast("int"))
    return a.read(spark, sf_dir, "events").select("event_id", t.failure_class(message).alias("bucket"))


# Quality

MEANINGFUL = r"""length(d) >= 200 AND NOT ends_with(d, '...') AND (regexp_matches(d, '[.!?）」』>]$') OR (ends_with(d, '>') AND contains(right(d, 50), '</')))
 AND (CASE WHEN contains(lower(d), 'equal opportunity employer') THEN 26 ELSE 0 END + CASE WHEN contains(lower(d), 'we are looking for') THEN 18 ELSE 0 END + CASE WHEN contains(lower(d), 'our company is') THEN 14 ELSE 0 END
 + CASE WHEN contains(lower(d), 'join our team') THEN 13 ELSE 0 END + CASE WHEN contains(lower(d), 'competitive salary') THEN 18 ELSE 0 END) / greatest(length(d), 1) <= 0.4
 AND len(list_filter(regexp_split_to_array(d, '[.!?]+'), lambda s: len(list_filter(regexp_split_to_array(s, '\s+'), lambda w: w <> '')) >= 4)) >= 3"""
DESCRIPTION = "CASE WHEN length({0}) >= 3000 THEN 1.0 WHEN length({0}) >= 1000 THEN 0.7 WHEN length({0}) >= 200 THEN 0.4 ELSE 0.0 END::DOUBLE"
FLAG = "CASE WHEN list_contains(quality_flags, '{0}') THEN {1} ELSE 0.0 END::DOUBLE"
FLAGS = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, " + " + ".join(FLAG.format(k, v) for k, v in quality.FLAG_WEIGHTS.items()) + "))"
REQUIREMENTS = "CASE WHEN len(requirements) + len(benefits) >= 3 THEN 1.0 WHEN len(requirements) + len(benefits) = 2 THEN 0.7 WHEN len(requirements) + len(benefits) = 1 THEN 0.4 ELSE 0.0 END::DOUBLE"
SCORE = f"""CAST(round_even((0.20::DOUBLE * least(1.0::DOUBLE, len(technical_skills) / 5.0::DOUBLE) + 0.10::DOUBLE * (CASE WHEN seniority = 'unknown' THEN 0 ELSE 1 END)
 + 0.15::DOUBLE * (CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL THEN 1.0 WHEN salary_min IS NOT NULL OR salary_max IS NOT NULL THEN 0.6 ELSE 0 END)::DOUBLE
 + 0.10::DOUBLE * (CASE remote_mode WHEN 'remote' THEN 1.0 WHEN 'hybrid' THEN 0.7 WHEN 'onsite' THEN 0.4 ELSE 0 END)::DOUBLE + 0.10::DOUBLE * ai_confidence
 + 0.10::DOUBLE * ({DESCRIPTION.format('description')}) + 0.10::DOUBLE * {FLAGS} + 0.05::DOUBLE * ({REQUIREMENTS}) + 0.10::DOUBLE * cv_drop_score) * 100, 0) AS INT)"""
PREMIUM = "len(technical_skills) >= 4 AND salary_min IS NOT NULL AND salary_max IS NOT NULL AND ai_confidence >= 0.85 AND list_has_any(quality_flags, ['clear_jd', 'has_requirements']) AND NOT list_contains(quality_flags, 'boilerplate')"
GATED = f"""{CLASSIFIED}, gated AS (SELECT *, {SCORE} AS quality_score, CASE WHEN lower(trim(company_name)) IN ('', 'unknown company', 'n/a', 'various', 'private', 'anonymous') THEN 'MISSING_COMPANY' WHEN len(technical_skills) < 2 THEN 'ZERO_SKILLS'
 WHEN description <> '' AND NOT ({MEANINGFUL}) THEN 'DESCRIPTION_INVALID' WHEN seniority = 'unknown' THEN 'UNKNOWN_SENIORITY_AFTER_RETRY' WHEN employment_type = 'unknown' THEN 'UNKNOWN_EMPLOYMENT_TYPE_AFTER_RETRY'
 WHEN remote_mode = 'unknown' THEN 'UNKNOWN_REMOTE_MODE_AFTER_RETRY' WHEN ai_confidence < 0.7 THEN 'LOW_CONFIDENCE' END AS reject_reason FROM (SELECT *, trim(description, chr(10) || chr(9) || ' ') AS d FROM classified)),
 tiered AS (SELECT *, CASE WHEN reject_reason IS NULL THEN 'active' ELSE 'rejected_quality' END AS status, CASE WHEN reject_reason IS NULL THEN CASE WHEN {PREMIUM} THEN 'premium' ELSE 'valid' END END AS quality_tier FROM gated)"""


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.evaluate(a.classified_jobs(spark, sf_dir), F.col("company_name"), F.col("description"))


@query(f"SELECT doc_id, {DESCRIPTION.format('text')} AS score FROM documents")
def description_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.read(spark, sf_dir, "documents").select("doc_id", quality.description_score(F.col("text")).alias("score"))


@query(f"SELECT doc_id, {MEANINGFUL} AS meaningful FROM (SELECT doc_id, trim(text, chr(10) || chr(9) || ' ') AS d FROM documents)")
def description_meaningful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.read(spark, sf_dir, "documents").select("doc_id", quality.description_meaningful(F.col("text")).alias("meaningful"))


@query(f"WITH {CLASSIFIED} SELECT arrival_idx, {FLAGS} AS score FROM classified")
def flags_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.classified_jobs(spark, sf_dir).select("arrival_idx", quality.flags_score(F.col("quality_flags")).alias("score"))


@query(f"WITH {CLASSIFIED} SELECT arrival_idx, {REQUIREMENTS} AS score FROM classified")
def requirements_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.classified_jobs(spark, sf_dir).select("arrival_idx", quality.requirements_score(F.col("requirements"), F.col("benefits")).alias("score"))


@query(f"WITH {CLASSIFIED} SELECT arrival_idx, {SCORE} AS quality_score FROM classified")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.classified_jobs(spark, sf_dir).select("arrival_idx", quality.quality_score(F.col("description")).alias("quality_score"))


@query(f"WITH {CLASSIFIED} SELECT arrival_idx, {PREMIUM} AS is_premium FROM classified")
def premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.classified_jobs(spark, sf_dir).select("arrival_idx", quality.premium().alias("is_premium"))


@query(f"WITH {GATED} SELECT arrival_idx, reject_reason, status, quality_tier, quality_score FROM tiered")
def gate_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated(spark, sf_dir).select("arrival_idx", "reject_reason", "status", "quality_tier", "quality_score")


@query(f"WITH {GATED} SELECT source, count(*) AS n_jobs, count(*) FILTER (quality_score > 0) AS n_graded, round_even(coalesce(avg(quality_score) FILTER (quality_score > 0), 0), 2) AS avg_quality FROM tiered GROUP BY 1")
def per_source_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.source_quality(gated(spark, sf_dir))


#: White space in the sense of Unicode, and the four separators.
BLANK = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
TOKENS = f"list_filter(regexp_split_to_array(text, '{BLANK}'), lambda w: w <> '')"
#: Terms of one to three words: those that the items of the benchmark begin with, and some frequent ones.
FREQUENT = ("the", "und", "de", "and", "of", "la", "of the", "to the", "The  AND", "in the of")
LEXICON = rf"""lexicon AS MATERIALIZED (SELECT DISTINCT trim(regexp_replace(lower(term), '{BLANK}', ' ', 'g')) AS term FROM (SELECT unnest([array_to_string(w[1:1], ' '), array_to_string(w[1:2], ' '), array_to_string(w[2:4], ' ')]) AS term FROM (SELECT {TOKENS} AS w FROM benchmark)
 UNION ALL SELECT unnest([{", ".join(f"'{x}'" for x in FREQUENT)}])) WHERE trim(term) <> '')"""


def token_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the whole text."""
    return a.read(spark, sf_dir, "documents").select("doc_id", F.filter(F.split("text", skills.BLANK), lambda w: w != "").alias("skills"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.filter(F.split("text", skills.BLANK), lambda w: w != "")
    part = lambda i, n: F.concat_ws(" ", F.slice("w", i, n))
    own = a.read(spark, sf_dir, "benchmark").select(w.alias("w")).select(F.explode(F.array(part(1, 1), part(1, 2), part(2, 3))).alias("term"))
    return skills.as_lexicon(own.unionByName(spark.createDataFrame([(x,) for x in FREQUENT], "term string")))


@query(f"WITH {LEXICON} SELECT doc_id, coalesce(string_agg(w, ',' ORDER BY i) FILTER (term IS NOT NULL), '') AS technical, md5(coalesce(string_agg(w, ',' ORDER BY i) FILTER (term IS NULL), '')) AS other_md5 FROM (SELECT doc_id, unnest(s) AS w, unnest(range(len(s))) AS i FROM (SELECT doc_id, CASE WHEN len(s) = 0 THEN [NULL] ELSE s END AS s FROM (SELECT doc_id, {TOKENS} AS s FROM documents))) LEFT JOIN lexicon ON term = lower(trim(w)) GROUP BY doc_id")
def skill_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of whole texts against a lexicon of hundreds of terms."""
    found = skills.split(token_skills(spark, sf_dir), "skills", lexicon(spark, sf_dir), "doc_id")
    return found.select("doc_id", F.array_join("technical", ",").alias("technical"), F.md5(F.array_join("other", ",")).alias("other_md5"))


@query(f"""WITH {LEXICON}, t AS (SELECT doc_id, unnest(w) AS a, unnest(range(len(w))) AS i FROM (SELECT doc_id, {TOKENS.replace('text', 'lower(text)')} AS w FROM documents)),
 w AS MATERIALIZED (SELECT doc_id, a, lead(a, 1) OVER (PARTITION BY doc_id ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM t),
 g AS (SELECT doc_id, a AS term FROM w UNION ALL SELECT doc_id, a || ' ' || b FROM w UNION ALL SELECT doc_id, a || ' ' || b || ' ' || c FROM w) SELECT doc_id, term, count(*) AS n FROM g JOIN lexicon USING (term) GROUP BY ALL""")
def skill_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of one to three words in whole texts."""
    return skills.mentions(a.read(spark, sf_dir, "documents"), "text", lexicon(spark, sf_dir), "doc_id")


FIRST_LINE = f"list_filter(regexp_split_to_array(split_part(text, chr(10), 1), '{BLANK}'), lambda w: w <> '')"


@query(f"""SELECT doc_id, CASE WHEN len(list_distinct(list_concat(e, a))) = 0 THEN 1.0 ELSE len(list_intersect(e, a)) / len(list_distinct(list_concat(e, a))) END::DOUBLE AS jaccard,
 CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_intersect(e, a)) / len(a) END::DOUBLE AS prec, CASE WHEN len(e) = 0 THEN 1.0 ELSE len(list_intersect(e, a)) / len(e) END::DOUBLE AS rec
 FROM (SELECT doc_id, list_distinct(list_transform(e, lambda w: lower(w))) AS e, list_distinct(list_transform(a, lambda w: lower(w))) AS a FROM (SELECT doc_id, {FIRST_LINE} AS e, {FIRST_LINE.replace("split_part(text, chr(10), 1)", "substr(text, length(split_part(text, chr(10), 1)) + 1)")} AS a FROM documents))""")
def skill_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the first line against those of all other lines."""
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    words = lambda c: F.filter(F.split(c, skills.BLANK), lambda w: w != "")
    rows = a.read(spark, sf_dir, "documents").select("doc_id", words(first).alias("e"), words(F.substr("text", F.length(first) + 1)).alias("a"))
    e, b = F.col("e"), F.col("a")
    return rows.select("doc_id", skills.jaccard(e, b).alias("jaccard"), skills.precision(e, b).alias("prec"), skills.recall(e, b).alias("rec"))


# Duplicates


@query(f"WITH {HASHED} SELECT dedup_hash, min(arrival_idx) AS arrival_idx FROM hashed GROUP BY 1")
def exact_dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed(spark, sf_dir).select("dedup_hash", "arrival_idx")
    return dedupe.keep_first(rows, ["dedup_hash"], [F.col("arrival_idx")])


@query("SELECT doc_id, doc_id = max(doc_id) OVER (PARTITION BY text) AS kept FROM documents")
def dedupe_keep_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.newest_kept(a.read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text")), "text", "doc_id").select("doc_id", "kept")


@query(f"WITH {RAW_JOBS} SELECT title, company_name, count(*) AS n FROM raw_jobs GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_groups(a.raw_jobs(spark, sf_dir), ["title", "company_name"])


@query(f"WITH {HASHED}, {PARTS} SELECT b.arrival_idx, arg_min(s.dedup_hash, s.arrival_idx) AS target_hash, min(s.arrival_idx) AS target_idx FROM b JOIN s ON b.cross_source_hash = s.cross_source_hash AND b.source <> s.source GROUP BY 1")
def cross_source_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.cross_source_hits(*parts(spark, sf_dir))


#: The words of a title in order; and the similarity of two such texts, by a longest common subsequence a row of the table at a time.
IN_ORDER = r"array_to_string(list_sort(list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')), ' ')"
RATIO = """CASE WHEN x = y THEN 100.0 WHEN x = '' OR y = '' THEN 0.0 ELSE 200.0 * list_last(list_reduce(list_transform(string_split(y, ''), lambda c: [unicode(c)]),
 lambda r, c: list_reduce(list_transform(range(1, length(x)::BIGINT + 1), lambda j: [j::INT]), lambda n, j: list_append(n, greatest(list_last(n), r[j[1] + 1], r[j[1]] + (unicode(substr(x, j[1], 1)) = c[1])::INT)), [0]),
 list_transform(range(0, length(x)::BIGINT + 1), lambda j: 0::INT))) / (length(x) + length(y)) END"""


@query(f"""WITH {HASHED}, k AS (SELECT arrival_idx, source, lower(trim(company_name)) AS company, name_normalized, posted_at, {IN_ORDER.format("lower(trim(title))")} AS t, {IN_ORDER.format("title_normalized")} AS s FROM hashed),
 p AS MATERIALIZED (SELECT b.arrival_idx, s.arrival_idx AS target_idx, b.t AS x, s.s AS y FROM k b JOIN k s ON b.company = s.name_normalized AND b.source <> s.source AND s.arrival_idx < b.arrival_idx AND s.posted_at >= TIMESTAMP '2024-01-15' - INTERVAL 14 DAYS
 WHERE 200.0 * least(length(b.t), length(s.s)) >= 92.0 * (length(b.t) + length(s.s))) SELECT arrival_idx, target_idx FROM p WHERE {RATIO} >= 92""")
def fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row against all earlier arrivals."""
    rows = hashed(spark, sf_dir)
    return dedupe.fuzzy_pairs(rows, rows, a.as_of("2024-01-15 00:00:00"), earlier=True)


@query(f"WITH {HASHED}, {PARTS} SELECT s.arrival_idx, least(s.posted_at, coalesce(min(b.posted_at), s.posted_at)) AS posted_at, count(b.arrival_idx) AS seen_count FROM s LEFT JOIN b ON b.cross_source_hash = s.cross_source_hash AND s.arrival_idx = (SELECT min(x.arrival_idx) FROM s x WHERE x.cross_source_hash = s.cross_source_hash) GROUP BY s.arrival_idx, s.posted_at")
def merge_same_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stored = parts(spark, sf_dir)
    hits = batch.join(stored.groupBy("cross_source_hash").agg(F.min("arrival_idx").alias("target_idx")), "cross_source_hash")
    return dedupe.merge_same_source(stored, hits).select("arrival_idx", F.col("posted_at").cast("timestamp_ntz").alias("posted_at"), "seen_count")


@query(f"""WITH {HASHED}, {PARTS}, f AS (SELECT cross_source_hash, min(arrival_idx) AS target_idx FROM s GROUP BY 1), h AS (SELECT b.*, f.target_idx FROM b JOIN f USING (cross_source_hash)),
 d AS (SELECT target_idx, min(posted_at) AS p, count(*) AS c, min(salary_min) AS lo, max(salary_max) AS hi, arg_max(description, length(description) * 1000000000 - arrival_idx) AS t FROM h GROUP BY 1)
 SELECT s.arrival_idx, least(s.posted_at, coalesce(p, s.posted_at)) AS posted_at, least(s.salary_min, coalesce(lo, s.salary_min)) AS salary_min, greatest(s.salary_max, coalesce(hi, s.salary_max)) AS salary_max, coalesce(c, 0) AS seen_count,
 md5(CASE WHEN length(t) > length(s.description) THEN t ELSE s.description END) AS description_md5 FROM s LEFT JOIN d ON d.target_idx = s.arrival_idx""")
def merge_cross_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stored = parts(spark, sf_dir)
    hits = batch.join(stored.groupBy("cross_source_hash").agg(F.min("arrival_idx").alias("target_idx")), "cross_source_hash")
    out = dedupe.merge_cross_source(stored, hits)
    return out.select("arrival_idx", F.col("posted_at").cast("timestamp_ntz").alias("posted_at"), "salary_min", "salary_max", "seen_count", F.md5("description").alias("description_md5"))


@query(f"""WITH {HASHED}, r AS (SELECT *, first_value(arrival_idx) OVER w AS f, first_value(source) OVER w AS fs FROM hashed WINDOW w AS (PARTITION BY cross_source_hash ORDER BY arrival_idx))
 SELECT CASE WHEN arrival_idx = f THEN 'new' WHEN lower(source) = lower(fs) THEN 'dedupe_hit' ELSE 'cross_source_hit' END AS outcome, count(*) AS n FROM r GROUP BY 1""")
def resolution_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.outcome_counters(dedupe.set_resolution(hashed(spark, sf_dir)))


#: Resolution a row at a time: ``ins`` holds what has been inserted, in order, with dates as hits have lowered them.
RESOLUTION = f"""WITH RECURSIVE {HASHED}{PREFILTER[len(RAW_JOBS):]},
 k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY arrival_idx) AS i, arrival_idx, h.source, lower(trim(h.company_name)) AS company, name_normalized, h.posted_at, dedup_hash AS d, cross_source_hash AS c, reason IS NOT NULL AS rejected, arrival_idx % 97 = 5 AS invalid,
  {IN_ORDER.format("lower(trim(h.title))")} AS t, {IN_ORDER.format("title_normalized")} AS s FROM hashed h JOIN checked USING (arrival_idx)),
 p AS (SELECT b.i, s.arrival_idx AS target, b.t AS x, s.s AS y FROM k b JOIN k s ON b.company = s.name_normalized AND b.source <> s.source AND s.i < b.i WHERE 200.0 * least(length(b.t), length(s.s)) >= 92.0 * (length(b.t) + length(s.s))),
 alike AS MATERIALIZED (SELECT i, list(target) AS a FROM p WHERE {RATIO} >= 92 GROUP BY 1), n AS MATERIALIZED (SELECT k.*, coalesce(a, []) AS a FROM k LEFT JOIN alike USING (i)),
 r AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS arrival_idx, NULL::VARCHAR AS outcome, NULL::BIGINT AS target_idx, false AS inserted, []::STRUCT(x BIGINT, d VARCHAR, c VARCHAR, source VARCHAR, seen TIMESTAMP)[] AS ins
  UNION ALL SELECT i, arrival_idx, outcome, target_idx, added, CASE WHEN added THEN list_append(ins, struct_pack(x := arrival_idx, d := d, c := c, source := source, seen := posted_at))
   ELSE list_transform(ins, lambda z: struct_pack(x := z.x, d := z.d, c := z.c, source := z.source, seen := CASE WHEN z.x = target_idx AND posted_at < z.seen THEN posted_at ELSE z.seen END)) END
  FROM (SELECT *, CASE WHEN rejected THEN 'rejected_prefilter' WHEN invalid THEN 'url_invalid' WHEN hd IS NOT NULL THEN 'dedupe_hit' WHEN hc IS NOT NULL THEN 'cross_source_hit' WHEN hf IS NOT NULL THEN 'fuzzy_hit' ELSE 'new' END AS outcome,
    CASE WHEN NOT rejected AND NOT invalid THEN coalesce(hd, hc, hf) END AS target_idx, CASE WHEN rejected OR invalid THEN hd IS NULL ELSE coalesce(hd, hc, hf) IS NULL END AS added
   FROM (SELECT n.*, r.ins, list_filter(r.ins, lambda z: z.d = n.d)[1].x AS hd, list_filter(r.ins, lambda z: z.c = n.c AND z.source <> n.source)[1].x AS hc,
     list_filter(r.ins, lambda z: list_contains(n.a, z.x) AND z.seen >= TIMESTAMP '2024-01-15')[1].x AS hf FROM r JOIN n ON n.i = r.i + 1)))
 SELECT arrival_idx, outcome, target_idx, inserted FROM r WHERE i > 0"""


@query(RESOLUTION)
def resolution_with_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedupe.with_hashes(prefilter.prefilter(a.raw_jobs(spark, sf_dir), a.as_of())).withColumn("url_invalid", F.col("arrival_idx") % 97 == 5)
    return resolve.resolve(rows, rows.limit(0), "2024-01-29 00:00:00")


# Stored jobs, sweeps


@query(f"WITH {STORED} SELECT coalesce(status, 'null') AS status, count(*) AS n FROM stored GROUP BY 1")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.status_histogram(a.stored_jobs(spark, sf_dir))


@query(f"WITH {STORED} SELECT count(*) AS total, count(*) FILTER (status IN ('active', 'valid', 'premium')) AS active, count(*) FILTER (status = 'expired') AS expired, count(*) FILTER (last_probed_at IS NULL) AS never_probed FROM stored")
def stats_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.totals(a.stored_jobs(spark, sf_dir))


@query(f"WITH {STORED} SELECT job_id, CASE WHEN status IN ('valid', 'premium') THEN 'active' ELSE status END AS status, CASE WHEN status IN ('valid', 'premium') THEN status END AS quality_tier FROM stored")
def status_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = a.stored_jobs(spark, sf_dir).withColumn("quality_tier", F.lit(None).cast("string"))
    return stats.migrate_status(jobs).select("job_id", "status", "quality_tier")


DUE = f"status IN ('active', 'valid', 'premium') AND (last_probed_at IS NULL OR last_probed_at < TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 24 HOURS)"


@query(f"WITH {STORED} SELECT job_id, status FROM stored WHERE {DUE} ORDER BY last_probed_at ASC NULLS FIRST, job_id LIMIT 500")
def expire_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveness.probe_candidates(a.stored_jobs(spark, sf_dir), a.as_of(AS_OF_ORDERS), "job_id").select("job_id", "status")


OLD = f"status IN ('active', 'valid', 'premium') AND posted_at < TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 60 DAYS AND last_probed_at IS NULL"


@query(f"WITH {STORED} SELECT job_id, CASE WHEN {OLD} THEN 'expired' ELSE status END AS status, CASE WHEN {OLD} THEN 'EXPIRED_MAX_AGE' END AS reject_reason FROM stored")
def max_age_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveness.expire_by_age(a.stored_jobs(spark, sf_dir), a.as_of(AS_OF_ORDERS)).select("job_id", "status", "reject_reason")


@query(f"WITH {STORED} SELECT job_id, status FROM stored WHERE status IN ('active', 'valid', 'premium') AND (last_probed_at IS NULL OR last_probed_at < TIMESTAMP '1995-10-01 12:00:00')")
def due_jobs_arranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All live jobs that were never probed, or last before a time, from a table arranged by that: it reads the months before that."""
    path = scratch(spark, "arranged")
    layout.arrange(a.stored_jobs(spark, sf_dir), path, "last_probed_at", ["status"])
    due = layout.before(layout.read(spark, path), "last_probed_at", "1995-10-01 12:00:00", or_null=True)
    return due.filter(F.col("status").isin(*liveness.LIVE_STATUSES)).select("job_id", "status")


@query(f"WITH {STORED} SELECT job_id, status FROM stored WHERE posted_at < TIMESTAMP '1995-09-15' AND status IN ('active', 'valid', 'premium') AND last_probed_at IS NULL")
def old_jobs_arranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live jobs beyond their age that were never probed, from a table arranged by the date of posting."""
    path = scratch(spark, "arranged")
    layout.arrange(a.stored_jobs(spark, sf_dir), path, "posted_at", ["status"])
    old = layout.before(layout.read(spark, path), "posted_at", "1995-09-15 00:00:00")
    return old.filter(liveness.max_age_expired(F.lit("1995-11-14").cast("timestamp"))).select("job_id", "status")


PROBES = """probes AS (SELECT event_id, list_extract([200, 301, 404, 410, 500, 451, 302], CAST(event_id % 7 AS INT) + 1) AS code, CASE WHEN event_id % 2 = 0 THEN 'https://x.example.com/expired' ELSE 'https://x.example.com/other' END AS loc,
 CASE WHEN event_id % 31 = 0 THEN 'redirect_loop' WHEN event_id % 29 = 0 THEN 'http_error' END AS err FROM events)"""


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    code = F.element_at(F.array(*map(F.lit, (200, 301, 404, 410, 500, 451, 302))), (i % 7 + 1).cast("int"))
    return a.read(spark, sf_dir, "events").select(
        i, code.alias("head_status"), F.when(i % 2 == 0, "https://x.example.com/expired").otherwise("https://x.example.com/other").alias("location"), F.lit("").alias("body"), F.lit("board").alias("source"),
        F.when(i % 31 == 0, "redirect_loop").when(i % 29 == 0, "http_error").alias("error_kind"),
    )


@query(f"""WITH {PROBES} SELECT event_id, CASE WHEN err = 'redirect_loop' THEN true WHEN err IS NOT NULL THEN NULL WHEN code IN (404, 410, 451) THEN true WHEN code IN (301, 302) AND contains(loc, '/expired') THEN true WHEN code >= 500 THEN NULL ELSE false END AS expired,
 CASE WHEN err = 'redirect_loop' THEN 'EXPIRED_REDIRECT_LOOP' WHEN err IS NOT NULL THEN 'PROBE_ERROR' WHEN code IN (404, 410, 451) THEN 'EXPIRED_' || code WHEN code IN (301, 302) AND contains(loc, '/expired') THEN 'EXPIRED_REDIRECT' WHEN code >= 500 THEN 'TRANSIENT_' || code END AS reason FROM probes""")
def expiry_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes(spark, sf_dir).select("event_id", liveness.expiry_verdict().alias("v")).select("event_id", "v.expired", "v.reason")


@query(f"WITH {PROBES}, v AS (SELECT CASE WHEN err = 'redirect_loop' THEN true WHEN err IS NOT NULL THEN NULL WHEN code IN (404, 410, 451) THEN true WHEN code IN (301, 302) AND contains(loc, '/expired') THEN true WHEN code >= 500 THEN NULL ELSE false END AS e, err FROM probes) SELECT count(*) AS total, count(*) FILTER (e) AS expired, count(*) FILTER (NOT e) AS alive, count(*) FILTER (e IS NULL) AS transient, count(*) FILTER (err = 'http_error') AS errors FROM v")
def sweep_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveness.sweep_counters(probes(spark, sf_dir).select(liveness.expiry_verdict().alias("verdict")))


@query("""SELECT event_id, reason, reason NOT IN ('http_404', 'http_410', 'redirect_to_root', 'dns_error') AS is_valid FROM (SELECT event_id, CASE WHEN event_id % 37 = 0 THEN 'dns_error' WHEN code = 404 THEN 'http_404' WHEN code = 410 THEN 'http_410'
 WHEN event_id % 5 = 0 AND event_id % 3 = 0 THEN 'redirect_to_root' WHEN code BETWEEN 200 AND 399 THEN 'ok' ELSE 'transient' END AS reason FROM (SELECT event_id, list_extract([200, 404, 410, 403, 500, 302], CAST(event_id % 6 AS INT) + 1) AS code FROM events))""")
def url_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    seen = a.read(spark, sf_dir, "events").select(
        i, F.element_at(F.array(*map(F.lit, (200, 404, 410, 403, 500, 302))), (i % 6 + 1).cast("int")).alias("status_code"), F.when(i % 5 == 0, "https://x.example.com/jobs/?q=1").otherwise("https://x.example.com/job/1").alias("final_url"),
        F.when(i % 3 == 0, 1).otherwise(0).alias("n_redirects"), F.when(i % 37 == 0, "dns").alias("error_kind"),
    )
    return seen.select("event_id", liveness.url_verdict().alias("v")).select("event_id", "v.reason", "v.is_valid")


PHRASE_LIST = ", ".join("'" + p.replace("'", "''") + "'" for ps in liveness.PHRASES.values() for p in ps)


@query(f"SELECT doc_id, length(b) < 500 AND list_aggregate(list_transform([{PHRASE_LIST}], lambda p: contains(lower(b), p)), 'bool_or') AS gone FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' Offre EXPIRÉE' ELSE text END AS b FROM documents)")
def soft404_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" Offre EXPIRÉE"))).otherwise(F.col("text"))
    return a.read(spark, sf_dir, "documents").select("doc_id", liveness.soft_404(body).alias("gone"))


@query("SELECT page_id, regexp_matches(u, '(?i)/expired|/job-not-found|/offre-expiree|/annuncio-scaduto|/oferta-cerrada|/stelle-nicht-mehr-verfuegbar|/(job|position|stelle|oferta|offre|annuncio)/(expired|closed|filled|scaduto|chiusa|abgelaufen)') AS gone FROM (SELECT page_id, CASE WHEN page_id % 4 = 1 THEN url || '/Job/Closed' ELSE url END AS u FROM pages)")
def redirect_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("page_id") % 4 == 1, F.concat("url", F.lit("/Job/Closed"))).otherwise(F.col("url"))
    return a.read(spark, sf_dir, "pages").select("page_id", liveness.redirect_expired(url).alias("gone"))


# Runs, reports, budgets, cost


@query(f"WITH {RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY started_at DESC, id DESC) AS rn FROM runs) SELECT provider, count(*) FILTER (status = 'failed') = 3 AS should_disable FROM r WHERE rn <= 3 GROUP BY 1")
def should_disable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.should_disable(a.runs(spark, sf_dir))


@query(f"WITH {RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY started_at DESC, id DESC) AS rn FROM runs) SELECT provider, CAST(coalesce(min(rn) FILTER (status <> 'failed'), count(*) + 1) - 1 AS BIGINT) AS streak FROM r WHERE rn <= 3 GROUP BY 1")
def failure_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.failure_streak(a.runs(spark, sf_dir))


@query("SELECT report_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS failure_reasons FROM (SELECT user_id % 10 AS report_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1")
def failure_map_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = a.read(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("report_id"), F.col("event_type").alias("reason"), F.lit(1).alias("n"))
    pairs = F.array_sort(F.transform(F.map_entries("failure_reasons"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return runs.failure_map(events, "report_id").select("report_id", F.array_join(pairs, ",").alias("failure_reasons"))


@query("""WITH s AS (SELECT user_id % 10 AS report_id, count(*) AS total_sources, sum(event_id % 50)::BIGINT AS total_fetched, sum(event_id % 20)::BIGINT AS total_passed_quality, sum(event_id % 25)::BIGINT AS total_upserted, sum(event_id % 5)::BIGINT AS dup, sum(event_id % 3)::BIGINT AS url, sum(event_id % 2)::BIGINT AS soft, sum(event_id % 7)::BIGINT AS failed FROM events GROUP BY 1),
 f AS (SELECT user_id % 10 AS report_id, count(*) FILTER (event_type = 'error') AS fu, count(*) FILTER (event_type = 'view') AS fd, count(*) FILTER (event_type NOT IN ('error', 'view')) AS fo FROM events GROUP BY 1)
 SELECT report_id, total_sources, total_fetched, total_passed_quality, total_upserted, dup + fd AS total_skipped_duplicate, url + fu AS total_url_invalid, soft AS total_expired_detected, failed + fo AS total_failed_quality FROM s JOIN f USING (report_id)""")
def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = a.read(spark, sf_dir, "events").withColumn("report_id", F.col("user_id") % 10), F.col("event_id")
    per = {"jobs_fetched": 50, "passed_quality_gate": 20, "jobs_stored": 25, "jobs_duplicated": 5, "url_invalid_count": 3, "soft_404_count": 2, "quality_failures": 7}
    failures = e.select("report_id", F.when(F.col("event_type") == "error", "URL_INVALID").when(F.col("event_type") == "view", "DUPLICATE").otherwise(F.col("event_type")).alias("reason"), F.lit(1).alias("n"))
    return runs.report_rollup(e.select("report_id", *((i % m).alias(c) for c, m in per.items())), failures)


@query("SELECT coalesce(avg(value), 0) AS avg_enrichment_ms FROM (SELECT round(value, 2) AS value FROM events)")
def run_latency_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.average_latency(a.read(spark, sf_dir, "events").select(F.round("value", 2).alias("value")), "value")


CALLS = """calls AS (SELECT event_id, list_extract(['llama-3.1-8b-instant', 'qwen/qwen3-32b', 'llama-3.3-70b-versatile', 'other'], CAST(event_id % 4 AS INT) + 1) AS model, event_id % 1500 AS tin, event_id % 300 AS tout, event_id % 5 = 0 AS hit, event_id % 6 = 0 AS esc FROM events)"""


@query(f"""WITH {CALLS} SELECT model, count(*) AS n_calls, count(*) FILTER (hit) AS n_cache_hits, count(*) FILTER (esc) AS n_escalated, sum(tin)::BIGINT AS tokens_in, sum(tout)::BIGINT AS tokens_out,
 round(sum(CASE WHEN hit THEN 0 ELSE tin * (CASE model WHEN 'qwen/qwen3-32b' THEN 0.29 WHEN 'llama-3.3-70b-versatile' THEN 0.59 ELSE 0.05 END)::DOUBLE / 1000000 + tout * (CASE model WHEN 'qwen/qwen3-32b' THEN 0.59 WHEN 'llama-3.3-70b-versatile' THEN 0.79 ELSE 0.08 END)::DOUBLE / 1000000 END), 6) AS cost_usd FROM calls GROUP BY ROLLUP (model)""")
def cost_by_model_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    model = F.element_at(F.array(*map(F.lit, ("llama-3.1-8b-instant", "qwen/qwen3-32b", "llama-3.3-70b-versatile", "other"))), (i % 4 + 1).cast("int"))
    calls = a.read(spark, sf_dir, "events").select(model.alias("model"), (i % 1500).alias("tokens_in"), (i % 300).alias("tokens_out"), (i % 5 == 0).alias("cache_hit"), F.when(i % 6 == 0, "fast").alias("escalated_from"))
    return runs.cost_rollup(calls)


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id % 3, CAST(ts AS DATE) ORDER BY ts, event_id) <= 240 AS allowed FROM events")
def daily_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = a.read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 3).alias("provider"), "ts")
    return runs.daily_allowed(calls).select(F.col("id").alias("event_id"), "allowed")


@query("SELECT event_id, CAST(greatest(0, least(n, 250 - coalesce(sum(n) OVER (PARTITION BY user_id, date_trunc('month', ts) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken FROM (SELECT *, event_id % 100 AS n FROM events)")
def monthly_budget_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = a.read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("provider"), "ts", (F.col("event_id") % 100).alias("n"))
    return runs.monthly_budget(pages).select(F.col("id").alias("event_id"), "taken")


@query(f"""WITH {RAW_JOBS}, e AS (SELECT *, CASE WHEN arrival_idx % 4 <> 1 THEN salary_min END AS emin, CASE WHEN arrival_idx % 5 <> 2 THEN salary_max END AS emax, CASE WHEN arrival_idx % 3 <> 0 THEN length(description) * 10 END AS amin, CASE WHEN arrival_idx % 7 <> 0 THEN length(title) * 1000 END AS amax FROM raw_jobs),
 d AS (SELECT abs(emin - amin) AS x FROM e WHERE emin IS NOT NULL AND amin IS NOT NULL UNION ALL SELECT abs(emax - amax) FROM e WHERE emax IS NOT NULL AND amax IS NOT NULL) SELECT count(*) AS n, avg(x)::DOUBLE AS mae FROM d""")
def baseline_salary_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of a salary, with nulls on either side; the model's are made of the texts' lengths."""
    c, i = F.col, F.col("arrival_idx")
    rows = a.raw_jobs(spark, sf_dir).select(
        F.when(i % 4 != 1, c("salary_min")).alias("expected_min"), F.when(i % 5 != 2, c("salary_max")).alias("expected_max"),
        F.when(i % 3 != 0, F.length("description") * 10).alias("actual_min"), F.when(i % 7 != 0, F.length("title") * 1000).alias("actual_max"),
    )
    return runs.salary_error(rows)


@query("SELECT count(*) AS n, avg((quality = toxic)::INT)::DOUBLE AS accuracy, avg(abs(quality - toxic))::DOUBLE AS mae FROM labels")
def baseline_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.accuracy(a.read(spark, sf_dir, "labels").select(F.col("quality").alias("expected"), F.col("toxic").alias("actual"), F.col("quality").alias("expected_value"), F.col("toxic").alias("actual_value")))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def lang_source_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.language_source_rollup(a.read(spark, sf_dir, "documents"))


# Companies

METRICS = f"""{GATED}, metrics AS (SELECT name_normalized, count(*) AS total_jobs_seen, count(*) FILTER (status = 'active') AS total_jobs_passed, sum(quality_score)::DOUBLE AS sum_quality_scores, count(*) FILTER (salary_min IS NOT NULL OR salary_max IS NOT NULL) AS jobs_with_salary,
 count(*) FILTER (len(technical_skills) > 0) AS jobs_with_skills, count(*) FILTER (quality_tier = 'premium') AS premium_count, count(*) FILTER (seniority <> 'unknown') AS jobs_with_seniority, sum(length(description))::BIGINT AS sum_description_length FROM (SELECT *, {NORM.format('company_name')} AS name_normalized FROM tiered) GROUP BY 1)"""
TRUST = "round_even(least(100.0::DOUBLE, greatest(0.0::DOUBLE, sum_quality_scores / n / 100.0::DOUBLE * 25 + total_jobs_passed / n * 15 + jobs_with_salary / n * 20 + jobs_with_skills / n * 15 + premium_count / n * 10 + jobs_with_seniority / n * 10 + least(sum_description_length / n / 2000, 1.0::DOUBLE) * 5)), 1)"


def company_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.metrics(gated(spark, sf_dir).withColumn("name_normalized", t.normalize_text(F.col("company_name"))))


@query(f"WITH {METRICS} SELECT * FROM metrics")
def company_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_rows(spark, sf_dir)


@query(f"WITH {METRICS} SELECT name_normalized, {TRUST} AS trust_score FROM (SELECT *, total_jobs_seen::DOUBLE AS n FROM metrics)")
def trust_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_rows(spark, sf_dir).select("name_normalized", companies.trust_score().alias("trust_score"))


@query(f"WITH {METRICS} SELECT name_normalized, total_jobs_seen * 2 AS total_jobs_seen, {TRUST} AS trust_score FROM (SELECT *, total_jobs_seen::DOUBLE AS n FROM metrics)")
def trust_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = company_rows(spark, sf_dir)
    return companies.combine(rows, rows).select("name_normalized", "total_jobs_seen", "trust_score")


# Model answers, fan-out, pages, languages, streams


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'senior' ELSE 'unknown' END AS seniority, CASE WHEN doc_id % 3 = 0 THEN 'backend' ELSE 'other' END AS role_family, 1.0::DOUBLE AS salary_confidence, (doc_id % 100) / 100.0::DOUBLE AS confidence FROM documents WHERE doc_id % 10 <> 9""")
def llm_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    body = F.format_string('{"skills":["Python","x"],"seniority":"%s","role_family":"%s","confidence":%s,"field_confidence":{"salary":1.7,"unknown":0.5}}', F.when(i % 2 == 0, "senior").otherwise("guru"), F.when(i % 3 == 0, "backend").otherwise("wizard"), ((i % 100) / 100.0).cast("string"))
    content = F.when(i % 10 == 9, "not json").when(i % 4 == 1, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    out = a.read(spark, sf_dir, "documents").select("doc_id", ai.coerced(ai.parse_output(content)).alias("o")).filter("o is not null")
    return out.select("doc_id", "o.seniority", "o.role_family", F.col("o.field_confidence")["salary"].alias("salary_confidence"), "o.confidence")


@query("SELECT doc_id, pos - 1 AS pos, doc_id || '-' || (pos - 1) AS item_id, md5(line) AS line_md5 FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE trim(line) <> ''")
def fanout_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = a.read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter("trim(line) <> ''")
    return lines.select("doc_id", F.col("pos").cast("long").alias("pos"), F.concat_ws("-", F.col("doc_id").cast("string"), F.col("pos").cast("string")).alias("item_id"), F.md5("line").alias("line_md5"))


@query()
def html_main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.read(spark, sf_dir, "pages").select("page_id", html.extract_content(F.col("html")).alias("c")).select("page_id", "c.description", "c.logo_url")


#: Profiles of the documents of three folds of four, and what they make of each posting.
PROFILED = f"""{RAW_JOBS}, d AS (SELECT lang, lower(text) AS t FROM documents WHERE substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) > '3' AND lang IS NOT NULL), counts AS (SELECT lang, gram, count(*) AS n FROM (SELECT lang, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS gram FROM d) GROUP BY ALL),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, unicode(gram), unicode(substr(gram, 2, 1)), unicode(substr(gram, 3, 1))) AS rank, sum(n) OVER (PARTITION BY lang) AS total FROM counts),
 profile AS MATERIALIZED (SELECT lang, gram, CAST(round(ln(n / total) * 1000) AS BIGINT) AS weight FROM ranked WHERE rank <= 3000), langs AS (SELECT DISTINCT lang FROM profile),
 g AS MATERIALIZED (SELECT arrival_idx, gram, count(*) AS n FROM (SELECT arrival_idx, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS gram FROM (SELECT arrival_idx, lower(description) AS t FROM raw_jobs)) GROUP BY ALL),
 total AS (SELECT arrival_idx, sum(n) AS total FROM g GROUP BY 1), hits AS (SELECT arrival_idx, lang, sum(g.n * weight) AS s, sum(g.n) AS known FROM g JOIN profile USING (gram) GROUP BY ALL),
 scored AS (SELECT arrival_idx, lang, coalesce(s, 0) - 14000 * (total - coalesce(known, 0)) AS score, coalesce(known, 0) AS known, total FROM total CROSS JOIN langs LEFT JOIN hits USING (arrival_idx, lang)),
 found AS (SELECT r.arrival_idx, CASE WHEN 100 * known >= 60 * total THEN lang ELSE 'other' END AS found, CAST(coalesce(score, 0) AS BIGINT) AS score FROM raw_jobs r LEFT JOIN (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY arrival_idx ORDER BY score DESC, lang) = 1) USING (arrival_idx))"""


def held_out(key: str) -> F.Column:
    """One fold of four."""
    return F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 1) <= "3"


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.read(spark, sf_dir, "documents").filter(~held_out("doc_id"))
    return language_profiles.profiles(rows.select("text", "lang"))


@query(f"WITH {PROFILED} SELECT arrival_idx, coalesce(found, 'other') AS found, score FROM found")
def language_of_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole descriptions, by profiles of three folds of four of the documents."""
    detect = language_profiles.detector(language_profiles.Profiles.of(profiled(spark, sf_dir)))
    return a.raw_jobs(spark, sf_dir).select("arrival_idx", detect(F.col("description")).alias("f")).select("arrival_idx", F.col("f.lang").alias("found"), "f.score")


@query(f"WITH {PROFILED} SELECT original_language AS lang, count(*) AS n, avg((original_language = coalesce(found, 'other'))::INT)::DOUBLE AS accuracy FROM raw_jobs JOIN found USING (arrival_idx) WHERE substr(md5(CAST(arrival_idx AS VARCHAR)), 1, 1) <= '3' AND original_language <> 'ja' GROUP BY 1")
def language_detect_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of postings of the held-out fold whose language is found."""
    detect = language_profiles.detector(language_profiles.Profiles.of(profiled(spark, sf_dir)))
    held = a.raw_jobs(spark, sf_dir).filter(held_out("arrival_idx") & (F.col("original_language") != "ja"))
    found = held.select(F.col("original_language").alias("lang"), detect(F.col("description"))["lang"].alias("found"))
    return found.groupBy("lang").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("found")).cast("double")).alias("accuracy"))


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT event_id) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def stream_dedup_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.daily_counts_to_completion(spark, f"{sf_dir}/events.parquet")


@query(f"""WITH {HASHED}, k AS (SELECT arrival_idx, source, name_normalized, posted_at, {IN_ORDER.format("title_normalized")} AS s FROM hashed),
 p AS MATERIALIZED (SELECT b.arrival_idx, s.arrival_idx AS target_idx, b.s AS x, s.s AS y FROM k b JOIN k s ON b.name_normalized = s.name_normalized AND b.source <> s.source AND s.arrival_idx < b.arrival_idx AND s.posted_at >= b.posted_at - INTERVAL 14 DAYS
 WHERE 200.0 * least(length(b.s), length(s.s)) >= 92.0 * (length(b.s) + length(s.s))), h AS (SELECT arrival_idx, min(target_idx) AS target_idx FROM p WHERE {RATIO} >= 92 GROUP BY 1)
 SELECT arrival_idx, target_idx FROM k LEFT JOIN h USING (arrival_idx)""")
def stream_similar_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as postings that come in, in four slices."""
    return streaming.similar_to_completion(hashed(spark, sf_dir))


@query("SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1")
def stream_ingested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in four slices, and all of them a second time."""
    rows = a.read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return streaming.ingest_to_completion(rows, "event_id").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
