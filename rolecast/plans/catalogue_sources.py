"""A query a source: payload records made of the documents, projected, against SQL that states the canonical rows.

Records are JSON texts, in the form in which a connector hands them over, so each query covers the declared schema,
the projection, the drops and the keep-first rule of its source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import payloads, registry
from . import adapters as a
from .registered import query

OUT = ("url", "title", "company_name", "source", "published_at", "location_raw", "salary_min", "salary_max", "currency", "original_language", "external_id")
FIELDS = (
    "doc_id", "cast(doc_id as string) as id", "case when doc_id % 13 = 0 then '' else concat('Job ', doc_id) end as title", "concat('Company ', doc_id % 17) as company", "concat('https://x.example.com/', doc_id) as url",
    "concat('City ', doc_id % 7) as place", "concat('2024-03-', lpad(cast(doc_id % 28 + 1 as string), 2, '0'), 'T10:00:00Z') as stamp", "concat('2024-03-', lpad(cast(doc_id % 28 + 1 as string), 2, '0')) as day",
    "1709287200 + (doc_id % 28) * 86400 as seconds", "doc_id % 1000 as n", "concat('About ', lang) as body",
)
VIEW = "d AS (SELECT " + ", ".join(FIELDS) + " FROM documents)"


@dataclass(frozen=True)
class Case:
    record: str  # the record's fields, in SQL
    rows: dict[str, str]  # what comes out, in SQL; columns that are not named are null
    where: str = "true"
    fan: str = ""  # a relation that multiplies the rows, in SQL
    company: bool = False  # whether the company comes from the registry of boards
    more: dict[str, str] = field(default_factory=dict)  # columns beside the record


def _s(*pairs: str) -> str:
    """A record of name, value, name, value."""
    return "named_struct(" + ", ".join(f"'{x}'" if i % 2 == 0 else x for i, x in enumerate(pairs)) + ")"


BASE = {"url": "url", "title": "title", "company_name": "company"}
TEXT_N = "CAST(n AS VARCHAR)"
RAPID = _s("job_id", "cast(doc_id - doc_id % 2 as string)", "job_title", "if(n % 2 = 0, title, ' ')", "position", "title", "organization", "if(n % 3 = 0, null, company)", "company", "company", "url", "url", "city", "place", "posted_at", "if(n % 5 = 0, 'soon', stamp)", "salary_min", "concat(n, '.9')", "salary_max", "if(n % 4 = 0, 'much', cast(n as string))", "salary_currency", "'EUR'")
RAPID_ROWS = BASE | {"published_at": "CASE WHEN n % 5 <> 0 THEN stamp END", "location_raw": "place", "salary_min": TEXT_N, "salary_max": f"CASE WHEN n % 4 <> 0 THEN {TEXT_N} END", "currency": "'EUR'", "external_id": "CAST(doc_id - doc_id % 2 AS VARCHAR)"}
NO_PAY = {"salary_min": "NULL", "salary_max": "NULL", "currency": "NULL"}
CASES = {
    "adzuna": Case(_s("title", "title", "company", _s("display_name", "company"), "description", "body", "redirect_url", "url", "location", _s("display_name", "place"), "created", "stamp", "salary_min", "n", "salary_max", "n + 10"), BASE | {"published_at": "stamp", "location_raw": "place", "salary_min": TEXT_N, "salary_max": "CAST(n + 10 AS VARCHAR)", "original_language": "'it'", "source": "'Adzuna'"}),
    "jooble": Case(_s("title", "title", "company", "if(n % 5 = 0, '', company)", "snippet", "body", "link", "if(n % 4 = 0, concat(url, '?a=1&closedJob=TRUE'), url)", "location", "place", "source", "if(n % 3 = 0, null, 'board')", "updated", "day"), BASE | {"company_name": "CASE WHEN n % 5 = 0 THEN 'Unknown' ELSE company END", "published_at": "day", "location_raw": "place", "source": "CASE WHEN n % 3 = 0 THEN 'Jooble (Unknown)' ELSE 'Jooble (board)' END"}, "n % 4 <> 0"),
    "iprogrammatori": Case(_s("title", "title", "company", "company", "content", "body", "url", "url", "city", "if(n % 2 = 0, null, place)", "date", "concat(' ', substr(day, 9, 2), '/03/2024 ')"), BASE | {"published_at": "day || 'T00:00:00Z'", "location_raw": "CASE WHEN n % 2 = 0 THEN '' ELSE place END", "source": "'IProgrammatori'", "original_language": "'it'"}),
    "arbeitnow": Case(_s("title", "title", "company_name", "company", "description", "body", "url", "url", "location", "place", "created_at", "if(n % 6 = 0, 'x', cast(seconds as string))"), BASE | {"published_at": "CASE WHEN n % 6 <> 0 THEN day END", "location_raw": "place", "source": "'Arbeitnow'"}),
    "remoteok": Case(_s("legal", "if(n % 9 = 0, 'terms', null)", "position", "title", "company", "company", "description", "body", "url", "if(n % 2 = 0, '', url)", "apply_url", "concat(url, '/apply')", "date", "stamp", "location", "place"), BASE | {"url": "CASE WHEN n % 2 = 0 THEN url || '/apply' ELSE url END", "published_at": "day", "location_raw": "place", "source": "'RemoteOK'"}, "n % 9 <> 0"),
    "jobicy": Case(_s("jobTitle", "title", "companyName", "if(n % 5 = 0, null, company)", "jobDescription", "body", "url", "url", "pubDate", "stamp", "jobGeo", "place", "annualSalaryMin", "n"), BASE | {"company_name": "CASE WHEN n % 5 = 0 THEN 'Unknown' ELSE company END", "published_at": "stamp", "location_raw": "place", "salary_min": TEXT_N, "source": "'Jobicy'"}, "n % 8 <> 0", more={"success": "n % 8 <> 0"}),
    "rss": Case(_s("title", "case n % 4 when 0 then concat(company, ' - ', id) when 1 then concat('Remote - ', id) when 2 then concat(company, ': ', id) else id end", "link", "url", "description", "body", "pubDate", "stamp", "author", "if(n % 5 = 0, ' Author ', null)"), {"url": "url", "title": "CASE n % 4 WHEN 0 THEN company || ' - ' || id WHEN 1 THEN 'Remote - ' || id WHEN 2 THEN company || ': ' || id ELSE id END", "company_name": "CASE WHEN n % 5 = 0 THEN 'Author' WHEN n % 4 IN (0, 2) THEN company ELSE 'Unknown' END", "published_at": "stamp", "location_raw": "'Remote'", "source": "'RSS Feed'"}),
    "himalayas": Case(_s("title", "title", "companyName", "if(n % 2 = 0, '', company)", "company", _s("name", "company"), "excerpt", "body", "applicationUrl", "url", "publishedAt", "if(n % 3 = 0, cast(seconds * 1000 as string), cast(seconds as string))", "locationRestrictions", "if(n % 5 = 0, array(), array(place, '', 'Else'))", "location", "if(n % 10 = 0, null, 'Home')", "minSalary", "n", "salaryMax", "n + 1", "currency", "'EUR'", "id", "id"), BASE | {"published_at": "stamp", "location_raw": "CASE WHEN n % 10 = 0 THEN 'Remote' WHEN n % 5 = 0 THEN 'Home' ELSE place || ', Else' END", "salary_min": TEXT_N, "salary_max": "CAST(n + 1 AS VARCHAR)", "currency": "'EUR'", "external_id": "id", "source": "'Himalayas'"}),
    "remotive": Case(_s("id", "doc_id", "title", "title", "company_name", "company", "url", "url", "description", "body", "publication_date", "stamp", "candidate_required_location", "if(n % 3 = 0, '', place)"), BASE | {"published_at": "stamp", "location_raw": "CASE WHEN n % 3 = 0 THEN 'Remote' ELSE place END", "external_id": "id", "source": "'Remotive'"}),
    "themuse": Case(_s("id", "doc_id - doc_id % 3", "name", "title", "company", _s("name", "company"), "refs", _s("landing_page", "url"), "contents", "body", "locations", f"if(n % 4 = 0, array(), array({_s('name', 'place')}, {_s('name', chr(39) + 'other' + chr(39))}))", "publication_date", "stamp"), BASE | {"published_at": "stamp", "location_raw": "CASE WHEN n % 4 = 0 THEN 'Remote' ELSE place END", "external_id": "CAST(doc_id - doc_id % 3 AS VARCHAR)", "source": "'TheMuse'"}),
    "reed": Case(_s("jobId", "doc_id", "jobTitle", "title", "employerName", "company", "jobUrl", "url", "jobDescription", "body", "locationName", "place", "minimumSalary", "n % 5 + 0.5", "maximumSalary", "n % 3", "currency", "if(n % 2 = 0, null, 'EUR')", "date", "day"), BASE | {"published_at": "day", "location_raw": "place", "salary_min": "CASE WHEN n % 5 <> 0 THEN CAST(n % 5 AS VARCHAR) END", "salary_max": "CASE WHEN n % 3 <> 0 THEN CAST(n % 3 AS VARCHAR) END", "currency": "CASE WHEN n % 2 = 0 THEN 'GBP' ELSE 'EUR' END", "external_id": "id", "source": "'Reed'"}),
    "jsearch": Case(_s("job_id", "id", "job_title", "title", "employer_name", "company", "job_apply_link", "url", "job_description", "body", "job_city", "if(n % 2 = 0, '', place)", "job_country", "'IT'", "job_min_salary", "n", "job_salary_currency", "'EUR'", "job_posted_at_datetime_utc", "if(n % 5 = 0, '', stamp)"), BASE | {"published_at": "CASE WHEN n % 5 <> 0 THEN stamp END", "location_raw": "CASE WHEN n % 2 = 0 THEN 'IT' ELSE place || ', IT' END", "salary_min": f"CASE WHEN n <> 0 THEN {TEXT_N} END", "currency": "'EUR'", "external_id": "id", "source": "'JSearch'"}),
    "greenhouse": Case(_s("id", "doc_id", "title", "title", "absolute_url", "url", "content", "body", "location", _s("name", "place"), "offices", f"if(n % 2 = 0, array(), array({_s('name', chr(39) + 'Office' + chr(39))}))", "updated_at", "stamp"), BASE | {"published_at": "stamp", "location_raw": "CASE WHEN n % 2 = 0 THEN place ELSE 'Office' END", "external_id": "id", "source": "'Greenhouse'"}, company=True),
    "lever": Case(_s("id", "id", "text", "title", "hostedUrl", "url", "description", "body", "categories", _s("team", "'Team'", "location", "if(n % 2 = 0, ' ', place)"), "salaryRange", _s("min", "n", "currency", "'EUR'"), "createdAt", "seconds"), BASE | {"published_at": "CAST(seconds AS VARCHAR)", "location_raw": "CASE WHEN n % 2 = 0 THEN 'Team' ELSE place END", "salary_min": TEXT_N, "currency": "'EUR'", "external_id": "id", "source": "'Lever'"}, company=True),
    "ashby": Case(_s("id", "id", "title", "title", "jobUrl", "url", "descriptionHtml", "body", "locationName", "place", "publishedAt", "stamp", "compensation", _s("minValue", "if(n % 4 = 3, null, n)", "max", "n + 1", "currency", "'EUR'", "interval", "case n % 3 when 0 then 'Hourly' when 1 then 'monthly' else 'Yearly' end")), BASE | {"published_at": "stamp", "location_raw": "place", "salary_min": "CASE WHEN n % 4 <> 3 THEN CAST(CASE n % 3 WHEN 0 THEN n * 2080 WHEN 1 THEN n * 12 ELSE n END AS VARCHAR) END", "salary_max": "CAST(CASE WHEN n % 4 = 3 THEN n + 1 ELSE CASE n % 3 WHEN 0 THEN (n + 1) * 2080 WHEN 1 THEN (n + 1) * 12 ELSE n + 1 END END AS VARCHAR)", "currency": "'EUR'", "external_id": "id", "source": "'Ashby'"}, company=True),
    "personio": Case(_s("id", "id", "name", "title", "office", "place", "create_date", "''", "createDate", "if(n % 2 = 0, concat(day, ' 10:00:00'), concat(substr(day, 9, 2), '.03.2024'))"), {"url": "'https://company-' || (doc_id % 17) || '.jobs.personio.de/job/' || id", "title": "title", "company_name": "company", "published_at": "CASE WHEN n % 2 = 0 THEN stamp ELSE day || 'T00:00:00Z' END", "location_raw": "place", "external_id": "id", "source": "'Personio'"}, company=True),
    "active_jobs_db": Case(RAPID.replace("'city', place", "'city', ' ', 'location_derived', array(place)"), RAPID_ROWS | {"source": "'Active Jobs DB'"}),
    "workday_jobs": Case(RAPID, RAPID_ROWS | {"source": "'Workday Jobs'"}),
    "startup_jobs": Case(RAPID, RAPID_ROWS | {"source": "'Startup Jobs'"}),
    "hn_hiring": Case(
        _s("commentId", "id", "commentUrl", "url", "time", "seconds", "body", "body", "extracted", _s("company", "company", "locations", f"array({_s('city', 'place', 'country', chr(39) + chr(39))}, {_s('city', chr(39) + 'Rome' + chr(39), 'country', chr(39) + 'IT' + chr(39))})", "salaryFrom", "n", "jobs", f"transform(sequence(0, n % 3), k -> {_s('role', 'if(k = 1, null, concat(title, k))', 'title', 'concat(title, k)', 'url', 'if(k = 2, concat(url, k), null)')})")),
        {"url": "CASE WHEN k = 2 THEN url || k ELSE url END", "title": "title || k", "company_name": "company", "published_at": "stamp", "location_raw": "place || '; Rome, IT'", "salary_min": TEXT_N, "external_id": "id || '-' || k", "source": "'HN Who is Hiring'"},
        fan=", (SELECT unnest(range(0, 3)) AS k) WHERE k <= n % 3",
    ),
    "yc_jobs": Case(_s("id", "id", "role", "title", "startup", "company", "apply_url", "url", "city", "place", "published_at", "stamp"), BASE | {"published_at": "stamp", "location_raw": "place", "external_id": "id", "source": "'Y Combinator Jobs'"}),
    "faang_watch": Case(_s("id", "id", "role", "title", "employer", "company", "apply_url", "url", "summary", "body", "earliest_date", "stamp", "locations", "array(place)", "parsed_locations", f"if(n % 2 = 0, array(), array({_s('city', 'place', 'state', chr(39) + chr(39), 'country', chr(39) + 'IT' + chr(39))}))"), BASE | {"published_at": "stamp", "location_raw": "CASE WHEN n % 2 = 0 THEN place ELSE place || ', IT' END", "external_id": "id", "source": "'faang.watch'"}),
    "hn_realtime": Case(_s("hn_id", "id", "position", "title", "organization", "company", "link", "url", "text", "body", "city", "place", "posted_date", "if(n % 2 = 0, 'soon', stamp)", "timestamp", "seconds"), BASE | {"published_at": "stamp", "location_raw": "place", "external_id": "id", "source": "'HN Real-Time Jobs'"}),
}


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as what records are made of; they arrive by ``doc_id``."""
    return a.read(spark, sf_dir, "documents").selectExpr(*FIELDS)


def listed(spark: SparkSession) -> DataFrame:
    """A registry of boards, as its file lists them."""
    return spark.range(17).selectExpr("concat('Company ', id) name", "concat('company-', id) slug")


def records_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    case = CASES[name]
    more = {**case.more, **({"_slug": "concat('company-', doc_id % 17)"} if case.company else {})}
    rows = view(spark, sf_dir).select(F.to_json(F.expr(case.record), {"ignoreNullFields": "true"}).alias("record"), "doc_id", *(F.expr(e).alias(n) for n, e in more.items()))
    rows = rows.select(F.from_json("record", payloads.SOURCES[name].record).alias("_r"), "doc_id", *more)
    return registry.with_company(rows, listed(spark)).drop("_slug") if case.company else rows


def postings(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return payloads.canonical(records_of(spark, sf_dir, name), name, order=None if CASES[name].fan else "doc_id")


def sql_of(name: str) -> str:
    case, kind = CASES[name], payloads.SOURCES[name]
    cols = ", ".join(f"{case.rows.get(c, repr(kind.language) if c == 'original_language' else 'NULL')} AS {c}" for c in OUT)
    inner = f"SELECT doc_id, {cols} FROM d{case.fan}{' AND' if case.fan else ' WHERE'} {case.where}"
    first = " QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY doc_id) = 1" if kind.unique and not case.fan else ""
    return f"WITH {VIEW} SELECT {', '.join(OUT)} FROM ({inner}) WHERE title <> '' AND url <> '' AND company_name <> ''{first}"


def _register(name: str) -> None:
    @query(sql_of(name), f"source_{name}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return postings(spark, sf_dir, name).select(*OUT)


for _name in CASES:
    _register(_name)


HINTS = """SELECT doc_id, concat_ws('|', CASE WHEN n % 2 = 0 THEN 'employment_type=contract' END, CASE WHEN n % 3 = 0 THEN 'remote_mode=remote' END,
 CASE n % 5 WHEN 0 THEN 'seniority=junior' WHEN 1 THEN 'seniority=mid' WHEN 2 THEN 'seniority=senior' END, 'skills=' || array_to_string(list_transform(range(1, 1 + least(n % 20 + 1, 15)), lambda k: 's' || k), ', ')) AS hints FROM d"""


@query(f"WITH {VIEW} {HINTS}")
def source_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a source states itself: kinds of employment, remote work, months of experience, the first fifteen skills."""
    months = "case n % 5 when 0 then 0 when 1 then 12 + n % 48 when 2 then 60 + n else 5 end"
    record = _s("job_employment_type", "if(n % 2 = 0, ' contractor ', 'other')", "job_is_remote", "n % 3 = 0", "job_required_experience", _s("no_experience_required", "false", "required_experience_in_months", months), "job_required_skills", "transform(sequence(1, n % 20 + 1), k -> concat(' s', k))")
    r = view(spark, sf_dir).select("doc_id", F.from_json(F.to_json(F.expr(record)), payloads.SOURCES["jsearch"].record).alias("_r"))
    found = payloads.jsearch_hints(lambda p: F.col(f"_r.{p}"))
    pairs = F.array_sort(F.transform(F.map_entries(found), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return r.select("doc_id", F.coalesce(F.array_join(pairs, "|"), F.lit("")).alias("hints"))


@query(f"WITH {VIEW} SELECT count(*) AS n, min(url) AS lo FROM d WHERE title <> '' AND contains(lower(title || ' ' || body || ' '), 'about en')")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings whose title, text or tags hold a keyword, whatever the case."""
    return payloads.canonical(records_of(spark, sf_dir, "arbeitnow"), "arbeitnow", keyword="About EN").agg(F.count("*").alias("n"), F.min("url").alias("lo"))


@query(f"WITH {VIEW}, p AS (SELECT 'Adzuna' AS source, doc_id, url FROM d WHERE title <> '' UNION ALL SELECT 'Remotive', doc_id, url FROM d WHERE title <> '') SELECT source, url, row_number() OVER (ORDER BY source, doc_id) AS place FROM p")
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings of two sources as one batch, numbered in order of arrival."""
    parts = [postings(spark, sf_dir, name).select("source", "url", "arrival_idx") for name in ("adzuna", "remotive")]
    return payloads.union_all(parts, start=1, places=False).select("source", "url", F.col("arrival_idx").alias("place"))


#: Records as they come: some are torn in the middle, some are no records at all.
TORN = "CASE WHEN n % 13 = 5 THEN 'torn' WHEN n % 17 = 3 THEN 'none' ELSE 'whole' END"


@query(f"WITH {VIEW}, r AS (SELECT source, {TORN} AS kind FROM (SELECT d.*, documents.source FROM d JOIN documents USING (doc_id))) SELECT source, count(*) FILTER (kind = 'whole') AS jobs_fetched, count(*) FILTER (kind <> 'whole') AS n_torn, CASE WHEN count(*) FILTER (kind = 'whole') = 0 THEN 'CONNECTOR_CRASH' END AS failure_reason FROM r GROUP BY 1")
def torn_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all sources in one pass; a torn one is counted, and breaks nothing else."""
    record = F.to_json(F.expr(CASES["remotive"].record), {"ignoreNullFields": "true"})
    kind = F.expr(TORN)
    rows = a.read(spark, sf_dir, "documents").selectExpr(*FIELDS, "source").withColumn("record", record)
    raw = rows.select("source", F.when(kind == "torn", F.substring("record", 1, 40)).when(kind == "none", "<html>busy</html>").otherwise(F.col("record")).alias("record"))
    _, log = registry.parsed(raw, "remotive")
    return log.select("source", "jobs_fetched", "n_torn", "failure_reason")


@query("SELECT lower(n_name) AS slug FROM nation LEFT JOIN (SELECT n_nationkey AS k, n_nationkey % 2 = 0 AS db FROM nation WHERE n_nationkey % 3 <> 0) p ON p.k = n_nationkey WHERE n_nationkey % 5 <> 0 AND coalesce(db, n_nationkey < 12) AND lower(n_name) NOT IN ('france', 'china')")
def enabled_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that code enables, no list denies, and whose provider row, or else the older list, allows."""
    n, key = a.read(spark, sf_dir, "nation").withColumn("slug", F.lower("n_name")), F.col("n_nationkey")
    legacy = [r["slug"] for r in n.filter(key < 12).select("slug").collect()]  # a registry is a short list
    return payloads.enabled_sources(n.select("slug", (key % 5 != 0).alias("enabled")), n.filter(key % 3 != 0).select("slug", (key % 2 == 0).alias("enabled")), ["france", "china"], legacy).select("slug")


@query("SELECT n_name AS name FROM nation WHERE lower(n_name) IN ('france', 'china', 'peru')")
def chosen_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.chosen(a.read(spark, sf_dir, "nation").select(F.col("n_name").alias("name")), " France, CHINA,peru, ")


@query("SELECT r_name AS region, n_name AS nation FROM region CROSS JOIN nation")
def request_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.sweep(a.read(spark, sf_dir, "region").select(F.col("r_name").alias("region")), a.read(spark, sf_dir, "nation").select(F.col("n_name").alias("nation")))


def board_pages(request: dict) -> list[dict]:
    """A connector that answers without a network: a page of postings."""
    return [{"id": f"{request['page']}-{i}", "title": f"Job {i}", "company_name": request["company"], "url": f"https://x.example.com/{request['page']}/{i}"} for i in range(request["page"] + 1)]


@query("SELECT 'https://x.example.com/' || r_regionkey || '/' || i AS url, r_name AS company_name, r_regionkey || '-' || i AS external_id, 'Remote' AS location_raw FROM region, (SELECT unnest(range(0, 100)) AS i) WHERE i <= r_regionkey")
def board_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a connector through a Spark data source, a task a request."""
    import json

    spark.dataSource.register(registry.BoardSource)
    requests = [{"page": r["r_regionkey"], "company": r["r_name"]} for r in a.read(spark, sf_dir, "region").collect()]
    raw = spark.read.format("board").option("fetch", f"{__name__}:board_pages").option("requests", json.dumps(requests)).load()
    return payloads.canonical(registry.records(raw, "remotive"), "remotive").select("url", "company_name", "external_id", "location_raw")


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN n % 2 = 0 THEN 'url' END, CASE WHEN n % 3 = 0 THEN 'title' END, CASE WHEN n % 5 = 0 THEN 'description' END], lambda x: x IS NOT NULL), ',') AS missing FROM (SELECT *, doc_id % 1000 AS n FROM documents)")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of required fields without a value."""
    n = F.col("doc_id") % 1000
    rows = a.read(spark, sf_dir, "documents").select("doc_id", F.when(n % 2 != 0, "u").alias("url"), F.when(n % 3 != 0, "t").alias("title"), F.lit("c").alias("company_name"), "source", F.when(n % 5 != 0, "d").alias("description"))
    return payloads.validate(rows).select("doc_id", F.array_join("missing", ",").alias("missing"))
