"""Projections of source payloads to the canonical posting.

A source is declared by the schema of its payload file, where its records are, and an expression for each canonical
field.  ``canonical`` does the rest: it explodes the records, drops those without url, title or company, keeps the
first of each id in order of arrival, and casts to ``schemas.CANONICAL``.  Fetching is not done here: payload files are
landed by the caller, and read with the declared schema, so that columns are pruned in the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.html import clean_description
from ..operators.dedupe import keep_first
from ..operators.running import running

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
NAMES = ("url", "title", "description", "company_name", "source", "published_at", "location_raw", "salary_min", "salary_max", "currency", "original_language", "external_id", "source_hints")


@dataclass(frozen=True)
class Source:
    name: str
    record: str  # schema of one record
    fields: Callable[[Callable[[str], Column]], dict[str, Column]]
    container: str | None = None  # the field that holds the array of records; none: the file is an array or lines of records
    fmt: str = "json"
    row_tag: str | None = None
    unique: bool = False  # whether an id is taken once
    keep: Callable[[Callable[[str], Column]], Column] | None = None
    search: Callable[[Callable[[str], Column]], Column] | None = None  # what a keyword is looked for in
    language: str = "en"
    more: str = ""  # further fields of the container
    extra: dict[str, str] = field(default_factory=dict)


def first(r: Callable[[str], Column], *names: str) -> Column:
    return t.first_text(*(r(n) for n in names))


def iso(c: Column) -> Column:
    return F.date_format(t.parse_iso(c), ISO)


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def number(c: Column) -> Column:
    """A salary as a whole number; none for zero and what is no number."""
    return F.nullif(t.to_salary(c), F.lit(0).cast("long"))


def joined(*cs: Column) -> Column:
    return F.array_join(F.filter(F.array(*cs), lambda x: x.isNotNull() & (x != "")), ", ")


def head(c: Column) -> Column:
    """The first element, null if there is none."""
    return F.get(c, F.lit(0))


def _adzuna(r):
    return {"title": r("title"), "company_name": r("company.display_name"), "description": clean_description(r("description")), "url": r("redirect_url"), "location_raw": r("location.display_name"), "published_at": r("created"), "salary_min": r("salary_min"), "salary_max": r("salary_max")}


def _jooble(r):
    return {"title": r("title"), "company_name": F.coalesce(or_null(r("company")), F.lit("Unknown")), "description": clean_description(r("snippet")), "url": r("link"), "location_raw": r("location"), "source": F.concat(F.lit("Jooble ("), F.coalesce(r("source"), F.lit("Unknown")), F.lit(")")), "published_at": r("updated")}


def _iprogrammatori(r):
    day = F.date_format(F.try_to_timestamp(F.trim(r("date")), F.lit("dd/MM/yyyy")), ISO)
    return {"title": r("title"), "company_name": F.coalesce(r("company"), F.lit("Unknown")), "description": clean_description(r("content")), "url": r("url"), "location_raw": F.coalesce(r("city"), F.lit("")), "published_at": day}


def _arbeitnow(r):
    return {"title": r("title"), "company_name": r("company_name"), "description": clean_description(r("description")), "url": r("url"), "location_raw": r("location"), "published_at": F.date_format(t.epoch_timestamp(r("created_at")), "yyyy-MM-dd")}


def _remoteok(r):
    return {"title": r("position"), "company_name": r("company"), "description": clean_description(r("description")), "url": F.coalesce(or_null(r("url")), r("apply_url")), "location_raw": r("location"), "published_at": F.split_part(r("date"), F.lit("T"), F.lit(1))}


def _jobicy(r):
    return {"title": r("jobTitle"), "company_name": F.coalesce(r("companyName"), F.lit("Unknown")), "description": clean_description(r("jobDescription")), "url": r("url"), "location_raw": r("jobGeo"), "published_at": r("pubDate"), "salary_min": r("annualSalaryMin"), "salary_max": r("annualSalaryMax")}


#: Title prefixes that are no company.
NO_COMPANY = ("remote", "hiring", "new", "job")


def rss_company(creator: Column, author: Column, credit: Column, title: Column) -> Column:
    """The company of a feed item: from its metadata, else from what stands before a dash, a colon or a bar in its title."""

    def before(pattern: str) -> Column:
        name = F.trim(F.regexp_extract(title, pattern, 1))
        return F.when((name != "") & ~F.lower(name).isin(*NO_COMPANY), name)

    return F.coalesce(*(or_null(F.trim(c)) for c in (creator, author, credit)), before(r"^(.*?)\s*[–—-]\s*"), before(r"^(.*?)\s*[:|]\s*"), F.lit("Unknown"))


def _rss(r):
    return {"title": r("title"), "company_name": rss_company(r("`dc:creator`"), r("author"), r("`media:credit`"), r("title")), "description": clean_description(r("description")), "url": r("link"), "location_raw": F.lit("Remote"), "published_at": r("pubDate")}


def _himalayas(r):
    raw = F.coalesce(or_null(r("pubDate")), or_null(r("publishedAt")), r("createdAt"))
    stamp = F.when(raw.rlike(r"^\d+(\.\d+)?$"), F.date_format(t.epoch_auto(raw), ISO)).otherwise(raw)
    places = F.array_join(F.filter(r("locationRestrictions"), lambda x: x != ""), ", ")
    return {
        "title": r("title"), "company_name": F.coalesce(or_null(r("companyName")), r("company.name")), "description": F.coalesce(or_null(r("description")), r("excerpt")), "url": first(r, "applicationLink", "applicationUrl", "url"), "published_at": stamp,
        "location_raw": F.coalesce(or_null(places), or_null(r("location")), F.lit("Remote")), "salary_min": F.coalesce(r("minSalary"), r("salaryMin")), "salary_max": F.coalesce(r("maxSalary"), r("salaryMax")), "currency": r("currency"), "external_id": first(r, "guid", "id", "slug"),
    }


def _remotive(r):
    return {"title": r("title"), "company_name": r("company_name"), "description": r("description"), "url": r("url"), "published_at": r("publication_date"), "location_raw": F.coalesce(or_null(r("candidate_required_location")), F.lit("Remote")), "external_id": r("id")}


def _themuse(r):
    return {"title": r("name"), "company_name": r("company.name"), "description": r("contents"), "url": r("refs.landing_page"), "published_at": r("publication_date"), "location_raw": F.when(F.coalesce(F.size(r("locations")), F.lit(0)) > 0, head(r("locations.name"))).otherwise("Remote"), "external_id": r("id")}


def _reed(r):
    return {"title": r("jobTitle"), "company_name": r("employerName"), "description": r("jobDescription"), "url": r("jobUrl"), "published_at": r("date"), "location_raw": r("locationName"), "salary_min": number(r("minimumSalary")), "salary_max": number(r("maximumSalary")), "currency": F.coalesce(r("currency"), F.lit("GBP")), "external_id": r("jobId")}


#: Employment types of this source.
EMPLOYMENT = {"FULLTIME": "full_time", "PARTTIME": "part_time", "CONTRACTOR": "contract", "INTERN": "internship"}


def jsearch_hints(r: Callable[[str], Column]) -> Column:
    """What the source states itself; keys without a value are left out."""
    kind, months = F.upper(F.trim(r("job_employment_type"))), r("job_required_experience.required_experience_in_months")
    level = F.when(r("job_required_experience.no_experience_required") | (months == 0), "junior").when(months >= 60, "senior").when(months.between(12, 59), "mid")
    named = F.slice(F.filter(F.transform(r("job_required_skills"), lambda s: F.trim(s)), lambda s: s != ""), 1, 15)
    pairs = {"employment_type": F.coalesce(*(F.when(kind == k, F.lit(v)) for k, v in EMPLOYMENT.items())), "remote_mode": F.when(r("job_is_remote"), "remote"), "seniority": level, "skills": or_null(F.array_join(named, ", "))}
    hints = F.map_filter(F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v))), lambda _, v: v.isNotNull())
    return F.when(F.size(hints) > 0, hints)


def _jsearch(r):
    return {
        "title": r("job_title"), "company_name": r("employer_name"), "description": r("job_description"), "url": r("job_apply_link"), "published_at": iso(r("job_posted_at_datetime_utc")), "location_raw": or_null(joined(r("job_city"), r("job_country"))),
        "salary_min": number(r("job_min_salary")), "salary_max": number(r("job_max_salary")), "currency": r("job_salary_currency"), "external_id": r("job_id"), "source_hints": jsearch_hints(r),
    }


def _greenhouse(r):
    place = F.when(F.coalesce(F.size(r("offices")), F.lit(0)) > 0, head(r("offices.name"))).otherwise(F.coalesce(r("location.name"), F.lit("")))
    return {"title": r("title"), "company_name": F.col("_company"), "description": r("content"), "url": r("absolute_url"), "published_at": r("updated_at"), "location_raw": place, "external_id": r("id")}


def _lever(r):
    return {"title": r("text"), "company_name": F.col("_company"), "description": F.coalesce(or_null(r("descriptionPlain")), r("description")), "url": r("hostedUrl"), "published_at": r("createdAt"), "location_raw": first(r, "categories.location", "categories.team"), "salary_min": r("salaryRange.min"), "salary_max": r("salaryRange.max"), "currency": r("salaryRange.currency"), "external_id": r("id")}


def yearly(value: Column, period: Column) -> Column:
    """An amount a year from one an hour or a month, cut to whole numbers."""
    v, p = value.cast("string").try_cast("double"), F.lower(period)
    return F.when(p == "hourly", (v * 2080).cast("long").cast("string")).when(p == "monthly", (v * 12).cast("long").cast("string")).otherwise(value)


def _ashby(r):
    low = F.coalesce(r("compensation.minValue"), r("compensation.min"))
    high = F.coalesce(r("compensation.maxValue"), r("compensation.max"))
    period = F.when(low.isNotNull(), r("compensation.interval"))
    return {"title": r("title"), "company_name": F.col("_company"), "description": F.coalesce(or_null(r("descriptionHtml")), r("description")), "url": r("jobUrl"), "published_at": r("publishedAt"), "location_raw": F.coalesce(or_null(r("location")), r("locationName")), "salary_min": yearly(low, period), "salary_max": yearly(high, period), "currency": F.coalesce(r("compensation.currencyCode"), r("compensation.currency")), "external_id": r("id")}


def _personio(r):
    raw = t.first_text(*(r(n) for n in ("createdAt", "created_at", "createDate", "publishedAt", "pubDate", "date")))
    dated = F.coalesce(*(F.date_format(F.try_to_timestamp(raw, F.lit(f)), ISO) for f in ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy")))
    slug = F.regexp_replace(F.lower(F.col("_company")), "[^a-z0-9]+", "-")
    text = F.array_join(F.transform(F.coalesce(r("jobDescriptions.jobDescription"), F.array().cast("array<struct<name:string,value:string>>")), lambda d: F.concat_ws("\n", d["name"], d["value"])), "\n\n")
    return {"title": r("name"), "company_name": F.col("_company"), "description": text, "url": F.concat(F.lit("https://"), slug, F.lit(".jobs.personio.de/job/"), r("id")), "published_at": dated, "location_raw": r("office"), "external_id": r("id")}


#: The keys under which these sources give the same thing, in order of preference.
def _rapid(title=("title", "job_title", "position"), company=("organization", "company", "company_name"), url=("url", "job_url", "apply_url"), place=("location", "city", "location_raw"), date=("date_posted", "posted_at", "published_at"), pay=True, ids=("id", "job_id"), text=("description", "description_text")):
    """Sources that name the same things in several ways: of each group of keys the first with a value counts."""

    def fields(r):
        link = first(r, *url)
        out = {"title": first(r, *title), "company_name": first(r, *company), "description": first(r, *text), "url": link, "published_at": iso(first(r, *date)), "location_raw": or_null(first(r, *place)), "external_id": F.coalesce(or_null(first(r, *ids)), link)}
        if pay:
            out |= {"salary_min": t.to_salary(r("salary_min")), "salary_max": t.to_salary(r("salary_max")), "currency": or_null(first(r, "currency", "salary_currency"))}
        return out

    return fields


def _keys(*groups: tuple[str, ...]) -> str:
    return ", ".join(f"{k} string" for k in dict.fromkeys(k for g in groups for k in g))


#: All keys of such a record.
RAPID = _keys(("id", "job_id", "title", "job_title", "position", "role", "organization", "company", "company_name", "employer_name", "startup", "url", "job_url", "apply_url", "application_url", "external_url", "location", "city", "location_raw", "description", "description_text", "date_posted", "posted_at", "published_at", "created_at", "salary_min", "salary_max", "currency", "salary_currency"))


def _active(r):
    out = _rapid(company=("organization", "company", "company_name", "employer_name"), url=("url", "job_url", "apply_url", "application_url"), date=("date_posted", "posted_at", "published_at", "created_at"))(r)
    return out | {"location_raw": F.coalesce(out["location_raw"], or_null(head(r("location_derived"))))}


def _hn_hiring(r):
    role, body = r("_role"), first(r, "text", "body", "content")
    words = F.filter(role["keywords"], lambda k: k.isNotNull() & (k != ""))
    keywords = F.when(F.coalesce(F.size(words), F.lit(0)) > 0, F.concat(F.lit("Keywords: "), F.array_join(words, ", ")))
    title = t.first_text(role["role"], role["title"])
    places = F.array_join(F.filter(F.transform(r("extracted.locations"), lambda x: joined(x["city"], x["country"])), lambda x: x != ""), "; ")
    comment = first(r, "commentId", "id")
    link = F.coalesce(or_null(t.first_text(role["url"])), or_null(first(r, "commentUrl", "url")))
    return {
        "title": title, "company_name": t.first_text(r("extracted.company")), "description": F.coalesce(or_null(F.concat_ws("\n\n", or_null(body), keywords)), title), "url": link, "published_at": F.coalesce(iso(first(r, "createdAt", "postedAt")), F.date_format(t.epoch_timestamp(r("time")), ISO)),
        "location_raw": or_null(places), "salary_min": r("extracted.salaryFrom"), "salary_max": r("extracted.salaryTo"), "external_id": F.when(comment != "", F.concat_ws("-", comment, r("_pos").cast("string"))).otherwise(link),
    }


def _faang(r):
    p = head(r("parsed_locations"))
    place = F.coalesce(or_null(joined(p["city"], p["state"], p["country"])), or_null(head(r("locations"))))
    return _rapid(title=("title", "job_title", "role"), company=("company", "company_name", "employer"), url=("company_url", "url", "apply_url", "job_url"), date=("earliest_date", "date_posted", "posted_at"), pay=False, ids=("job_id", "id"), text=("description", "summary"), place=("location",))(r) | {"location_raw": place}


def _hn_realtime(r):
    out = _rapid(title=("title", "role", "position", "job_title"), company=("company", "company_name", "organization"), url=("url", "apply_url", "hn_url", "link"), date=("posted_date", "date", "posted_at", "published_at", "created_at", "scraped_at"), pay=False, ids=("id", "hn_id"), text=("description", "text", "body"), place=("location", "city"))(r)
    return out | {"published_at": F.coalesce(out["published_at"], F.date_format(t.epoch_timestamp(F.coalesce(r("time"), r("timestamp"))), ISO))}


ROLE = "struct<role:string,title:string,url:string,keywords:array<string>>"
SOURCES = {
    s.name: s
    for s in (
        Source("adzuna", "title string, company struct<display_name:string>, description string, redirect_url string, location struct<display_name:string>, created string, salary_min string, salary_max string", _adzuna, "results", language="it", extra={"source": "Adzuna"}),
        Source("jooble", "title string, company string, snippet string, link string, location string, source string, updated string", _jooble, "jobs", keep=lambda r: ~t.closed_url(r("link"))),
        Source("iprogrammatori", "title string, company string, content string, url string, city string, date string", _iprogrammatori, fmt="xml", row_tag="job", language="it", search=lambda r: F.concat_ws(" ", r("title"), r("content")), extra={"source": "IProgrammatori"}),
        Source("arbeitnow", "title string, company_name string, description string, url string, location string, created_at string, tags array<string>", _arbeitnow, "data", search=lambda r: F.concat_ws(" ", r("title"), r("description"), F.array_join(r("tags"), " ")), extra={"source": "Arbeitnow"}),
        Source("remoteok", "legal string, position string, company string, description string, url string, apply_url string, tags array<string>, date string, location string", _remoteok, keep=lambda r: r("legal").isNull(), search=lambda r: F.concat_ws(" ", r("position"), F.array_join(r("tags"), " ")), extra={"source": "RemoteOK"}),
        Source("jobicy", "jobTitle string, companyName string, jobDescription string, url string, pubDate string, jobGeo string, annualSalaryMin string, annualSalaryMax string", _jobicy, "jobs", more="success boolean", keep=lambda r: F.col("success"), search=lambda r: F.concat_ws(" ", r("jobTitle"), r("jobDescription")), extra={"source": "Jobicy"}),
        Source("rss", "title string, link string, description string, pubDate string, author string, `dc:creator` string, `media:credit` string", _rss, fmt="xml", row_tag="item", search=lambda r: r("title"), extra={"source": "RSS Feed"}),
        Source("himalayas", "title string, companyName string, company struct<name:string>, applicationLink string, applicationUrl string, url string, pubDate string, publishedAt string, createdAt string, locationRestrictions array<string>, location string, description string, excerpt string, minSalary string, salaryMin string, maxSalary string, salaryMax string, currency string, guid string, id string, slug string", _himalayas, "jobs", extra={"source": "Himalayas"}),
        Source("remotive", "id string, title string, company_name string, url string, description string, publication_date string, candidate_required_location string", _remotive, "jobs", extra={"source": "Remotive"}),
        Source("themuse", "id string, name string, company struct<name:string>, refs struct<landing_page:string>, contents string, locations array<struct<name:string>>, publication_date string", _themuse, "results", unique=True, extra={"source": "TheMuse"}),
        Source("reed", "jobId string, jobTitle string, employerName string, jobUrl string, jobDescription string, locationName string, minimumSalary string, maximumSalary string, currency string, date string", _reed, "results", unique=True, extra={"source": "Reed"}),
        Source("jsearch", "job_id string, job_title string, employer_name string, job_apply_link string, job_description string, job_city string, job_country string, job_min_salary string, job_max_salary string, job_salary_currency string, job_posted_at_datetime_utc string, job_employment_type string, job_is_remote boolean, job_required_experience struct<no_experience_required:boolean,required_experience_in_months:long>, job_required_skills array<string>", _jsearch, "data", unique=True, extra={"source": "JSearch"}),
        Source("greenhouse", "id string, title string, absolute_url string, content string, location struct<name:string>, offices array<struct<name:string>>, updated_at string", _greenhouse, "jobs", more="_company string", extra={"source": "Greenhouse"}),
        Source("lever", "_company string, id string, text string, hostedUrl string, descriptionPlain string, description string, categories struct<team:string,location:string>, salaryRange struct<min:string,max:string,currency:string>, createdAt string", _lever, extra={"source": "Lever"}),
        Source("ashby", "id string, title string, jobUrl string, descriptionHtml string, description string, location string, locationName string, publishedAt string, compensation struct<minValue:string,min:string,maxValue:string,max:string,currencyCode:string,currency:string,interval:string>", _ashby, "jobs", more="_company string", extra={"source": "Ashby"}),
        Source("personio", "_company string, id string, name string, office string, createdAt string, created_at string, createDate string, publishedAt string, pubDate string, date string, jobDescriptions struct<jobDescription:array<struct<name:string,value:string>>>", _personio, fmt="xml", row_tag="position", extra={"source": "Personio"}),
        Source("active_jobs_db", f"{RAPID}, location_derived array<string>", _active, "data", unique=True, extra={"source": "Active Jobs DB"}),
        Source("workday_jobs", RAPID, _rapid(url=("url", "job_url", "apply_url", "external_url")), "data", unique=True, extra={"source": "Workday Jobs"}),
        Source("startup_jobs", RAPID, _rapid(), "data", unique=True, extra={"source": "Startup Jobs"}),
        Source("hn_hiring", f"commentId string, id string, commentUrl string, url string, createdAt string, postedAt string, time string, text string, body string, content string, extracted struct<company:string,locations:array<struct<city:string,country:string>>,salaryFrom:string,salaryTo:string,jobs:array<{ROLE}>>", _hn_hiring, "items", unique=True, extra={"source": "HN Who is Hiring", "fan_out": "extracted.jobs"}),
        Source("yc_jobs", RAPID, _rapid(title=("title", "job_title", "role", "position"), company=("company_name", "company", "organization", "startup"), place=("location", "city"), pay=False), "data", unique=True, extra={"source": "Y Combinator Jobs"}),
        Source("faang_watch", "job_id string, id string, title string, job_title string, role string, company string, company_name string, employer string, company_url string, url string, apply_url string, job_url string, description string, summary string, earliest_date string, date_posted string, posted_at string, location string, locations array<string>, parsed_locations array<struct<city:string,state:string,country:string>>", _faang, "batch", unique=True, extra={"source": "faang.watch"}),
        Source("hn_realtime", _keys(("id", "hn_id", "title", "role", "position", "job_title", "company", "company_name", "organization", "url", "apply_url", "hn_url", "link", "description", "text", "body", "posted_date", "date", "posted_at", "published_at", "created_at", "scraped_at", "location", "city", "time", "timestamp")), _hn_realtime, "data", unique=True, extra={"source": "HN Real-Time Jobs"}),
    )
}


def read_payload(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Payload files as records, one a row, in a column ``_r`` beside the fields of their container."""
    s = SOURCES[name]
    if s.fmt == "xml":
        return spark.read.schema(s.record).option("rowTag", s.row_tag).xml(path).select(F.struct("*").alias("_r"), *(["_company"] if "_company string" in s.record else []))
    if s.container is None:
        rows = spark.read.schema(s.record).option("multiLine", True).json(path)
        return rows.select(F.struct("*").alias("_r"), *(["_company"] if "_company string" in s.record else []))
    schema = f"{s.container} array<struct<{_nested(s.record)}>>" + (f", {s.more}" if s.more else "")
    rest = [x.split()[0] for x in s.more.split(", ")] if s.more else []
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode(s.container).alias("_r"), *rest)


def _nested(record: str) -> str:
    """A list of columns as the fields of a struct."""
    from pyspark.sql.types import StructType

    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in StructType.fromDDL(record).fields)


def canonical(records: DataFrame, name: str, language: str | None = None, keyword: str = "", order: str | None = None) -> DataFrame:
    """Canonical postings of a source in order of arrival (``arrival_idx`` within it); an empty keyword passes all.

    Records arrive by the column ``order``, which numbers them; without it by their places in the input, which have to be the same
    whenever it is read: files are, but not a sort, whose ranges come from a sample.  Several postings of a record need places.
    """
    s = SOURCES[name]
    if order and "fan_out" in s.extra:
        raise ValueError(f"{name} makes several postings of a record, which would share its number")
    r = lambda path: F.col(f"_r.{path}") if path not in ("_role", "_pos") else F.col(path)
    fan = s.extra.get("fan_out")
    rows = records.select("*", F.posexplode(r(fan)).alias("_pos", "_role")) if fan else records
    rows = rows.withColumn("_seq", F.col(order) if order else F.monotonically_increasing_id())
    if s.keep:
        rows = rows.filter(s.keep(r))
    if s.search and keyword:
        rows = rows.filter(F.contains(F.lower(s.search(r)), F.lit(keyword.lower())))
    fields = {"source": F.lit(s.extra.get("source", name)), "original_language": F.lit(language or s.language)} | s.fields(r)
    kinds = {"source_hints": "map<string,string>"}
    cols = [fields.get(n, F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in NAMES]
    out = rows.select("_seq", *cols)
    out = out.filter(" and ".join(f"coalesce({c}, '') <> ''" for c in ("url", "title", "company_name", "source")))
    if s.unique:
        out = keep_first(out.filter("coalesce(external_id, '') <> ''"), ["external_id"], [F.col("_seq")])
    return out.select(F.col("_seq").cast("long").alias("arrival_idx"), *NAMES)


def to_raw_jobs(postings: DataFrame) -> DataFrame:
    """Typed postings: repaired texts, dates in the three formats that are taken, whole salaries."""
    fixed = {c: t.fix_mojibake(F.col(c)) for c in ("title", "description", "company_name", "location_raw")}
    typed = {"salary_min": t.to_salary(F.col("salary_min")), "salary_max": t.to_salary(F.col("salary_max")), "posted_at": t.parse_posted(F.col("published_at"))}
    return postings.withColumns(fixed | typed).drop("published_at").filter("coalesce(url, '') <> '' and coalesce(title, '') <> '' and coalesce(company_name, '') <> '' and coalesce(source, '') <> ''")


def validate(postings: DataFrame) -> DataFrame:
    """Adds ``missing``: the names of required fields without a value."""
    names = ("url", "title", "company_name", "source", "description")
    missing = F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in names))
    return postings.withColumn("missing", F.filter(missing, lambda x: x.isNotNull()))


def union_all(parts: list[DataFrame], limit_each: int | None = None, limit: int | None = None, start: int = 0, places: bool = True) -> DataFrame:
    """Postings of all sources in registry order; the limits are features of the import command.

    Their arrival numbers are places in the input; if not, they may be any numbers and are counted.
    """
    tagged = [(p.orderBy("arrival_idx").limit(limit_each) if limit_each else p).withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    both = reduce(DataFrame.unionByName, tagged)
    out = dense(both, start) if places else counted(both, start)
    return out.orderBy("arrival_idx").limit(limit) if limit else out


def dense(rows: DataFrame, start: int = 0) -> DataFrame:
    """``arrival_idx`` numbered anew from ``start`` in order of ``_part`` and of itself, with gaps of dropped rows only.

    The number of a row is its place in its input partition, behind all earlier partitions; of these only the highest
    places reach the driver.  So numbers grow with the rows, and many imports one after the other do not run out of them.
    """
    spark, low = rows.sparkSession, (1 << 33) - 1
    split = rows.withColumns({"_task": F.shiftright("arrival_idx", 33), "_place": F.col("arrival_idx").bitwiseAND(F.lit(low))})
    tops = split.groupBy("_part", "_task").agg(F.max("_place").alias("top")).orderBy("_part", "_task").collect()
    found, at = [], start
    for r in tops:
        found.append((r["_part"], r["_task"], at))
        at += r["top"] + 1
    offsets = spark.createDataFrame(found, "_part int, _task long, _offset long")
    return split.join(F.broadcast(offsets), ["_part", "_task"]).withColumn("arrival_idx", F.col("_offset") + F.col("_place")).drop("_part", "_task", "_place", "_offset")


def counted(rows: DataFrame, start: int = 0) -> DataFrame:
    """``arrival_idx`` numbered anew from ``start`` in order of ``_part`` and of itself, without gaps, by sums over ranges."""
    numbered = running(rows, [F.lit(0)], ["_part", "arrival_idx"], F.lit(1), "_before")
    return numbered.withColumn("arrival_idx", (F.col("_before") + start).cast("long")).drop("_part", "_before")


def enabled_sources(registry: DataFrame, providers: DataFrame, denied: list[str], legacy: list[str]) -> DataFrame:
    """Sources that code enables, no list denies, and whose provider row, or else the older list, allows."""
    p = providers.select("slug", F.col("enabled").alias("_db"))
    allowed = F.coalesce(F.col("_db"), F.col("slug").isin(*legacy) if legacy else F.lit(False))
    out = registry.join(p, "slug", "left").filter(F.col("enabled") & allowed).drop("_db")
    return out.filter(~F.col("slug").isin(*denied)) if denied else out


def sweep(*dimensions: DataFrame) -> DataFrame:
    """Every combination of a request's parameters; each dimension is a short list."""
    out = dimensions[0]
    for d in dimensions[1:]:
        out = out.crossJoin(d)
    return out
