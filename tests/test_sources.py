import json

import pytest

from rolecast.schemas import CANONICAL
from rolecast.sources import payloads as p
from rolecast.sources import registry

BASE = {"title": "Data Engineer", "company_name": "ACME", "url": "https://a/1"}
RAPID = [{"id": "7", "job_title": "Data Engineer", "organization": "ACME", "url": "https://a/1", "description": "d", "location": "Rome", "date_posted": "2024-03-05T10:00:00Z", "salary_min": "10.9", "currency": "EUR"}]
ROLE = {"role": "Data Engineer", "keywords": ["x", "y"], "url": "https://a/1"}

# name, payload, more columns of the file, expected values
JSON = [
    ("adzuna", {"results": [{"title": "Data Engineer", "company": {"display_name": "ACME"}, "description": "<p>d</p>", "redirect_url": "https://a/1", "location": {"display_name": "Rome"}, "created": "2024-03-05T10:00:00Z", "salary_min": 10}]}, {"location_raw": "Rome", "salary_min": "10", "source": "Adzuna", "original_language": "it"}),
    ("jooble", {"jobs": [{"title": "Data Engineer", "company": "ACME", "snippet": "d", "link": "https://a/1", "source": "s", "updated": "2024-03-05"}, {"title": "x", "link": "https://a/2?closedJob=True"}]}, {"source": "Jooble (s)"}),
    ("arbeitnow", {"data": [BASE | {"description": "d", "location": "Rome", "created_at": 1709632800, "tags": ["t"]}]}, {"published_at": "2024-03-05"}),
    ("remoteok", [{"legal": "x"}, {"position": "Data Engineer", "company": "ACME", "apply_url": "https://a/1", "date": "2024-03-05T10:00:00+00:00", "tags": []}], {"published_at": "2024-03-05"}),
    ("jobicy", {"success": True, "jobs": [{"jobTitle": "Data Engineer", "companyName": "ACME", "url": "https://a/1", "jobDescription": "d", "annualSalaryMin": 5}]}, {"salary_min": "5"}),
    ("himalayas", {"jobs": [{"title": "Data Engineer", "company": {"name": "ACME"}, "applicationLink": "https://a/1", "pubDate": 1709632800000, "locationRestrictions": ["Italy", "Spain"], "guid": "g"}]}, {"published_at": "2024-03-05T10:00:00Z", "location_raw": "Italy, Spain", "external_id": "g"}),
    ("remotive", {"jobs": [BASE | {"id": 3, "publication_date": "2024-03-05"}]}, {"location_raw": "Remote", "external_id": "3"}),
    ("themuse", {"results": [{"id": 1, "name": "Data Engineer", "company": {"name": "ACME"}, "refs": {"landing_page": "https://a/1"}, "locations": [{"name": "Rome"}]}, {"id": 1, "name": "again", "company": {"name": "ACME"}, "refs": {"landing_page": "https://a/2"}, "locations": []}]}, {"location_raw": "Rome"}),
    ("reed", {"results": [{"jobId": 1, "jobTitle": "Data Engineer", "employerName": "ACME", "jobUrl": "https://a/1", "minimumSalary": 10.5, "maximumSalary": 0}]}, {"currency": "GBP", "salary_min": "10", "salary_max": None}),
    ("jsearch", {"data": [{"job_id": "1", "job_title": "Data Engineer", "employer_name": "ACME", "job_apply_link": "https://a/1", "job_city": "Rome", "job_country": "IT", "job_posted_at_datetime_utc": "2024-03-05T10:00:00Z", "job_employment_type": "fulltime", "job_is_remote": True, "job_required_experience": {"required_experience_in_months": 60}, "job_required_skills": [" a ", "", "b"]}]}, {"location_raw": "Rome, IT", "published_at": "2024-03-05T10:00:00Z", "source_hints": {"employment_type": "full_time", "remote_mode": "remote", "seniority": "senior", "skills": "a, b"}}),
    ("greenhouse", {"_company": "ACME", "jobs": [{"id": 1, "title": "Data Engineer", "absolute_url": "https://a/1", "offices": [{"name": "Rome"}], "location": {"name": "x"}}]}, {"location_raw": "Rome", "external_id": "1"}),
    ("lever", [{"_company": "ACME", "id": "1", "text": "Data Engineer", "hostedUrl": "https://a/1", "categories": {"team": "T"}, "salaryRange": {"min": 1, "currency": "EUR"}, "createdAt": 1709632800000}], {"location_raw": "T", "salary_min": "1", "published_at": "1709632800000"}),
    ("ashby", {"_company": "ACME", "jobs": [{"id": "1", "title": "Data Engineer", "jobUrl": "https://a/1", "compensation": {"minValue": 10.5, "maxValue": 20, "interval": "Hourly"}}]}, {"salary_min": "21840", "salary_max": "41600"}),
    ("active_jobs_db", {"data": RAPID + RAPID}, {"salary_min": "10", "published_at": "2024-03-05T10:00:00Z", "external_id": "7"}),
    ("workday_jobs", {"data": RAPID}, {"location_raw": "Rome"}),
    ("startup_jobs", {"data": RAPID}, {"currency": "EUR"}),
    ("hn_hiring", {"items": [{"commentId": "9", "commentUrl": "https://hn/9", "text": "body", "createdAt": "2024-03-05T10:00:00Z", "extracted": {"company": "ACME", "locations": [{"city": "Rome", "country": "IT"}], "jobs": [ROLE]}}]}, {"external_id": "9-0", "description": "body\n\nKeywords: x, y", "location_raw": "Rome, IT"}),
    ("yc_jobs", {"data": [{"id": "1", "role": "Data Engineer", "startup": "ACME", "url": "https://a/1"}]}, {"external_id": "1"}),
    ("faang_watch", {"batch": [{"job_id": "1", "title": "Data Engineer", "company": "ACME", "company_url": "https://a/1", "parsed_locations": [{"city": "Rome", "state": "", "country": "IT"}]}]}, {"location_raw": "Rome, IT"}),
    ("hn_realtime", {"data": [{"id": "1", "title": "Data Engineer", "company": "ACME", "url": "https://a/1", "time": 1709632800}]}, {"published_at": "2024-03-05T10:00:00Z"}),
]

XML = [
    ("iprogrammatori", "<jobs><job><title>Data Engineer</title><company>ACME</company><content>d</content><url>https://a/1</url><city>Roma</city><date>05/03/2024</date></job></jobs>", {"published_at": "2024-03-05T00:00:00Z", "location_raw": "Roma"}),
    ("rss", "<rss><channel><item><title>ACME - Data Engineer</title><link>https://a/1</link><pubDate>Tue, 05 Mar 2024 10:00:00 +0000</pubDate></item></channel></rss>", {"company_name": "ACME", "source": "RSS Feed", "title": "ACME - Data Engineer"}),
    ("personio", "<positions><position><_company>ACME</_company><id>5</id><name>Data Engineer</name><office>Roma</office><createdAt>2024-03-05T10:00:00+00:00</createdAt><jobDescriptions><jobDescription><name>n</name><value>v</value></jobDescription></jobDescriptions></position></positions>", {"url": "https://acme.jobs.personio.de/job/5", "description": "n\nv", "published_at": "2024-03-05T10:00:00Z"}),
]


def check(spark, name, path, expected):
    out = p.canonical(p.read_payload(spark, name, path), name)
    rows = out.collect()
    assert len(rows) == 1 and out.drop("arrival_idx").schema.simpleString() == spark.createDataFrame([], CANONICAL).select(*p.NAMES).schema.simpleString()
    want = {"title": "Data Engineer", "company_name": "ACME"} | expected
    assert {k: rows[0][k] for k in want} == want
    assert p.to_raw_jobs(out).count() == 1


@pytest.mark.parametrize(("name", "payload", "expected"), JSON, ids=[x[0] for x in JSON])
def test_json_sources(spark, tmp_path, name, payload, expected):
    (tmp_path / "x.json").write_text(json.dumps(payload))
    check(spark, name, f"file://{tmp_path}/x.json", expected)


@pytest.mark.parametrize(("name", "payload", "expected"), XML, ids=[x[0] for x in XML])
def test_xml_sources(spark, tmp_path, name, payload, expected):
    (tmp_path / "x.xml").write_text(payload)
    check(spark, name, f"file://{tmp_path}/x.xml", expected)


def test_all_sources_are_covered():
    assert {x[0] for x in JSON + XML} == set(p.SOURCES) and len(p.SOURCES) == 23


def test_keywords_union_and_gates(spark, tmp_path):
    rows = [BASE | {"description": "python", "created_at": 1, "tags": []}, BASE | {"url": "https://a/2", "description": "x", "created_at": 1, "tags": ["Python"]}, BASE | {"url": "https://a/3", "description": "x", "created_at": 1, "tags": []}]
    (tmp_path / "x.json").write_text(json.dumps({"data": rows}))
    records = p.read_payload(spark, "arbeitnow", f"file://{tmp_path}/x.json")
    one = p.canonical(records, "arbeitnow", keyword="PYTHON")
    assert one.count() == 2 and p.union_all([one, one], limit_each=1).count() == 2 and p.union_all([one, one], limit=3).count() == 3
    registry = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "slug string, enabled boolean")
    providers = spark.createDataFrame([("a", True), ("b", False)], "slug string, enabled boolean")
    assert sorted(r["slug"] for r in p.enabled_sources(registry, providers, [], ["d"]).collect()) == ["a", "d"]
    assert [r["slug"] for r in p.enabled_sources(registry, providers, ["a"], ["d"]).collect()] == ["d"]
    assert p.sweep(registry.select("slug"), providers.select("enabled")).count() == 8
    assert p.validate(one.limit(1).withColumn("url", one["url"].substr(1, 0)).drop("description").withColumn("description", one["currency"])).first()["missing"] == ["description"]


def test_torn_records_are_counted_and_break_nothing(spark):
    rows = [("a", '{"id": "1", "title": "T", "url": "https://x"}'), ("a", '{"id": "2", "title": "T'), ("a", ""), ("a", None), ("b", "<html>"), ("b", "[1"), ("c", '{"id": "3", "title": {"no": "text"}, "url": 5}'), ("c", "{}")]
    whole, log = registry.parsed(spark.createDataFrame(rows, "source string, record string"), "remotive")
    got = {r["source"]: (r["jobs_fetched"], r["n_torn"], r["failure_reason"]) for r in log.collect()}
    assert got["a"] == (1, 3, None) and got["b"] == (0, 2, "CONNECTOR_CRASH") and sum(got["c"][:2]) == 2
    assert whole.filter("source = 'a'").count() == 1 and whole.filter("source = 'b'").count() == 0


def test_arrival_numbers_of_a_key_do_not_hang_on_ranges_of_a_sort(spark, tmp_path):
    """Records in no order, in many files; ranges of a sort differ from run to run, as they do in large tables."""
    from rolecast.plans import catalogue

    ids = [(k * 7919) % 6000 + (1 << 34) * (k % 3) for k in range(6000)]
    spark.createDataFrame([(i, "x", "en", "s") for i in ids], "doc_id long, text string, lang string, source string").repartition(7).write.parquet(f"file://{tmp_path}/documents.parquet")
    conf = {"spark.sql.execution.rangeExchange.sampleSizePerPartition": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {(r["source"], r["url"]): r["place"] for r in catalogue.queries()["source_union"](spark, f"file://{tmp_path}").collect()}
        kept = {r["url"] for r in catalogue.queries()["source_themuse"](spark, f"file://{tmp_path}").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    named = sorted(i for i in ids if i % 13)
    url = "https://x.example.com/{}".format
    assert got == {(s, url(i)): n for n, (s, i) in enumerate([(s, i) for s in ("Adzuna", "Remotive") for i in named], 1)}
    first = {}
    for i in named:
        first.setdefault(i - i % 3, url(i))
    assert kept == set(first.values())


def test_several_postings_of_a_record_need_places(spark):
    with pytest.raises(ValueError, match="several postings"):
        p.canonical(spark.range(1), "hn_hiring", order="id")
