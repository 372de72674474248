import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolecast.operators import ai, companies, dedupe, geocode, liveness, prefilter, resolve, runs, stats, store
from rolecast.plans import importing

AS_OF = "2024-03-05 00:00:00"
NOW = datetime(2024, 3, 5)
TEXT = "We build and run the data platform for many teams. You will write and review code every day. The work is remote and the team is small and kind. " * 2
RAW = "arrival_idx long, url string, title string, description string, company_name string, source string, posted_at timestamp, location_raw string, salary_min long, salary_max long, currency string, original_language string, external_id string, source_hints map<string,string>"


def posting(i, title="Data Engineer", company="ACME", source="a", days=1, text=TEXT, lang="en", url=None, low=None, high=None):
    return (i, url or f"https://x.example.com/{i}", title, text, company, source, None if days is None else NOW - timedelta(days=days), None, low, high, None, lang, None, None)


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None), ({"title": "  "}, "MISSING_REQUIRED_FIELDS"), ({"company": "N/A"}, "MISSING_REQUIRED_FIELDS"), ({"url": "ftp://x"}, "MISSING_REQUIRED_FIELDS"), ({"url": "https://x/?closedJob=true"}, "CLOSED_LISTING"),
        ({"days": None}, "MISSING_REQUIRED_FIELDS"), ({"days": 60}, None), ({"days": 61}, "EXPIRED_LISTING"), ({"text": "x" * 199}, "DESCRIPTION_TOO_SHORT"), ({"lang": "ja", "text": "日本語の求人です。" * 40}, "LANGUAGE_NOT_SUPPORTED"),
        ({"lang": "ja"}, None), ({"title": "A B C D E"}, "SUSPECTED_SPAM"), ({"title": "A B C D"}, None), ({"title": "", "days": 90}, "MISSING_REQUIRED_FIELDS"),
    ],
)
def test_prefilter(spark, change, reason):
    df = spark.createDataFrame([posting(1, **change)], RAW)
    assert prefilter.prefilter(df, F.lit(AS_OF).cast("timestamp")).first()["prefilter_reason"] == reason


def sequential(rows, horizon):
    """The fold over the whole batch, without companies kept apart."""
    return resolve.fold([dict(r) for r in rows], horizon)


@pytest.mark.parametrize("seed", range(8))
def test_resolution_equals_the_sequential_fold(spark, seed):
    rng = random.Random(seed)
    titles = ["Software Engineer - Backend", "Software Engineer Backend", "Data Engineer", "Data  Engineér", "Nurse", "Senior Software Engineer Backend"]
    companies = ["ACME", "Café X", "ACME ", "日本", ""] if seed < 4 else ["ACME"]  # one company: every title meets every other, and hashes repeat often
    raw = [posting(i, title=rng.choice(titles), company=rng.choice(companies), source=rng.choice("abC"), days=rng.choice([1, 5, 13, 20, 70])) for i in range(40 + 40 * (seed >= 4))]
    df = dedupe.with_hashes(prefilter.prefilter(spark.createDataFrame(raw, RAW), F.lit(AS_OF).cast("timestamp"))).withColumn("url_invalid", F.col("arrival_idx") % 9 == 4)
    stored, batch = df.filter("arrival_idx < 8"), df.filter("arrival_idx >= 8")
    names = [c.split()[0] for c in resolve.COLUMNS.split(", ")]
    rows = [r.asDict() for r in stored.withColumn("stored", F.lit(True)).select(*names).orderBy("arrival_idx").collect()] + [r.asDict() for r in batch.withColumn("stored", F.lit(False)).select(*names).orderBy("arrival_idx").collect()]
    expected = {(i, o, None if t is None else t, ins) for i, o, t, ins in sequential(rows, pd.Timestamp(AS_OF) - pd.Timedelta(days=14))}
    for parts in (5,):
        got = {(r["arrival_idx"], r["outcome"], r["target_idx"], r["inserted"]) for r in resolve.resolve(batch.repartition(parts), stored, AS_OF).collect()}
        assert got == expected


def test_keep_first_and_newest(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 4), (3, None, 1), (4, "b", 1)], "id int, k string, v int")
    assert sorted((r["id"], r["k"]) for r in dedupe.keep_first(df, ["k"], [F.col("v")]).collect()) == [(2, "a"), (4, "b")]
    assert {r["id"]: r["kept"] for r in dedupe.newest_kept(df, "k", "id").collect()} == {1: False, 2: True, 3: True, 4: True}


def test_merges(spark):
    target = spark.createDataFrame([(1, "short", NOW, 10, None, None)], "arrival_idx long, description string, posted_at timestamp, salary_min long, salary_max long, seen_count long")
    hits = spark.createDataFrame([(2, 1, "longest text", NOW - timedelta(days=2), 5, 50), (3, 1, "longest tex2", NOW, None, 40), (4, 1, "x", None, 20, None)], "arrival_idx long, target_idx long, description string, posted_at timestamp, salary_min long, salary_max long")
    r = dedupe.merge_cross_source(target, hits).first()
    assert (r["description"], r["salary_min"], r["salary_max"], r["seen_count"], r["posted_at"]) == ("longest text", 5, 50, 3, NOW - timedelta(days=2))
    r = dedupe.merge_same_source(target, hits).first()
    assert (r["description"], r["salary_min"], r["seen_count"]) == ("short", 10, 3)


def metric_row(name, *values):
    return (name, *values)


METRICS = "name_normalized string, total_jobs_seen long, total_jobs_passed long, sum_quality_scores double, jobs_with_salary long, jobs_with_skills long, premium_count long, jobs_with_seniority long, sum_description_length long"


def test_trust_scores(spark):
    df = spark.createDataFrame([("none", 0, 0, 0.0, 0, 0, 0, 0, 0), ("best", 10, 10, 1000.0, 10, 10, 10, 10, 30000)], METRICS)
    assert {r["name_normalized"]: r["s"] for r in df.select("name_normalized", companies.trust_score().alias("s")).collect()} == {"none": 80.0, "best": 100.0}
    stored = df.withColumn("trust_score", F.lit(1.0))
    out = {r["name_normalized"]: r for r in companies.update_stored(stored, df.filter("name_normalized = 'best'")).collect()}
    assert out["best"]["total_jobs_seen"] == 20 and out["best"]["trust_score"] == 100.0 and out["none"]["trust_score"] == 1.0
    batch = spark.createDataFrame([("new", "New Co", 2), ("new", "New Inc", 1), ("best", "Best", 3)], "name_normalized string, company_name string, arrival_idx long")
    known = stored.withColumns({"name": F.lit("old"), "company_id": F.lit("id")})
    found = {r["name_normalized"]: r for r in companies.upsert_companies(known, batch).collect()}
    assert found["new"]["name"] == "New Inc" and found["new"]["trust_score"] == 80.0 and found["new"]["total_jobs_seen"] == 0 and found["best"]["total_jobs_seen"] == 10


def test_report_of_three_sources(spark):
    s = spark.createDataFrame([("r", 100, 80, 90, 3, 2, 1, 4), ("r", 50, 30, 40, 2, 1, 0, 2), ("r", 20, 15, 13, 0, 1, 0, 0)], "report_id string, jobs_fetched long, passed_quality_gate long, jobs_stored long, jobs_duplicated long, url_invalid_count long, soft_404_count long, quality_failures long")
    f = spark.createDataFrame([("r", "URL_INVALID", 2), ("r", "LOW_CONFIDENCE", 1)], "report_id string, reason string, n long")
    r = runs.report_rollup(s, f).first()
    assert (r["total_sources"], r["total_fetched"], r["total_passed_quality"], r["total_upserted"]) == (3, 170, 125, 143)
    assert (r["total_skipped_duplicate"], r["total_url_invalid"], r["total_expired_detected"], r["total_failed_quality"]) == (5, 6, 1, 7)
    errors = spark.createDataFrame([("r", i, f"e{i}") for i in range(130)], "report_id string, seq int, error string")
    assert runs.bounded_errors(errors, "report_id").first()["errors"] == [f"e{i}" for i in range(30, 130)]


def test_runs_and_budgets(spark):
    rows = [("p", i, NOW + timedelta(hours=i), s) for i, s in enumerate(["failed", "success", "failed", "failed"])] + [("q", i, NOW, "failed") for i in range(3)] + [("s", 0, NOW, "failed")]
    df = spark.createDataFrame(rows, "provider string, id int, started_at timestamp, status string")
    assert {r["provider"]: r["streak"] for r in runs.failure_streak(df).collect()} == {"p": 2, "q": 3, "s": 1}
    assert {r["provider"]: r["should_disable"] for r in runs.should_disable(df).collect()} == {"p": False, "q": True, "s": False}
    pages = spark.createDataFrame([("p", i, NOW + timedelta(hours=i), 100) for i in range(4)], "provider string, id int, ts timestamp, n long")
    assert [r["taken"] for r in sorted(runs.monthly_budget(pages).collect(), key=lambda r: r["id"])] == [100, 100, 50, 0]
    assert all(r["allowed"] for r in runs.daily_allowed(pages, 0).collect())
    assert [r["allowed"] for r in sorted(runs.daily_allowed(pages, 2).collect(), key=lambda r: r["id"])] == [True, True, False, False]


@pytest.mark.parametrize(
    ("row", "valid", "reason"),
    [((404, "https://a/x", 0, None), False, "http_404"), ((410, "https://a/x", 0, None), False, "http_410"), ((200, "https://a/", 1, None), False, "redirect_to_root"), ((200, "https://a/careers/?x=1", 2, None), False, "redirect_to_root"), ((200, "https://a/", 0, None), True, "ok"), ((403, "https://a/x", 0, None), True, "transient"), ((None, None, None, "timeout"), True, "timeout"), ((None, None, None, "dns"), False, "dns_error")],
)
def test_url_verdicts(spark, row, valid, reason):
    df = spark.createDataFrame([("https://a/x", *row)], "url string, status_code int, final_url string, n_redirects int, error_kind string")
    v = df.select(liveness.url_verdict().alias("v")).first()["v"]
    assert (v["is_valid"], v["reason"]) == (valid, reason)


def test_soft_404_and_sweep(spark):
    bodies = [("OFFRE EXPIRÉE", True), ("x" * 500 + "offre expirée", False), ("Stelle nicht mehr verfügbar", True), ("all good", False), (None, False)]
    got = spark.createDataFrame(bodies, "b string, e boolean").select("b", "e", liveness.soft_404(F.col("b")).alias("g")).collect()
    assert all(r["e"] == r["g"] for r in got)
    own = {"board": ["gone now"]}
    row = spark.createDataFrame([("u", "board", 200, None, "It is Gone Now", None)], "url string, source string, head_status int, location string, body string, error_kind string")
    v = row.select("url", liveness.expiry_verdict(own).alias("verdict"))
    assert v.first()["verdict"]["reason"] == "EXPIRED_PATTERN"
    jobs = spark.createDataFrame([("u", "active", None, None), ("w", "active", None, None)], "url string, status string, reject_reason string, last_probed_at timestamp")
    out = {r["url"]: r for r in liveness.apply_verdicts(jobs, v, F.lit(AS_OF).cast("timestamp")).collect()}
    assert out["u"]["status"] == "expired" and out["u"]["last_probed_at"] == NOW and out["w"]["status"] == "active" and out["w"]["last_probed_at"] is None


def test_model_answers(spark):
    good = '{"skills":["Python","Talk"],"seniority":"senior","confidence":0.9,"salary_min":1000.7,"field_confidence":{"salary":2,"other":1}}'
    results = spark.createDataFrame([("k1", good, "m", "fast", 0.9), ("k2", "no json", "m", "fast", 0.1), ("k3", f"[{good}]", "m", "fast", 0.9), ("k4", '{"confidence":0.2}', "m", "fast", 0.2)], "cache_key string, content string, model string, tier string, confidence double")
    got = {r["cache_key"]: r["output"] for r in ai.usable_results(results).collect()}
    assert set(got) == {"k1", "k3", "k4"} and got["k1"]["salary_min"] == 1000 and got["k1"]["field_confidence"] == {"salary": 1.0} and got["k4"]["seniority"] == "unknown"
    asked = spark.createDataFrame([(f"k{i}", "p") for i in range(1, 6)], "cache_key string, prompt string")
    assert sorted(r["cache_key"] for r in ai.misses(asked, results).collect()) == ["k2", "k5"]
    assert sorted(r["cache_key"] for r in ai.ask(ai.misses(asked, results), lambda p: (good, "m2"), "fast").collect()) == ["k2", "k5"]
    second = results.filter("cache_key = 'k1'").withColumn("cache_key", F.lit("k4"))
    up = {r["cache_key"]: r["escalated"] for r in ai.escalated(results, second).collect()}
    assert up == {"k1": False, "k3": False, "k4": True}
    assert "k4" not in {r["cache_key"] for r in ai.escalated(results, second.limit(0)).collect()}


def test_geocoding(spark):
    payload = '[{"lat":"45.1","lon":"9.2","display_name":"Milano","address":{"town":"Milano","country_code":"it"}}]'
    jobs = spark.createDataFrame([(1, " Milano ", True), (2, "Nowhere", True), (3, None, True)], "id int, location_raw string, geocode_pending boolean")
    assert geocode.candidates(jobs, "id").count() == 2
    answers = spark.createDataFrame([("Milano", payload), ("Nowhere", '[{"lat":"95","lon":"9"}]')], "address string, payload string")
    out = {r["id"]: r for r in geocode.apply_answers(jobs, answers).collect()}
    assert out[1]["city"] == "Milano" and out[1]["country"] == "IT" and out[1]["location_geo"]["coordinates"] == [9.2, 45.1] and not out[1]["geocode_pending"]
    assert out[2]["geocode_pending"] and out[3]["geocode_pending"] and out[2]["city"] is None


def test_store(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/tables")
    a = spark.createDataFrame([("x", 1), ("y", 1)], "k string, v int")
    assert not s.exists("t") and s.write("t", a) == 1
    b = spark.createDataFrame([("y", 2), ("y", 3), ("z", 2)], "k string, v int")
    s.write("t", store.upsert(s.read("t"), b, "k", [F.col("v")]))
    assert sorted(map(tuple, s.read("t").collect())) == [("x", 1), ("y", 2), ("z", 2)]
    s.write("t", store.insert_absent(s.read("t"), b, "k", [F.col("v")]))
    assert s.version("t") == 3 and s.read("t").count() == 3
    seeded = store.seed(spark.createDataFrame([("p", False, "old")], "slug string, enabled boolean, label string"), spark.createDataFrame([("p", True, "new"), ("q", True, "q")], "slug string, enabled boolean, label string"), "slug")
    assert sorted(map(tuple, seeded.select("slug", "enabled", "label").collect())) == [("p", False, "new"), ("q", True, "q")]
    with pytest.raises(ValueError):
        s.drop("t")
    s.drop("t", confirm=True)
    assert not s.exists("t")


def test_import_is_idempotent(spark):
    raw = [posting(i + 100, title=("Nurse", "Plumber", "Bus Driver", "Chemistry Teacher")[i % 4], company=f"C{i % 3}", source="ab"[i % 2], low=10, high=20) for i in range(16)] + [posting(200, title=""), posting(201, url="https://dead.example.com/1", title="Dead one")]
    batch = spark.createDataFrame(raw, RAW)
    seen = spark.createDataFrame([("https://dead.example.com/1", 404, None, 0, None)], "url string, status_code int, final_url string, n_redirects int, error_kind string")
    results = spark.createDataFrame([], "cache_key string, content string, model string, tier string, confidence double")
    empty = dedupe.with_hashes(prefilter.prefilter(batch, F.lit(AS_OF).cast("timestamp"))).withColumn("url_invalid", F.lit(False)).limit(0)
    one = importing.run(batch, empty, seen, results, AS_OF)
    counts = {r["outcome"]: r["n"] for r in one.counters.collect()}
    assert sum(counts.values()) == 18 and counts["rejected_prefilter"] == 1 and counts["url_invalid"] == 1 and counts["ai_unavailable"] == 12
    assert one.jobs.count() == 14
    stored = one.jobs.withColumn("arrival_idx", F.col("arrival_idx") - 1000)
    again = importing.run(batch, stored, seen, results, AS_OF)
    second = {r["outcome"]: r["n"] for r in again.counters.collect()}
    assert set(second) <= {"dedupe_hit", "cross_source_hit", "rejected_prefilter", "url_invalid"} and not again.resolved.filter("inserted").count()


def test_status_migration(spark):
    df = spark.createDataFrame([("valid", None), ("premium", None), ("active", "valid"), (None, None)], "status string, quality_tier string")
    assert [tuple(r) for r in stats.migrate_status(df).collect()] == [("active", "valid"), ("active", "premium"), ("active", "valid"), (None, None)]
