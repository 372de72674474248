"""Probers, tiers, older loaders, the store under two writers, the import over many runs, and the stream of similar postings."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolecast import cli, reports, shared
from rolecast.functions import language
from rolecast.operators import ai, dedupe, links, prefilter, probing, resolve, runs, store
from rolecast.plans import catalogue, catalogue_tables, importing
from rolecast.sources import payloads, registry
from rolecast.streaming import postings as streaming

NOW = datetime(2024, 3, 5)
AS_OF = "2024-03-05 00:00:00"
TEXT = "We build and run the data platform for many teams. You will write and review code every day. The work is remote and the team is small and kind. " * 2
RAW = "arrival_idx long, url string, title string, description string, company_name string, source string, posted_at timestamp, location_raw string, salary_min long, salary_max long, currency string, original_language string, external_id string, source_hints map<string,string>"


def posting(i, title="Data Engineer", company="ACME", source="a", days=1, text=TEXT, url=None):
    return (i, url or f"https://x.example.com/{i}", title, text, company, source, NOW - timedelta(days=days), None, None, None, None, "en", None, None)


# Calls


def test_calls_are_repeated_where_that_can_help():
    waits, calls = [], []

    def call(outcomes):
        def run():
            calls.append(1)
            x = outcomes[len(calls) - 1]
            if isinstance(x, Exception):
                raise x
            return probing.Reply(x)

        return run

    for outcomes, status, n in (([200], 200, 1), ([500, 429, 200], 200, 3), ([503, 503, 503], 503, 3), ([404], 404, 1), ([probing.ProbeError("timeout"), 200], 200, 2)):
        calls.clear()
        assert probing.with_retry(call(outcomes), waits.append).status == status and len(calls) == n
    assert waits[:2] == [1.0, 2.0] and probing.waits(6) == [1.0, 2.0, 4.0, 8.0, 10.0]
    calls.clear()
    with pytest.raises(probing.ProbeError):
        probing.with_retry(call([probing.ProbeError("dns")]), waits.append)
    assert len(calls) == 1 and not probing.retryable(ValueError()) and probing.retryable(status=599) and not probing.retryable(status=600)


def test_limiter_keeps_its_rate():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 6))
        now[0] += s

    limiter = probing.Limiter.per_minute(30, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        limiter.acquire()
    assert slept == [2.0, 2.0]
    shared_rate = probing.Limiter(1.0, 4, clock=lambda: now[0], sleep=sleep)
    for key in ("a", "b", "a"):
        shared_rate.acquire(key)
    assert slept[2:] == [4.0]


def asked_locally(prompt, call, sleep=lambda s: None):
    """The row that ``ask`` makes of one request, without a cluster: its function is taken from the plan that it makes."""
    found = {}

    class Frame:
        def select(self, *_):
            return self

        def mapInPandas(self, run, schema):  # noqa: N802
            found["run"] = run

    ai.ask(Frame(), call, "FAST", sleep=sleep)
    out = list(found["run"](iter([pd.DataFrame([("k", prompt)], columns=["cache_key", "prompt"])])))
    return out[0].to_dict("records")[0]


def test_model_calls_are_repeated_and_failures_are_rows():
    seen, pauses = [], []

    def busy(prompt):
        seen.append(prompt)
        if len(seen) < 3:
            raise ai.TransientError("busy")
        return ai.Answer('{"confidence": 1}', "m", 5, 7, 9)

    row = asked_locally("p", busy, pauses.append)
    assert (row["attempts"], row["error"], row["tokens_in"], pauses) == (3, None, 5, [2, 4])
    seen.clear()

    def torn(prompt):
        seen.append(prompt)
        return "[]", "m"

    row = asked_locally("p", torn)
    assert row["content"] is None and row["attempts"] == 3 and row["error"].startswith("invalid") and seen[0] == "p" and "could not be read" in seen[2]

    def refusing(prompt):
        raise KeyError("x")

    row = asked_locally("p", refusing)
    assert row["attempts"] == 1 and row["error"].startswith("KeyError")
    assert ai.wrong('[{"a": 1}]') is None and ai.wrong("3") and ai.wrong("{")


def test_tiers_and_prompts():
    assert ai.tiers_of("EXTRACT") == ["FAST", "STRUCT"] and ai.tiers_of("EXTRACT", hops=0) == ["FAST"] and ai.tiers_of("TRIAGE") == ["FAST"] and ai.tiers_of("SPAM_CHECK") == ["REASON"]
    with pytest.raises(KeyError):
        ai.get_prompt("extract", "v9")
    assert set(json.loads(ai.get_prompt("extract", "v1")[1])["required"]) <= set(json.loads(ai.get_prompt("extract", "v1")[1])["properties"])


# Store


def test_two_writers_of_one_version(spark, tmp_path):
    one, two = (store.Store(spark, f"file://{tmp_path}/t", 4) for _ in range(2))
    df = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int")
    one.merge("t", df, "k", [F.col("v")])
    version = two.version
    two.version = lambda table: 0  # as if it had looked before the first wrote
    with pytest.raises(store.Conflict):
        two.write("t", df.limit(1))
    two.version = version
    assert one.version("t") == 1 and one.read("t").count() == 20


def test_a_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/t", 8)
    s.merge("t", spark.createDataFrame([(f"k{i}", i) for i in range(100)], "k string, v int"), "k", [F.col("v")])
    before = s.manifest("t")["folders"]
    s.merge("t", spark.createDataFrame([("k5", -1), ("k5", 3)], "k string, v int"), "k", [F.col("v")])
    after = s.manifest("t")["folders"]
    assert sum(before[b] != after[b] for b in before) == 1 and {r["v"] for r in s.read("t").filter("k = 'k5'").collect()} == {-1} and s.read("t").count() == 100
    s.merge("t", spark.createDataFrame([("k5", 9), ("new", 1)], "k string, v int"), "k", [F.col("v")], absent=True)
    assert {r["v"] for r in s.read("t").filter("k in ('k5', 'new')").collect()} == {-1, 1} and s.read("t").count() == 101
    s.write("t", s.read("t").limit(3))
    s.merge("t", spark.createDataFrame([("other", 1)], "k string, v int"), "k", [F.col("v")])
    assert s.read("t").count() == 4 and len(s.versions("t")) == store.KEPT
    s.append("t", spark.createDataFrame([("more", 1)], "k string, v int"))
    assert s.read("t").count() == 5 and s.recreate("t", spark.createDataFrame([("only", 1)], "k string, v int"), confirm=True) == 1


# Import


def payload(tmp_path, name, n, start=0):
    rows = [{"id": start + i, "title": f"Job {start + i} {'abcdefgh'[i % 8]}", "company_name": f"Company {i % 3}", "url": f"https://x.example.com/{name}/{start + i}", "description": TEXT, "publication_date": "2024-03-04T10:00:00Z"} for i in range(n)]
    (tmp_path / f"{name}.json").write_text(json.dumps({"jobs": rows}))
    return f"file://{tmp_path}/{name}.json"


def test_arrival_numbers_stay_small_over_many_imports(spark, tmp_path):
    path, top = payload(tmp_path, "remotive", 9), 0
    for _ in range(30):
        one = payloads.canonical(payloads.read_payload(spark, "remotive", path), "remotive").repartition(3)
        out = payloads.union_all([one, one], start=top)
        rows = [r["arrival_idx"] for r in out.collect()]
        assert len(set(rows)) == 18 and min(rows) >= top
        top = max(rows) + 1
    assert top <= 30 * 18


def test_command_line_import_writes_all_tables(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    good, root = payload(tmp_path, "remotive", 6), f"file://{tmp_path}/root"
    (tmp_path / "broken.json").write_text("{")
    for day in range(1, 5):
        args = ["import", "--root", root, "--payload", f"remotive={good}", "--payload", f"himalayas=file://{tmp_path}/missing.json", "--as-of", f"2024-03-0{day} 12:00:00", "--report", f"file://{tmp_path}/r.md", "--health", f"file://{tmp_path}/h.json"]
        assert cli.main(args) == 0
    s = store.Store(spark, root)
    assert s.read("jobs").count() == 6 and s.read("jobs").filter("company_id is null").count() == 0
    assert s.read("companies").count() == 3 and s.read("import_runs").count() == 8 and s.read("import_reports").count() == 4
    off = {r["slug"]: r["enabled"] for r in s.read("providers").collect()}
    assert off == {"Himalayas": False}
    crash = s.read("import_runs").filter("connector_crashed").first()
    assert crash["status"] == "failed" and sum(crash["failure_reasons"].values()) == 1
    last = s.read("import_reports").orderBy(F.desc("started_at")).first()
    assert last["total_sources"] == 2 and last["failure_reasons"]["DUPLICATE"] == 6 and len(last["errors"]) == 1
    assert "## Stages" in (tmp_path / "r.md").read_text() and json.loads((tmp_path / "h.json").read_text())["last_command"] == "import"
    for command in ("stats", "reindex", "repair", "duplicates", "expire", "geocode"):
        assert cli.main([command, "--root", root, "--as-of", AS_OF]) in (0, 1)
    assert cli.main(["stats", "--root", f"file://{tmp_path}/none"]) == 1
    assert '"run_id"' in capsys.readouterr().err


def test_metered_sources_stop_at_their_budget(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    rows = [{"id": str(i), "title": f"Job {i}", "company": f"C{i}", "url": f"https://x.example.com/{i}", "description": TEXT, "date_posted": "2024-03-04T10:00:00Z"} for i in range(200)]
    (tmp_path / "w.json").write_text(json.dumps({"data": rows}))
    counts = []
    for day in ("2024-03-05", "2024-03-06", "2024-04-01"):
        assert cli.main(["import", "--root", f"file://{tmp_path}/root", "--payload", f"workday_jobs=file://{tmp_path}/w.json", "--as-of", f"{day} 00:00:00"]) == 0
        counts.append(store.Store(spark, f"file://{tmp_path}/root").read("import_runs").agg(F.sum("jobs_fetched")).first()[0])
    assert counts == [200, 250, 450]


def test_observations_are_taken_in_a_known_order(spark):
    rows = spark.createDataFrame([posting(1)], RAW)
    seen = spark.createDataFrame([("https://x.example.com/1", 500, None, 0, None), ("https://x.example.com/1", 404, None, 0, None)], "url string, status_code int, final_url string, n_redirects int, error_kind string")
    for parts in (1, 3):
        assert importing.with_observations(rows, seen.repartition(parts)).first()["url_reason"] == "http_404"


def test_import_asks_the_model_for_what_is_not_recorded(spark):
    batch = spark.createDataFrame([posting(i, title=("Nurse", "Plumber", "Driver")[i % 3], company=f"C{i}") for i in range(6)], RAW)
    empty = dedupe.with_hashes(prefilter.prefilter(batch, F.lit(AS_OF).cast("timestamp"))).withColumn("url_invalid", F.lit(False)).limit(0)
    seen = spark.createDataFrame([], "url string, status_code int, final_url string, n_redirects int, error_kind string")
    none = spark.createDataFrame([], "cache_key string, content string, model string, tier string, confidence double")

    def sure(prompt):
        return json.dumps({"skills": ["python", "sql"], "seniority": "senior", "employment_type": "contract", "remote_mode": "remote", "confidence": 0.9}), "m"

    def refuse(prompt):
        raise AssertionError("a recorded answer was asked for again")

    done = importing.run(batch, empty, seen, none, AS_OF, calls={"FAST": sure, "STRUCT": sure})
    stages = done.stages.first()
    assert stages["total"] == 6 and stages["ai_classified"] == 6 and stages["ai_unavailable"] == 0 and stages["persisted"] == 6 and done.results.count() == 6
    again = importing.run(batch, empty, seen, done.results, AS_OF, calls={"FAST": refuse, "STRUCT": refuse})
    assert again.stages.first()["ai_classified"] == 6 and again.results.count() == 0


def test_rejected_rows_of_one_company_need_no_fold(spark):
    raw = [posting(i, title=f"T{i % 5}", company="N/A", source="ab"[i % 2]) for i in range(40)] + [posting(100 + i, title="Same", company="Real", source="ab"[i % 2]) for i in range(6)]
    rows = dedupe.with_hashes(prefilter.prefilter(spark.createDataFrame(raw, RAW), F.lit(AS_OF).cast("timestamp"))).withColumn("url_invalid", F.lit(False))
    got = {r["arrival_idx"]: r for r in resolve.resolve(rows, rows.limit(0), AS_OF).collect()}
    assert len(got) == 46 and all(got[i]["outcome"] == "rejected_prefilter" for i in range(40))
    assert sorted(i for i in range(40) if got[i]["inserted"]) == list(range(10))
    assert [got[100 + i]["outcome"] for i in range(4)] == ["new", "cross_source_hit", "dedupe_hit", "cross_source_hit"]


def test_registry_and_fixtures(spark, tmp_path):
    (tmp_path / "boards.json").write_text(json.dumps({"greenhouse": [{"name": "ACME", "slug": "acme"}, {"name": "", "slug": "solo"}], "lever": []}))
    listed = registry.boards(spark, f"file://{tmp_path}/boards.json", "greenhouse")
    records = spark.createDataFrame([("acme", 1), ("solo", 2), ("gone", 3)], "_slug string, n int")
    assert {r["n"]: r["_company"] for r in registry.with_company(records, listed).collect()} == {1: "ACME", 2: "solo"}
    assert registry.boards(spark, f"file://{tmp_path}/boards.json", "ashby").count() == 0
    (tmp_path / "f").mkdir()
    for k in "ba":
        (tmp_path / "f" / f"{k}.json").write_text(json.dumps({"name": k}, indent=1))
    assert [(r["name"], r["n"]) for r in registry.fixtures(spark, f"file://{tmp_path}/f", "name string").orderBy("n").collect()] == [("a", 0), ("b", 1)]
    parts, log = registry.isolated(["a", "b"], lambda n: spark.read.schema("x int").json(f"file://{tmp_path}/none-{n}") if n == "b" else spark.range(3), spark)
    rows = {r["source"]: r for r in log.collect()}
    assert list(parts) == ["a"] and rows["a"]["jobs_fetched"] == 3 and rows["b"]["failure_reason"] is not None


# Streams


def test_daily_counts_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "event_id long, event_type string, ts timestamp").write.parquet(f"file://{tmp_path}/e.parquet")
    assert streaming.daily_counts_to_completion(spark, f"file://{tmp_path}/e.parquet").count() == 0


# The rest


def test_reports_are_whole_or_an_error(spark, tmp_path):
    text = reports.markdown("T", {"a": 1}, {"x": spark.createDataFrame([("a|b", None)], "k string, v int")})
    assert "| a\\|b |  |" in text
    reports.write_text(spark, f"file://{tmp_path}/r.md", text)
    reports.write_text(spark, f"file://{tmp_path}/r.md", "new")
    assert (tmp_path / "r.md").read_text() == "new"
    with pytest.raises(ValueError):
        reports.table(spark.range(5), most=4)


def test_budget_limits_a_scan(spark):
    records = spark.range(10).selectExpr("'p' provider", "id seq")
    used = spark.createDataFrame([("p", 3)], "provider string, used long")
    assert runs.within_budget(records, used, cap=8, page=2).select("seq", "page_no").orderBy("seq").collect() == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]
    assert runs.within_budget(records, used, cap=0).count() == 10 and runs.within_budget(records, used, cap=2).count() == 0


def test_languages_of_the_documents(spark):
    rows = catalogue.queries()["language_detect_accuracy"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 <= r["accuracy"] <= 1 for r in rows)
    assert [language.detect(x)[0] for x in ("we are looking for an engineer with the skills of a builder", "cerchiamo uno sviluppatore per il nostro ufficio di Milano", "wir suchen einen Entwickler für das Büro in der Stadt")] == ["en", "it", "de"]


def test_folders_that_all_share(spark):
    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    path = shared.scratch(spark, "x")
    spark.range(2).write.parquet(path)
    shared.drop(spark, path)
    with pytest.raises(Exception):  # noqa: B017, PT011
        spark.read.parquet(path).count()
    assert links.one_of(F.lit("A"), "") is not None and catalogue_tables.no_wait(1) is None
