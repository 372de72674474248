import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rolecast.functions import fuzzy, html, language, quality, skills
from rolecast.functions import text as t


def value(spark, expr, **cols):
    df = spark.range(1)
    for k, v in cols.items():
        df = df.withColumn(k, F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v)).cast("array<string>"))
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(("raw", "folded"), [("  Ingénieur  Données\n", "ingenieur donnees"), ("ABC", "abc"), ("łódź", "odz"), ("日本", ""), ("ﬁn Ⅷ", "fin viii"), ("a b", "a b"), ("", "")])
def test_normalize_text(spark, raw, folded):
    assert value(spark, t.normalize_text(F.col("x")), x=raw) == folded


def test_hashes(spark):
    assert value(spark, t.dedup_hash(F.lit("a"), F.lit("b"), F.lit("SrC"))) == hashlib.sha1(b"a|b|src").hexdigest()
    assert value(spark, t.cache_key("extract", "v1", F.lit("p"))) == hashlib.sha256(b"extract\0v1\0p").hexdigest()


@pytest.mark.parametrize(("url", "ok"), [("https://a.b/c", True), ("HTTP://a", True), ("ftp://a", False), ("https:///x", False), ("a.b/c", False), ("", False)])
def test_urls(spark, url, ok):
    assert value(spark, t.url_valid(F.col("x")), x=url) is ok


@pytest.mark.parametrize(("url", "closed"), [("https://a/j?closedJob=True", True), ("https://a/j?x=1&closedJob=TRUE#f", True), ("https://a/j?closedJob=False&closedJob=True", False), ("https://a/closedJob=True", False), ("https://a", False)])
def test_closed_urls(spark, url, closed):
    assert value(spark, t.closed_url(F.col("x")), x=url) is closed


@pytest.mark.parametrize(("title", "spam"), [("A B C D E", True), ("A B C D", False), ("A B C D e", False), ("1 2 3 4 5", False), ("A B C D E", True)])
def test_spam_titles(spark, title, spam):
    assert value(spark, t.spam_title(F.col("x")), x=title) is spam


@pytest.mark.parametrize(("bad", "good"), [("CafÃ©", "Café"), ("itâ€™s", "it’s"), ("clean é", "clean é"), ("Ã日", "Ã日"), ("niÃ±o", "niño")])
def test_mojibake(spark, bad, good):
    assert value(spark, t.fix_mojibake(F.col("x")), x=bad) == good


@pytest.mark.parametrize(("raw", "n"), [("1200.9", 1200), ("-3.7", -3), ("abc", None), ("nan", None), ("inf", None), ("1e3", 1000), ("", None)])
def test_salaries(spark, raw, n):
    assert value(spark, t.to_salary(F.col("x")), x=raw) == n


def test_dates(spark):
    at = datetime(2024, 3, 5, 10, 20, 30)
    assert value(spark, t.parse_posted(F.col("x")).cast("timestamp_ntz"), x="2024-03-05T10:20:30Z") == at
    assert value(spark, t.parse_posted(F.col("x")), x="05/03/2024") is None
    for raw in ("Tue, 05 Mar 2024 10:20:30 +0100", "2024-03-05 10:20:30", "2024-03-05T10:20:30"):
        assert value(spark, t.parse_legacy(F.col("x"), F.lit(at)).cast("timestamp_ntz"), x=raw) == at
    assert value(spark, t.parse_legacy(F.col("x"), F.lit("2024-03-05").cast("timestamp")).cast("string"), x="posted 2024-03-05!") == "2024-03-05 00:00:00"
    assert value(spark, t.published_today(F.col("x"), F.lit("2024-03-06").cast("timestamp")), x="2024-03-05") is True
    assert value(spark, t.published_today(F.col("x"), F.lit("2024-03-06").cast("timestamp")), x="Oggi") is True
    assert value(spark, t.epoch_auto(F.col("x")).cast("long"), x="1700000000000") == 1_700_000_000


@pytest.mark.parametrize(("message", "bucket"), [("HTTPError 429", "RATE_LIMIT_429"), ("read timed out", "TIMEOUT"), ("403 Forbidden", "AUTH_ERROR"), ("404", "NOT_FOUND"), ("dns failure", "NETWORK_ERROR"), ("boom", "CONNECTOR_CRASH")])
def test_failure_class(spark, message, bucket):
    assert value(spark, t.failure_class(F.col("x")), x=message) == bucket


LONG = "We build and run the data platform for many teams. You will write and review code every day. The work is remote and the team is small and kind. " * 2


@pytest.mark.parametrize(
    ("text", "ok"),
    [(LONG, True), (LONG.strip() + "..", False), ("x" * 300, False), ("Short one here now. " * 3, False), (LONG.strip().rstrip("."), False), (LONG + "<p>end</p>", True), ("a b. " * 60, False), (None, False), ("join our team! competitive salary! " * 10 + "We are here to work.", False)],
)
def test_description_meaningful(spark, text, ok):
    assert value(spark, quality.description_meaningful(F.col("x")), x=text) is ok


def test_flags_and_tiers(spark):
    assert value(spark, quality.flags_score(F.col("x")), x=["clear_jd", "has_requirements", "has_benefits", "has_tech_stack"]) == 1.0
    assert value(spark, quality.flags_score(F.col("x")), x=["vague", "boilerplate"]) == 0.0
    for n, score in ((199, 0.0), (200, 0.4), (999, 0.4), (1000, 0.7), (3000, 1.0)):
        assert value(spark, quality.description_score(F.col("x")), x="x" * n) == score


def test_best_and_worst_scores(spark):
    best = {"technical_skills": ["a"] * 5, "seniority": "senior", "salary_min": 1, "salary_max": 2, "remote_mode": "remote", "ai_confidence": 1.0, "quality_flags": ["clear_jd", "has_requirements", "has_benefits", "has_tech_stack"], "requirements": ["a", "b"], "benefits": ["c"], "cv_drop_score": 1.0, "d": "x" * 3000}
    worst = best | {"technical_skills": [], "seniority": "unknown", "salary_min": None, "salary_max": None, "remote_mode": "unknown", "ai_confidence": 0.0, "quality_flags": [], "requirements": [], "benefits": [], "cv_drop_score": 0.0, "d": ""}
    assert value(spark, quality.quality_score(F.col("d")), **best) == 100
    assert value(spark, quality.quality_score(F.col("d")), **worst) == 0


def test_gate_takes_the_first_rule(spark):
    row = {"technical_skills": ["a", "b"], "seniority": "senior", "employment_type": "contract", "remote_mode": "remote", "ai_confidence": 0.7, "c": "ACME", "d": LONG}
    reason = quality.gate_reason(F.col("c"), F.col("d"))
    assert value(spark, reason, **row) is None
    for change, expected in (({"c": " N/A ", "technical_skills": []}, "MISSING_COMPANY"), ({"technical_skills": ["a"]}, "ZERO_SKILLS"), ({"d": "no"}, "DESCRIPTION_INVALID"), ({"d": ""}, None), ({"seniority": "unknown", "remote_mode": "unknown"}, "UNKNOWN_SENIORITY_AFTER_RETRY"), ({"employment_type": "unknown"}, "UNKNOWN_EMPLOYMENT_TYPE_AFTER_RETRY"), ({"remote_mode": "unknown"}, "UNKNOWN_REMOTE_MODE_AFTER_RETRY"), ({"ai_confidence": 0.69}, "LOW_CONFIDENCE")):
        assert value(spark, reason, **(row | change)) == expected


def test_skills(spark):
    assert value(spark, skills.technical(F.col("x")), x=[" Python ", "talking", "SQL"]) == [" Python ", "SQL"]
    assert value(spark, skills.other(F.col("x")), x=[" Python ", "talking"]) == ["talking"]
    assert value(spark, skills.jaccard(F.col("x"), F.col("y")), x=[], y=[]) == 1.0
    assert value(spark, skills.precision(F.col("x"), F.col("y")), x=["a"], y=[]) == 0.0
    assert value(spark, skills.recall(F.col("x"), F.col("y")), x=["A", "b"], y=["a"]) == 0.5


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(row[j], before[j + 1]))
    return row[-1]


def test_token_sort_ratio():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc ", k=rng.randint(0, 20))) for _ in range(2))
        assert fuzzy.lcs(a, b) == slow_lcs(a, b)
    assert fuzzy.token_sort_ratio("b a", "a b") == 100 and fuzzy.token_sort_ratio("", "") == 100 and fuzzy.token_sort_ratio("", "a") == 0
    assert fuzzy.token_sort_ratio("software engineer - backend", "software engineer backend") >= 92


def test_html():
    assert html.clean("<p>a<script>x</script><img src=1>b</p>&amp;") == "<p>ab</p>&amp;" and html.clean("a < b") == "a < b" and html.clean(None) is None
    assert html.normalize("<h1>a</h1><h4>b</h4><p> </p>") == "<h2>a</h2><h3>b</h3>"
    page = "<nav>n</nav><article><img src='l.png'><h2>Title</h2><p>" + "word " * 100 + "</p></article><footer>f</footer>"
    text, logo = html.main_content(page)
    assert text.startswith("## Title") and logo == "l.png" and "n" not in text.split()[0]
    assert html.main_content(None) == ("", None)


def test_language_votes():
    for lang, text in (("en", "the work of the team is in the office"), ("it", "il lavoro è per la squadra della città"), ("de", "die Arbeit ist für das Team und nicht im Büro"), ("fr", "le travail est pour une équipe dans la ville"), ("es", "el trabajo es para una persona con la formación"), ("pt", "o trabalho é para uma pessoa com a formação não")):
        assert language.detect(text)[0] == lang
    assert language.detect("日本語の求人です") == ("other", 0.0) and language.detect(None) == ("other", 0.0)


@pytest.mark.parametrize("text", ["Wij zoeken een ontwikkelaar die met ons het team van de afdeling versterkt en niet bang is voor werk", "Szukamy programisty do pracy w zespole, który nie boi się wyzwań i jest otwarty", "Vi söker en utvecklare som är van att arbeta med data och som inte är rädd för det"])
def test_languages_that_are_not_supported(text):
    assert language.detect(text) == ("other", 0.0)
