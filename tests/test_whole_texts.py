"""Queries that must see whole texts, against brute force on small tables."""

import hashlib

from rolecast.plans import catalogue

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def run(spark, tmp_path, name, texts):
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    return {r["doc_id"]: r for r in catalogue.queries()[name](spark, str(tmp_path)).collect()}


def repaired(text):
    for encoding in ("cp1252", "latin-1"):
        try:
            return text.encode(encoding).decode("utf-8")
        except UnicodeError:
            continue
    return text


def test_mojibake_is_repaired_in_the_whole_text(spark, tmp_path):
    texts = {1: "one two\nthe cafÃ© is here", 2: "plain words\nonly", 3: "genuine café behind cafÃ©", 4: None, 5: "", 10: "some words", 20: "dÃ©jÃ\xa0 vu\n" + "w " * 5000, 21: "a quote â€œhereâ€\x9d"}
    got = run(spark, tmp_path, "mojibake_repair", texts)
    said = {i: t + " dÃ©veloppeur" if t and i % 10 == 0 else t for i, t in texts.items()}
    damaged = lambda t: t and ("Ã" in t or "â€" in t)
    assert {i: r["fixed"] for i, r in got.items()} == {i: repaired(t) if damaged(t) else t for i, t in said.items()}
    assert got[1]["fixed"] == "one two\nthe café is here" and got[10]["fixed"] == "some words développeur" and got[20]["fixed"].startswith("déjà vu\n")


WORDS = {1: "The cat\nand THE dog\nlast line of la casa", 2: "one", 3: None, 4: "", 5: " \n\t ", 6: "tab\tand  wide\u00a0blank\r\nof end", 7: "first " * 3 + "\n" + "de x%d " * 3000 % tuple(range(3000))}


def test_skills_are_split_in_the_whole_text(spark, tmp_path):
    spark.createDataFrame([(1, "Casa of steel and glass"), (2, "wide")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    terms = {r["term"] for r in catalogue.lexicon(spark, str(tmp_path)).collect()}
    assert {"casa", "casa of", "of steel and", "wide", "of the", "the and"} <= terms and "steel" not in terms
    got = run(spark, tmp_path, "skill_split", WORDS)
    for i, t in WORDS.items():
        known = [w.lower() in terms for w in (t or "").split()]
        pick = lambda want: None if t is None else ",".join(w for w, k in zip(t.split(), known, strict=True) if k == want)
        assert (got[i]["technical"], got[i]["other_md5"]) == (pick(True), None if t is None else hashlib.md5(pick(False).encode()).hexdigest())
    assert got[1]["technical"] == "The,and,THE,of,la,casa"


def test_skill_metrics_of_the_whole_text(spark, tmp_path):
    got = run(spark, tmp_path, "skill_metrics", WORDS)
    for i, t in WORDS.items():
        if t is None:
            continue
        first, _, rest = t.partition("\n")
        e, b = {w.lower() for w in first.split()}, {w.lower() for w in rest.split()}
        want = (len(e & b) / len(e | b) if e | b else 1.0, len(e & b) / len(b) if b else 0.0, len(e & b) / len(e) if e else 1.0)
        assert all(abs(x - y) < 1e-12 for x, y in zip(got[i][1:], want, strict=True))
    assert got[1]["rec"] == 0.5


def test_fuzzy_pairs_of_the_same_parity_are_found(spark, tmp_path):
    texts = {1: "Senior data engineer", 2: "Junior baker", 3: "Senior data engineer", 4: "Junior baker", 5: "Senior data engineers"}
    spark.createDataFrame([(i, t, "en", f"s{i}", len(t)) for i, t in texts.items()], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["arrival_idx"], r["target_idx"]) for r in catalogue.queries()["fuzzy_pairs"](spark, str(tmp_path)).collect()}
    assert got == {(3, 1), (4, 2), (5, 1), (5, 3)}
