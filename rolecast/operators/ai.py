"""Model requests and answers as tables: keys, prompts, cache misses, tiers, escalation and parsing.

The model itself is a function that the caller passes; it sees only rows that no recorded result answers.  Each pass is
written before the next one reads it, so no call is made twice, and a call that fails leaves a row that says why.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import skills
from ..functions import text as t
from ..schemas import AI_OUTPUT, FIELD_CONFIDENCE_KEYS, VOCABULARY
from ..shared import cut
from .dedupe import keep_first

PROMPT_CHARS, TRIAGE_CHARS, ESCALATE_BELOW, ATTEMPTS, LONGEST_WAIT, MOST_HOPS = 4000, 1500, 0.7, 3, 30, 1
# Tiers from the smallest to the largest, and by task where it starts, how far it may go, its prompt and the tokens of its answer.
TIERS = ("FAST", "STRUCT", "REASON")
TASKS = {"EXTRACT": ("FAST", "STRUCT", "extract", "v1", 1024), "TRIAGE": ("FAST", "FAST", "triage", "v1", 256), "SPAM_CHECK": ("REASON", "REASON", "spam_check", "v1", 512)}
#: What a stronger model is told.
HINT = "Say 'unknown', or null, for what the text does not tell; make nothing up."


def _object(required: str, **properties: dict) -> dict:
    return {"type": "object", "additionalProperties": False, "required": required.split(), "properties": properties}


_RATE, _WORD, _WORDS = {"type": "number", "minimum": 0, "maximum": 1}, {"type": ["string", "null"]}, {"type": "array", "items": {"type": "string"}}
#: Prompts by name and version: what the model is told once, and the schema of its answer.
PROMPTS = {
    ("extract", "v1"): (
        "You read job postings and answer with one JSON object of the given schema, nothing else. Rate between 0 and 1 how sure you are, overall and field by field.",
        _object("skills seniority role_family employment_type remote_mode confidence", skills=_WORDS, **{k: {"enum": list(v)} for k, (v, _) in VOCABULARY.items()}, salary_min={"type": ["number", "null"]}, salary_max={"type": ["number", "null"]}, currency=_WORD, languages_required=_WORDS, quality_flags=_WORDS, cv_drop_score=_RATE, confidence=_RATE, field_confidence={"type": "object"}),
    ),
    ("triage", "v1"): ("You sort job postings quickly: is it a job in information technology, how likely is it spam, is it easy or hard to read? Answer with one JSON object of the given schema.", _object("is_it_job spam_likelihood complexity", is_it_job={"type": "boolean"}, category_guess=_WORD, spam_likelihood=_RATE, complexity={"enum": ["easy", "hard"]})),
    ("spam_check", "v1"): ("You look for spam, for postings that claim remote work but ask for presence, and for recruiters without a real role. Flag only what the text shows. Answer with one JSON object of the given schema.", _object("is_spam fake_remote suspicious_recruiter confidence", is_spam={"type": "boolean"}, fake_remote={"type": "boolean"}, suspicious_recruiter={"type": "boolean"}, reason=_WORD, confidence=_RATE)),
}


def get_prompt(name: str, version: str) -> tuple[str, str]:
    """What the model is told once, and the schema as text; an unknown name or version is a ``KeyError``."""
    if (name, version) not in PROMPTS:
        raise KeyError(f"no prompt {name!r} in version {version!r}")
    system, schema = PROMPTS[name, version]
    return system, json.dumps(schema, separators=(",", ":"))


def prompt_registry(spark: SparkSession) -> DataFrame:
    """The prompts as a small dimension."""
    return spark.createDataFrame([(n, v, *get_prompt(n, v)) for n, v in sorted(PROMPTS)], "prompt_id string, version string, system string, schema string")


def corrected(user: Column, correction: Column | None) -> Column:
    """A request with what was wrong with the answer before, if anything was."""
    if correction is None:
        return user
    return F.concat(F.when(F.coalesce(correction, F.lit("")) != "", F.concat(F.lit("\nIMPORTANT: "), correction, F.lit("\n"))).otherwise(""), user)


def _asked(name: str, version: str = "v1") -> Column:
    return F.lit(f"\n\nAnswer in JSON of this schema:\n{get_prompt(name, version)[1]}")


def _named(**columns: Column) -> list[Column]:
    return [F.concat(F.lit(f"{k.upper()}: "), t.text(c), F.lit("\n")) for k, c in columns.items()]


def triage_prompt(title: Column, company: Column, description: Column) -> Column:
    """A short look at a posting."""
    return F.concat(*_named(title=title, company=company), F.lit("DESCRIPTION:\n"), F.substring(t.text(description), 1, TRIAGE_CHARS), _asked("triage"))


def spam_prompt(title: Column, company: Column, location: Column, description: Column) -> Column:
    return F.concat(*_named(title=title, company=company, location=location), F.lit("DESCRIPTION:\n"), F.substring(t.text(description), 1, PROMPT_CHARS), _asked("spam_check"))


def freeform_prompt(text: Column, correction: Column | None = None) -> Column:
    """A posting as plain text."""
    return corrected(F.concat(F.lit("POSTING:\n"), F.substring(t.text(text), 1, PROMPT_CHARS), _asked("extract")), correction)


def prompt(title: Column, company: Column, location: Column, language: Column, description: Column, hints: Column, schema: str, chars: int = PROMPT_CHARS) -> Column:
    """What is asked about a posting, with what its source declares, sorted, as hints."""
    lines = F.array_join(F.array_sort(F.transform(F.map_entries(hints), lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"]))), "\n")
    block = F.when(F.coalesce(F.size(hints), F.lit(0)) > 0, F.concat(F.lit("Fields given by the source:\n"), lines, F.lit("\n"))).otherwise("")
    head = [F.concat(F.lit(f"{name}: "), t.text(c), F.lit("\n")) for name, c in (("TITLE", title), ("COMPANY", company), ("LOCATION", location), ("LANGUAGE", language))]
    return F.concat(*head, block, F.lit("DESCRIPTION:\n"), F.substring(t.text(description), 1, chars), F.lit(f"\n\nAnswer in JSON of this schema:\n{schema}"))


def parse_output(content: Column) -> Column:
    """The answer as a struct of ``schemas.AI_OUTPUT``, null if it is no JSON object; a list of one object is that object."""
    one = F.regexp_extract(content, r"(?s)^\s*\[(\s*\{.*\}\s*)\]\s*$", 1)
    body = F.when(one != "", one).otherwise(content)
    return F.when(body.rlike(r"(?s)^\s*\{.*\}\s*$"), F.from_json(body, AI_OUTPUT, {"mode": "PERMISSIVE"}))


def coerced(out: Column) -> Column:
    """Values outside the vocabularies become defaults, confidences are clamped, salaries become whole numbers."""
    fields = {}
    for name, (allowed, default) in VOCABULARY.items():
        fields[name] = F.when(out[name].isin(*allowed), out[name]).otherwise(F.lit(default).cast("string"))
    known = F.map_filter(out["field_confidence"], lambda k, v: k.isin(*FIELD_CONFIDENCE_KEYS) & v.isNotNull())
    fields["field_confidence"] = F.when(F.size(known) > 0, F.transform_values(known, lambda _, v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))))
    for name in ("skills", "languages_required", "quality_flags"):
        fields[name] = F.coalesce(out[name], F.array().cast("array<string>"))
    for name in ("cv_drop_score", "confidence"):
        fields[name] = F.coalesce(out[name], F.lit(0.0))
    for name in ("salary_min", "salary_max"):
        fields[name] = t.to_salary(out[name])
    fields["currency"] = out["currency"]
    return F.when(out.isNotNull(), F.struct(*(c.alias(n) for n, c in fields.items())))


def classified(df: DataFrame, output: str = "output", lexicon: tuple[str, ...] = skills.DEFAULT) -> DataFrame:
    """Adds the columns of a classification from a coerced answer."""
    o = F.col(output)
    return df.withColumns({
        "technical_skills": skills.technical(o["skills"], lexicon), "skills": skills.other(o["skills"], lexicon), **{c: o[c] for c in VOCABULARY}, **{c: o[c] for c in ("salary_min", "salary_max", "currency", "languages_required", "quality_flags", "cv_drop_score", "field_confidence")},
        "ai_confidence": o["confidence"], "remote": o["remote_mode"].isin("hybrid", "remote"), "requirements": F.array().cast("array<string>"), "benefits": F.array().cast("array<string>"),
    })


def usable_results(results: DataFrame) -> DataFrame:
    """Recorded results that can still be parsed; others count as missing."""
    return results.withColumn("output", coerced(parse_output(F.col("content")))).filter("output is not null")


def misses(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests without a usable result, of each key the first by its prompt."""
    return keep_first(requests.join(usable_results(results).select("cache_key"), "cache_key", "left_anti"), ["cache_key"], [F.col("prompt")])


class TransientError(Exception):
    """A call that may be repeated."""


@dataclass
class Answer:
    """What a model returns."""

    content: str
    model: str
    tokens_in: int = 0
    tokens_out: int = 0
    latency_ms: int = 0


def wrong(content: str) -> str | None:
    """What keeps an answer from being read: it has to be a JSON object, or a list of one."""
    try:
        found = json.loads(content)
    except ValueError as e:
        return str(e)[:200]
    if isinstance(found, list) and len(found) == 1:
        found = found[0]
    return None if isinstance(found, dict) else "the answer is no JSON object"


ANSWERED = "cache_key string, content string, model string, tier string, attempts int, tokens_in long, tokens_out long, latency_ms long, error string"


def ask(requests: DataFrame, call: Callable[[str], Answer | tuple[str, str]], tier: str, check: Callable[[str], str | None] = wrong, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """:data:`ANSWERED` for each request (``cache_key`` and ``prompt``).

    After a :class:`TransientError` the call is repeated after a wait, and after an answer that cannot be read with a
    note of what was wrong, ``attempts`` times in all.  What fails in the end has no content, and the error.
    """

    def one(text: str) -> tuple:
        note, error = "", None
        for attempt in range(1, attempts + 1):
            try:
                got = call(note + text)
            except TransientError as e:
                error = f"transient: {e}"[:200]
                if attempt < attempts:
                    sleep(min(2**attempt, LONGEST_WAIT))
                continue
            except Exception as e:  # noqa: BLE001 - whatever a client raises is the row's error, not the job's
                return None, None, attempt, 0, 0, 0, f"{type(e).__name__}: {e}"[:200]
            got = got if isinstance(got, Answer) else Answer(*got)
            if (problem := check(got.content)) is None:
                return got.content, got.model, attempt, got.tokens_in, got.tokens_out, got.latency_ms, None
            note, error = f"\nThe answer before could not be read: {problem}\n", f"invalid: {problem}"[:200]
        return None, None, attempts, 0, 0, 0, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ANSWERED.split(", ")]
        for pdf in frames:
            rows = []
            for key, text in zip(pdf["cache_key"], pdf["prompt"], strict=True):
                content, model, *rest = one(text)
                rows.append((key, content, model, tier, *rest))
            yield pd.DataFrame(rows, columns=names)

    return requests.select("cache_key", "prompt").mapInPandas(run, ANSWERED)


def tiers_of(task: str, hops: int = MOST_HOPS, reason: bool = False) -> list[str]:
    """The tiers that a task may go through: from where it starts, up to its ceiling, ``hops`` times."""
    start, ceiling, *_ = TASKS[task]
    path = TIERS[TIERS.index(start) : TIERS.index(ceiling) + 1]
    return [x for k, x in enumerate(path) if k == 0 or k <= hops and (reason or x != "REASON")]


def route(requests: DataFrame, results: DataFrame, calls: dict[str, Callable[[str], Answer | tuple[str, str]]], task: str = "EXTRACT", below: float = ESCALATE_BELOW, hops: int = MOST_HOPS, reason: bool = False, **how) -> tuple[DataFrame, DataFrame]:
    """``cache_key``, ``output``, ``model``, ``tier`` and ``escalated_from`` of what could be answered, and a row a call.

    Recorded results come first and cost no call.  Other requests go to the first tier; where its confidence is below
    ``below`` the next one is asked with a hint, and its outcome counts, even if that is none.  A failure is not passed on.
    """
    known = usable_results(results).select("cache_key", "output", "model", "tier", F.lit(None).cast("string").alias("escalated_from"))
    known = known.join(requests.select("cache_key").distinct(), "cache_key", "left_semi")
    todo, done, log, before = cut(misses(requests, results), "misses"), [known], [], None
    path = tiers_of(task, hops, reason)
    for k, tier in enumerate(path):
        asked = todo if k == 0 else todo.withColumn("prompt", corrected(F.col("prompt"), F.lit(HINT)))
        found = cut(ask(asked, calls[tier], tier, **how), f"tier-{tier}")
        usable = usable_results(found.filter("content is not null")).withColumn("escalated_from", F.lit(before).cast("string"))
        low = F.coalesce(F.col("output.confidence") < below, F.lit(False)) if k + 1 < len(path) else F.lit(False)
        done.append(usable.filter(~low).select("cache_key", "output", "model", "tier", "escalated_from"))
        log.append(found.select(F.lit(task).alias("task"), "*", F.lit(before).cast("string").alias("escalated_from")))
        todo, before = todo.join(usable.filter(low).select("cache_key"), "cache_key", "left_semi"), tier
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return union(done), union(log)


def escalated(first: DataFrame, second: DataFrame, below: float = ESCALATE_BELOW) -> DataFrame:
    """Results of the first tier, but where their confidence is too low those of the second, or none if it failed."""
    f = usable_results(first).withColumn("low", F.col("output.confidence") < below)
    s = usable_results(second).select("cache_key", F.col("output").alias("output2"), F.col("model").alias("model2"))
    out = f.join(s, "cache_key", "left").filter(~F.col("low") | F.col("output2").isNotNull())
    return out.select("cache_key", F.when(F.col("low"), F.col("output2")).otherwise(F.col("output")).alias("output"), F.when(F.col("low"), F.col("model2")).otherwise(F.col("model")).alias("model"), F.col("low").alias("escalated"))


def evict(results: DataFrame, most: int = 4096) -> DataFrame:
    """The results used last, as many as a cache holds."""
    return results.orderBy(F.desc("last_used"), "cache_key").limit(most)
