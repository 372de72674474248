"""Scores and predicates of a classified posting.  Inputs are columns of the names in ``schemas.AI_OUTPUT``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text

# Thresholds, weights and sentinels of the gate.
LEAST_CHARS, LEAST_SENTENCES, LEAST_WORDS, MOST_BOILERPLATE = 200, 3, 4, 0.4
BOILERPLATE = ("equal opportunity employer", "we are looking for", "our company is", "join our team", "competitive salary")
NO_COMPANY = ("", "unknown company", "n/a", "various", "private", "anonymous")
FLAG_WEIGHTS = {"clear_jd": 0.30, "has_requirements": 0.25, "has_benefits": 0.25, "has_tech_stack": 0.20, "vague": -0.30, "boilerplate": -0.30}
REMOTE_WEIGHTS = {"remote": 1.0, "hybrid": 0.7, "onsite": 0.4}
LEAST_SKILLS, LEAST_PREMIUM_SKILLS, LEAST_CONFIDENCE, LEAST_PREMIUM_CONFIDENCE = 2, 4, 0.7, 0.85


def unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def items(c: Column) -> Column:
    """Length of an array, 0 if it is null."""
    return F.coalesce(F.size(c), F.lit(0))


def tiers(c: Column, *steps: tuple[float, float]) -> Column:
    """The value of the first step that ``c`` reaches, else 0."""
    return F.coalesce(*(F.when(c >= least, F.lit(value)) for least, value in steps), F.lit(0.0))


def description_score(description: Column) -> Column:
    return tiers(F.length(text(description)), (3000, 1.0), (1000, 0.7), (200, 0.4))


def description_meaningful(description: Column) -> Column:
    """Long enough, properly ended, not mostly boilerplate, and with three sentences of four words."""
    return F.get(F.transform(F.array(strip(text(description))), _meaningful), F.lit(0))


def _meaningful(d: Column) -> Column:
    """Of a stripped text, which a lambda binds, so that it is stripped once."""
    tagged = d.endswith(">") & F.contains(F.substring(d, -50, 50), F.lit("</"))
    ended = F.substring(d, -1, 1).rlike("[.!?）」』>]") | tagged
    low = F.lower(d)
    filler = reduce(lambda a, b: a + b, (F.when(F.contains(low, F.lit(p)), len(p)).otherwise(0) for p in BOILERPLATE))
    sentences = F.filter(F.split(d, "[.!?]+"), lambda s: F.size(F.filter(F.split(s, r"(?U)[\s\x1C-\x1F]+"), lambda w: w != "")) >= LEAST_WORDS)
    # The cheap tests come first: what fails them is not split.
    return (F.length(d) >= LEAST_CHARS) & ~d.endswith("...") & ended & (filler / F.greatest(F.length(d), F.lit(1)) <= MOST_BOILERPLATE) & (F.size(sentences) >= LEAST_SENTENCES)


def flags_score(flags: Column) -> Column:
    flags = F.coalesce(flags, F.array().cast("array<string>"))
    return unit(reduce(lambda a, b: a + b, (F.when(F.array_contains(flags, f), F.lit(w)).otherwise(0.0) for f, w in FLAG_WEIGHTS.items())))


def requirements_score(requirements: Column, benefits: Column) -> Column:
    return tiers(items(requirements) + items(benefits), (3, 1.0), (2, 0.7), (1, 0.4))


def quality_score(description: Column) -> Column:
    """0 to 100, rounded half to even; terms are added from left to right."""
    c = F.col
    known = (F.when(c("salary_min").isNotNull(), 1).otherwise(0)) + (F.when(c("salary_max").isNotNull(), 1).otherwise(0))
    salary = F.when(known == 2, 1.0).when(known == 1, 0.6).otherwise(0.0)
    remote = F.coalesce(*(F.when(c("remote_mode") == m, F.lit(w)) for m, w in REMOTE_WEIGHTS.items()), F.lit(0.0))
    terms = (
        (0.20, F.least(F.lit(1.0), items(c("technical_skills")) / 5.0)), (0.10, F.when(c("seniority") == "unknown", 0.0).otherwise(1.0)), (0.15, salary), (0.10, remote), (0.10, unit(c("ai_confidence"))),
        (0.10, description_score(description)), (0.10, flags_score(c("quality_flags"))), (0.05, requirements_score(c("requirements"), c("benefits"))), (0.10, unit(c("cv_drop_score"))),
    )
    return F.bround(reduce(lambda a, b: a + b, (F.lit(w) * x for w, x in terms)) * 100, 0).cast("int")


def company_missing(company: Column) -> Column:
    return F.lower(strip(text(company))).isin(*NO_COMPANY)


def gate_reason(company: Column, description: Column, threshold: float = LEAST_CONFIDENCE) -> Column:
    """The first rule of the gate that fails; null if it is passed."""
    rules = (
        ("MISSING_COMPANY", company_missing(company)), ("ZERO_SKILLS", items(F.col("technical_skills")) < LEAST_SKILLS), ("DESCRIPTION_INVALID", (text(description) != "") & ~description_meaningful(description)),
        ("UNKNOWN_SENIORITY_AFTER_RETRY", F.col("seniority") == "unknown"), ("UNKNOWN_EMPLOYMENT_TYPE_AFTER_RETRY", F.col("employment_type") == "unknown"),
        ("UNKNOWN_REMOTE_MODE_AFTER_RETRY", F.col("remote_mode") == "unknown"), ("LOW_CONFIDENCE", F.col("ai_confidence") < threshold),
    )
    return F.coalesce(*(F.when(broken, F.lit(name)) for name, broken in rules))


def premium() -> Column:
    flags = F.coalesce(F.col("quality_flags"), F.array().cast("array<string>"))
    return F.coalesce(
        (items(F.col("technical_skills")) >= LEAST_PREMIUM_SKILLS) & F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull() & (F.col("ai_confidence") >= LEAST_PREMIUM_CONFIDENCE)
        & F.arrays_overlap(flags, F.array(F.lit("clear_jd"), F.lit("has_requirements"))) & ~F.array_contains(flags, "boilerplate"),
        F.lit(False),
    )
