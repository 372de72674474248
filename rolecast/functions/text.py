"""Text functions: normalisation, hashes, urls, dates and repair of wrongly decoded text.

All are expressions; Python runs only where a value needs it, on input that is null for every other row.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII = r"^[\x00-\x7F]*$"
BLANKS = r"[\x09-\x0D\x1C-\x20]+"


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at the ends, in the sense of Unicode.  The expression, which tries every blank, sees only texts
    that have some there."""
    blank = lambda x: x.rlike(r"(?U)[\s\x1C-\x1F]")
    at_ends = blank(F.substring(c, 1, 1)) | blank(F.substring(c, -1, 1))
    return F.when(at_ends, F.regexp_replace(c, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")).otherwise(c)


def first_text(*cs: Column) -> Column:
    """The first string that is not blank, trimmed; else the empty string."""
    return F.coalesce(*(F.nullif(strip(c.cast("string")), F.lit("")) for c in cs), F.lit(""))


@F.pandas_udf(T.StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower().split()))


def normalize_text(c: Column) -> Column:
    """Compatibility decomposition, ASCII only, lower case, single blanks.  ASCII input, the common case, stays in the JVM."""
    plain = F.trim(F.regexp_replace(F.lower(c), BLANKS, " "))
    return F.coalesce(F.when(c.rlike(ASCII), plain), _fold(F.when(~c.rlike(ASCII), c)))


def dedup_hash(title: Column, company: Column, source: Column) -> Column:
    """Of titles and companies that are normalised already."""
    return F.sha1(F.concat(title, F.lit("|"), company, F.lit("|"), F.lower(source)))


def cross_source_hash(title: Column, company: Column) -> Column:
    return F.sha1(F.concat(title, F.lit("|"), company))


def cache_key(task: str, version: str, payload: Column) -> Column:
    nul = F.lit("\0")
    return F.sha2(F.concat(F.lit(task), nul, F.lit(version), nul, payload), 256)


def classify_payload(title: Column, company: Column, location: Column, language: Column, description: Column, hints: Column) -> Column:
    """What a classification depends on; hints sorted by key."""
    pairs = F.array_sort(F.transform(F.map_entries(hints), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.concat_ws("\0", *(text(c) for c in (title, company, location, language, description)), F.coalesce(F.array_join(pairs, "|"), F.lit("")))


def url_valid(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#]+"), F.lit(False))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def closed_url(url: Column) -> Column:
    """Whether the first closedJob parameter of the query says true."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^?#]*\?(?:[^#]*?&)??closedJob=([^&#]*)", 1)) == "true", F.lit(False))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)[\s\x1C-\x1F]+"), lambda w: w != ""))


def spam_title(title: Column) -> Column:
    """Five words or more, all in capitals, with a letter."""
    return F.coalesce((word_count(title) >= 5) & (title == F.upper(title)) & title.rlike(r"\p{L}"), F.lit(False))


def has_mojibake(c: Column) -> Column:
    """Every sequence that tells of UTF-8 read as another encoding starts with one of two."""
    return F.coalesce(c.rlike("Ã|â€"), F.lit(False))


@F.pandas_udf(T.StringType())
def _redecode(s: pd.Series) -> pd.Series:
    def repair(x: str | None) -> str | None:
        for encoding in ("cp1252", "latin-1"):
            try:
                return None if x is None else x.encode(encoding).decode("utf-8")
            except UnicodeError:
                continue
        return None

    return s.map(repair)


def fix_mojibake(c: Column) -> Column:
    """The text decoded rightly where that can be done, else unchanged."""
    return F.coalesce(_redecode(F.when(has_mojibake(c), c)), c)


def to_salary(c: Column) -> Column:
    """Whole number towards zero; null for what is no finite number."""
    value = c.cast("string").try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < 9.2e18), value.cast("long"))


def parse_posted(c: Column) -> Column:
    """The three date formats that normalisation takes."""
    return F.coalesce(*(F.when(c.rlike(p), F.try_to_timestamp(c, F.lit(f))) for p, f in ((r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$", "yyyy-MM-dd'T'HH:mm:ss'Z'"), (r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$", "yyyy-MM-dd'T'HH:mm:ss"), (r"^\d{4}-\d\d-\d\d$", "yyyy-MM-dd"))))


def parse_legacy(c: Column, as_of: Column) -> Column:
    """Seven older formats; a text that holds the date of ``as_of`` counts as ``as_of``."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3}, ", "")
    zoned = F.regexp_replace(bare, r" (GMT|UTC|Z)$", " +0000")
    formats = ((bare, "yyyy-MM-dd'T'HH:mm:ss'Z'"), (bare, "yyyy-MM-dd'T'HH:mm:ss"), (bare, "yyyy-MM-dd HH:mm:ss"), (F.regexp_replace(zoned, r" [+-]\d{4}$", ""), "dd MMM yyyy HH:mm:ss"), (bare, "yyyy-MM-dd"), (bare, "d MMM yyyy"))
    return F.coalesce(*(F.try_to_timestamp(x, F.lit(f)) for x, f in formats), F.when(F.contains(c, F.date_format(as_of, "yyyy-MM-dd")), as_of))


def published_today(c: Column, as_of: Column, days: int = 1) -> Column:
    dt = parse_legacy(c, as_of)
    recent = F.floor((as_of.cast("double") - dt.cast("double")) / 86400) <= days
    return F.coalesce(recent, F.lower(c).rlike("today|oggi"), F.lit(False))


def parse_iso(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit("")).try_cast("timestamp")


def epoch_timestamp(c: Column) -> Column:
    return F.timestamp_seconds(c.cast("string").try_cast("bigint"))


def epoch_auto(c: Column) -> Column:
    """Seconds, or milliseconds where the number is too large for seconds."""
    n = c.cast("string").try_cast("double")
    return F.timestamp_seconds(F.when(n > 1e11, n / 1000).otherwise(n))


def relevant_title(title: Column, keywords: list[str]) -> Column:
    return F.coalesce(F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.lower(title), F.lower(k))), F.lit(False))


def failure_class(message: Column) -> Column:
    """Bucket of an error text; the first that fits."""
    low = F.lower(message)
    rules = (("RATE_LIMIT_429", "429|rate limit|ratelimit|too many requests"), ("TIMEOUT", "timeout|timed out"), ("AUTH_ERROR", "401|403|unauthorized|forbidden"), ("NOT_FOUND", "404|not found"), ("NETWORK_ERROR", "connection|network|dns"))
    return F.coalesce(*(F.when(low.rlike(p), F.lit(name)) for name, p in rules), F.lit("CONNECTOR_CRASH"))


def prefilter_code(reason: Column) -> Column:
    return F.when(reason.startswith("PREFILTER_"), reason).otherwise(F.concat(F.lit("PREFILTER_"), reason))


def geo_point_valid(lng: Column, lat: Column) -> Column:
    return F.coalesce(lng.between(-180, 180) & lat.between(-90, 90), F.lit(False))
