"""Skills: split by a lexicon, mentions in texts, and set metrics.

The lexicon is a table of terms of one or more words.  ``lexicon_from`` reads one from a file, a term a line; without
a file, a short list of common terms is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space in the sense of Unicode, and the four separators.
BLANK = r"(?U)[\s\x1C-\x1F]+"
# A small default lexicon.
DEFAULT = tuple(
    "python java javascript typescript go rust c++ c# scala kotlin swift php ruby sql postgresql mysql mongodb redis kafka spark hadoop airflow dbt docker kubernetes terraform ansible"
    " aws azure gcp linux git jenkins react angular vue node.js django flask spring graphql rest html css tensorflow pytorch pandas numpy".split()
)


#: So many terms are taken into expressions, as a set; more are joined.
MOST_TERMS = 20_000


def normal(term: Column) -> Column:
    """A term as it is looked up: in lower case, with single blanks between its words."""
    return F.trim(F.regexp_replace(F.lower(term), BLANK, " "))


def lexicon_from(spark: SparkSession, path: str) -> DataFrame:
    """``term`` and ``n_words`` of a file with a term of one or more words a line; lines that begin with ``#`` are notes."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#"))
    return as_lexicon(lines.select(F.col("value").alias("term")))


def as_lexicon(terms: DataFrame) -> DataFrame:
    """The distinct terms of a column ``term``, as they are looked up, with ``n_words``."""
    known = terms.select(normal(F.col("term")).alias("term")).filter("term <> ''").distinct()
    return known.withColumn("n_words", F.size(F.split("term", " ")))


def technical(skills: Column, lexicon: tuple[str, ...] = DEFAULT) -> Column:
    """Those of an array that the lexicon has, as they are written; a set lookup each."""
    return F.filter(skills, lambda s: F.lower(F.trim(s)).isin(*lexicon))


def other(skills: Column, lexicon: tuple[str, ...] = DEFAULT) -> Column:
    return F.filter(skills, lambda s: ~F.lower(F.trim(s)).isin(*lexicon))


def split(df: DataFrame, skills: str, lexicon: DataFrame, key: str, most: int = MOST_TERMS) -> DataFrame:
    """``df`` with ``technical`` and ``other``: the members of an array that the lexicon (``term``) has, and the rest, in their order.

    A lexicon of few terms is a set in the expression.  A larger one is joined: members with their places by their terms, and put
    together again by ``key``, which tells rows apart.  A null array gives null for both; a null member is in neither.
    """
    terms = [r["term"] for r in lexicon.select("term").limit(most + 1).collect()]
    if len(terms) <= most:
        return df.withColumns({"technical": technical(F.col(skills), tuple(terms)), "other": other(F.col(skills), tuple(terms))}) if terms else df.withColumns({"technical": F.filter(skills, lambda s: F.lit(False)), "other": F.filter(skills, lambda s: s.isNotNull())})
    members = df.select(key, F.posexplode(skills).alias("_pos", "_skill")).filter("_skill is not null").withColumn("term", F.lower(F.trim("_skill")))
    marked = members.join(lexicon.select("term", F.lit(True).alias("_known")), "term", "left")
    pick = lambda known: F.transform(F.array_sort(F.collect_list(F.when(known, F.struct("_pos", "_skill")))), lambda x: x["_skill"])
    known = F.coalesce("_known", F.lit(False))
    both = marked.groupBy(key).agg(pick(known).alias("technical"), pick(~known).alias("other"))
    none = F.when(F.col(skills).isNotNull(), F.array().cast("array<string>"))
    return df.join(both, key, "left").withColumns({"technical": F.coalesce("technical", none), "other": F.coalesce("other", none)})


def mentions(df: DataFrame, text: str, lexicon: DataFrame, key: str) -> DataFrame:
    """``key``, ``term`` and ``n``: how often each term of the lexicon (``term``, ``n_words``) stands in a text, whatever its case.

    Runs of as many words as terms have, from words that begin one, are joined with the lexicon by the term; terms may overlap.
    The runs of a text are made one word after the other, so they take space in proportion to it.
    """
    longest = lexicon.agg(F.coalesce(F.max("n_words"), F.lit(0)).alias("n")).first()["n"]
    if not longest:
        return df.select(key, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n")).limit(0)
    words = F.filter(F.split(F.lower(F.col(text)), BLANK), lambda w: w != "")
    tokens = df.select(key, F.explode(F.array(words)).alias("_w"))  # a row as before; the words are made once
    ahead = F.arrays_zip(*(F.slice("_w", k + 1, F.size("_w")) for k in range(longest)))
    rows = tokens.select(key, F.explode(ahead).alias("z")).select(key, *(F.col("z")[str(k)].alias(f"_{k}") for k in range(longest)))
    first = [r["w"] for r in lexicon.select(F.split_part("term", F.lit(" "), F.lit(1)).alias("w")).distinct().limit(MOST_TERMS + 1).collect()]
    if len(first) <= MOST_TERMS:  # most words begin no term
        rows = rows.filter(F.col("_0").isin(*first))
    runs = F.array(F.col("_0"), *(F.when(F.col(f"_{n}").isNotNull(), F.concat_ws(" ", *(F.col(f"_{k}") for k in range(n + 1)))) for n in range(1, longest)))
    found = rows.select(key, F.explode(runs).alias("term")).join(lexicon.select("term"), "term")
    return found.groupBy(key, "term").agg(F.count("*").alias("n"))


def as_set(skills: Column) -> Column:
    return F.array_distinct(F.transform(skills, lambda s: F.lower(s)))


def jaccard(expected: Column, actual: Column) -> Column:
    a, b = as_set(expected), as_set(actual)
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def precision(expected: Column, actual: Column) -> Column:
    a, b = as_set(expected), as_set(actual)
    return F.when(F.size(b) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(b), F.lit(1)))


def recall(expected: Column, actual: Column) -> Column:
    a, b = as_set(expected), as_set(actual)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))
