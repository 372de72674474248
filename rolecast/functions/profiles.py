"""Language of a text by profiles of character trigrams.

A profile has the ``TOP`` most frequent trigrams of a language's lower-cased texts, with the logarithms of their shares as
integers (thousandths).  A text is of the language whose profile gives its trigrams the highest sum, trigrams that a
profile lacks counting ``MISSING``; of equal sums the first language by name wins.  It is ``other`` if fewer than ``KNOWN`` percent
of its trigrams are in the winner's profile.  Sums are of integers, so they are the same in whatever order.

Edge cases: a null text, and one of fewer than three characters, is ``other`` with confidence 0, as is every text without
profiles; rows without a language or a text make no profile; very long texts are read in pieces that overlap by two characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOP, MISSING, KNOWN, PIECE = 3000, -14_000, 60, 1_000_000
FOUND = T.StructType().add("lang", "string").add("confidence", "double").add("score", "long")


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a text, three code points in 63 bits, and how often each occurs."""
    found, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, max(1, len(text) - 2), PIECE):
        cp = np.frombuffer(text[at : at + PIECE + 2].encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        g, n = np.unique((cp[:-2] << 42) | (cp[1:-1] << 21) | cp[2:], return_counts=True)
        if not len(found):
            found, counts = g, n
        else:
            found, place = np.unique(np.concatenate([found, g]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([counts, n])).astype(np.int64)
    return found, counts


def profiles(labelled: DataFrame, top: int = TOP) -> DataFrame:
    """``lang``, ``gram`` (as :func:`trigrams` has it) and ``weight`` of texts (``text``, ``lang``); a task counts before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(trigrams(text))
            for lang, parts in held.items():
                grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([c for _, c in parts]), minlength=len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    known = labelled.filter("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.lower("text").alias("text"))
    counted = known.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "gram", F.round(F.log(F.col("n") / F.col("total")) * 1000).cast("long").alias("weight"))


@dataclass(frozen=True)
class Profiles:
    """Profiles as arrays: sorted trigrams, and for each a row of weights by language and of whether the language's profile has it.

    Of much text a profile has trigrams so rare that they weigh ``MISSING`` or less, so weights alone do not tell.
    """

    langs: tuple[str, ...]
    grams: np.ndarray
    weights: np.ndarray
    held: np.ndarray

    @staticmethod
    def of(table: DataFrame) -> Profiles:
        """``TOP`` rows a language."""
        pdf = table.select("lang", "gram", "weight").toPandas()
        langs, grams = sorted(pdf["lang"].unique()), np.unique(pdf["gram"].to_numpy(np.int64))
        weights = np.full((len(grams), len(langs)), MISSING, np.int64)
        place = np.searchsorted(grams, pdf["gram"].to_numpy(np.int64)), pd.Categorical(pdf["lang"], langs).codes
        weights[place], held = pdf["weight"].to_numpy(np.int64), np.zeros(weights.shape, bool)
        held[place] = True
        return Profiles(tuple(langs), grams, weights, held)

    def detect(self, text: str | None) -> tuple[str, float, int]:
        """Language, share of trigrams that its profile has, and sum; of a text in lower case."""
        grams, n = trigrams(text or "")
        if not len(grams) or not self.langs:
            return "other", 0.0, 0
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        there = self.grams[at] == grams
        at, times, total = at[there], n[there], int(n.sum())
        own = self.weights[at]
        sums = times @ own + MISSING * (total - int(times.sum()))
        best = int(sums.argmax())  # the first of equals
        known = int(times[self.held[at, best]].sum())
        return (self.langs[best] if 100 * known >= KNOWN * total else "other"), known / total, int(sums[best])


def detector(found: Profiles) -> Callable[[Column], Column]:
    """An expression that gives a struct of ``lang``, ``confidence`` and ``score``, for a text."""

    @F.pandas_udf(FOUND)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([found.detect(x) for x in s], columns=["lang", "confidence", "score"])

    return lambda text: run(F.lower(text))
