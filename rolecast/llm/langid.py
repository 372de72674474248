"""Language identification by hierarchical discrimination.

First the language family is predicted (one-versus-rest linear support vector machines), then one-versus-one linear
machines separate the languages within it.  Features are hashed counts of one to three characters over the whole
text, lower-cased, with all that is not a letter as one blank; they are damped by a square root and scaled to length one.

Fitting takes at most ``SAMPLE`` labelled rows, those with the smallest hashes; it runs in one task on their feature rows.  Prediction covers all rows.  ``lang_pred`` is ``und``, with score 0, where a text is null or has no letter.

Edge cases: rows with a null text or language are not learned from; with one learned language all texts with letters
are of that language; with none, all are ``und``; repeated rows are predicted each; very long texts are read in pieces;
other columns are kept, and those named like the results are replaced, unless these get other names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codepoints import LOWER, UPPER, points, runs, tables
from .common import release, slices

SAMPLE, BUCKETS, CHARS, BLOCK = 4000, 4096, 400_000, 256
#: Families of languages by code.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt",
    "indic": "hi bn ur mr gu pa ne",
    "sinitic": "zh yue",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def codes(cp: np.ndarray, letter_before: bool) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, a run of all else as one blank; and which of the characters stay."""
    kinds, lower = tables()
    kind = kinds[cp]
    letter = (kind == UPPER) | (kind == LOWER)
    keep = letter | np.concatenate([[letter_before], letter[:-1]])
    return np.where(letter, lower[cp], 32)[keep].astype(np.uint64), keep


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` codes."""
    mixed = code * np.uint64(0x9E3779B97F4A7C15)
    h = mixed[: len(code) - n + 1].copy()
    for k in range(1, n):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : len(code) - n + 1 + k]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(40)).astype(np.int64)


def long_counts(text: str, buckets: int, chars: int) -> np.ndarray:
    """Counts of one text, a piece of it at a time; runs across the pieces' ends are counted once."""
    out, tail, letter = np.zeros(buckets), np.empty(0, dtype=np.uint64), True
    for at in range(0, len(text) + 1, chars):
        piece = text[at : at + chars] + (" " if at + chars > len(text) else "")
        cp = points(piece)
        code, _ = codes(cp, letter)
        letter = bool(np.isin(tables()[0][cp[-1]], (UPPER, LOWER)))
        both = np.concatenate([tail, code])
        for n in (1, 2, 3):
            new = both[max(0, len(tail) - n + 1) :]
            if len(new) >= n:
                out += np.bincount(grams(new, n) % buckets, minlength=buckets)
        tail = both[-2:]
    return out


def features(texts: list[str], buckets: int = BUCKETS, chars: int = CHARS) -> np.ndarray:
    """A row of feature values for each text; a text of more than ``chars`` characters is read in pieces."""
    short = [t if len(t) <= chars else "" for t in texts]
    cps = [points(t + " ") for t in short]
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), [len(c) for c in cps])
    cp, keep = codes(np.concatenate(cps), True)
    doc = doc[keep]
    out = np.zeros(len(texts) * buckets, dtype=np.float64)
    for n in (1, 2, 3):
        if len(cp) < n:
            break
        at = doc[: len(cp) - n + 1] * buckets + grams(cp, n) % buckets
        if n > 1:
            at = at[doc[: len(at)] == doc[n - 1 :]]
        out += np.bincount(at, minlength=len(out))
    out = out.reshape(len(texts), buckets)
    for i, t in enumerate(texts):
        if len(t) > chars:
            out[i] = long_counts(t, buckets, chars)
    out = np.sqrt(out)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, steps: int = 300) -> np.ndarray:
    """Weights, the bias last, of a linear SVM with squared hinge loss for labels -1 and 1, by accelerated gradients.

    ``y`` is 0 for rows of ``x`` that do not count, so that no part of it need be copied.
    """
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), np.where(y < 0, 0.5 / max(1, (y < 0).sum()), 0)).astype(np.float32) * c * 100
    rate = np.float32(1.0 / (1.0 + 2 * float((weight * (np.einsum("ij,ij->i", x, x) + 1)).sum())))
    w = v = np.zeros(x.shape[1] + 1, dtype=np.float32)
    for k in range(steps):
        slack = weight * y * np.maximum(0, 1 - y * (x @ v[:-1] + v[-1]))
        new = v - rate * (v - 2 * np.append(slack @ x, slack.sum()))
        v = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    langs: dict[str, list[str]] = field(default_factory=dict)
    family_w: np.ndarray | None = None
    pair_w: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)


def fit(x: np.ndarray, langs: list[str]) -> Model:
    m = Model()
    for code in sorted(set(langs)):
        m.langs.setdefault(FAMILY.get(code.split("-")[0].lower(), f"only {code}"), []).append(code)
    m.families = sorted(m.langs)
    family = np.array([next(f for f in m.families if code in m.langs[f]) for code in langs])
    codes = np.array(langs)
    if len(m.families) > 1:
        m.family_w = np.stack([fit_svm(x, np.where(family == f, 1, -1)) for f in m.families])
    for f in m.families:
        for a, b in combinations(m.langs[f], 2):
            m.pair_w[a, b] = fit_svm(x, np.where(codes == a, 1, np.where(codes == b, -1, 0)))
    return m


def predict(m: Model, x: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Languages and scores; a score is the product of what speaks for the family and for the language within it."""
    n = len(x)
    sure = lambda margin: 1 / (1 + np.exp(-4 * margin))
    if m.family_w is not None:
        margins = x @ m.family_w[:, :-1].T + m.family_w[:, -1]
        family = margins.argmax(axis=1)
        rest = np.where(np.arange(margins.shape[1]) == family[:, None], -np.inf, margins).max(axis=1)
        score = sure((margins[np.arange(n), family] - rest) / 2)
    else:
        family, score = np.zeros(n, dtype=int), np.ones(n)
    out = np.empty(n, dtype=object)
    for k, f in enumerate(m.families):
        own, codes = np.flatnonzero(family == k), m.langs[f]
        if not len(own):
            continue
        votes, trust = np.zeros((len(own), len(codes))), np.full((len(own), len(codes)), np.inf)
        for i, j in combinations(range(len(codes)), 2):
            w = m.pair_w[codes[i], codes[j]]
            margin = x[own] @ w[:-1] + w[-1]
            p = sure(margin)
            votes[:, i] += (margin >= 0) + 1e-3 * p
            votes[:, j] += (margin < 0) + 1e-3 * (1 - p)
            trust[:, i], trust[:, j] = np.minimum(trust[:, i], p), np.minimum(trust[:, j], 1 - p)
        best = votes.argmax(axis=1)
        out[own] = np.array(codes, dtype=object)[best]
        score[own] *= np.where(np.isinf(t := trust[np.arange(len(own)), best]), 1.0, t)
    return list(out), score


def floors(m: Model) -> dict[str, float]:
    """The least score that a text without any sign of a language still gets, by predicted language."""
    family = 0.5 if len(m.families) > 1 else 1.0
    return {code: family * (0.5 if len(codes) > 1 else 1.0) for codes in m.langs.values() for code in codes}


def fitted(found: pa.Table) -> Model:
    """The model of rows of ``lang`` and ``x``."""
    order = pc.sort_indices(found, [("lang", "ascending"), ("x", "ascending")]).to_numpy()  # rows come in any order; a known one gives the same model
    place = np.empty(len(order), dtype=int)
    place[order] = np.arange(len(order))
    x, at = np.empty((len(order), BUCKETS), dtype=np.float32), 0
    for part in found["x"].chunks:
        for row in part:
            x[place[at]] = np.frombuffer(row.as_buffer(), dtype="<f2")
            at += 1
    return fit(x, found["lang"].take(pa.array(order)).to_pylist())


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` distinct rows of ``doc_id``, ``text`` and ``lang``, those with the smallest hashes.

    Features come from all tasks, the machines are fitted in one, and only their weights reach the driver.
    """
    rows = labelled.filter("text is not null and lang is not null").select(F.xxhash64("doc_id", "text", "lang").alias("h"), F.col("lang").cast("string").alias("lang"), "text")
    most = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h").alias("h")).first()["h"]
    if most is None:
        return Model()
    taken = rows.filter(F.col("h") <= most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, BLOCK):
            h, langs, texts = (b.column(i).to_pylist() for i in range(3))
            for i, j in runs(texts, CHARS):
                x = features(texts[i:j])
                yield pa.RecordBatch.from_arrays([pa.array(h[i:j], pa.int64()), pa.array(langs[i:j], pa.string()), pa.array([r.astype("<f2").tobytes() for r in x], pa.binary())], names=["h", "lang", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches), pa.schema([("lang", pa.string()), ("x", pa.binary())]))
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted(found))], pa.binary())], names=["model"])
        del found
        release()

    once = taken.mapInArrow(run, "h long, lang string, x binary").groupBy("h").agg(F.first("lang").alias("lang"), F.first("x").alias("x"))  # rows of a hash are equal
    model = once.orderBy("h").limit(sample).select("lang", "x").mapInArrow(train, "model binary").collect()
    return pickle.loads(model[0]["model"]) if model else Model()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def identify(df: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its score; columns of these names are replaced."""
    df = df.drop(lang, score)
    names = df.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, BLOCK):
            texts = b.column(place).to_pylist()
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            own = [i for i, t in enumerate(texts) if model.families and has_letter(t)]
            held = [texts[i] for i in own]
            for i, j in runs(held, CHARS):
                for n, code, p in zip(own[i:j], *predict(model, features(held[i:j])), strict=True):
                    langs[n], scores[n] = code, p
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, lang, score])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, `{lang}` string, `{score}` double")
