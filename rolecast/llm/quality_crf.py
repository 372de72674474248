"""Document quality from a linear-chain conditional random field over lines.

Every non-blank line of a text is good or bad.  Observations of a line are what share of it are signs, capitals,
digits, words that repeat the word before, words that end in runs of signs, words without letters; its length, word
length and ending; and the same of its neighbours.  Two labels, a transition matrix and start weights make the chain.
It is fitted by maximum likelihood; the lines of a labelled document take its label.  The score of a document is the mean of its lines' forward-backward marginals of *good*,
weighted by their lengths, put through a logistic curve that is fitted on the same sample (it keeps the order).

Fitting takes at most ``SAMPLE`` labelled documents, those with the smallest hashes, and runs in one task on their
observations.  Scoring covers whole texts of all rows.

Edge cases: a text that is null, empty or blank scores 0; with no labelled rows every other text scores 0.5; repeated
rows are scored each; a ``doc_id`` that is labelled twice counts once, with the smaller label; very long texts are read in
pieces, and a word of more than two million characters counts as several; other columns are kept, and one named like the
score is replaced, unless that gets another name.  For fitting, chains of more than ``CHUNK`` lines are cut into such.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codepoints import DIGIT, LOWER, SIGN, SPACE, UPPER, points, runs, tables
from .common import release, slices

SAMPLE, CHARS, STEPS, CHUNK = 5000, 500_000, 250, 64
CUTS = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.6])  # bucket 0: none at all
SHARES = 7
OWN, LEVELS = SHARES + 3, len(CUTS) + 1
WIDTH = OWN * LEVELS + 2 * SHARES * LEVELS + 2


#: Sums over the words and characters of a line, and whether its last word ends a sentence.
CHARS_IN, LETTERS, SIGNS, CAPITALS, DIGITS, WORDS, SAME, RUN, BARE, ENDS, FINAL = range(11)


def pieces(text: str, chars: int = CHARS) -> list[str]:
    """A text in pieces of about so many characters, cut behind white space; a word of more than four times that is cut, too."""
    out, at = [], 0
    blank = re.compile(r"\s")
    while len(text) - at > chars:
        m = blank.search(text, at + chars, at + 4 * chars)
        end = m.end() if m else min(len(text), at + 4 * chars)
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


def line_sums(texts: list[str], chars: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """For every line of the texts: the text's number, and its sums.  Texts beyond ``chars`` are read in pieces."""
    if all(len(t) <= chars for t in texts):
        return _sums(texts)
    owners, sums = [], []
    for i, text in enumerate(texts):
        parts, found, before = pieces(text, chars), [], ""
        for part in parts:
            own = _sums([part])[1]
            if before and before[-1] != "\n":  # the line goes on
                last, first = before.split("\n")[-1].split()[-1:], part.split("\n")[0].split()[:1]
                own[0, SAME] += bool(last) and last == first
                if not own[0, WORDS]:
                    own[0, FINAL] = found[-1][-1, FINAL]
                own[0, :FINAL] += found[-1][-1, :FINAL]
                found[-1] = found[-1][:-1]
            elif before:  # the empty line that the end of the piece before stands for
                found[-1] = found[-1][:-1]
            found.append(own)
            before = part
        sums += found
        owners.append(np.full(sum(map(len, found)), i))
    return np.concatenate(owners), np.concatenate(sums)


def _sums(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    kinds, _ = tables()
    cps = [points(t + "\n") for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in cps])
    cp = np.concatenate(cps)
    kind = kinds[cp]
    ends = np.flatnonzero(cp == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    space = kind == SPACE

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (sums[ends] - sums[starts]).astype(np.float64)

    before = np.concatenate([[True], space[:-1]])
    first = np.flatnonzero(~space & before)  # where words start
    past = np.flatnonzero(space & ~before)  # and end
    line = np.searchsorted(ends, first)
    n_lines = len(ends)
    sign = kind == SIGN
    # Words by two sums of their code points; equal neighbours repeat.
    csum = np.concatenate([[0], np.cumsum(cp.astype(np.uint64))])
    qsum = np.concatenate([[0], np.cumsum(cp.astype(np.uint64) * (np.arange(len(cp), dtype=np.uint64) + np.uint64(1)))])
    plain = csum[past] - csum[first]
    placed = qsum[past] - qsum[first] - first.astype(np.uint64) * plain
    same = np.zeros(len(first), dtype=bool)
    same[1:] = (plain[1:] == plain[:-1]) & (placed[1:] == placed[:-1]) & (line[1:] == line[:-1]) & ((past - first)[1:] == (past - first)[:-1])
    last = past - 1
    run = sign[last] & sign[last - 1] & (last > first)
    sums = np.concatenate([[0], np.cumsum(sign, dtype=np.int32)])
    bare = (sums[past] - sums[first]) == (past - first)
    ends_sentence = np.isin(cp[last], [ord(c) for c in ".!?…:;"])

    def by_line(mask: np.ndarray) -> np.ndarray:
        return np.bincount(line, weights=mask, minlength=n_lines)

    final = np.zeros(n_lines)
    final[line] = ends_sentence  # the last word of a line is the last to be written
    out = [total(~space), total((kind == UPPER) | (kind == LOWER)), total(sign), total(kind == UPPER), total(kind == DIGIT), np.bincount(line, minlength=n_lines), by_line(same), by_line(run), by_line(bare), by_line(ends_sentence), final]
    return owner[ends], np.stack(out, axis=1).astype(np.float64)


def observations(texts: list[str], most: int = CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every non-blank line of the texts: the text's number, the line's length and its active features, a row a line."""
    owner, sums = line_sums(texts, most)
    live = sums[:, WORDS] > 0
    doc, sums = owner[live], sums[live]
    chars, letters, words = sums[:, CHARS_IN], np.maximum(sums[:, LETTERS], 1), sums[:, WORDS]
    shares = np.stack([sums[:, SIGNS] / chars, sums[:, CAPITALS] / letters, sums[:, DIGITS] / chars, *(sums[:, k] / words for k in (SAME, RUN, BARE, ENDS))], axis=1)
    levels = np.where(shares <= 0, 0, np.searchsorted(CUTS, shares, side="left"))
    length = np.minimum(np.log2(chars + 1).astype(int) // 2, LEVELS - 1)
    mean = np.minimum((chars / words / 2).astype(int), LEVELS - 1)
    own = np.concatenate([levels, length[:, None], mean[:, None], sums[:, FINAL].astype(int)[:, None]], axis=1) + np.arange(OWN) * LEVELS
    head, tail = np.ones(len(doc), dtype=bool), np.ones(len(doc), dtype=bool)
    head[1:], tail[:-1] = doc[1:] != doc[:-1], doc[1:] != doc[:-1]
    base = OWN * LEVELS
    outside = base + 2 * SHARES * LEVELS
    prev = np.where(head[:, None], outside, np.roll(levels, 1, axis=0) + base + np.arange(SHARES) * LEVELS)
    succ = np.where(tail[:, None], outside + 1, np.roll(levels, -1, axis=0) + base + (SHARES + np.arange(SHARES)) * LEVELS)
    return doc, chars, np.concatenate([own, prev, succ], axis=1).astype(np.int16)


@dataclass
class Chain:
    emit: np.ndarray  # WIDTH x 2
    move: np.ndarray  # 2 x 2
    start: np.ndarray  # 2
    scale: tuple[float, float] = (0.0, 1.0)  # of the logistic curve from mean marginals to scores


def padded(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each line in a (sequence, step) grid: sequence number and step."""
    new = np.ones(len(doc), dtype=bool)
    new[1:] = doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    seq = np.cumsum(new) - 1
    return seq, np.arange(len(doc)) - first[seq]


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def forward_backward(m: Chain, scores: np.ndarray, seq: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals a line (n x 2) and summed expected transitions (2 x 2)."""
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    order = np.argsort(step, kind="stable")
    bounds = np.searchsorted(step[order], np.arange(step.max() + 2))
    for t in range(step.max() + 1):
        at = order[bounds[t] : bounds[t + 1]]
        alpha[at] = scores[at] + (m.start if t == 0 else lse(alpha[at - 1][:, :, None] + m.move[None], 1))
    for t in range(step.max(), 0, -1):
        at = order[bounds[t] : bounds[t + 1]]
        beta[at - 1] = lse(m.move[None] + (scores[at] + beta[at])[:, None, :], 2)
    joint = alpha + beta
    z = lse(joint, 1)
    later = np.flatnonzero(step > 0)
    pairs = np.exp(alpha[later - 1][:, :, None] + m.move[None] + (scores[later] + beta[later])[:, None, :] - z[later][:, None, None]).sum(axis=0) if len(later) else np.zeros((2, 2))
    return np.exp(joint - z[:, None]), pairs


def emitted(m: Chain, feats: np.ndarray) -> np.ndarray:
    """Summed weights of the lines' features; a column at a time, so that memory is a few values a line."""
    out = np.zeros((len(feats), 2))
    for k in range(feats.shape[1]):
        out += m.emit[feats[:, k]]
    return out


def fit(doc: np.ndarray, feats: np.ndarray, labels: np.ndarray, steps: int = STEPS, l2: float = 1e-4) -> Chain:
    """Maximum likelihood by Adam; ``labels`` has one value a line.  Chains of more than ``CHUNK`` lines are cut into such
    for fitting, as a step of the forward pass takes a line of all chains at once; in scoring they are whole."""
    seq, step = padded(doc)
    step, y = step % CHUNK, labels.astype(int)
    m = Chain(np.zeros((WIDTH, 2)), np.zeros((2, 2)), np.zeros(2))
    columns, n, onehot = np.ascontiguousarray(feats.T), len(y), np.eye(2)[y]
    head, later = step == 0, np.flatnonzero(step > 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[later - 1], y[later]), 1)
    params = [m.emit, m.move, m.start]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, steps + 1):
        marg, pairs = forward_backward(m, emitted(m, feats), seq, step)
        diff, grad = np.ascontiguousarray((onehot - marg).T), np.zeros((WIDTH, 2))
        for column in columns:
            for c in (0, 1):
                grad[:, c] += np.bincount(column, weights=diff[c], minlength=WIDTH)
        grads = [grad, seen - pairs, diff[:, head].sum(axis=1)]
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            g = g / n - l2 * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += 0.05 * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.99**k)) + 1e-8)
    return m


def document_scores(m: Chain | None, texts: list[str | None]) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, j in runs(texts, CHARS):
        doc, length, feats = observations([t or "" for t in texts[i:j]])
        if not len(doc):
            continue
        if m is None:
            good = np.full(len(doc), 0.5)
        else:
            good = forward_backward(m, emitted(m, feats), *padded(doc))[0][:, 1]
        weight = np.bincount(doc, weights=length, minlength=j - i)
        mean = np.bincount(doc, weights=length * good, minlength=j - i) / np.maximum(weight, 1)
        if m is not None:
            mean = 1 / (1 + np.exp(-(m.scale[0] + m.scale[1] * mean)))
        out[i:j] = np.where(weight > 0, mean, 0)
    return np.clip(out, 0, 1)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Offset and slope of a logistic curve by Newton's method."""
    a, w = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w = w + np.linalg.solve(hess, a.T @ (y - p) - ridge * w)
    return float(w[0]), float(w[1])


PER_LINE = (OWN + 2 * SHARES) * 2  # bytes of a line's features


def fitted(found: list[tuple[int, int, bytes, bytes]]) -> Chain:
    """The chain of documents (id, quality, features, line lengths)."""
    counts = [len(x) // PER_LINE for _, _, x, _ in found]
    feats = np.frombuffer(b"".join(x for *_, x, _ in found), dtype=np.int16).reshape(-1, PER_LINE // 2)
    doc, y = np.repeat(np.arange(len(found)), counts), np.array([int(q > 0) for _, q, *_ in found])
    m = fit(doc, feats, y[doc])
    good = forward_backward(m, emitted(m, feats), *padded(doc))[0][:, 1]
    length = np.frombuffer(b"".join(z for *_, z in found), dtype="<f4")
    m.scale = calibrate(np.bincount(doc, weights=good * length) / np.bincount(doc, weights=length), y)
    return m


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """Fit on at most ``sample`` distinct rows among the ``sample`` labelled documents with the smallest hashes.

    Features come from all tasks, the chain is fitted in one, and only its weights reach the driver.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    taken = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").selectExpr("cast(doc_id as long) doc_id", "text", "cast(quality as int) quality", "xxhash64(doc_id, text) h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, texts, quality, h = (b.column(i).to_pylist() for i in range(4))
            for i, j in runs(texts, CHARS):
                doc, length, feats = observations([t or "" for t in texts[i:j]])
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                rows = [(h[i + k], ids[i + k], quality[i + k], feats[cut[k] : cut[k + 1]].tobytes(), length[cut[k] : cut[k + 1]].astype("<f4").tobytes()) for k in range(j - i) if cut[k] < cut[k + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["h", "doc_id", "quality", "x", "length"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted(found))], pa.binary())], names=["model"])
        del found
        release()

    rows = taken.mapInArrow(run, "h long, doc_id long, quality int, x binary, length binary")
    once = rows.groupBy("h").agg(*(F.first(c).alias(c) for c in ("doc_id", "quality", "x", "length")))  # rows of a hash are equal
    model = once.orderBy("h").limit(sample).select("doc_id", "quality", "x", "length").mapInArrow(train, "model binary").collect()
    return pickle.loads(model[0]["model"]) if model else None


def score(df: DataFrame, model: Chain | None, name: str = "score") -> DataFrame:
    """``df`` with the score; a column of its name is replaced."""
    df = df.drop(name)
    names = df.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(document_scores(model, b.column(place).to_pylist()))], names=[*names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, `{name}` double")
