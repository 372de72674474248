"""Benchmark decontamination by template canonicalisation.

A text becomes words in lower case.  In its template, numbers, names (capitalised words inside a sentence, runs of them as
one) and units are replaced by typed placeholders whose values are kept as slots.  Every window of ``WINDOW`` template
words of a document is looked up in a hash table of the benchmark's windows.  Matches of one item on one diagonal
form stretches, the longest first; a stretch counts only if its slots are consistent, with those of longer ones, too, which is
that equal values of the item stand for equal ones of the document and different for different ones, per type.  So a question with other numbers and names is caught, and
chance fits of placeholders are not.  Windows of plain words are looked up as well, for copies whose
capitals were changed.  A document is contaminated by an item if matches cover ``min(ENOUGH, 80 % of the item's words)``.

The benchmark comes in blocks of at most ``BLOCK_BYTES`` of text (one item at least), which a task holds; more than one are
searched one after the other, a pass over the documents each, and what they find is joined by text.

Edge cases: null, empty and wordless texts match nothing, and items of fewer than ``WINDOW`` words have one window of all their words; repeated
items are all listed; null item ids are ignored; an empty benchmark leaves all documents clean; other columns are kept,
but ``item_ids`` and ``covered`` are replaced.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codepoints import runs
from .common import held, slices, store

WINDOW, ENOUGH, BLOCK_BYTES, CHARS = 8, 13, 16 << 20, 1_000_000
WORD, NUMBER, NAME, UNIT, STOP = 0, 1, 2, 3, 4
#: Words for units of measure.
UNITS = frozenset(
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters mg g kg t lb lbs oz"
    " gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces ml cl l liter liters litre litres gallon gallons s sec secs second seconds min mins minute minutes h hr"
    " hrs hour hours day days week weeks month months year years hz khz mhz ghz w kw mw v kv j kj cal kcal n pa kpa bar k b kb mb gb tb usd eur gbp dollar dollars euro euros cent cents percent"
    " degree degrees mph kph".split()
)
TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]|[€$£¥%°]")
TYPED = np.array([0, 0x51ED270B7F4A7C15, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85, 0], dtype=np.uint64)
PRIME = np.uint64(0x9E3779B97F4A7C15)


class Canon:
    """Words of texts as arrays: hash, kind, and whether a sentence starts."""

    MOST = 300_000

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def chunk(self, chunk: str) -> bytes:
        """The tokens of what stands between two blanks; none goes beyond."""
        if len(self.known) >= self.MOST:
            self.known.clear()
        found = self.known[chunk] = b"".join(map(self.token, TOKEN.findall(chunk)))
        return found

    @staticmethod
    def token(t: str) -> bytes:
        low = t.lower()
        if t[0].isdigit():
            kind = NUMBER
        elif len(t) == 1 and t in ".!?:\n":
            kind = STOP
        elif low in UNITS or not t[0].isalpha():
            kind = UNIT
        else:
            kind = NAME if t[0].isupper() and (len(t) == 1 or t[1:].islower()) else WORD
        return xxhash.xxh3_64_digest(low.encode("utf-8", "replace")) + bytes([kind, 0, 0, 0, 0, 0, 0, 0])

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document number, hash and kind of every token of the texts; units count only after a number."""
        get, parts, counts = self.known.get, [], []
        for text in texts:
            own = [x if (x := get(t)) is not None else self.chunk(t) for t in text.split(" ")] if text else []
            parts.append(b"".join(own))
            counts.append(len(parts[-1]) // 16)
        both = np.frombuffer(b"".join(parts), dtype=np.uint64).reshape(-1, 2)
        doc = np.repeat(np.arange(len(texts)), counts)
        h, kind = both[:, 0], np.frombuffer(both.tobytes(), dtype=np.uint8)[8::16].astype(np.int64)
        first = np.ones(len(doc), dtype=bool)
        first[1:] = doc[1:] != doc[:-1]
        before = np.concatenate([[STOP], kind[:-1]])[: len(kind)]
        before = np.where(first, STOP, before)
        kind = np.where((kind == NAME) & (before == STOP) | (kind == UNIT) & (before != NUMBER), WORD, kind)
        words = kind != STOP
        return doc[words], h[words], kind[words]

    def forms(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Template words, then plain words: document, hash, kind, and value of the slot."""
        doc, h, kind = self.tokens(texts)
        go_on = np.zeros(len(doc), dtype=bool)
        go_on[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (doc[1:] == doc[:-1])
        value = h
        if go_on.any():  # a run of names is one, whose value is made of all of them
            head = np.flatnonzero(~go_on)
            value = np.add.reduceat(h * (np.arange(len(h), dtype=np.uint64) - np.repeat(head, np.diff(np.append(head, len(h)))).astype(np.uint64) + np.uint64(1)), head)
        yield doc[~go_on], np.where(kind > 0, TYPED[kind], h)[~go_on], kind[~go_on], value
        yield doc, h, np.zeros_like(kind), h


def windows(doc: np.ndarray, h: np.ndarray, kind: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows within one document, half of whose words at least are no placeholders, and their hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    acc = h[:n].copy()
    for k in range(1, width):
        acc = (acc ^ (acc >> np.uint64(31))) * PRIME + h[k : n + k]
    acc ^= acc >> np.uint64(29)
    plain = np.concatenate([[0], np.cumsum(kind == WORD)])
    ok = (doc[:n] == doc[width - 1 :]) & (2 * (plain[width:] - plain[:n]) >= width)
    return np.flatnonzero(ok), acc[ok]


class Index:
    """The windows of a block of benchmark items, for both forms."""

    def __init__(self, items: list[tuple[int, str]], width: int = WINDOW) -> None:
        self.width, self.ids = width, [i for i, _ in items]
        self.tables, self.slots, self.needs = [], [], []
        for form, (doc, h, kind, value) in enumerate(Canon().forms([t for _, t in items])):
            table: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
            starts = np.searchsorted(doc, np.arange(len(items) + 1))
            slots = [(h[a:b], value[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            lengths = np.diff(starts)
            for w in sorted({width} | {int(n) for n in lengths if 0 < n < width}):
                at, hashes = windows(doc, h, kind, w)
                for p, x in zip(at.tolist(), hashes.tolist(), strict=True):
                    item = int(doc[p])
                    if w == width or lengths[item] == w:
                        table[x].append((item, p - int(starts[item]), w))
            self.tables.append(dict(table))
            self.slots.append(slots)
            self.needs.append([min(ENOUGH, -(-4 * int(n) // 5)) for n in lengths])
        self.widths = [sorted({w for hits in t.values() for *_, w in hits}) for t in self.tables]
        self.masks = []
        for t in self.tables:
            mask = np.zeros(1 << 20, dtype=bool)
            if t:
                mask[np.fromiter(t, dtype=np.uint64) >> np.uint64(44)] = True
            self.masks.append(mask)

    def search(self, canon: Canon, texts: list[str | None]) -> dict[int, dict[int, int]]:
        """By text: the items that contaminate it, with the number of words covered."""
        found: dict[int, dict[int, int]] = defaultdict(dict)
        for form, (doc, h, kind, value) in enumerate(canon.forms(texts)):
            table, diagonals = self.tables[form], defaultdict(list)
            for width in self.widths[form]:
                at, hashes = windows(doc, h, kind, width)
                near = np.flatnonzero(self.masks[form][hashes >> np.uint64(44)])
                for p, x in zip(at[near].tolist(), hashes[near].tolist(), strict=True):
                    for item, q, w in table.get(x, ()):
                        if w == width:
                            diagonals[int(doc[p]), item, p - q].append((p, w))
            covered: dict[tuple[int, int], set[int]] = defaultdict(set)
            for (d, item, shift), hits in diagonals.items():
                words, values = self.slots[form][item]
                slot = lambda p: (int(kind[p]), int(values[p - shift]), int(value[p]))  # noqa: B023, E731
                # Words of the document that fit right next to a stretch belong to it, and their slots must be consistent, too.
                more = lambda p: 0 <= p - shift < len(words) and 0 <= p < len(h) and doc[p] == d and words[p - shift] == h[p]  # noqa: B023, E731
                stretches, fits = [], Mapping()
                for start, stop in runs_of(hits):
                    while more(start - 1):
                        start -= 1
                    while more(stop):
                        stop += 1
                    stretches.append((start, stop - start))
                for start, stop in sorted(runs_of(stretches), key=lambda r: (r[0] - r[1], r[0])):
                    if fits.add([slot(p) for p in range(start, stop) if kind[p] != WORD]):
                        covered[d, item].update(range(start - shift, stop - shift))
            for (d, item), places in covered.items():
                if len(places) >= self.needs[form][item]:
                    item_id = self.ids[item]
                    found[d][item_id] = max(found[d].get(item_id, 0), len(places))
        return found


def runs_of(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Start and stop of the stretches that windows (start, width) cover without a gap."""
    out: list[tuple[int, int]] = []
    for p, w in sorted(windows):
        if out and p <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], p + w)
        else:
            out.append((p, p + w))
    return out


class Mapping:
    """Values of an item's slots and those of a document that stand for them, one to one within each type."""

    def __init__(self) -> None:
        self.there: dict[tuple[int, int], int] = {}
        self.here: dict[tuple[int, int], int] = {}

    def add(self, slots: list[tuple[int, int, int]]) -> bool:
        """Take (type, value there, value here) if all are consistent with each other and with what was taken, else none."""
        there, here = {}, {}
        for k, a, b in slots:
            if self.there.get((k, a), b) != b or self.here.get((k, b), a) != a or there.setdefault((k, a), b) != b or here.setdefault((k, b), a) != a:
                return False
        self.there |= there
        self.here |= here
        return True


def blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("i"), "text").filter("i is not null and text is not null").toLocalIterator():
        if block and size + len(r["text"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], r["text"]))
        size += len(r["text"])
    if block:
        yield block


def contamination(df: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with ``item_ids``, the items that its text holds, and ``covered``, the most words any of them covers."""
    out = df.drop("item_ids", "covered").withColumns({"item_ids": F.array().cast("array<long>"), "covered": F.lit(0).cast("long")})
    parts = blocks(benchmark, block_bytes)
    first, second = next(parts, None), next(parts, None)
    if first is None:
        return out
    if second is None:
        return _pass(out, first, width)[0]
    # A pass a block over the texts, each on its own, so that a task holds one block; what they find is a table by text.
    texts, found = out.filter("text is not null").select("text", "item_ids", "covered"), []
    for block in chain((first, second), parts):
        hits, shared = _pass(texts, block, width)
        found.append(store(hits.filter("covered > 0").select(F.md5("text").alias("_text"), "item_ids", "covered").distinct(), "block")[0])
        shared.destroy()
    merged = reduce(DataFrame.unionByName, found).groupBy("_text").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("_ids"), F.max("covered").alias("_most"))
    joined = out.withColumn("_text", F.md5("text")).join(merged, "_text", "left")
    return joined.withColumns({"item_ids": F.coalesce("_ids", "item_ids"), "covered": F.coalesce("_most", "covered")}).select(*out.columns)


def _pass(df: DataFrame, items: list[tuple[int, str]], width: int) -> tuple[DataFrame, Broadcast]:
    names = df.columns
    place = names.index("text")
    shared, name = df.sparkSession.sparkContext.broadcast(items), f"index {uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, canon = held(name, lambda: Index(shared.value, width), "templates"), held("canon", Canon, "templates")
        for b in slices(batches, group="templates"):
            texts, ids, most = b.column(place).to_pylist(), b.column(len(names) - 2).to_pylist(), b.column(len(names) - 1).to_pylist()
            for i, j in runs(texts, CHARS):
                for d, hits in index.search(canon, texts[i:j]).items():
                    ids[i + d] = sorted({*ids[i + d], *hits})
                    most[i + d] = max(most[i + d], *hits.values())
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(ids, pa.list_(pa.int64())), pa.array(most, pa.int64())], names=names)

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)), shared
