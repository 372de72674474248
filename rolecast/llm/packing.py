"""Packing of tokenised documents into sequences of fixed capacity.

Method: first-fit decreasing with a tournament tree over the free space of the bins, run independently in
randomised groups of documents.  A group takes about ``group_bytes`` of text, so its memory does not depend on
the corpus, and groups are dealt by a seeded hash, so no order of the input can spoil one.

* Documents longer than the capacity are first cut into full sequences and a rest; rests are the items of FFD.
* Rows that repeat very often are numbered, and the number is part of the hash, so they spread over the groups, too.
* FFD leaves gaps at the end of a few bins.  Because pieces may be cut, the emptiest bins are then dissolved into
  the gaps of the fuller ones; at most one bin a group stays partly filled, and it is split into sequences whose
  lengths are powers of two, which need no padding.

Edge cases: a null or empty text is the single end id; repeated rows (also of a ``doc_id``) are packed as often as
they occur; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, numbered_copies, release, tasks

CAPACITY, END_ID, SEED = 2048, 1, 20240229
#: Bits of a sequence's number within its group; the others, 35 of them, number the groups.
WITHIN = 28
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PIECES = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])


class TournamentTree:
    """Free space of bins; ``first_fit`` finds the leftmost bin with enough of it in O(log n)."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.width = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.width)

    def first_fit(self, need: int) -> int:
        free, at = self.free, 1
        while at < self.width:
            at *= 2
            if free[at] < need:
                at += 1
        left = at - self.width
        free[at] -= need
        while at > 1:
            at //= 2
            a, b = free[2 * at], free[2 * at + 1]
            free[at] = a if a > b else b
        return left


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces that cover documents of the given lengths."""
    full, rests = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % capacity
        full += [[(doc, s, capacity)] for s in range(0, cut, capacity)]
        if n > cut:
            rests.append((doc, cut, n - cut))
    rests.sort(key=lambda x: (-x[2], x[0]))
    tree, bins = TournamentTree(max(1, len(rests)), capacity), [[] for _ in rests]
    for item in rests:
        bins[tree.first_fit(item[2])].append(item)
    return full + fill_gaps([b for b in bins if b], capacity)


def fill_gaps(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Dissolve the emptiest bins into the gaps of the others and split what is left by powers of two."""
    order = sorted(bins, key=lambda b: -sum(x[2] for x in b))
    gaps = [capacity - sum(x[2] for x in b) for b in order]
    to, last = 0, len(order) - 1
    while to < last:
        if not gaps[to]:
            to += 1
            continue
        doc, start, n = order[last].pop()
        take = min(n, gaps[to])
        order[to].append((doc, start, take))
        gaps[to] -= take
        gaps[last] += take
        if n > take:
            order[last].append((doc, start + take, n - take))
        if not order[last]:
            last -= 1
    done = [b for b in order[:to] if b]
    for b in order[to : last + 1]:
        left = sum(x[2] for x in b)
        while left:
            want = 1 << (left.bit_length() - 1)
            left, part = left - want, []
            while want:
                doc, start, n = b.pop()
                take = min(n, want)
                part.append((doc, start, take))
                want -= take
                if n > take:
                    b.append((doc, start + take, n - take))
            done.append(part)
    return done


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, equal to ``Tokenizer.encode(...).ids``.

    No token of this tokenizer spans white space, so ids are looked up by words split at ASCII white space, each distinct
    word of a batch of texts once.  A plain word (Latin-1 letters, then ASCII signs) goes through the library's model alone;
    any other goes through the whole library tokenizer, which knows further white space and the special tokens.
    """

    PLAIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-&(-/:-@\[-`{-~]*)$"
    MOST = 500_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.level = self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        #: Ids by lower-cased part of a word.  The older half is asked before the model, and goes when the newer one is full.
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        if (known := self.older.get(part)) is None:
            mapped = part if part.isascii() else self.level.pre_tokenize_str(part)[0][0]
            known = np.array([x.id for x in self.model.tokenize(mapped)], dtype="<u4").tobytes()
        if len(self.newer) >= self.MOST:
            self.newer, self.older = {}, self.newer
        self.newer[part] = known
        return known

    def parts(self, column: pa.Array) -> pa.Array:
        coded = column.dictionary_encode()
        get, distinct = self.newer.get, coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [get(x) for x in distinct]
        for i, x in enumerate(known):
            if x is None:
                known[i] = self.part(distinct[i]) if distinct[i] else b""
        return pa.array(known, pa.large_binary()).take(coded.indices)

    def words(self, words: pa.Array) -> pa.Array:
        core, signs = pc.extract_regex(words, self.PLAIN).flatten()
        ids = pc.binary_join_element_wise(self.parts(pc.utf8_lower(core)), self.parts(signs), pa.scalar(b"", pa.large_binary()))
        if ids.null_count:
            other = ids.is_null()
            ids = pc.replace_with_mask(ids, other, pa.array([self.whole(w) for w in words.filter(other).to_pylist()], pa.large_binary()))
        return ids

    def batch(self, texts: list[str | None]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
        coded = words.values.dictionary_encode()
        ids = self.words(coded.dictionary).take(coded.indices)
        _, starts, data = ids.buffers()
        bounds = np.frombuffer(starts, dtype=np.int64)[words.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def __call__(self, text: str | None) -> bytes:
        return self.batch([text])[0]


def encoder(path: str) -> Encoder:
    return held(path, lambda: Encoder(path), "encoder")


def first_sequence(group: int) -> int:
    """The number of a group's first sequence.  A group of a few MiB, or of one text of the 2 GiB that a row can hold, has fewer than 2 ** 28."""
    return group << WITHIN


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, seed: int = SEED, group_bytes: int = 4 << 20) -> DataFrame:
    """One row a piece (:data:`SCHEMA`) for ``df`` with ``doc_id`` and ``text``."""
    spark = df.sparkSession
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 64
    total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    groups = int(total // group_bytes) + 1
    rows = numbered_copies(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    dealt = rows.select("doc_id", "text", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", "_copy"), F.lit(groups)).alias("grp"))

    def group(table: pa.Table) -> pa.Table:
        encode, end = encoder(tokenizer_path), np.array([END_ID], dtype="<u4").tobytes()
        # The order in which rows arrive depends on the shuffle; packing must not.
        rows = sorted(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        ids = [x + end for x in encode.batch([text for _, text in rows])]
        first, out = first_sequence(table["grp"][0].as_py()), []
        for s, pieces in enumerate(pack([len(x) // 4 for x in ids], capacity)):
            offset = 0
            for doc, start, n in pieces:
                out.append((rows[doc][0], start, n, zlib.crc32(ids[doc][4 * start : 4 * (start + n)]), len(ids[doc]) // 4, first + s, offset))
                offset += n
        found = pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=PIECES)
        del rows, ids, out
        release()
        return found

    return dealt.repartition(tasks(spark, total, 16 << 20), "grp").groupBy("grp").applyInArrow(group, SCHEMA)


def padding(lengths: Iterable[int], capacity: int = CAPACITY) -> int:
    """Ids of padding for sequences of these lengths: to the capacity, but none at a power of two."""
    return sum(capacity - n for n in lengths if n & (n - 1))


def sequences(rows: Iterable) -> Iterator[list]:
    """Group pieces by sequence, in order of their offsets."""
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for x in by.values():
        yield sorted(x, key=lambda r: r["offset"])
