"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts are sets of word shingles.  Two documents link when ``100 * intersection >= percent * union``.

Order.  Shingles are ordered by how many documents hold them, then by hash.  Frequencies are counted over all
documents: each task reports what occurs twice or more in a chunk of ``CHUNK`` shingles, so a count falls short by one a chunk at
most; the ``FREQUENT`` most frequent make a table of bounded size, and every other shingle counts as rare.
Any fixed order gives the same links; frequencies only decide how much work they are.

Prefixes.  If x and y link, they share at least ``ceil(percent * |x| / 100)`` shingles, so the first
``|x| - that + l`` of x and the like of y share l or more.  The smaller of the two need be indexed by a shorter prefix only,
as it shares ``ceil(2 * percent * |x| / (100 + percent))`` at least.  Each document picks its own l: a longer prefix costs more
postings but fewer candidates pass, and the estimate from the frequencies decides.  A pair is a candidate when its prefixes
share the smaller of the two l and, with all that may follow, could still reach the similarity; then whole sets are compared.

Groups of copies.  Equal sets are joined through one representative.  Near copies with equal minima under pairs of hash functions are
compared with a few heads of their groups first; documents that links have joined need not be paired again,
as only their component is asked for.  So a large group costs in proportion to its size, without a pair of different components left out.

Families.  Documents near a large group, but not linked with it, hold little else than its frequent shingles and would meet all
of its members by these.  So the documents with the same head are a family, and within it a set is told by its
difference from the head's: ``|x ^ y|`` is that of the differences, too.  Of two documents that do not both link with the
head, and link with each other, the differences share a shingle at least (else the triangle inequality would link both with
the head), and the rarer ones come first again: added ones by their frequency, missing ones by that of what has them.  So
pairs within a family join by multi-match prefixes of their differences, all other pairs by those of their whole sets.

Edge cases: a null, empty or blank text has an empty set and links with nothing; fewer than ``n`` words make one
shingle; rows with a null ``doc_id`` link with nothing; the nodes of the graph are
ids, so rows that share a ``doc_id`` have one component, which any of their texts may link with others (give distinct
ids to texts that are to be told apart); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held as kept
from .common import slices, store, tasks
from .components import connected_components

CHUNK, FREQUENT, MOST_MATCHES, MINIMA, AGREE, LARGE, HEADS, MOST_BROADCAST = 2_000_000, 1 << 17, 4, 8, 3, 32, 3, 500_000
#: What comparing two whole sets costs against a posting; of differences that meet, few are still to be compared.
VERIFY_COST, FAMILY_VERIFY_COST = 10.0, 1.0
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Odd multipliers of the hash functions whose minima group near copies.
MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, 2 * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sorted distinct hashes of a text's word shingles; A-Z are lower-cased, words end at ASCII white space."""

    MOST = 300_000

    def __init__(self, n: int) -> None:
        self.n, self.known = n, {}

    def word(self, word: bytes) -> bytes:
        if len(self.known) >= self.MOST:
            self.known.clear()
        found = self.known[word] = xxhash.xxh3_64_digest(word)
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        get, word = self.known.get, self.word
        words = [get(w) or word(w) for w in (text or "").encode("utf-8", "replace").translate(LOWER).split()]
        h = np.frombuffer(b"".join(words), dtype=np.uint64)
        if not len(h):
            return h
        n = min(self.n, len(h))
        acc = h[: len(h) - n + 1] + np.uint64(n)
        for k in range(1, n):
            acc = (acc ^ (acc >> np.uint64(31))) * MIX + h[k : len(h) - n + 1 + k]
        acc = (acc ^ (acc >> np.uint64(29))) * MIX2
        return np.unique(acc ^ (acc >> np.uint64(32)))


def shingler(n: int) -> Shingler:
    return kept(str(n), lambda: Shingler(n), "shingles")


@dataclass(frozen=True)
class Frequent:
    """Hashes in order, and how many documents hold each."""

    hashes: np.ndarray
    counts: np.ndarray

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(h), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.counts[at], 1)


def least_shared(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix(h: np.ndarray, frequent: Frequent, percent: int, df: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """The prefix that a document joins with, and how many of it a partner must share."""
    df = frequent.of(h) if df is None else df
    order = np.argsort(df, kind="stable")  # ties stay in order of their hashes
    need = least_shared(len(h), percent)
    least = len(h) - need + 1
    best = matches(df[order], least, need)
    return h[order[: least + best - 1]], best


def matches(df: np.ndarray, least: int, need: int, verify: float = VERIFY_COST) -> int:
    """How many shared shingles to ask for, ``need`` at most, in a prefix that is ``least`` long for one; ``df`` is in order."""
    costs = np.cumsum(df - 1.0)
    best, found = 1, None
    for match in range(1, min(MOST_MATCHES, need) + 1):
        cost = costs[min(least + match - 1, len(df)) - 1] * (1 + verify / match)
        if found is None or cost < found:
            best, found = match, cost
    return best


def difference(x: np.ndarray, head: np.ndarray, linked: bool, frequent: Frequent, percent: int) -> tuple[int, int, int, np.ndarray]:
    """Of the symmetric difference of two sets: its size, the length of the prefix by which the smaller of two
    differences is indexed, how many shingles a partner must share, and the prefix of the larger one."""
    both = np.concatenate([np.setdiff1d(x, head, assume_unique=True), gone := np.setdiff1d(head, x, assume_unique=True)])
    size = len(both)
    if not size:
        return 0, 0, 0, both
    df = frequent.of(both)
    df[size - len(gone) :] = np.maximum(1, frequent.of(head).max() - df[size - len(gone) :])
    order = np.lexsort((both, df))
    # Linked sets differ by so much at most.  What two differences must share follows, for the smaller one and the larger.
    most = (100 - percent) * len(x) // percent
    as_smaller, as_larger = max(1, size - most // 2), max(1, size - most)
    if linked:  # a partner whose own label matters is farther from the head than the similarity allows
        beyond = (size * (100 + percent) + (100 - percent) * (len(head) - len(x))) // (2 * (100 + percent)) + 1
        as_smaller, as_larger = max(as_smaller, beyond), max(as_larger, beyond)
    if as_larger > size:
        return size, 0, 1, both[:0]
    match = matches(df[order], max(1, size - as_smaller + 1), as_larger, FAMILY_VERIFY_COST)
    return size, max(0, min(size, size - as_smaller + match)), match, both[order[: size - as_larger + match]]


def small(df: DataFrame, tag: str) -> DataFrame:
    """``df`` stored, and marked for broadcast if it has ``MOST_BROADCAST`` rows of a few numbers at most."""
    df, _ = store(df, tag)
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def frequent_shingles(docs: DataFrame, n: int) -> Frequent:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, held, size, seen = shingler(n), [], 0, set()

        def report() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], names=["h", "c"])

        for b in slices(batches, group="shingles"):
            for text in b.column(1).to_pylist():
                h = shingle(text)
                if not len(h) or (key := xxhash.xxh3_128_digest(h.tobytes())) in seen:
                    continue
                seen.add(key)
                held.append(h)
                size += len(h)
                if size >= CHUNK:
                    yield report()
                    held, size, seen = [], 0, set()
        if held:
            yield report()

    rows = docs.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    found = rows.orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    h, c = (found[k].to_numpy() for k in ("h", "c"))
    h = h.view(np.uint64) if len(h) else np.empty(0, dtype=np.uint64)
    order = np.argsort(h)
    return Frequent(h[order], c[order])


SIGNED = "doc_id long, n long, rare long, d1 long, d2 long, minima array<long>, matches int, prefix array<long>"


def signatures(docs: DataFrame, n: int, percent: int, shared: Broadcast) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, table = shingler(n), shared.value
        for b in slices(batches, group="shingles"):
            ids, sizes, rare, digests, minima, needed, prefixes = b.column(0), [], [], [], [], [], []
            for text in b.column(1).to_pylist():
                h = shingle(text)
                sizes.append(len(h))
                if not len(h):
                    rare.append(0)
                    digests.append(b"\0" * 16)
                    minima.append(None)
                    needed.append(0)
                    prefixes.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                least = np.array([(h * m).min() for m in MULTIPLIERS])
                minima.append((least[0::2] * MIX ^ least[1::2]).view(np.int64))
                df = table.of(h)
                taken, match = prefix(h, table, percent, df)
                rare.append(int((df <= 1).sum()))
                needed.append(match)
                prefixes.append(taken.view(np.int64))
            d = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(rare, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(minima, longs), pa.array(needed, pa.int32()), pa.array(prefixes, longs)], names=["doc_id", "n", "rare", "d1", "d2", "minima", "matches", "prefix"])

    return docs.mapInArrow(sign, SIGNED)


COMPARED = "a long, b long, linked boolean, doc_id long, head long, n int, size int, index int, matches int, prefix array<long>"


def compared(pairs: DataFrame, docs: DataFrame, n: int, percent: int, shared: Broadcast, tag: str) -> DataFrame:
    """The pairs (a, b) with whether their whole sets link, and, where one is the ``head`` of the other, that other's
    ``doc_id``, family and difference from it.  Pairs without either are left out; texts of documents in no pair are not made into sets."""
    pairs, _ = store(pairs, f"{tag}-pairs")
    needed = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    needed = small(needed, f"{tag}-needed")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = shingler(n)
        for b in slices(batches, group="shingles"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle(t).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["doc_id", "h"])

    sets, _ = store(docs.join(needed, "doc_id", "left_semi").mapInArrow(make, "doc_id long, h binary"), f"{tag}-sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in slices(batches, group="shingles"):
            out = []
            for one, two, head, x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), b.column(4), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                less, more = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(more, less), len(more) - 1)
                both = int((more[at] == less).sum())
                linked = 100 * both >= percent * (len(x) + len(y) - both)
                if head is not None:
                    own, other = (y, x) if head == one else (x, y)
                    size, index, match, prefix = difference(own, other, linked, table, percent)
                    family = int(np.frombuffer(xxhash.xxh3_64_digest(other.tobytes()), dtype=np.int64)[0])
                    # A family is known by its head's set, as rows may share an id.
                    out.append((one, two, linked, two if head == one else one, family, len(own), size, index, match, prefix.view(np.int64)))
                elif linked:
                    out.append((one, two, linked, *[None] * 7))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in COMPARED.split(", ")])
    # The larger id first: of a star around a small id, only the second join meets a hot key.
    one = sets.select(F.col("doc_id").alias("b"), F.col("h").alias("hb"))
    two = sets.select(F.col("doc_id").alias("a"), F.col("h").alias("ha"))
    joined = pairs.join(one, "b").join(two, "a").select("a", "b", "head", "ha", "hb")
    return store(joined.mapInArrow(compare, COMPARED), f"{tag}-links")[0]


def stars(reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of likely near copies: every document with its ``head``, and with some others of large groups.

    The head of a group is the document with the fewest rare shingles, the smallest of these, so that it lies in the
    middle of the group; a document takes the first of those heads whose groups it shares ``AGREE`` of.  Groups of more than
    ``LARGE`` have ``HEADS`` more, which hashes pick, so that a large group hangs together even where copies are too far
    from its head.
    """
    keyed = reps.select("doc_id", "n", "rare", F.posexplode("minima").alias("i", "v"))
    head = lambda *order: F.min(F.struct(*order, "doc_id", "n", "rare"))
    picks = [F.struct(F.lit(None).cast("long").alias("o"), F.col("first.*"))] + [F.col(f"pick{k}") for k in range(HEADS)]
    groups = keyed.groupBy("i", "v").agg(F.count("*").alias("c"), F.min(F.struct("rare", "doc_id", "n")).alias("first"), *(head(F.xxhash64("doc_id", F.lit(k)).alias("o")).alias(f"pick{k}") for k in range(HEADS))).filter("c > 1")
    one = groups.select("i", "v", F.col("first.doc_id").alias("a"), F.col("first.n").alias("na"), F.col("first.rare").alias("ra"), F.lit(True).alias("first"))
    more = groups.filter(f"c > {LARGE}").select("i", "v", F.explode(F.array(*(F.col(f"pick{k}") for k in range(HEADS)))).alias("h"))
    more = more.select("i", "v", F.col("h.doc_id").alias("a"), F.col("h.n").alias("na"), F.col("h.rare").alias("ra"), F.lit(False).alias("first"))
    heads = one.unionByName(more).groupBy("i", "v", "a", "na", "ra").agg(F.max("first").alias("first"))
    found = keyed.withColumnRenamed("doc_id", "x").join(heads, ["i", "v"]).filter(F.col("x") != F.col("a"))
    found = found.filter(F.least("n", "na") * 100 >= F.greatest("n", "na") * percent)
    agreed = found.groupBy("x", "a").agg(F.count("*").alias("c"), F.first(F.struct("ra", "a")).alias("order"), F.first(F.struct("rare", "x")).alias("own"), F.max("first").alias("first"), F.max(~F.col("first")).alias("picked")).filter(F.col("c") >= AGREE)
    # Of the heads before it a document takes the first as its own; the picked ones are few a large group.
    own = agreed.filter("first and order < own").groupBy("x").agg(F.min("order").alias("o")).select("x", F.col("o.a").alias("a"), F.col("o.a").alias("head"))
    others = agreed.filter("picked").select("x", F.struct(F.xxhash64("a").alias("o"), "a").alias("s")).groupBy("x").agg(F.min("s").alias("one"), F.max("s").alias("two"))
    others = others.select("x", F.explode(F.array("one.a", "two.a")).alias("a"), F.lit(None).cast("long").alias("head"))
    return own.unionByName(others).groupBy(F.least("a", "x").alias("a"), F.greatest("a", "x").alias("b")).agg(F.max("head").alias("head"))


def pairs_of(met: DataFrame, enough: str) -> DataFrame:
    """Pairs (a, b) of documents that met at ``least(matches)`` places and can reach what ``enough`` asks for."""
    counted = met.groupBy("doc_id_a", "doc_id_b").agg(F.count("*").alias("c"), F.first(F.least("matches_a", "matches_b")).alias("need"), F.first(F.expr("greatest(size_a - index_a, size_b - probe_b)")).alias("rest"), F.first(F.expr("bigint(n_a) + n_b")).alias("n"), F.first(F.expr("size_a + size_b")).alias("sizes"))
    # Of the prefix that ends first in the order, all shared shingles are counted; what follows it adds its rest at most.
    return counted.filter(f"c >= need and {enough}").select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b"))


POSTING = ("pos", "doc_id", "n", "size", "probe", "index", "matches", "label", "head")


def postings(known: DataFrame, key: list[str], parts: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join on shared shingles; those that only one label has are left out."""
    spread = known.select(*{*POSTING, *key} - {"pos", "t"}, F.posexplode("prefix").alias("pos", "t")).repartition(parts, *key)
    over = f"over (partition by {', '.join(key)})"
    kept, _ = store(spread.withColumns({"lo": F.expr(f"min(label) {over}"), "hi": F.expr(f"max(label) {over}")}).filter("lo < hi").drop("lo", "hi"), tag)
    return tuple(kept.select(*key, *(F.col(c).alias(f"{c}_{k}") for c in POSTING if c not in key)) for k in "ab")


def family_candidates(families: DataFrame, label: DataFrame, percent: int, parts: int) -> DataFrame:
    """Pairs of one family whose differences from the head share enough, but those that links have joined already."""
    known = families.join(label, "doc_id", "left").withColumns({"probe": F.size("prefix"), "label": F.coalesce("label", "doc_id")})
    a, b = postings(known, ["head", "t"], parts, "differences")
    fits = f"(size_a < size_b or size_a = size_b and doc_id_a < doc_id_b) and label_a <> label_b and 100L * least(n_a, n_b) >= {percent}L * greatest(n_a, n_b)"
    # |x ^ y| is what the differences do not share; linked sets have (100 - percent) / (100 + percent) of both sizes at most.
    near_enough = f"(size_a + size_b - 2 * (least(pos_a, pos_b) + least(size_a - pos_a, size_b - pos_b))) * {100 + percent}L <= {100 - percent}L * (n_a + n_b)"
    met = a.filter("pos_a < index_a").join(b, ["head", "t"]).filter(f"{fits} and {near_enough}")
    return pairs_of(met, f"(sizes - 2 * (c + rest)) * {100 + percent} <= {100 - percent} * n")


def candidates(reps: DataFrame, families: DataFrame, label: DataFrame, percent: int, parts: int) -> DataFrame:
    """Pairs of no common family whose prefixes share enough, but those that links have joined already."""
    n = F.col("n")
    known = reps.join(label, "doc_id", "left").join(families.select("doc_id", "head"), "doc_id", "left")
    known = known.withColumns({"n": n.cast("int"), "size": n.cast("int"), "probe": F.size("prefix"), "index": (n - F.ceil(2 * percent * n / (100 + percent)) + F.col("matches")).cast("int"), "label": F.coalesce("label", "doc_id")})
    a, b = postings(known, ["t"], parts, "postings")
    fits = f"(n_a < n_b or n_a = n_b and doc_id_a < doc_id_b) and label_a <> label_b and not coalesce(head_a = head_b, false) and 100L * n_a >= {percent}L * n_b"
    # Up to a shared shingle no more can be shared than its place, and behind it than the shorter rest: every shared shingle of a link passes.
    near_enough = f"(least(pos_a, pos_b) + least(n_a - pos_a, n_b - pos_b)) * {100 + percent}L >= {percent}L * (n_a + n_b)"
    met = a.filter("pos_a < index_a").join(b, "t").filter(f"{fits} and {near_enough}")
    return pairs_of(met, f"(c + rest) * {100 + percent} >= {percent} * n")


def jaccard_join(df: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``df`` with ``doc_id`` and ``text``."""
    docs = _texts(df)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, n))
    signed, _ = store(signatures(docs, n, percent, shared), "signed")
    full = signed.filter("n > 0 and doc_id is not null")
    groups = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")).filter("c > 1").drop("c")
    repeated = small(groups, "repeated")
    reps = full.join(repeated, ["d1", "d2"], "left").filter("rep is null or rep = doc_id").drop("rep")
    near = compared(stars(reps, percent), docs, n, percent, shared, "near")
    families = near.filter("head is not null").drop("a", "b", "linked")
    near = near.filter("linked").select("a", "b")
    label = small(connected_components(near).toDF("doc_id", "label"), "labels")
    parts = tasks(df.sparkSession, signed.agg(F.sum("n")).first()[0] or 0, 4_000_000)
    far = family_candidates(families, label, percent, parts).unionByName(candidates(reps, families, label, percent, parts))
    far = compared(far.distinct().withColumn("head", F.lit(None).cast("long")), docs, n, percent, shared, "far")
    links = near.unionByName(far.select("a", "b"))
    found = small(connected_components(links), "components").withColumnRenamed("id", "rep")
    owned = signed.select("doc_id", "n", "d1", "d2").join(repeated, ["d1", "d2"], "left").withColumn("rep", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
    return owned.join(found, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def brute_force(rows: list[tuple[int, str | None]], n: int, percent: int, words: Callable[[str], list[str]]) -> dict[int, int]:
    """Components of a small table from all pairs of its sets of word tuples."""
    sets = {}
    for i, text in rows:
        w = words(text or "")
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}
