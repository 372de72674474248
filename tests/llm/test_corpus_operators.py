"""The corpus operators against brute force, round trips and held-out accuracy."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolecast.llm import chat_format, components, decontaminate, embed_dedup, html_extract, jaccard_join, langid, packing, quality_crf, queries, sharding, warc
from rolecast.llm.common import held, store

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, *texts, schema="doc_id long, text string"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], schema)


def test_all_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))


# 1 HTML


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain", "plain"),
        ("<nav>a</nav><article><h1>T &amp; U</h1><p>one\n two<p>three&nbsp;four</article><footer>f</footer>", "T & U\none two\nthree four"),
        ("<body class='has-sidebar'><main><p>text here</p></main><div class='sidebar-left'>s</div></body>", "text here"),
        ("<article><p>a<br>b</p><form><p>name</p></form><aside>x</aside><p>c</p></article>", "a\nb\nc"),
        ("<article>x<script>if (a<b) '<p>'</script>y<!-- z --></article><div id='comments'><p>a long reader comment of many words</p></div>", "xy"),
        ("<div class=cookie-notice>we use cookies</div><div><p>A paragraph that is long enough.</p><p>Short.</p></div>", "A paragraph that is long enough.\nShort."),
        ('<article title="a>b"><p>1 < 2 and <b>bold</p></article>', "1 < 2 and bold"),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_main_text_of_pages_is_their_article(spark):
    from html import unescape

    rows = queries.op1_html_extract(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    assert len(rows) == 50
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|br|h1)>", inner))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_long_page_is_read_whole():
    assert len(html_extract.main_text("<article>" + "<p>word word</p>" * 50_000 + "</article>")) == 50_000 * 10 - 1


# 2 embeddings


def test_e8_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(200, 8)) * 2
    p = embed_dedup.nearest_e8(y)
    assert np.all((np.rint(p * 2) == p * 2) & (p.sum(axis=1) % 2 == 0)[:, None])
    around = ((y[:, None] - p[:, None] - embed_dedup.minimal_vectors()[None]) ** 2).sum(axis=2).min(axis=1)
    assert np.all(((y - p) ** 2).sum(axis=1) <= around + 1e-9)
    assert len(embed_dedup.minimal_vectors()) == 240 and np.allclose((embed_dedup.minimal_vectors() ** 2).sum(axis=1), 2)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = embed_dedup.unit_rows(rng.normal(size=(2000, 64)))
    u = rng.normal(size=x.shape)
    u = embed_dedup.unit_rows(u - (u * x).sum(axis=1, keepdims=True) * x)
    y, hit = 0.95 * x + np.sqrt(1 - 0.95**2) * u, np.zeros(len(x), bool)
    args = embed_dedup.TABLES, embed_dedup.BLOCKS, embed_dedup.PROBES, embed_dedup.SCALE
    for (ox, px), (oy, py) in zip(embed_dedup.cells(x, *args), embed_dedup.cells(y, *args), strict=True):
        hit |= (ox == oy) | (px == oy[:, None]).any(axis=1) | (py == ox[:, None]).any(axis=1)
    assert hit.mean() > 0.99


def test_embedding_links_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = embed_dedup.unit_rows(rng.normal(size=(60, 16)))
    x = np.vstack([base, base[:30] + rng.normal(size=(30, 16)) * 0.03, np.repeat(base[:1], 5, axis=0)]).astype("float32")
    rows = [(int(i), [float(v) for v in r], "x") for i, r in enumerate(x)]
    rows += [(1000, None, "x"), (1001, [0.0] * 16, "x"), (1002, [float("nan")] * 16, "x"), (1003, [None] * 16, "x"), (1004, [], "x"), (1005, [1.0, 2.0], "x"), (1006, [2.0, 4.0], "x"), (None, [1.0] * 16, "x")]
    out = {r["vec_id"]: r for r in embed_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links string")).collect()}
    u = embed_dedup.unit_rows(x.astype(float))
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    assert [out[i]["n_links"] for i in range(len(x))] == linked.sum(axis=1).tolist()
    label = list(range(len(x)))
    for _ in range(len(x)):
        label = [min([label[i], *(label[j] for j in np.flatnonzero(linked[i]))]) for i in range(len(x))]
    assert [out[i]["component_id"] for i in range(len(x))] == label
    assert all(out[i]["kept"] == (label[i] == i) for i in range(len(x)))
    assert all(out[i]["n_links"] == 0 and out[i]["component_id"] == i and out[i]["kept"] for i in range(1000, 1005))
    assert out[1006]["component_id"] == 1005 and out[1006]["n_links"] == 1
    assert out[None]["n_links"] == 0 and out[None]["component_id"] is None and out[None]["kept"] is False
    assert embed_dedup.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


# 3 Jaccard


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join_against_brute_force(spark, n, percent):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    common = " ".join(rng.choices(vocabulary, k=40))
    texts = []
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.randint(1, 120))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else "\n".join(copy))
        texts.append(common + " " + " ".join(rng.choices(vocabulary, k=60)))
    texts += [None, "", " \t\n", "one", "ONE", "one two", "one  two", "É é", "é É"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "one", "x")], "doc_id long, text string, prefix string")
    out = jaccard_join.jaccard_join(df, n, percent).collect()
    got = {r["doc_id"]: r["component_id"] for r in out}
    assert len(out) == len(rows) + 1 and got.pop(None) is None
    assert got == jaccard_join.brute_force(rows, n, percent, word_list)
    sizes = {r["doc_id"]: r["n_shingles"] for r in out}
    for i, t in rows:
        w = word_list(t or "")
        assert sizes[i] == (len({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}) if w else 0)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    texts = []
    for _ in range(300):
        copy = list(words)
        copy[rng.randrange(400)] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    out = jaccard_join.jaccard_join(docs(spark, *texts), 3, 90).collect()
    assert {r["component_id"] for r in out} == {0}


def test_prefixes_share_enough():
    """Documents that link share at least the smaller number of matches, whatever the frequencies are."""
    rng = np.random.default_rng(6)
    for _ in range(200):
        both = rng.integers(1, 1 << 40, 100, dtype=np.uint64)
        one, two = np.unique(np.append(both, rng.integers(1, 1 << 40, rng.integers(0, 9), dtype=np.uint64))), np.unique(both)
        hot = np.unique(rng.choice(both, 60))
        f = jaccard_join.Frequent(hot, rng.integers(2, 500, len(hot)))
        (p, a), (q, b) = jaccard_join.prefix(one, f, 90), jaccard_join.prefix(two, f, 90)
        assert len(np.intersect1d(p, q)) >= min(a, b)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert jaccard_join.jaccard_join(none).count() == 0
    assert sharding.shuffle_into_shards(none).count() == 0
    assert packing.pack_documents(none, queries.tokenizer_path(spark)).count() == 0
    assert decontaminate.contamination(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert langid.identify(none, langid.learn(none)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_crf.score(none, quality_crf.learn(none, labels)).count() == 0
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert chat_format.digests(chat_format.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    assert warc.archive_round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101 + i) for i in range(30)] + [(200, 200)]
    got = {r["id"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 131)}


# 4 chat


def test_template_language():
    run = chat_format.compile_template("{% for x in xs %}{% if loop.first %}[{% elif x.a == 'q' and not x.b %}Q{% else %}{{ x.a | upper ~ '!' }}{% endif %}{% endfor %}{{ 'a' ~ 1 }}{% if 1 == 2 %}no{% endif %}")
    assert run(xs=[{"a": "x"}, {"a": "q", "b": False}, {"a": "z"}]) == ("[QZ!a1", [])
    folded = chat_format.fold(chat_format.parse_template("a{{ 'b' ~ 'c' }}{% if 'x' == 'y' %}d{% else %}e{% endif %}f"))
    assert folded == chat_format.Node("list", (chat_format.Node("text", ("abcef",)),))
    for bad in ("{% for x %}{% endfor %}", "{{ x | exec }}", "{{ x.() }}", "{% if x %}", "{% import os %}", "{{ 1 + }}"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.compile_template(bad)
    assert chat_format.compile_template("{{ x.__class__ }}")(x="text") == ("", [])


def test_texts_of_control_strings_come_back(spark):
    rng = random.Random(7)
    parts = ["\\", "### ", "</turn>", "\n", ": ", "assistant", "#", "<", "é😀", " "]
    rows = [(c, t, rng.choice(["user", "assistant", "a:#<\\b", None]), None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.randint(0, 12)))) for c in range(40) for t in range(rng.randint(1, 6))]
    rng.shuffle(rows)
    made = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = {r["conv_id"]: r for r in chat_format.digests(made).collect()}
    for c in range(40):
        said = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])]
        loss = "".join(t for role, t in said if role == "assistant")
        assert by[c]["n_turns"] == len(said) and by[c]["loss_chars"] == len(loss)
        assert by[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert by[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


# 5 sharding


def test_shards_differ_by_one_row(spark):
    rows = [(i % 90, f"text {i % 70}" if i % 11 else None, i) for i in range(403)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot long")
    out = sharding.shuffle_into_shards(df, shards=16, bucket_bytes=2000)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    again = sharding.shuffle_into_shards(df.repartition(7), shards=16, bucket_bytes=2000).collect()
    key = lambda r: (r["shard"], r["slot"])
    assert [(r["doc_id"], r["text"]) for r in sorted(got, key=key)] == [(r["doc_id"], r["text"]) for r in sorted(again, key=key)]


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(8)
    seen = Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert list(sharding.fisher_yates(0, rng)) == []


# 6 WARC


def test_reader_owns_each_record_once_whatever_the_splits():
    rng = random.Random(9)
    payloads = [bytes(rng.choices(range(256), k=rng.randint(0, 400))) + warc.MAGIC * 3 for _ in range(60)]
    data = b"".join(warc.member(warc.record(i, "http://x/ \r\n", p, hashlib.sha256(p).hexdigest(), None)) for i, p in enumerate(payloads))
    for split in (1, 7, 100, 1000, len(data)):
        read = warc.Reader(io.BytesIO(data), len(data))
        found = [warc.parse_record(d) for s in range(0, len(data), split) for _, d in read.records(s, min(s + split, len(data)))]
        assert [int(h["page-id"]) for h, _ in found] == list(range(60))
        assert [b.partition(b"\r\n\r\n")[2] for _, b in found] == payloads


def test_reader_goes_on_behind_damage():
    members = [warc.member(warc.record(i, "u", b"x" * 300, "d", None)) for i in range(5)]
    data = b"junk" + members[0] + members[1][:40] + members[2] + warc.MAGIC + b"zz" + members[3] + members[4][:-9]
    read = warc.Reader(io.BytesIO(data), len(data))
    assert [warc.parse_record(d)[0]["page-id"] for _, d in read.records(0, len(data))] == ["0", "2", "3"]


def test_warc_round_trip(spark):
    big, small = "p" * 100, "q" * 99
    rows = [(5, "u", big), (3, None, big), (9, "u", big), (1, "u", small), (2, "u", small), (4, "u", None), (6, "u", ""), (7, "u", "é" * 50), (None, "u", "n" * 200), (8, "u", "é" * 50)]
    out = {r["page_id"]: r for r in warc.archive_round_trip(spark, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")).collect()}
    assert len(out) == len(rows)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        r = out[page_id]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        to = {5: 3, 9: 3, 8: 7}.get(page_id)
        assert (r["record_type"], r["refers_to"]) == ("revisit" if to else "response", to)


# 7 decontamination


def test_reparameterised_questions(spark):
    item = "If Anna walks 12 km in 3 hours and then meets Bob at the station, how far does Anna walk in 6 hours?"
    bench = spark.createDataFrame([(1, item, "x"), (None, item, "x"), (2, None, "x"), (3, "tiny item here", "x")], "item_id long, text string, covered string")
    texts = [
        "Some text first. If Maria walks 15 km in 5 hours and then meets Tom at the station, how far does Maria walk in 10 hours? And more.",
        "If Maria walks 15 km in 5 hours and then meets Tom at the station, how far does Zoe walk in 10 hours?",
        item.lower(), item, "If Anna walks", None, "", "a tiny item here too", " ".join(["the"] * 500),
    ]
    out = decontaminate.contamination(docs(spark, *texts), bench).collect()
    assert {r["doc_id"]: r["item_ids"] for r in out} == {0: [1], 1: [], 2: [1], 3: [1], 4: [], 5: [], 6: [], 7: [3], 8: []}
    split = decontaminate.contamination(docs(spark, *texts), bench, block_bytes=1).collect()
    assert [r["item_ids"] for r in sorted(split, key=lambda r: r["doc_id"])] == [r["item_ids"] for r in sorted(out, key=lambda r: r["doc_id"])]


def test_whole_items_in_documents_are_found(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = {b["item_id"]: f" {flat(b['text'])} " for b in bench}
    held_by = {r["doc_id"]: sorted(i for i, t in items.items() if t in f" {flat(r['text'])} ") for r in rows}
    got = {r["doc_id"]: r["item_ids"] for r in queries.op7_decontamination(spark, SF).collect()}
    assert got == {k: v for k, v in held_by.items() if v}


# 8 quality, 10 languages


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(10)
    m = quality_crf.Chain(np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    scores = rng.normal(size=(7, 2))
    seq, step = quality_crf.padded(np.array([0, 0, 0, 0, 1, 2, 2]))
    got, _ = quality_crf.forward_backward(m, scores, seq, step)
    for rows in ([0, 1, 2, 3], [4], [5, 6]):
        weight = np.zeros((len(rows), 2))
        for code in range(2 ** len(rows)):
            y = [code >> k & 1 for k in range(len(rows))]
            w = np.exp(m.start[y[0]] + sum(scores[r, v] for r, v in zip(rows, y, strict=True)) + sum(m.move[a, b] for a, b in zip(y, y[1:], strict=False)))
            for k, v in enumerate(y):
                weight[k, v] += w
        assert np.allclose(got[rows], weight / weight.sum(axis=1, keepdims=True))


def test_quality_on_held_out_documents(spark):
    rows = queries.op8_quality_crf(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(rows) > 40 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_scores_of_odd_texts(spark):
    texts = [None, "", " \n ", "a", "x " * 100_000, "one line\n\n\nanother line.", "😀 \x1c é"]
    df = spark.createDataFrame([(i, t, 1.0, "k") for i, t in enumerate(texts)], "doc_id long, text string, score double, lang_pred string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    out = sorted(quality_crf.score(df, quality_crf.learn(df, labels)).collect())
    assert [r["score"] for r in out[:3]] == [0, 0, 0] and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in quality_crf.score(df, None).collect()} == {0.0, 0.5}
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None), (5, "le chien et le chat", "fr"), (6, "qq zz", "tlh")], "doc_id long, text string, lang string")
    found = sorted(langid.identify(df, langid.learn(train)).collect())
    assert [r["lang_pred"] for r in found[:3]] == ["und"] * 3 and all(r["lang_pred"] in ("en", "de", "fr", "tlh") for r in found[3:])
    assert {r["lang_pred"] for r in langid.identify(docs(spark, "12 34", "a"), langid.learn(train.filter("lang = 'en'"))).collect()} == {"und", "en"}


def test_languages_of_held_out_documents(spark):
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


# 9 packing


def test_encoder_equals_the_library(spark):
    e = packing.Encoder(queries.tokenizer_path(spark))
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["It's a dog's life, they've ’s ﬁ Ⅷ ΣΑΣ é İstanbul 12a3\x1cx <|endoftext|> a b　c​d", "", "  ", "!!''s", "ẞß ŒœŸ x́ ́y", "it's IT'S 'll"]
    for t in texts:
        assert e(t) == e.whole(t)


def test_tournament_tree_is_first_fit():
    rng = random.Random(11)
    tree, free = packing.TournamentTree(40, 100), [100] * 40
    for _ in range(60):
        need = rng.randint(1, 60)
        place = next((i for i, f in enumerate(free) if f >= need), None)
        if place is None:
            continue
        assert tree.first_fit(need) == place
        free[place] -= need


def test_pack_covers_each_id_once_without_padding():
    rng = random.Random(12)
    for n in (0, 1, 5, 60):
        lengths = [rng.choice([1, 2, 700, 2048, 5000, rng.randint(1, 3000)]) for _ in range(n)]
        out = packing.pack(lengths)
        spans = sorted(p for s in out for p in s)
        for doc, length in enumerate(lengths):
            at = 0
            for _, start, k in (p for p in spans if p[0] == doc):
                assert start == at and k > 0
                at += k
            assert at == length
        assert all(sum(p[2] for p in s) <= 2048 for s in out)
        assert packing.padding(sum(p[2] for p in s) for s in out) == 0


def test_packed_rows(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (1, "hello world", "x"), (2, None, "x"), (3, "", "x"), (None, "a b c " * 2000, "x")], "doc_id long, text string, start string")
    out = packing.pack_documents(df, queries.tokenizer_path(spark)).collect()
    assert sum(r["length"] for r in out) == 3 + 3 + 1 + 1 + 6001
    e = packing.Encoder(queries.tokenizer_path(spark))
    one = e("hello world") + b"\1\0\0\0"
    assert [(r["length"], r["ids_crc32"]) for r in out if r["doc_id"] == 1 and r["length"] == 3] == [(3, zlib.crc32(one))] * 2 or sum(r["length"] for r in out if r["doc_id"] == 1) == 6
    for s in packing.sequences(out):
        at = 0
        for r in s:
            assert r["offset"] == at
            at += r["length"]


def test_workers_keep_few_objects():
    for i in range(20):
        held(f"test {i}", dict)
    from rolecast.llm.common import HELD

    assert len(HELD) <= 6


# pipeline


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as p

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    d, kept = rows, [rows.count()]
    outs = []
    for name, stage in p.STAGES[:-1]:
        before = d
        d, _ = store(stage(spark, d, SF), "test")
        assert d.columns == rows.columns and d.join(before, rows.columns, "left_anti").count() == 0
        outs.append((before.collect(), {r["doc_id"] for r in d.collect()}))
        kept.append(d.count())
    before, after = outs[2]
    groups = jaccard_join.brute_force([(r["doc_id"], r["text"]) for r in before], p.SHINGLE_WORDS, p.SIMILAR_PERCENT, word_list)
    assert after == {i for i, c in groups.items() if i == c}
    before, after = outs[3]
    flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [f" {flat(b['text'])} " for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert after == {r["doc_id"] for r in before if not any(i in f" {flat(r['text'])} " for i in items)}
    packed = p.packing(spark, d, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in d.collect()}
    assert pd.DataFrame([r.asDict() for r in packed]).groupby("doc_id").agg(n=("length", "sum"), t=("doc_tokens", "first")).eval("n == t").all()
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the cat and the dog are here.", "en", "s", 1)], DOCS)
    for _, stage in p.STAGES[2:]:
        stage(spark, odd, SF).collect()
