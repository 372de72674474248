"""WARC records whose header is longer than one read."""

import hashlib
import io
import random

from rolecast.llm import warc

rng = random.Random(21)
URLS = ["http://x/" + "a" * 100_000, "http://x/" + " " * 20_000, "http://x/" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=100_000)), "http://x/" + "é" * 60_000, "u"]


def test_reader_finds_records_with_long_headers_whatever_the_splits():
    payload = b"p" * 300
    data = b"".join(warc.member(warc.record(i, u, payload, "d", None)) for i, u in enumerate(URLS))
    for split in (1000, 50_000, len(data)):
        read = warc.Reader(io.BytesIO(data), len(data))
        found = [warc.parse_record(d) for s in range(0, len(data), split) for _, d in read.records(s, min(s + split, len(data)))]
        assert [h["page-id"] for h, _ in found] == [str(i) for i in range(len(URLS))]
        assert [h["warc-target-uri"] for h, _ in found] == [u.replace(" ", "%20") for u in URLS]


def test_round_trip_of_long_urls(spark):
    rows = [(i, u, f"page {i} " * 50) for i, u in enumerate(URLS)]
    out = {r["page_id"]: r["payload_digest"] for r in warc.archive_round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: hashlib.sha256(h.encode()).hexdigest() for i, _, h in rows}
