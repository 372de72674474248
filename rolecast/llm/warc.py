"""WARC archives: a writer of one gzip member a record and a splittable reader.

Reader: a task gets a byte range of a file.  It scans the range for the gzip magic, validates a candidate by decoding
it up to the end of its WARC header, and owns the records that start inside the range; the last one
is read to its end, wherever that is.  After a valid member the next starts right behind it, so only the head of a
range, or a damaged place, is scanned.

Writer: of records with equal payloads of at least ``SMALLEST`` bytes the one with the smallest ``page_id`` is the
response and the others are revisits that refer to it.  Tasks write files of their own name into a folder that all
executors share (any file system that ``pyarrow.fs`` opens by URI); the manifest lists those of finished tasks only, so a lost or
repeated attempt leaves nothing that is read.

Edge cases: a null html is an empty payload, a null url an empty target; rows that share both the payload and the
smallest ``page_id`` are all responses, and with null ids only, too; an empty table gives an archive without files;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, store

SMALLEST, FILE_BYTES, SPLIT_BYTES, MOST_BROADCAST = 100, 1 << 30, 16 << 20, 100_000
MAGIC, HEAD, CHUNK = b"\x1f\x8b\x08", 16 << 10, 1 << 20
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:rolecast:page")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, start long"


def classify(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """``pages`` with ``digest``, and ``refers_to`` where a row is a revisit."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    counted = pages.filter(F.octet_length("html") >= smallest).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    repeated, _ = store(counted.filter("n > 1 and first_id is not null").select("digest", "first_id"), "repeated")
    if repeated.count() <= MOST_BROADCAST:
        repeated = F.broadcast(repeated)
    return pages.join(repeated, "digest", "left").select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(SPACE, str(page_id)).urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-Id: {refers_to}", f"Payload-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archive(classified: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records; returns the manifest (file, size), a row a file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        out, size, done = None, 0, []
        for b in batches:
            for page_id, url, html, digest, refers_to in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                        done.append((name, size))
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                data = member(record(page_id, url, html.encode(), digest, refers_to))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            done.append((name, size))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["file", "size"])

    # Collected, so that every file is written once; at 1 GiB a file the manifest is small.
    found = classified.mapInArrow(write, "file string, size long").collect()
    return classified.sparkSession.createDataFrame([(f"{folder}/{r['file']}", r["size"]) for r in found], "file string, size long")


class Reader:
    """The records that start in [start, stop) of a file."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size = file, size

    def at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(min(n, self.size - start)) if start < self.size else b""

    def valid(self, start: int) -> bool:
        """Whether a gzip member with a WARC record begins here, told from its header, however long that is."""
        z, at, head, end, data = zlib.decompressobj(31), start, bytearray(), -1, b""
        try:
            while end < 0 and not z.eof:
                if not data:
                    data = self.at(at, HEAD)
                    at += len(data)
                    if not data:
                        break
                seen = max(0, len(head) - 3)
                head += z.decompress(data, HEAD)
                data = z.unconsumed_tail
                if len(head) >= 7 and not head.startswith(b"WARC/1."):
                    return False
                end = head.find(b"\r\n\r\n", seen)
        except zlib.error:
            return False
        return head.startswith(b"WARC/1.") and end >= 0 and b"\r\nWARC-Type:" in head[:end] and b"\r\nContent-Length:" in head[:end]

    def member(self, start: int) -> tuple[bytes, int]:
        """A whole member and where it ends."""
        z, at, parts = zlib.decompressobj(31), start, []
        while not z.eof:
            data = self.at(at, CHUNK if parts else 4 * HEAD)
            if not data:
                raise zlib.error("a member is cut off")
            parts.append(z.decompress(data))
            at += len(data)
        return b"".join(parts), at - len(z.unused_data)

    def records(self, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
        at = start
        while at < stop:
            if not self.valid(at):
                at = self.scan(at + (at > start), stop)
                if at is None:
                    return
            try:
                data, end = self.member(at)
            except zlib.error:
                at = self.scan(at + 1, stop)
                if at is None:
                    return
                continue
            yield at, data
            at = end

    def scan(self, at: int, stop: int) -> int | None:
        while at < stop:
            data = self.at(at, min(CHUNK, stop - at) + len(MAGIC) - 1)
            found = data.find(MAGIC)
            while found >= 0:
                if at + found < stop and self.valid(at + found):
                    return at + found
                found = data.find(MAGIC, found + 1)
            at += CHUNK
        return None


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def read_archive(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the files of a manifest (:data:`RECORD`); a revisit has no payload, but its length and digest."""
    splits = manifest.select("file", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes))).alias("start"))
    splits = splits.withColumn("stop", F.least(F.col("start") + split_bytes, "size"))
    n = splits.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, size, start, stop in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as file:
                    out, held = [], 0
                    for at, data in Reader(file, size).records(start, stop):
                        h, block = parse_record(data)
                        revisit = h["warc-type"] == "revisit"
                        payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                        digest = h["warc-payload-digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest()
                        page, to = h.get("page-id"), h.get("refers-to-page-id")
                        out.append({"page_id": page and int(page), "url": h.get("warc-target-uri"), "payload": payload, "payload_bytes": int(h["payload-length"]) if revisit else len(payload), "payload_digest": digest, "record_type": h["warc-type"], "refers_to": to and int(to), "file": uri, "start": at})
                        held += len(data)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, held = [], 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORD.split(", ")])
    return splits.select("file", "size", "start", "stop").repartition(max(1, n), "file", "start").mapInArrow(read, RECORD)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new folder of the shared space and read the records back."""
    return read_archive(write_archive(classify(pages), scratch(spark, "warc")))
