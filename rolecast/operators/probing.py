"""Probers: calls that the caller passes in, kept within a rate, repeated where that can help, and recorded as rows.

Urls are dealt out by host, so the rate of a host is kept by the one task that has all of it.  The verdict on what was
seen is an expression (``liveness``), so recorded probes can be judged again.  A client is a function of a method and a
url; it is sent to the executors.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..schemas import PROBE_OBSERVATION, URL_OBSERVATION

# Attempts and waits, calls at once by host, statuses that ask for another method, what is read of a body.
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 3, 1.0, 10.0
PER_HOST, OTHER_METHOD, BODY_CHARS = 4, (405, 501), 100_000


@dataclass
class Reply:
    """What a client returns."""

    status: int
    url: str = ""
    redirects: int = 0
    location: str | None = None
    body: str | None = None


class ProbeError(Exception):
    """A call without a reply: ``kind`` is dns, refused, timeout, redirect_loop or another word."""

    def __init__(self, kind: str, message: str = "") -> None:
        super().__init__(message or kind)
        self.kind = kind


def retryable(error: Exception | None = None, status: int | None = None) -> bool:
    """Whether a call may be repeated: after no reply, too many calls, or an error of the server."""
    if status is not None:
        return status == 429 or 500 <= status < 600
    return isinstance(error, ProbeError) and error.kind in ("timeout", "refused", "connection")


def waits(attempts: int = ATTEMPTS, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT) -> list[float]:
    """Seconds before each attempt but the first: doubled, up to the longest."""
    return [min(longest, first * 2**k) for k in range(attempts - 1)]


def with_retry(call: Callable[[], Reply], sleep: Callable[[float], None] = time.sleep, attempts: int = ATTEMPTS) -> Reply:
    """The reply of the first attempt that need not be repeated; the last one's reply or error else."""
    for wait in [*waits(attempts), None]:
        try:
            reply = call()
        except ProbeError as e:
            if wait is None or not retryable(e):
                raise
        else:
            if wait is None or not retryable(status=reply.status):
                return reply
        sleep(wait)
    raise AssertionError


@dataclass
class Limiter:
    """Least seconds between two calls of a key; ``share`` tasks that call the same key get a part of the rate each."""

    interval: float
    share: int = 1
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: dict[str, float] = field(default_factory=dict)

    @classmethod
    def per_minute(cls, calls: int, share: int = 1, **kw) -> Limiter:
        return cls(60.0 / max(calls, 1), share, **kw)

    def acquire(self, key: str = "") -> None:
        gap = self.interval * self.share
        wait = self.last.get(key, float("-inf")) + gap - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.last[key] = self.clock()


Client = Callable[[str, str], Reply]


def observe(client: Client, url: str) -> dict:
    """A row of ``schemas.URL_OBSERVATION``: the head, or the start of the body where a host takes no such request."""
    out = {"url": url, "status_code": None, "final_url": None, "n_redirects": None, "error_kind": None}
    try:
        reply = client("HEAD", url)
        if reply.status in OTHER_METHOD:
            reply = client("GET", url)
    except ProbeError as e:
        return out | {"error_kind": e.kind}
    return out | {"status_code": reply.status, "final_url": reply.url or url, "n_redirects": reply.redirects}


def probe(client: Client, url: str, source: str) -> dict:
    """A row of ``schemas.PROBE_OBSERVATION``; the body is read only where the head says that the page is there."""
    out = {"url": url, "source": source, "head_status": None, "location": None, "body": None, "error_kind": None}
    try:
        reply = client("HEAD", url)
        out |= {"head_status": reply.status, "location": reply.location}
        if reply.status == 200:
            out["body"] = (client("GET", url).body or "")[:BODY_CHARS]
    except ProbeError as e:
        return out | {"error_kind": e.kind}
    return out


def _by_host(urls: DataFrame, parts: int) -> DataFrame:
    return urls.withColumn("_host", t.url_host(F.col("url"))).repartition(parts, "_host")


def observe_urls(urls: DataFrame, client: Client, parts: int = 32, at_once: int = PER_HOST) -> DataFrame:
    """Observations of the distinct urls of a table; ``at_once`` calls of a task run side by side."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(at_once) as pool:
            for pdf in frames:
                yield _frame(pool.map(lambda u: observe(client, u), pdf["url"]), URL_OBSERVATION)

    return _by_host(urls.select("url").filter("url <> ''").distinct(), parts).mapInPandas(run, URL_OBSERVATION)


def probe_jobs(jobs: DataFrame, client: Client, interval: float = 1.0, parts: int = 10) -> DataFrame:
    """Probes of the urls of postings (``url`` and ``source``), a call a host and ``interval``; postings without a url are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(interval)
        for pdf in frames:
            rows = []
            for url, source, host in zip(pdf["url"], pdf["source"], pdf["_host"], strict=True):
                limiter.acquire(host or url)
                rows.append(probe(client, url, source))
            yield _frame(rows, PROBE_OBSERVATION)

    due = jobs.filter("url <> ''").groupBy("url").agg(F.min("source").alias("source"))
    return _by_host(due, parts).mapInPandas(run, PROBE_OBSERVATION)


def look_up(addresses: DataFrame, call: Callable[[str], str | None], interval: float = 1.0) -> DataFrame:
    """``address``, ``payload`` and ``error`` for each address, through one task, as the service takes a call a second."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(interval)
        for pdf in frames:
            rows = []
            for address in pdf["address"]:
                limiter.acquire()
                try:
                    rows.append((address, call(address), None))
                except (ProbeError, OSError, ValueError) as e:
                    rows.append((address, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["address", "payload", "error"])

    return addresses.coalesce(1).mapInPandas(run, "address string, payload string, error string")


def _frame(rows, schema: str) -> pd.DataFrame:
    kinds = {"int": "Int32", "string": "object"}
    out = pd.DataFrame(list(rows), columns=[c.split()[0] for c in schema.split(", ")])
    return out.astype({c.split()[0]: kinds[c.split()[1]] for c in schema.split(", ")})
