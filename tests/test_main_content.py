"""Main content of raw pages against a plain reading of their article, tag by tag."""

from __future__ import annotations

import re
from html import unescape

import duckdb

from rolecast.plans import catalogue

SF = "/root/testdata/sf0.001"
BEFORE = {"h1": "\n\n# ", "p": "\n\n", "b": "**", "br": "\n", "div": "\n\n", "ul": "\n\n", "li": "\n- "}
AFTER = {"h1": "\n\n", "p": "\n\n", "b": "**", "div": "\n\n"}


def plain(inner: str) -> str:
    """The article's markup as Markdown: an end tag also ends what was left open in it, and bold text ends with its parent."""
    out, open_ = [], []
    for part in re.split("(<[^>]*>)", inner):
        m = re.fullmatch(r"<(/?)(\w+)[^>]*>", part)
        if not m:
            out.append(re.sub(r"\s+", " ", unescape(part)))
        elif not m[1]:
            out.append(BEFORE.get(m[2], ""))
            if m[2] != "br":
                open_.append(m[2])
        elif m[2] in open_:
            while (name := open_.pop()) != m[2]:
                out.append("**" if name == "b" else "")
            out.append(AFTER.get(m[2], ""))
    out += ["**" for name in open_ if name == "b"]
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def test_main_content_of_the_pages(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    got = {r["page_id"]: r["description"] for r in catalogue.queries()["html_main_content"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    long = 0
    for i, html in pages.items():
        want = plain(re.search("<article>(.*?)</article>", html, re.S)[1])
        if len(want) > 400:  # shorter ones may lose to the whole page
            long += 1
            assert got[i] == want, i
    assert long > len(pages) / 2
