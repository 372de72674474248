"""HTML functions on the standard library's parser, as Arrow UDFs."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that go, and containers of a posting's text in order of preference.
MEDIA = frozenset("img svg figure picture video audio iframe object embed script style".split())
NOISE = frozenset("script style nav header footer aside form noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEAST_CONTENT, LOGO_CHARS = 300, 50
CONTAINERS = ("article", "main", ".job-description", ".description", "#job-description", ".content", "#content")


class Cleaner(HTMLParser):
    """The markup again without some elements."""

    def __init__(self, gone: frozenset[str]) -> None:
        super().__init__(convert_charrefs=False)
        self.gone, self.depth, self.out = gone, 0, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.gone:
            self.depth += tag not in VOID
        elif not self.depth:
            self.out.append(self.get_starttag_text())

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in self.gone and not self.depth:
            self.out.append(self.get_starttag_text())

    def handle_endtag(self, tag: str) -> None:
        if tag in self.gone:
            self.depth = max(0, self.depth - (tag not in VOID))
        elif not self.depth:
            self.out.append(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if not self.depth:
            self.out.append(data)

    def handle_entityref(self, name: str) -> None:
        self.handle_data(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self.handle_data(f"&#{name};")


def clean(html: str | None) -> str | None:
    if not html or not ("<" in html and ">" in html):
        return html
    c = Cleaner(MEDIA)
    c.feed(html)
    c.close()
    return "".join(c.out).strip()


class Headings(Cleaner):
    """Headings start at the second level and go down one level at a time; empty elements go."""

    def __init__(self) -> None:
        super().__init__(frozenset())
        self.level, self.names = 0, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if re.fullmatch("h[1-6]", tag):
            level = min(max(2, int(tag[1])), (self.level or 1) + 1)
            self.level = level
            self.names.append(f"h{level}")
            self.out.append(f"<h{level}>")
        elif tag == "img" and not any(k == "alt" for k, _ in attrs):
            self.out.append(self.get_starttag_text().rstrip("/>").rstrip() + ' alt="">')
        else:
            super().handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        super().handle_endtag(self.names.pop() if re.fullmatch("h[1-6]", tag) and self.names else tag)


def normalize(html: str | None) -> str | None:
    if not html:
        return html
    h = Headings()
    h.feed(html)
    h.close()
    out, before = "".join(h.out), None
    while out != before:
        before, out = out, re.sub(r"<(p|div|span|li|ul|ol|strong|em|b|i|h[2-6])(?:\s[^>]*)?>\s*</\1>", "", out)
    return out.strip()


class Tree(HTMLParser):
    """Text as Markdown of the whole page and of each container, without noise."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack, self.parts, self.spans, self.skipped, self.images = [], [], [], 0, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in NOISE:
            self.skipped += 1
        if self.skipped:
            return
        if tag == "img":
            self.images.append((len(self.parts), a.get("src")))
        self.parts.append({"li": "\n- ", "br": "\n", "strong": "**", "b": "**"}.get(tag, f"\n\n{'#' * int(tag[1])} " if re.fullmatch("h[1-6]", tag) else "\n\n" if tag in ("p", "div", "ul", "ol", "article", "main", "section", "table", "tr") else ""))
        if tag not in VOID:
            self.stack.append((tag, len(self.parts), {tag, *(f".{c}" for c in (a.get("class") or "").split()), f"#{a.get('id')}"}))

    def handle_endtag(self, tag: str) -> None:
        if tag in NOISE:
            self.skipped = max(0, self.skipped - 1)
            return
        if self.skipped or not any(x[0] == tag for x in self.stack):
            return
        while self.stack:
            name, start, marks = self.stack.pop()
            if name in ("strong", "b"):
                self.parts.append("**")
            self.spans.append((marks, start, len(self.parts)))
            if name == tag:
                break
        self.parts.append("\n\n" if tag in ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6") else "")

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.parts.append(re.sub(r"\s+", " ", data))


def main_content(html: str | None) -> tuple[str, str | None]:
    """Markdown of the longest container with enough text, else of the page; and a logo that stands before any text."""
    t = Tree()
    t.feed(html or "")
    t.close()
    while t.stack:
        _, start, marks = t.stack.pop()
        t.spans.append((marks, start, len(t.parts)))
    best = (0, 0, len(t.parts))
    for marks, start, stop in t.spans:
        n = len("".join(t.parts[start:stop]).strip())
        if not marks.isdisjoint(CONTAINERS) and n > LEAST_CONTENT and n > best[0]:
            best = (n, start, stop)
    logo = next((src for at, src in t.images if best[1] <= at < best[2]), None)
    at = next((at for at, src in t.images if best[1] <= at < best[2]), 0)
    if logo and len("".join(t.parts[best[1] : at]).strip()) >= LOGO_CHARS:
        logo = None
    markdown = re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(t.parts[best[1] : best[2]]))
    return re.sub(r"\n{3,}", "\n\n", markdown).strip(), logo


@F.pandas_udf(T.StringType())
def _clean(s: pd.Series) -> pd.Series:
    return s.map(clean)


@F.pandas_udf(T.StringType())
def _normalize(s: pd.Series) -> pd.Series:
    return s.map(normalize)


@F.pandas_udf(T.StructType().add("description", "string").add("logo_url", "string"))
def _main(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([main_content(x) for x in s], columns=["description", "logo_url"])


def clean_description(c: Column) -> Column:
    """Media and scripts removed; text without both brackets does not go to Python."""
    tagged = F.contains(c, F.lit("<")) & F.contains(c, F.lit(">"))
    return F.coalesce(_clean(F.when(tagged, c)), c)


def normalize_html(c: Column) -> Column:
    return F.coalesce(_normalize(F.when(F.contains(c, F.lit("<")), c)), c)


def extract_content(c: Column) -> Column:
    return _main(c)


def paragraph(text: str) -> str:
    return f"<p>{escape(text)}</p>"
