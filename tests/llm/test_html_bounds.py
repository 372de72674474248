"""Bounds of the main text: several articles in a main, link blocks between paragraphs, class words on text, broken markup."""

from __future__ import annotations

import time

import pytest

from rolecast.llm.html_extract import main_text

T = "A sentence that is long enough to count as text of the article, surely. " * 3
LONG = T.strip()


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (f"<main><h1>Title</h1><p>Intro text</p><article><p>{T}A</p></article><article><p>{T}B</p></article><h2>Related</h2><ul><li><a href=x>one</a></ul></main>", ["Title", "Intro text", f"{T}A", f"{T}B"]),
        (f"<nav><a href=x>x</a></nav><div><div><p>{T}one</p></div><div><a href=x>only a link</a></div><div><p>{T}two</p></div></div><footer>f</footer>", [f"{T}one", f"{T}two"]),
        (f"<article><h2 class='notice-period'>Head</h2><p class='comment-free'>{T}</p><p class=ad>Buy</p><p>{T}</p></article>", ["Head", LONG, LONG]),
        (f"<div class='content with-sidebar'><h1>H</h1><p>{T}</p></div><div class=sidebar><p>No</p></div>", ["H", LONG]),
        (f"<article><p>{T}<p>short<p>{T}</article><div class=comments><p>{T}</p></div>", [LONG, "short", LONG]),
        ("", []), (None, []), ("<p></p><div> </div>", []),
    ],
)
def test_bounds(html, expected):
    assert main_text(html) == "\n".join(expected)


@pytest.mark.parametrize("bad", ["</b>" * 100_000, "<div>" * 50_000 + "</i>" * 100_000, "<b>" * 50_000 + "<br>" * 50_000, "<p><b>" * 50_000, "<b><div>" * 20_000 + "</b>" * 100_000])
def test_broken_markup_takes_time_in_proportion(bad):
    start = time.process_time()
    assert main_text(f"{bad}<p>{T}</p>").endswith(LONG)
    assert time.process_time() - start < 2
