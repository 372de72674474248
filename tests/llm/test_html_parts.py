"""Parts of an article whose names may mean something else, lists of links within a text, articles side by side."""

from __future__ import annotations

import random

import pytest

from rolecast.llm.html_extract import main_text

P = [f"Paragraph {w} of the article, which is long enough to be one of several that make up its text." for w in ("one", "two", "three", "four", "five", "six")]
LIST = "<ul>" + "".join(f"<li><a href=/{i}>link number {i}</a></li>" for i in range(4)) + "</ul>"


def ps(*which):
    return "".join(f"<p>{P[i]}</p>" for i in which)


def text(*which):
    return "\n".join(P[i] for i in which)


@pytest.mark.parametrize("name", ["section id=discussion", "div class='share-price'", "div class=related", "div class='search results'", "section class=widget", "div class=banner", "div id=respond"])
@pytest.mark.parametrize("holder", ["article", "main"])
def test_named_part_of_an_article_stays(name, holder):
    tag = name.split()[0]
    assert main_text(f"<nav><a href=/>home</a></nav><{holder}>{ps(0, 1)}<{name}>{ps(2)}</{tag}>{ps(3)}</{holder}>") == text(0, 1, 2, 3)


@pytest.mark.parametrize(
    "part",
    [
        "<div class=share>Share this</div>", f"<div class=related>{LIST}</div>", "<div class='share-buttons'><a href=/>Tell all of your friends about this article, please, and do it now or later</a></div>",
        f"<div class=ad>{ps(4)}</div>", f"<section id=comments>{ps(4)}</section>", f"<div class='cookie notice'>{ps(4)}</div>", f"<aside>{ps(4)}</aside>", f"<div class='discussion comments'>{ps(4)}</div>", "<div class=widget>12 °C</div>",
    ],
)
def test_what_is_no_part_goes(part):
    assert main_text(f"<article>{ps(0, 1)}{part}{ps(2, 3)}</article>") == text(0, 1, 2, 3)


@pytest.mark.parametrize("links", [1, 3, 4, 12])
@pytest.mark.parametrize("page", ["<body>{0}{2}{1}</body>", "<div><div>{0}</div>{2}<div>{1}</div></div>", "<body><nav><a href=/>x</a></nav><div>{0}{2}{1}</div><footer>f</footer></body>"])
def test_links_within_a_text_do_not_end_it(page, links):
    found = main_text(page.format(ps(0, 1), ps(2, 3), "<ul>" + "".join(f"<li><a href=/{i}>link number {i}</a></li>" for i in range(links)) + "</ul>"))
    assert [x for x in found.split("\n") if not x.startswith("link number")] == P[:4]


def test_articles_side_by_side():
    assert main_text(f"<body><article>{ps(0, 1)}</article><article>{ps(2, 3)}</article></body>") == text(0, 1, 2, 3)
    assert main_text(f"<body><article>{ps(0, 1, 2)}</article><article><p>teaser</p></article><p>after</p></body>") == text(0, 1, 2)
    assert main_text(f"<article>{ps(0, 1)}</article><section id=comments><article>{ps(2, 3, 4)}</article></section>") == text(0, 1)


def built(rng):
    """A random page and its text: blocks of an article, with what does not belong before, within and behind it."""
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randrange(a, b)))
    blocks, html = [], []
    for _ in range(rng.randrange(2, 9)):
        t = words(12, 60)
        kind = rng.randrange(6)
        if kind == 0:
            head = words(2, 6)
            blocks.append(head)
            html.append(f"<h2>{head}</h2>")
        blocks.append(t)
        html.append({1: f"<section id=discussion><p>{t}</p></section>", 2: f"<blockquote class='share-quote'>{t}</blockquote>", 3: f"<p>{t[:8]}<b>{t[8:20]}</b><a href=/x></a>{t[20:]}"}.get(kind, f"<p>{t}</p>"))
        if rng.random() < 0.3:
            html.append(rng.choice([f"<div class='ad'>{words(5, 30)}</div>", f"<!-- {words(3, 9)} -->", f"<script>{words(2, 5)}</script>", f"<form><p>{words(3, 30)}</p></form>", f"<aside>{words(4, 30)}</aside>", "<div class=share><a href=/>share</a></div>"]))
    nav = "<nav><ul>" + "".join(f"<li><a href=/>{word()}</a></li>" for _ in range(rng.randrange(12))) + "</ul></nav>"
    tail = rng.choice(["", f"<section class='comments'><p>{words(20, 90)}</p></section>", f"<div class='sidebar'><p>{words(5, 20)}</p></div>"])
    holder = rng.choice(["article", "main"])
    return f"<html><head><title>{words(2, 5)}</title></head><body>{nav}<header>{words(2, 6)}</header><{holder}>{''.join(html)}</{holder}>{tail}<footer>{words(4, 12)}</footer>", "\n".join(blocks)


@pytest.mark.parametrize("seed", range(60))
def test_random_pages(seed):
    page, want = built(random.Random(seed))
    assert main_text(page) == want
