"""Main text of web pages by line-block distribution.

1. The markup is stripped: a page becomes lines, one a block-level run of text, with character references decoded and
   white space turned into single spaces.  Subtrees that are never main text (scripts, styles, navigation, headers,
   footers, sidebars, forms, and elements whose class, id or role names an advert, notice, menu or comments) yield
   no lines.  A wrapper whose class or id merely has such a word (``content with-sidebar``) stays if it holds the page's
   main article, or most of the text; and within the article an element stays whose name may mean part of a text as well
   (``discussion``, ``share-price``) if it holds text like the paragraphs around it, mostly outside links.
2. Text lengths (without link text) are summed over sliding windows of ``WINDOW`` lines.  A surge point is where the
   sum rises above ``SURGE`` times the mean and stays there; a dive point is where it falls to a line without text of
   its own.  The stretch between them with the most text is the core of the page.
3. Line counts alone would cut short paragraphs at the ends of an article.  So surge and dive are moved out to the
   bounds of the element that holds the core: its ``article`` or ``main`` if it has one, else the parent of the core's
   lines.  Lines of the stretch that lie in a ``main`` around it, or in other articles of that ``main``, stay as well, but for
   headings at its end, and so do articles beside it that hold enough text.  Without such elements, stretches that hold enough of
   the text are one where they share a parent, or where little but links parts them.

Edge cases: null, empty and tag-only pages give the empty text; unclosed and stray tags are tolerated; pages of any
length are read whole; repeated rows are extracted each; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW, SURGE = 3, 0.5
#: A stretch or an article with this share of the main one's text belongs to it; what parts them has no more than this share of the smaller.
ENOUGH = 0.2
#: Elements that hold text rather than others: one word of several in their class (``notice-period``) says nothing.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li td th dd dt span b strong em i u a q cite code pre blockquote figcaption caption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
ATTR = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
UNQUOTED = re.compile(r"""=\s*[^\s"'=]*/$""")  # a slash at the end of a tag that is part of a value
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset("script style template noscript head title nav header footer aside form button select option input textarea iframe svg canvas object applet audio video dialog menu map datalist".split())
WHOLE = frozenset("html body main article".split())
#: Words of class, id or role that name what is not main text.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices notification alert"
    " sidebar sidebars rail menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar header masthead footer colophon copyright comment comments disqus"
    " discussion replies respond reply share sharing social related recommended recommendations newsletter subscribe subscription signup login popup modal overlay widget widgets"
    " search contentinfo complementary skip".split()
)
#: Of these, words that also name parts of an article; by themselves they say nothing about an element with paragraphs.
OPEN_NAMES = frozenset("discussion respond share sharing social related recommended recommendations search widget widgets subscription promotion rail toolbar banner".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog toolbar".split())
CLOSES_P = BLOCK - {"br"}
#: An open element of the first name ends where one of the second group begins.
IMPLIED = {"li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"}), "p": CLOSES_P}


@dataclass
class Line:
    text: str
    own: int  # characters outside links
    parent: int  # the block that holds it
    holder: int  # its innermost article or main, 0 if none
    outer: int = 0  # its outermost article or main
    heading: bool = False


@dataclass
class Named:
    """An element whose class or id has a word of :data:`NAMES`."""

    number: int
    whole: bool  # all of its class, or its id, are such words
    holder: int  # the innermost article or main around it, 0 if none
    sure: bool = True  # it has a word beyond :data:`OPEN_NAMES`
    own: int = 0  # characters outside links
    links: int = 0  # characters in links


@dataclass
class Seen:
    """Where the text of a page is, in or outside named elements."""

    named: list[Named] = field(default_factory=list)
    holders: dict[int, tuple[int, list[Named]]] = field(default_factory=dict)  # by article or main: characters, and the named elements around it
    parents: dict[int, int] = field(default_factory=dict)  # of articles and mains, the element around
    total: int = 0
    free: int = 0  # outside whole named elements

    def wrappers(self, whole: bool) -> set[int]:
        """Named elements to be kept: those around the article or main with the most text, and those that hold most of
        its text, or of the page's if it has none.  Elements named as a whole are kept if nothing else is left, only."""
        held = {h: x for h, x in self.holders.items() if x[0]}
        own, around = 0, []
        if held:
            open_ = {h: x for h, x in held.items() if not any(n.whole for n in x[1])} or held
            target = max(open_, key=lambda h: (open_[h][0], -h))
            own, around = open_[target]
            inside = [n for n in self.named if n.holder == target]
        else:
            own, inside = self.total if whole else self.free, self.named
        return {n.number for n in around} | {n.number for n in inside if 2 * n.own > own and (whole or not n.whole)}


def dropped(name: str, attrs: str) -> bool:
    """Whether an element never is main text, whatever it holds."""
    if name in DROPPED:
        return True
    if name in WHOLE or "=" not in attrs and "hidden" not in attrs:
        return False
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "role" and value in ROLES or key == "aria-hidden" and value == "true" or key == "hidden":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def names(name: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether a class or id has a word of :data:`NAMES`, whether all of the class or the id are such words, and whether
    one of them is not of :data:`OPEN_NAMES`."""
    part = whole = sure = False
    if name not in WHOLE and "=" in attrs:
        for m in ATTR.finditer(attrs):
            if m[1].lower() in ("class", "id"):
                value = (m[2] or "").strip("\"'").lower()
                words = [w for w in re.split(r"[^a-z]+", value) if w]
                if not NAMES.isdisjoint(words) and (name not in TEXTUAL or NAMES.issuperset(words)):
                    part = True
                    sure = sure or not OPEN_NAMES.issuperset(NAMES.intersection(words))
                    whole = whole or NAMES.issuperset(value.split())
    return part, whole, sure


def lines_of(html: str, kept: frozenset[int] | set[int] = frozenset(), seen: Seen | None = None) -> list[Line]:
    """The page as lines of text, without markup and dropped subtrees; named elements of ``kept`` stay."""
    lines: list[Line] = []
    stack: list[tuple[str, int, int, int, int]] = []  # name, number, dropped (1 for its name, 2 for good), holder, outer holder
    open_: dict[str, list[int]] = {}  # where elements of a name are in the stack
    blocks: list[int] = []  # where blocks are in it, and those that hold lines
    holding: list[int] = []
    inside: list[tuple[int, Named]] = []  # named elements that are open, with their depth
    parts: list[str] = []
    own = number = links = 0

    def flush() -> None:
        nonlocal own
        if parts:
            if text := " ".join("".join(parts).split()):
                last = stack[blocks[-1]][0] if blocks else ""
                lines.append(Line(text, own, stack[holding[-1]][1] if holding else 0, *(stack[-1][3:] if stack else (0, 0)), last in HEADING))
            parts.clear()
        own = 0

    def put(text: str) -> None:
        nonlocal own
        gone = stack[-1][2] if stack else 0
        if not text or gone == 2:
            return
        text = unescape(text)
        if seen is not None:
            count(len(text.strip()))
        if not gone:
            parts.append(text)
            if not links:
                own += len(text)

    def count(n: int) -> None:
        if links:
            for _, x in inside:
                x.links += n
            return
        holder, out = stack[-1][3] if stack else 0, False  # whether a whole named element comes between
        for _, x in reversed(inside):
            x.own += 0 if out else n
            out = out or x.whole
            if holder and x.holder != holder:
                break
        seen.total += n
        seen.free += 0 if any(x.whole for _, x in inside) else n
        if holder and not any(x.whole and x.holder == holder for _, x in inside):
            before, around = seen.holders[holder]
            seen.holders[holder] = before + n, around

    def pop(to: int) -> None:
        nonlocal links
        for x in stack[to:]:
            links -= x[0] == "a"
            open_[x[0]].pop()
        del stack[to:]
        for places in (blocks, holding):
            while places and places[-1] >= to:
                places.pop()
        while inside and inside[-1][0] >= to:
            inside.pop()

    at, end = 0, len(html)
    while at < end:
        start = html.find("<", at)
        if start < 0:
            put(html[at:])
            break
        put(html[at:start])
        m = TOKEN.match(html, start)
        if not m:
            # A tag with a stray quote ends at its bracket; any other "<" is text.
            close = html.find(">", start) if re.match(r"</?[A-Za-z]", html[start : start + 3]) else -1
            if close < 0:
                put("<")
                at = start + 1
            else:
                at = close + 1
            continue
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        if m["end"]:
            places = open_.get(name)
            if places and (name in BLOCK or not blocks or blocks[-1] <= places[-1]):
                pop(places[-1])
            continue
        if name in BLOCK:
            while blocks and name in IMPLIED.get(stack[blocks[-1]][0], ()):
                pop(blocks[-1])
        if name in VOID or m["attrs"].endswith("/") and name not in BLOCK and not UNQUOTED.search(m["attrs"]):
            continue
        number += 1
        gone, holder, outer = stack[-1][2:] if stack else (0, 0, 0)
        part = False
        if gone < 2:
            if dropped(name, m["attrs"]):
                gone = 2
            else:
                part, whole, sure = names(name, m["attrs"])
                if part and number not in kept:
                    gone = 1
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, at)
            if not gone:
                put(html[at : close.start() if close else end])
            at = (html.find(">", close.start()) + 1 or end) if close else end
            continue
        links += name == "a"
        if part and seen is not None:
            inside.append((len(stack), Named(number, whole, holder, sure)))
            seen.named.append(inside[-1][1])
        if name in ("article", "main"):
            holder, outer = number, outer or number
            if seen is not None and gone < 2:
                seen.holders[number] = 0, [x for _, x in inside]
                seen.parents[number] = stack[-1][1] if stack else 0
        open_.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            blocks.append(len(stack))
            if name != "p":
                holding.append(len(stack))
        stack.append((name, number, gone, holder, outer))
    flush()
    return lines


def stretches(lines: list[Line], window: int = WINDOW) -> list[tuple[int, int]]:
    """First and last lines between a surge and the next dive."""
    lengths = [x.own for x in lines]
    sums, total = [], sum(lengths[:window])
    for i in range(len(lines)):
        sums.append(total)
        total += (lengths[i + window] if i + window < len(lines) else 0) - lengths[i]
    least = SURGE * sum(sums) / len(sums)
    out, at = [], 0
    while at < len(lines):
        if sums[at] <= least or not lengths[at]:
            at += 1
            continue
        dive = at
        while dive + 1 < len(lines) and lengths[dive + 1] and sums[dive + 1] > 0:
            dive += 1
        out.append((at, dive))
        at = dive + 1
    return out or [(0, len(lines) - 1)]


def core(lines: list[Line], window: int = WINDOW) -> tuple[int, int]:
    """The stretch that holds the most text."""
    return max(stretches(lines, window), key=lambda s: (sum(x.own for x in lines[s[0] : s[1] + 1]), -s[0]))


def main_holder(stretch: list[Line]) -> int:
    """The innermost article or main that holds most of a stretch's text, 0 if that is in none."""
    holders: dict[int, int] = {}
    for x in stretch:
        holders[x.holder] = holders.get(x.holder, 0) + x.own
    return max(holders, key=lambda h: (holders[h], -h))


def kept_lines(html: str) -> tuple[list[Line], Seen]:
    """The lines of a page, with those of wrappers around its main text, and of parts of it that merely have such a name."""
    lines, kept = lines_of(html, seen=(seen := Seen())), set()
    for whole in (False, True):
        if seen.named and (not whole or not any(x.own for x in lines)):
            if kept := seen.wrappers(whole):
                lines = lines_of(html, kept)
    if any(not x.sure and x.holder for x in seen.named) and lines:
        surge, dive = core(lines)
        holder = main_holder(lines[surge : dive + 1])
        like = sorted(x.own for x in lines if x.holder == holder and x.own and not x.heading)
        parts = {x.number for x in seen.named if holder and like and x.holder == holder and not x.sure and x.own >= ENOUGH * like[len(like) // 2] and x.own >= 3 * x.links}
        if parts - kept:
            lines = lines_of(html, kept | parts)
    return lines, seen


def main_text(html: str | None) -> str:
    lines, seen = kept_lines(html or "")
    if not lines:
        return ""
    surge, dive = core(lines)
    holder = main_holder(lines[surge : dive + 1])
    kept = in_holder(lines, surge, dive, holder, seen.parents) if holder else without_holder(lines, surge, dive)
    return "\n".join(x.text for x in kept)


def in_holder(lines: list[Line], surge: int, dive: int, holder: int, parents: dict[int, int]) -> list[Line]:
    """All lines of the holder, those of the stretch that another element around it holds, and those of articles beside it."""
    outer = next(x.outer for x in lines if x.holder == holder)
    size: dict[int, int] = {}
    for x in lines:
        size[x.holder] = size.get(x.holder, 0) + x.own
    beside = {h for h, n in size.items() if h and parents.get(h) == parents.get(holder) and n >= ENOUGH * size[holder]}
    own = [i for i, x in enumerate(lines) if x.holder in beside]
    more = [i for i in range(surge, dive + 1) if lines[i].outer == outer]
    while more and more[-1] > own[-1] and lines[more[-1]].heading:
        more.pop()
    return [lines[i] for i in sorted({*own, *more})]


def without_holder(lines: list[Line], surge: int, dive: int) -> list[Line]:
    """The stretch, with what its lines' parents hold next to it, and near stretches with enough text."""
    size = lambda s: sum(x.own for x in lines[s[0] : s[1] + 1])
    found, least = stretches(lines), ENOUGH * size((surge, dive))
    at = found.index((surge, dive))

    def joined(a: tuple[int, int], b: tuple[int, int]) -> bool:
        parents = [{x.parent for x in lines[i : j + 1]} for i, j in (a, b)]
        return not parents[0].isdisjoint(parents[1]) or size((a[1] + 1, b[0] - 1)) <= ENOUGH * min(size(a), size(b))

    low = high = at
    while low and size(found[low - 1]) >= least and joined(found[low - 1], found[low]):
        low -= 1
    while high + 1 < len(found) and size(found[high + 1]) >= least and joined(found[high], found[high + 1]):
        high += 1
    kept: set[int] = set()
    for first, last in found[low : high + 1]:
        parents = {x.parent for x in lines[first : last + 1]}
        while first and lines[first - 1].parent in parents:
            first -= 1
        while last + 1 < len(lines) and lines[last + 1].parent in parents:
            last += 1
        kept.update(range(first, last + 1))
    return [lines[i] for i in sorted(kept)]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and its length in code points for every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
