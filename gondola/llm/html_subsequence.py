"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of tags and runs of words. Each word scores a positive weight and each tag
a negative one, by what it is and stands in; the contiguous region of the highest total is the
content, found by one linear scan. Weights are log odds counted over all labelled pages: those
with an `<article>` element, whose words and tags are content and all others are not. Elements
that are never content (menus, forms, adverts, ...) are known by name, or by the words in their
class, id and role; what they hold neither scores nor appears, so they may interrupt an article.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements by kind.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
DROPPED = frozenset(
    "nav header footer aside form button select dialog menu svg math object audio video canvas "
    "map figure head noscript template iframe".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer colophon "
    "sidebar side aside widget related recommended share sharing social comment comments reply "
    "replies discussion disqus respond cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login search pagination pager "
    "copyright legal disclaimer complementary contentinfo toolbar skip".split()
)
# Start tags that imply an end: of which elements, and within what.
P, CELL = frozenset({"p"}), frozenset({"td", "th", "caption"})
P_BOUNDS = CELL | frozenset("table button object template".split())
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
TABLE_PARTS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
_TABLE, _LISTS = frozenset({"table"}), frozenset("ul ol menu table".split()) | CELL
_SECTIONS = frozenset("thead tbody tfoot tr".split()) | CELL
IMPLIED = {
    "li": (frozenset({"li"}), _LISTS),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"}) | _LISTS),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}) | _LISTS),
    "option": (frozenset({"option"}), frozenset({"select"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "td": (CELL, _TABLE | {"tr"}),
    "th": (CELL, _TABLE | {"tr"}),
    "tr": (frozenset({"tr"}) | CELL, _TABLE),
    "thead": (_SECTIONS, _TABLE),
    "tbody": (_SECTIONS, _TABLE),
    "tfoot": (_SECTIONS, _TABLE),
}
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_MARKS = re.compile(r"(?:^|[\s/])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Weights where no page is labelled, and the bounds of learned ones.
DEFAULT_WEIGHTS = {"word": 1.0, "tag": -1.0, "dropped": -0.5}
WORD_RANGE, TAG_RANGE = (0.05, 4.0), (-12.0, -0.05)


def _is_boilerplate(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if "=" not in attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _MARKS.finditer(attributes):
        if any(part.lower() in BOILERPLATE for part in _PART.findall(m[1])):
            return True
    return False


def _events(page: str) -> list[tuple[str | None, bool, str, int, int]]:
    """(name, closing, attributes, start, end) of every tag, and with no name of every text;
    without comments and raw text."""
    out, at, end = [], 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if (stop := m.start() if m else end) > at:
            out.append((None, False, "", at, stop))
        if not m:
            break
        at = m.end()
        if m[2]:
            name = m[2].lower()
            out.append((name, m[1] == "/", m[3], m.start(), at))
            if name in RAW and m[1] != "/":
                at = _raw_end(page, at, name)
    return out


def _innermost(stack: list, name: str) -> int | None:
    """The place of the open element that this end tag ends; it ends those within it, too. An
    inline one does not reach out of its block, others not out of a table's cell."""
    for j in range(len(stack) - 1, -1, -1):
        other = stack[j][0]
        if other == name:
            return j
        if name in INLINE and other not in INLINE or other in CELL and name not in TABLE_PARTS or other == "table":
            return None
    return None


def _outermost(stack: list, names: frozenset, bounds: frozenset) -> int | None:
    """The place of the outermost element of these names within the nearest bound."""
    found = None
    for j in range(len(stack) - 1, -1, -1):
        if stack[j][0] in bounds:
            break
        if stack[j][0] in names:
            found = j
    return found


def _dropped(page: str, events: list) -> dict[int, int]:
    """Where dropped elements begin -> where they end, as places in `events`.

    An element ends by its end tag, an implied one, or its parent's. One without an end tag of
    its own also ends where an article or main begins. Names in a class, and a form, say nothing
    against an element that holds all articles and mains of the page, or, where there are none,
    most of its words; nor does any name for one without an end tag."""
    stack: list[tuple[str, int, bool]] = []  # name, place, boilerplate
    n_open: Counter = Counter()
    ended: list[tuple[int, int, bool]] = []
    unended: dict[str, list[tuple[int, int]]] = {}
    marks = [k for k, e in enumerate(events) if e[0] in ("article", "main") and not e[1]]

    def end(j: int | None, k: int, own: bool) -> None:
        while j is not None and len(stack) > j:
            name, start, boilerplate = stack.pop()
            n_open[name] -= 1
            if boilerplate:
                ended.append((start, k, own and len(stack) == j))
            if not (own and len(stack) == j):
                unended.setdefault(name, []).append((start, k))

    for k, (name, closing, attributes, _, _) in enumerate(events):
        if name is None:
            continue
        if closing:
            if n_open[name]:
                end(_innermost(stack, name), k, True)
            continue
        if name in ENDS_P and n_open["p"]:
            end(_outermost(stack, P, P_BOUNDS), k, True)
        if name in IMPLIED and any(n_open[x] for x in IMPLIED[name][0]):
            end(_outermost(stack, *IMPLIED[name]), k, True)
        foreign = name in ("svg", "math") or n_open["svg"] or n_open["math"]
        if name in VOID or name in RAW or foreign and attributes.endswith("/"):
            continue
        stack.append((name, k, _is_boilerplate(name, attributes)))
        n_open[name] += 1
    end(0, len(events), False)

    words = None
    out = {}
    for start, stop, own in ended:
        held = marks[bisect_right(marks, start) : bisect_left(marks, stop)]
        name = events[start][0]
        # Its end tag may be that of an element around it that has none.
        if held and (not own or any(a < start and b >= stop for a, b in unended.get(name, ()))):
            stop = held[0]
        elif not own or name not in DROPPED or name == "form":
            if marks:
                if len(held) == len(marks):
                    continue
            else:
                if words is None:
                    words = [0, *accumulate(0 if e[0] else len(page[e[3] : e[4]].split()) for e in events)]
                if 2 * (words[stop] - words[start]) > words[-1]:
                    continue
        out[start] = stop
    return out


def tokens(page: str) -> Iterator[tuple[str, str, str | None, bool]]:
    """(kind, feature, text, in article) in page order; kind is 'tag', 'break' (a block starts or
    ends), 'space' or 'text'. Nothing comes from dropped elements but their tags."""
    events = _events(page)
    dropped = _dropped(page, events)
    inside = 0  # depth in article elements
    context = "body"
    k = 0
    while k < len(events):
        name, closing, _, start, stop = events[k]
        if k in dropped:
            yield "break", "dropped", None, inside > 0
            k = dropped[k]
            if k < len(events):
                yield "break", "dropped", None, inside > 0
                k += events[k][0] == name and events[k][1]  # its own end tag
            continue
        k += 1
        if name is None:
            yield "text", "word:" + context, unescape(page[start:stop]), inside > 0
            continue
        if name == "article" and closing:
            inside = max(0, inside - 1)
        if name not in INLINE:
            kind = "space" if name == "br" else "break"
            yield kind, ("tag:/" if closing else "tag:") + name, None, inside > 0
        else:
            yield "tag", ("tag:/" if closing else "tag:") + name, None, inside > 0
        if closing:
            context = "body" if name == context else context
            continue
        if name == "article":
            inside += 1
        elif name not in VOID and name not in RAW and (name not in INLINE or name == "a"):
            context = name


def _raw_end(page: str, at: int, name: str) -> int:
    """Where the closing tag of a raw text element begins (its text is no markup)."""
    m = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
    return m.start() if m else len(page)


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The text of the best region: its blocks joined by line ends, white space made one space.
    Empty for a null or empty page, or one without words."""
    best, best_from, best_to = 0.0, 0, 0
    total, start = 0.0, 0
    kept = []
    word, tag = weights["word"], weights["tag"]
    for kind, feature, text, _ in tokens(page or ""):
        kept.append((kind, text))
        if kind == "text":
            total += len(text.split()) * weights.get(feature, word)
        else:
            total += weights.get(feature, tag)
        if total <= 0:
            total, start = 0.0, len(kept)
        elif total > best:
            best, best_from, best_to = total, start, len(kept)
    blocks, current = [], []
    for kind, text in kept[best_from:best_to]:
        if kind == "text":
            current.append(text)
        elif kind == "space":
            current.append(" ")
        elif kind == "break" and current:
            blocks.append("".join(current))
            current = []
    blocks.append("".join(current))
    lines = (" ".join(block.split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def _features(frames):
    content, other = Counter(), Counter()
    for frame in frames:
        for page in frame.column(0):
            page = page.as_py()
            if not page or "<article" not in page.lower():
                continue
            for kind, feature, text, within in tokens(page):
                if feature == "dropped":
                    continue
                n = len(text.split()) if kind == "text" else 1
                if len(feature) <= 30:
                    (content if within and feature != "tag:article" else other)[feature] += n
    names = sorted(content.keys() | other.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([content[n] for n in names], pa.int64()),
         pa.array([other[n] for n in names], pa.int64())],
        names=["feature", "content", "other"],
    )


def learn(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Weights from all labelled pages (an action). Counts per feature go to the driver: known
    HTML elements and the 1,000 commonest others, the rest keeping the default weight."""
    counts = (
        pages.select(F.col(html).cast("string").alias("html"))
        .mapInArrow(_features, "feature string, content long, other long")
        .groupBy("feature").agg(F.sum("content").alias("content"), F.sum("other").alias("other"))
        .orderBy(F.desc(F.col("content") + F.col("other")), "feature").limit(1000).collect()
    )
    weights = dict(DEFAULT_WEIGHTS)
    for kind, (low, high) in (("word", WORD_RANGE), ("tag", TAG_RANGE)):
        rows = [r for r in counts if r.feature.startswith(kind + ":")]
        base = log((sum(r.content for r in rows) + 1) / (sum(r.other for r in rows) + 1))
        if kind == "word":
            base = 0.0  # most words of a page are content: that is evidence too
        for r in rows:
            odds = log((r.content + 0.5) / (r.other + 0.5)) - base
            weights[r.feature] = min(max(odds, low), high)
    return weights


def extract_pages(pages: DataFrame, html: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text and n_chars (its code points) of every page; with no weights given
    they are learned from the same pages first (an action). Null ids and urls stay, repeated
    pages are extracted each, an empty table gives no rows."""
    weights = weights or learn(pages, html)

    def run(frames):
        for frame in frames:
            texts = [extract(page.as_py(), weights) for page in frame.column(2)]
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), frame.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    )
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
