"""Main text of web pages by the line-block distribution.

Markup is stripped to lines, one a block element. The distribution is the sum of text lengths over a sliding window of
lines. It surges where the main text sets in and dives to nothing where it ends: the lines between a surge and the next
dive are one run. Elements that by their name, role or class are no article text (menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts, styles) become a gap as wide as the window, so the distribution dives there, and so
do the borders of article and main elements; link text does not count for the distribution, but for headings in articles.

Article and main elements are evidence only: text outside them counts by ``OUTSIDE``. The story is of the run with most text
so counted. If it is in an article, all runs in articles are main text; otherwise runs whose peak is small beside the highest are
not. A run of the other side is main text if it has a like share of the story's text.

Gaps of removed elements do not split a story outside articles. Its containers are the elements around the paragraphs of its longer
lines; every other run inside one is main text however short, and so are paragraphs and headings that stand directly in an
element around one, and the last h1 ahead if the story has none. An article inside a container counts if the story goes on after it.

Defined results: a null or empty page, or one without text, gives the empty text. Unclosed elements end with their parent; an
unclosed comment, script or style goes to the end of the page. Character references are decoded as browsers do, also
without a semicolon. Each page is read whole; pages are independent, so there is no shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import small_batches, text_batches, tidy

#: Lines a window spans; a run's peak in characters, as a share of the page's highest, to be main text.
WINDOW, PEAK_SHARE = 3, 0.3
#: What a character outside article and main elements counts on a page that has them.
OUTSIDE = 0.5
CHARS = 1 << 21

RAW = "script|style|noscript|template|textarea|iframe|svg|math|title|object|audio|video|canvas|select|xmp|noembed|noframes"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attr2>[^>]*)>|<[!?/][^>]*>", re.S | re.I)
_HINT = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
         "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table",
         "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} - {"br"}
CLOSED_BY_ITSELF = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
DROPPED = {"nav", "aside", "footer", "form", "head", "menu", "button", "dialog", "input", "fieldset"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold paragraphs, and paragraphs.
GROUPS = {"article", "body", "center", "details", "div", "html", "main", "section", "td"}
PROSE = HEADINGS | {"blockquote", "p", "pre"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu",
                 "menubar", "toolbar"}
DROPPED_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
                 "promotion", "banner", "nav", "navbar", "navigation", "menu", "sidebar", "aside", "breadcrumb", "breadcrumbs",
                 "footer", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert",
                 "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "share",
                 "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "disqus", "replies",
                 "respond", "toolbar", "pagination", "pager", "widget", "widgets", "skip", "commentlist", "commentform", "reply",
                 "sidenav", "topnav", "subnav", "navmenu", "topbar", "adbox", "adslot", "adunit", "cookiebar", "paywall",
                 "trending", "popular", "teaser", "teasers", "disclaimer"}
#: A class that also has one of these words tells what the element has or lacks, not what it is ("with-sidebar").
KEPT_WORDS = {"closed", "disabled", "enabled", "has", "is", "layout", "no", "not", "open", "with", "without"}


def _boilerplate(name: str, attr: str, in_main: bool) -> bool:
    if name in DROPPED or (name == "header" and not in_main):
        return True
    if not attr or name in ("html", "body"):
        return False
    for kind, a, b, c in _HINT.findall(attr):
        kind, value = kind.lower(), (a or b or c).lower()
        if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
            return True
        if kind == "role":
            if value.strip() in DROPPED_ROLES:
                return True
        elif kind in ("class", "id"):
            for one in value.split():
                words = set(re.split(r"[^a-z0-9]+", one))
                if words & DROPPED_WORDS and not words & KEPT_WORDS:
                    return True
                if not in_main and name not in MAIN and one in ("header", "site-header", "page-header", "top-bar"):
                    return True
    return False


def lines_of(page: str) -> tuple[list[str], list[int], list[bool], list[int], list[tuple[str, int]]]:
    """Text, length outside links, whether inside an article, and innermost block element of every line; gaps are empty lines. Also
    name and parent of every block element; the first stands for the page."""
    texts: list[str] = []
    lengths: list[int] = []
    inside: list[bool] = []
    place: list[int] = []
    elements: list[tuple[str, int]] = [("", 0)]
    parts: list[str] = []
    plain = 0
    stack: list[tuple[str, bool, bool, int]] = []  # element, whether it is dropped, whether in an article, block element
    links = headings = 0
    dropped = in_main = False
    at = 0

    def flush() -> None:
        nonlocal plain
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                texts.append(text)
                lengths.append(min(plain, len(text)))
                inside.append(in_main)
                place.append(stack[-1][3] if stack else 0)
            parts.clear()
        plain = 0

    def gap() -> None:
        for _ in range(WINDOW):
            texts.append("")
            lengths.append(0)
            inside.append(False)
            place.append(0)

    def leave(depth: int) -> None:
        """Close all elements from ``depth`` on."""
        nonlocal dropped, in_main, links, headings
        links -= sum(name == "a" for name, *_ in stack[depth:])
        headings -= sum(name in HEADINGS for name, *_ in stack[depth:])
        was = dropped, in_main
        del stack[depth:]
        dropped, in_main = stack[-1][1:3] if stack else (False, False)
        if not dropped and was != (dropped, in_main):
            gap()

    for m in _TOKEN.finditer(page):
        if m.start() > at and not dropped:
            text = page[at : m.start()]
            parts.append(text)
            if not links or (in_main and headings):
                plain += len(text)
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        if m["end"] or m["end2"]:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] != name:
                depth -= 1
            if depth >= 0:
                if any(x in BLOCK for x, *_ in stack[depth:]):
                    flush()
                leave(depth)
            continue
        if name in CLOSED_BY_ITSELF:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] not in BLOCK:
                depth -= 1
            if depth >= 0 and stack[depth][0] == name:
                leave(depth)
        attr = m["attr"] or m["attr2"] or ""
        if attr.endswith("/") and name not in BLOCK:
            continue
        now = dropped or _boilerplate(name, attr, in_main)
        if now and not dropped:
            flush()
        if name in MAIN and not in_main and not now:
            gap()
        dropped, in_main = now, in_main or name in MAIN
        block = stack[-1][3] if stack else 0
        if name in BLOCK and not dropped:
            elements.append((name, block))
            block = len(elements) - 1
        stack.append((name, dropped, in_main, block))
        links += name == "a"
        headings += name in HEADINGS
    if at < len(page) and not dropped:
        parts.append(page[at:])
        plain += len(page) - at
    flush()
    return texts, lengths, inside, place, elements


def runs_of(lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """First line, line after the last, and peak of the distribution, of every run between a surge and the next dive."""
    if not len(lengths):
        return []
    block = np.convolve(lengths, np.ones(WINDOW, np.int64))  # the window that ends at each line
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (block > 0).astype(np.int8), [0]])))
    # a surge is at a line with text, and the last window before a dive begins with one
    return [(int(a), int(b) - WINDOW + 1, int(block[a:b].max())) for a, b in zip(edge[::2], edge[1::2])]


def story(runs: list[tuple[int, int, int]], length: np.ndarray, in_main: np.ndarray, place: list[int],
          elements: list[tuple[str, int]]) -> list[int]:
    """The runs that are main text, in order."""
    if not runs:
        return []
    marked = np.array([in_main[a] for a, _, _ in runs])  # no run goes across an article's border
    weight = np.where(marked, 1, OUTSIDE)
    text = np.array([length[a:b].sum() for a, b, _ in runs]) * weight
    peak = np.array([p for _, _, p in runs])
    side = marked == marked[text.argmax()]
    own = side & (marked | (peak >= PEAK_SHARE * peak[side].max()))
    kept = own | (text >= PEAK_SHARE * text.max())
    if not kept.all() and (kept & ~marked).any():
        kept |= _set_apart(runs, kept, marked, length, place, elements)
    return np.flatnonzero(kept).tolist()


def _set_apart(runs: list[tuple[int, int, int]], kept: np.ndarray, marked: np.ndarray, length: np.ndarray, place: list[int],
               elements: list[tuple[str, int]]) -> np.ndarray:
    """The runs that belong to the kept ones outside articles by their place in the page."""
    group = [0]
    for _, parent in elements[1:]:
        group.append(parent if elements[parent][0] in GROUPS else group[parent])
    containers = set()
    for k in np.flatnonzero(kept & ~marked).tolist():
        a, b, _ = runs[k]
        containers |= {group[place[i]] for i in range(a, b) if length[i] >= PEAK_SHARE * length[a:b].max()}
    top = {e for e in containers if elements[e][0] in ("", "html", "body")}
    within = [0 in containers]
    deep = [False]  # in a container other than the whole page
    for e in range(1, len(elements)):
        within.append(e in containers or within[elements[e][1]])
        deep.append((e in containers and e not in top) or deep[elements[e][1]])
    around = {0}
    for e in containers:
        while e not in around:
            around.add(e)
            e = elements[e][1]
    out = np.zeros(len(runs), bool)
    for k, (a, b, _) in enumerate(runs):
        own = place[a:b]
        out[k] = not marked[k] and any(within[e] or (elements[e][0] in PROSE and group[e] in around) for e in own)
    last = int(np.flatnonzero((kept | out) & ~marked)[-1])
    for k in np.flatnonzero(marked[:last]).tolist():
        out[k] = any(deep[e] for e in place[runs[k][0] : runs[k][1]])
    titled = [k for k, (a, b, _) in enumerate(runs) if any(elements[e][0] == "h1" for e in place[a:b])]
    first = int(np.flatnonzero(kept | out)[0])
    if not any(kept[k] or out[k] for k in titled):
        ahead = [k for k in titled if k < first and not marked[k]]
        out[ahead[-1:]] = True
    return out


def main_text(page: str | None) -> str:
    """The page's main text, its blocks joined by a line feed."""
    if not page:
        return ""
    texts, lengths, inside, place, elements = lines_of(page)
    length = np.asarray(lengths, np.int64)
    in_main = np.asarray(inside, bool)
    if not length[in_main].any():  # articles made of links count by these
        length = np.where(in_main, [len(t) for t in texts], length)
    runs = runs_of(length)
    keep = [t for a, b, _ in (runs[k] for k in story(runs, length, in_main, place, elements)) for t in texts[a:b] if t]
    return "\n".join(keep)


def extract(pages: DataFrame, *, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``'s columns with ``text`` and ``n_chars`` (code points) of every row."""
    small_batches(pages.sparkSession)
    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep) + "text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in text_batches(batches, CHARS, "__page"):
            found = [main_text(x) for x in t["__page"].to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *(t[c].combine_chunks() for c in keep), pa.array(found, pa.string()),
                pa.array(np.fromiter(map(len, found), np.int64, len(found)))], names=[*keep, "text", "n_chars"])

    return pages.select(*keep, F.col(html_col).alias("__page")).mapInArrow(tidy(run), schema)
