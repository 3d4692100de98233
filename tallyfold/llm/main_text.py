"""Main text of a page by the distribution of its line blocks.

Markup is stripped into lines, one per block of the page. Regions that markup itself names as furniture
(menus, headers, footers, forms, adverts, comments ...) leave blank lines only. The text lengths, less link text,
are summed over windows of ``WINDOW`` lines; a region begins where the sum surges from nothing and
ends where it dives back to nothing. Regions choose, they do not cut: kept are the strongest region, every other one that
shares a container with it at any depth, and those elsewhere that reach ``PEER`` of its strength; and with them all lines in the containers
their weighted lines stand in directly, also lines that are all link. Where the page marks articles, only what is inside
counts, and all lines of every article with a weighted line of its own are kept.

Pages are independent of each other: no shuffle.

Defined cases: null, empty or text-free html gives an empty text; unclosed and stray tags are borne; cut-off
markup at the end is dropped; repeated rows are pages of their own; the body itself is no container, so that lines directly
in it are kept from the first to the last weighted line of a region.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices, utf8

WINDOW = 3
PEER = 0.5
GAP = WINDOW + 1

# Elements of the HTML standard.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
FURNITURE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
ARTICLE = {"article", "main"}
CONTAINERS = ARTICLE | {"div", "section", "td", "blockquote"}
# Words in class, id and role that name furniture, and those that do so outside articles only.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|"
    r"sidebar\w*|side-?bar|footer|masthead|topbar|cookie\w*|consent|notice\w*|alert|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|replies|reply|"
    r"respond|disqus\w*|search\w*|widget\w*|pagination|pager|skip|toolbar|complementary|contentinfo|disclaimer|copyright)"
    r"(?=$|[\s_-]|\d)", re.I)

NAMED_OUTSIDE = re.compile(r"(?:^|[\s_-])(?:header|banner)(?=$|[\s_-]|\d)", re.I)

_REMOVED = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.I | re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>")
_BROKEN = re.compile(r"<(?=[a-zA-Z/])[^>]*(?:>|\Z)")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for m in _NAMES.finditer(attributes):
        named = m[2] or m[3] or m[4] or ""
        if NAMED.search(named) or not in_article and NAMED_OUTSIDE.search(named):
            return True
    return False


def lines_of(page: str) -> tuple[list[tuple[str, int, int, int]], list[int], list[int]]:
    """``text, weight, article, container`` per line, blank lines where furniture was; and of each container the one around it
    and the article it is in (0 for none)."""
    page = _REMOVED.sub(" ", page)
    lines: list[tuple[str, int, int, int]] = []
    containers = [0]
    around, article = [0], [0]
    text: list[str] = []
    linked = 0
    open_tags: list[str] = []
    articles = links = 0
    furniture = None  # number of open tags outside the furniture we are in

    def end_line():
        nonlocal linked
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if line:
            lines.append((line, max(0, len(line) - linked), article[containers[-1]], containers[-1]))
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw and furniture is None:
            text.append(raw)
            if links:
                linked += len(raw.strip())

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            say(_BROKEN.sub(" ", page[at:m.start()]))
        at = m.end()
        closing, tag, attributes, own = m[1], m[2].lower(), m[3], m[4]
        if tag not in INLINE and furniture is None:
            end_line()
        if closing:
            if tag in open_tags:
                while True:
                    gone = open_tags.pop()
                    articles -= gone in ARTICLE
                    links -= gone == "a"
                    if gone in CONTAINERS:
                        containers.pop()
                    if gone == tag:
                        break
                if furniture is not None and len(open_tags) <= furniture:
                    furniture = None
            continue
        if tag in VOID or own and tag not in ("p", "div"):
            continue
        if tag == "p" and open_tags and open_tags[-1] == "p":
            open_tags.pop()
        if furniture is None and _is_furniture(tag, attributes, articles > 0):
            end_line()
            furniture = len(open_tags)
            if not articles:
                lines.extend([("", 0, 0, 0)] * GAP)
        open_tags.append(tag)
        if tag in CONTAINERS:
            around.append(containers[-1])
            article.append(len(article) if tag in ARTICLE else article[containers[-1]])
            containers.append(len(article) - 1)
        articles += tag in ARTICLE
        links += tag == "a"
    say(_BROKEN.sub(" ", page[at:]))
    end_line()
    return lines, around, article


def regions(weights: list[int]) -> list[tuple[int, int]]:
    """``[surge, dive)`` of every stretch whose window sums stay above nothing."""
    sums = [sum(weights[i: i + WINDOW]) for i in range(len(weights))]
    found, start = [], None
    for i, total in enumerate(sums):
        if total and start is None:
            start = i
        elif not total and start is not None:
            found.append((start, i))
            start = None
    if start is not None:
        found.append((start, len(sums)))
    # A window sees its weight up to WINDOW - 1 lines ahead: the text itself begins at the first weighted line.
    return [(next(i for i in range(a, b) if weights[i]), b) for a, b in found]


def extract(page: str | None) -> str:
    if not page:
        return ""
    lines, around, article = lines_of(page)
    marked = any(weight and inside for _, weight, inside, _ in lines)
    weights = [weight if (inside > 0) == marked else 0 for _, weight, inside, _ in lines]
    found = [(sum(weights[a:b]), a, b) for a, b in regions(weights)]
    if not found:
        return ""
    best, start, stop = max(found, key=lambda x: (x[0], -x[1]))
    # Containers are numbered from outside to inside.
    outermost = [0] * len(around)
    for c in range(1, len(around)):
        outermost[c] = outermost[around[c]] or c
    home = {outermost[lines[i][3]] for i in range(start, stop) if weights[i]} - {0}
    chosen, whole = [False] * len(lines), [False] * len(around)
    for strength, a, b in found:
        inside = [i for i in range(a, b) if weights[i]]
        if marked or strength >= PEER * best or home & {outermost[lines[i][3]] for i in inside}:
            chosen[a:b] = [True] * (b - a)
            for i in inside:
                whole[lines[i][2 if marked else 3]] = True
    whole[0] = False
    for c in range(1, len(around)):
        whole[c] |= whole[around[c]]
    return "\n".join(x[0] for x, there in zip(lines, chosen) if (there or whole[x[3]]) and x[0] and (x[2] > 0) == marked)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        texts = [extract(None if (raw := x.as_py()) is None else raw.decode("utf-8", "replace")) for x in part["_utf8"]]
        yield pa.RecordBatch.from_arrays(
            [part["_row"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["_row", "main_text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``_row`` (all columns of ``pages``), ``main_text, n_chars``."""
    rows = pages.select(F.struct("*").alias("_row"), utf8("html").alias("_utf8"))
    return rows.mapInArrow(
        _extract, f"_row {rows.schema['_row'].dataType.simpleString()}, main_text string, n_chars bigint")


def report(pages: DataFrame) -> DataFrame:
    return extract_main_text(pages.select("page_id", "url", "html")).select(
        "_row.page_id", "_row.url", F.col("main_text").alias("text"), "n_chars")
