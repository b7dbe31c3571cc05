"""Main text of web pages by line-block distribution.

Markup is stripped into lines (one per block of text, in page order), and every
line gets a weight: its number of characters, nothing for menus, page headers,
footers, sidebars, notices, adverts, forms, reader comments and blocks outside paragraphs
and headings that are nothing but links, half of it where a class, id or role has a
word of those but means something else as well ("related-work"). Where article or main elements hold most of a page's weight, lines
outside them weigh nothing.

The weights are summed over windows of ``2 * REACH + 1`` lines. A surge is where the
sum rises to ``SURGE`` of its mean over the lines of full weight, a dive where it
falls below. Lines of lowered weight are kept between a surge and the next
dive and dropped elsewhere: amid the article a doubtful line is part of it, by itself
or among menus it is not. Lines of full weight are kept wherever they stand, as
any threshold on them would drop article text.

Outside article and main elements a heading that announces reader comments ends the article.

A page is one row, so the job is one pass without a shuffle.

Defined results: null and empty pages have empty text; broken markup (unclosed, wrongly nested or
truncated tags) never fails; extra columns pass through.
"""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.common import ship

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
_BLANK = re.compile(r"\s+")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object"}
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A) for name in _RAW}
#: Blocks whose text is kept even if all of it is a link.
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "figcaption", "caption"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_DROP = {"nav", "aside", "footer", "form", "menu", "button", "select", "dialog", "audio", "video", "canvas"} | _RAW
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "input"}
#: Words of class, id and role that mark text outside the article.
_OUTSIDE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
            "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup",
            "modal", "overlay", "sidebar", "sidebars", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb",
            "breadcrumbs", "footer", "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing",
            "social", "related", "recommended", "newsletter", "subscribe", "signup", "login", "search", "widget",
            "toolbar", "pagination", "pager", "complementary", "contentinfo"}
#: Words that say nothing by themselves beside one of the above ("ad-box", "share-buttons", "related-posts").
_PLAIN = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form",
          "group", "header", "heading", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "media",
          "module", "outer", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "sticky",
          "stories", "story", "text", "title", "top", "unit", "wrap", "wrapper", "zone"}
#: Share of its characters that a line weighs whose marks leave it open.
FAINT = 0.5
#: Lines to either side of a window's middle, and the share of the mean sum at which a surge begins.
REACH, SURGE = 2, 0.25
_ANNOUNCED = re.compile(r"(?:\d+\s+)?(?:reader\s+|user\s+)?(?:comments?|responses|replies)(?:\s*\(?\d+\)?)?\s*:?|leave a (?:comment|reply)", re.I)
_REMARKS = {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "comment", "comments", "reply"}


def _marks(attributes: str) -> tuple[list[set[str]], bool]:
    """Words of each name in class, id and role; whether the element is hidden."""
    found, hidden = [], False
    for name, *values, bare in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() in ("class", "id", "role"):
            found += [set(re.split(r"[_-]+", v)) - {""} for v in value.split()]
        hidden |= bool(bare) or (name.lower() == "style" and "display:none" in value.replace(" ", ""))
    return found, hidden


def _outside(tag: str, attributes: str, within_article: bool) -> int:
    """2 if an element's text lies outside the main text, 1 if its marks leave that open, else 0."""
    if tag in ("html", "body"):
        return 0
    marks, hidden = _marks(attributes) if attributes.strip() else ([], False)
    if tag in _DROP or hidden or (tag == "header" and not within_article):
        return 2
    if tag in ("article", "main"):
        return 2 * any(m & _REMARKS for m in marks)
    words = _OUTSIDE if within_article else _OUTSIDE | {"header", "masthead"}
    hit = [m for m in marks if m & words]
    return 2 if any(m <= words | _PLAIN or all(w.isdigit() or w in words | _PLAIN for w in m) for m in hit) else int(bool(hit))


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """Blocks in page order: text, how far outside the main text (2: surely, 1: perhaps), within an article or main
    element, nothing but links."""
    lines: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    plain: list[str] = []  # what of them is no link
    block, linked = "", False
    skip, depth, article, anchor = "", 0, 0, 0
    faint, layers, remarks = "", 0, False
    cut = page.rfind("<")
    if cut > page.rfind(">") and page[cut + 1:cut + 2].isalpha():
        page = page[:cut]  # the page ends within a tag
    at, n = 0, len(page)

    def close() -> None:
        nonlocal linked, remarks
        text = _BLANK.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            only = linked and block not in _PROSE and not any(map(str.isalnum, html.unescape("".join(plain))))
            if not (article or skip) and block in _HEADINGS and _ANNOUNCED.fullmatch(text):
                remarks = True
            lines.append((text, 2 if skip or remarks else int(bool(faint)), article > 0, only))
        parts.clear()
        plain.clear()
        linked = False

    while at < n:
        tag = _TOKEN.search(page, at)
        end = tag.start() if tag else n
        if end > at:
            parts.append(page[at:end])
            if not (anchor and linked):  # a link that a former block left open is none
                plain.append(page[at:end])
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                parts.append(html.escape(tag[0][9:].removesuffix("]]>")))
                plain.append(parts[-1])
            continue
        closing, empty = bool(tag[1]), name in _VOID or tag[0].endswith("/>")
        if name not in _INLINE:
            close()
            block = "" if closing else name
        elif name == "br":
            parts.append(" ")
        if not closing and name in _RAW and not empty:  # raw text: up to the end tag, whatever it holds
            stop = _END[name].search(page, at)
            if not stop and name in ("noscript", "svg", "math", "object"):
                continue  # never closed: its tags are read like any others
            shut = page.find(">", stop.end()) if stop else -1
            at = shut + 1 if shut >= 0 else n
            continue
        if skip:
            if not closing and name in ("article", "main") and skip in ("nav", "header") \
                    and _outside(name, tag[3], False) < 2:
                skip, depth = "", 0  # an unclosed menu or header ends where the article begins
            elif name == skip and not empty:
                depth += -1 if closing else 1
                if depth <= 0:
                    close()
                    skip, depth = "", 0
                continue
            elif closing and name in ("body", "html", "article", "main") and name != skip:
                close()
                skip, depth = "", 0
        if closing:
            if name in ("article", "main"):
                article = max(0, article - 1)
            elif name == "a":
                anchor = max(0, anchor - 1)
        elif not empty and not skip:
            far = _outside(name, tag[3], article > 0)
            if far == 2:
                close()
                skip, depth = name, 1
            elif name in ("article", "main"):
                article += 1
                remarks = False
            elif name == "a":
                anchor, linked = 1, True
            elif far == 1 and not faint and name not in _INLINE:
                faint, layers = name, 0
        if faint and name == faint and not empty and not skip:
            layers += -1 if closing else 1
            if layers <= 0:
                close()
                faint, layers = "", 0
    close()
    return lines


def _dense(weights: list[float], full: list[bool]) -> list[bool]:
    """Which lines stand between a surge and a dive of the windows' sums."""
    n = len(weights)
    running = [0.0, *itertools.accumulate(weights)]
    sums = [running[min(n, i + REACH + 1)] - running[max(0, i - REACH)] for i in range(n)]
    level = [s for s, f in zip(sums, full) if f]
    surge = SURGE * sum(level) / len(level) if level else 0.0
    return [s > 0 and s >= surge for s in sums]


def main_text(page) -> str:
    """Main text of one page; blocks joined by a line feed."""
    if not isinstance(page, str) or not page:
        return ""
    lines = lines_of(page)
    inner = sum(len(text) for text, out, inside, _ in lines if inside and out < 2)
    outer = sum(len(text) for text, out, inside, only in lines if not (inside or out == 2 or only))
    weights, full = [], []
    for text, out, inside, only in lines:
        # in an article a list of links is part of it
        share = 0.0 if out == 2 or (not inside and (only or inner > outer)) else FAINT if out else 1.0
        weights.append(share * len(text))
        full.append(share == 1.0)
    dense = _dense(weights, full)
    return "\n".join(line[0] for line, w, f, d in zip(lines, weights, full, dense) if f or (w and d))


def extract_text(page: Column) -> Column:
    """Column of main texts (never null)."""
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in parts:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return run(page)
