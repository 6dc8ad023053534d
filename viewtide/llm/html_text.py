"""Main text of web pages by line-block distribution.

A page is cut into lines at block-level tags. Every line weighs the characters
of its text, where text of links and of boilerplate elements (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments) weighs nothing.
The weights are summed over a sliding window of lines; a *surge* opens a region
where a window gets enough text, a *dive* closes it where a window has none.
The text between surge and dive is the main text.

Cases: null or empty html, or a page without text, gives the empty string. Long
pages are read whole. Equal rows give equal rows. A page with an ``article`` or
``main`` element gives weight only to text inside it, and any text is a surge.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The window and surge size published with the method, HTML
# element classes, and words that name boilerplate in class and id attributes.
WINDOW = 3
SURGE = 86
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Raw text runs to its closing tag, or to the end of the page. Controls and what stands
# in for media are elements without text of the page, which an enclosing tag ends.
RAW = frozenset("script style title textarea iframe noframes noembed xmp".split())
CONTROLS = frozenset("button select".split())
STANDINS = frozenset("noscript template svg object canvas audio video".split())
FOREIGN = frozenset("svg math".split())
DROPPED = frozenset("nav footer aside form menu dialog search".split())
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside rail widget widgets footer "
    "masthead topbar toolbar cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social comment comments commentlist reply replies "
    "respond disqus related recommended recommendations pagination pager copyright skip".split())
WEAK_BOILERPLATE = frozenset(
    "header head side form search alert alerts notice notices notification legal foot".split())
CONTENT = frozenset("article content entry post story main body text".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _names(value: str) -> set[str]:
    return {part.lower() for part in _NAME_PART.findall(value)}


def is_boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds something other than the article."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    found = {name.lower(): next(filter(None, values), "")
             for name, *values in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    names = _names(found.get("class", "")) | _names(found.get("id", ""))
    if tag in ("article", "main", "body", "html"):
        return tag == "article" and bool(names & {"comment", "comments", "reply", "ad", "advert"})
    return bool(names & BOILERPLATE or names & WEAK_BOILERPLATE and not names & CONTENT)


def page_lines(page: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """Lines ``(text, weight, in_article)`` of a page; whether it has an article.

    Text of boilerplate elements is left out of its line, so a line inside one
    is empty but keeps its place in the distribution. Elsewhere a run of empty
    lines is one line.
    """
    lines: list[tuple[str, int, bool]] = []
    open_tags: list[tuple[str, bool]] = []  # element, whether it is boilerplate
    n_open: Counter[str] = Counter()
    text: list[str] = []
    linked = 0
    dropped = links = articles = 0
    has_article = passed = blank = False

    def end_line() -> None:
        nonlocal linked, passed, blank
        joined = " ".join(entities.unescape("".join(text)).split())
        # Between two tags without text is one gap, however the tags are nested.
        empty = not (joined or passed or dropped)
        if not (empty and blank):
            lines.append((joined, max(0, len(joined) - linked), articles > 0))
        blank = empty
        text.clear()
        linked = 0
        passed = False

    def close(depth: int) -> None:
        nonlocal dropped, links, articles
        for tag, boilerplate in open_tags[depth:]:
            n_open[tag] -= 1
            dropped -= boilerplate
            links -= tag == "a"
            articles -= tag in ("article", "main")
        del open_tags[depth:]

    @cache
    def last_close(tag: str) -> int:
        return max((m.start() for m in re.finditer(rf"</{tag}\s*>", page, re.I)), default=-1)

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        piece = page[at:found.start() if found else len(page)]
        if piece and not dropped:
            text.append(piece)
            if links:
                linked += len(piece)
        elif dropped and piece.strip():
            passed = True
        if not found:
            break
        at = found.end()
        slash, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            end_line()
        elif tag == "br" and not dropped:
            text.append(" ")
        # Only foreign elements close themselves; elsewhere the slash means nothing, but for
        # an anchor without a target, which holds no text.
        closed = attributes.endswith("/") and (
            tag in FOREIGN or any(n_open[name] for name in FOREIGN)
            or tag == "a" and "href" not in attributes.lower())
        if slash and not n_open[tag]:
            continue
        if slash:
            depth = next((i for i in range(len(open_tags) - 1, -1, -1)
                          if open_tags[i][0] == tag), None)
            if depth is not None:
                close(depth)
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif not attributes.endswith("/"):
                at = len(page)
        elif tag not in VOID and not closed:
            if tag in CONTROLS or tag in STANDINS:
                # One that is never closed ends with its parent, or else is no element.
                boilerplate = last_close(tag) >= at or tag in CONTROLS and any(
                    name not in ("html", "body") for name, _ in open_tags)
            else:
                boilerplate = is_boilerplate(tag, attributes, articles > 0)
            if tag in ("article", "main") and not boilerplate:
                # An article ends boilerplate that was never closed, comments aside.
                if dropped and not any(name in DROPPED for name, _ in open_tags):
                    first = next(i for i, (_, bad) in enumerate(open_tags) if bad)
                    close(first)
                has_article = has_article or not dropped
            if tag == "p":
                depth = next((i for i in range(len(open_tags) - 1, -1, -1)
                              if open_tags[i][0] in BLOCKS), None)
                if depth is not None and open_tags[depth][0] == "p":
                    close(depth)
            open_tags.append((tag, boilerplate))
            n_open[tag] += 1
            dropped += boilerplate
            links += tag == "a"
            articles += tag in ("article", "main")
    end_line()
    return lines, has_article


def main_lines(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[bool]:
    """Which lines lie between a surge and the next dive.

    A window starts at its line. A region surges at the first line with weight
    whose window reaches ``surge``; it dives before the first window of no
    weight. Without any surge the heaviest window decides.
    """
    total = [0, *accumulate(weights)]
    sums = [total[min(i + window, len(weights))] - total[i] for i in range(len(weights))]
    if not any(sums):
        return [False] * len(weights)
    surge = min(surge, max(sums))
    kept, inside = [], False
    for weight, block in zip(weights, sums, strict=True):
        inside = block > 0 and (inside or (weight > 0 and block >= surge))
        kept.append(inside)
    # What leads up to a surge without a gap belongs to it: a title, a short line.
    for i in range(len(kept) - 2, -1, -1):
        kept[i] = kept[i] or (kept[i + 1] and weights[i] > 0)
    return kept


def extract(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Main text of one page, one line per block."""
    if not page:
        return ""
    lines, has_article = page_lines(page)
    weights = [weight if in_article or not has_article else 0
               for _, weight, in_article in lines]
    if has_article:
        # Links count inside the article: a linked heading is still its text.
        weights = [len(text) if in_article else 0 for text, _, in_article in lines]
    kept = main_lines(weights, window, 1 if has_article else surge)
    return "\n".join(text for (text, _, in_article), keep in zip(lines, kept, strict=True)
                     if keep and text and (in_article or not has_article))


def main_text(html: Column, window: int = WINDOW, surge: int = SURGE) -> Column:
    """Main text of an html column; never null."""
    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: extract(page, window, surge))
    return extracted(F.coalesce(html, F.lit("")))


def extract_pages(pages: DataFrame, html: str = "html", output: str = "text",
                  window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """The table with its main text in ``output`` (a column of that name is replaced)."""
    return pages.withColumn(output, main_text(F.col(html), window, surge))
