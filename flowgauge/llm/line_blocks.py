"""Main text of a page by the distribution of text over its lines.

Markup is stripped into lines, one per block element. Text in menus, footers, forms, scripts and the
like is blanked. A line in an element that the page marks as its article counts as a surge at least, and the other
lines are blanked, unless they hold the larger surge and more text than any such element. The lengths of the lines are summed over a sliding window; where the sums surge,
text begins, and where they dive to nothing, it ends. Lines between such points are the article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML element names and the words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math semantics annotation mrow mi mn mo ms mtext mspace mstyle msup msub msubsup mfrac msqrt mroot mover munder "
    "munderover mfenced menclose mpadded mphantom mtable mtr mtd".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg object canvas".split())
FURNITURE = frozenset("nav footer aside form menu dialog button select option head".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|widget|ads?|advert\w*|"
    r"sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|social|related|"
    r"comments?|comment-?list|respond|disqus|replies|login|signup|search)(?:$|[\s_-])",
    re.IGNORECASE,
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

READERS = re.compile(r"(?:^|[\s_-])(?:comments?|comment-?list|respond|disqus|replies)(?:$|[\s_-])", re.IGNORECASE)

# A quote counts only where a value begins; elsewhere it is a letter like any other, and the tag ends at the next >.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:{VALUE}|(?=>)))*+)>")
ATTRIBUTE = re.compile(rf"([a-zA-Z_:][-\w:.]*+)\s*+(?:=\s*+({VALUE}))?")
TAG_BEGINS = re.compile(r"</?[a-zA-Z]")
# What is no text and no tag, and how it ends.
ASIDE = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">"))
SPACE = re.compile(r"\s+")

WINDOW = 3  # lines in a sliding window
SURGE = 86  # characters in a window at which text begins


def _is_furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in FURNITURE:
        return True
    if name == "header":
        return not in_article
    if not attributes:
        return False
    values = {key.lower(): value.strip("\"'") for key, value in ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or values.get("role", "").lower() in ROLES:
        return True
    if name in ("body", "html", "article", "main") or name in HEADINGS:
        return False
    # in an article a section's id is an anchor for a heading's words
    by_id = READERS if in_article and name == "section" else MARKED
    return bool(MARKED.search(values.get("class", "")) or by_id.search(values.get("id", "")))


def _is_article(name: str, attributes: str) -> bool:
    return name in ("article", "main") or "articleBody" in attributes or "role=\"main\"" in attributes


def page_lines(page: str) -> tuple[list[str], list[int]]:
    """Lines of text in page order, blank where furniture stood, and the number of the outermost marked article of each, or 0."""
    lines: list[str] = []
    marks: list[int] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, furniture, article
    hidden = articles = number = 0

    def end_line(blank: bool = False) -> None:
        line = SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if line or blank:
            lines.append(line)
            marks.append(number if articles else 0)

    def close(down_to: int) -> None:
        nonlocal hidden, articles
        while len(stack) > down_to:
            closing, was_hidden, was_article = stack.pop()
            held[closing] -= 1
            hidden -= was_hidden
            articles -= was_article
            if was_hidden and not hidden:
                for _ in range(WINDOW):
                    end_line(blank=True)

    held: Counter[str] = Counter()  # names on the stack
    at = text_from = 0
    end = len(page)
    while at < end:
        start = page.find("<", at)
        aside = next((own for own in ASIDE if start >= 0 and page.startswith(own[0], start)), None)
        if start >= 0 and not aside and not TAG_BEGINS.match(page, start):
            at = start + 1  # a sign like any other
            continue
        if not hidden:
            text.append(page[text_from : start if start >= 0 else end])
        text_from = end
        if start < 0:
            break
        if aside:
            closed = page.find(aside[1], start + len(aside[0]))
            if closed < 0:
                break
            at = text_from = closed + len(aside[1])
            continue
        tag = TAG.match(page, start)
        if tag is None:  # never closed: it takes the rest of the page with it
            break
        at = text_from = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if name not in INLINE:
                if not hidden:
                    end_line()
                if held[name]:
                    close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name in INLINE:
            continue
        if not hidden:
            end_line()
        if name == "p" or name in HEADINGS:  # these end an open paragraph
            if stack and stack[-1][0] == "p":
                close(len(stack) - 1)
        if name in VOID or tag[3].endswith("/"):
            continue
        furniture = _is_furniture(name, tag[3], articles > 0)
        if furniture and not hidden:
            for _ in range(WINDOW):
                end_line(blank=True)
        article = not hidden and not furniture and _is_article(name, tag[3])
        stack.append((name, furniture, article))
        held[name] += 1
        hidden += furniture
        number += article and not articles
        articles += article
        if name in RAW:  # nothing but its own end tag counts in it
            own_end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            at = text_from = own_end.start() if own_end else end
    if not hidden:
        text.append(page[text_from:])
        end_line()
    return lines, marks


def text_spans(lengths: np.ndarray, surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Half-open ranges of lines between a surge of the window sums and the dive after it.

    A surge is a line whose window, forwards, holds ``surge`` characters or more; a dive is a line from which
    on the window holds none. A range begins no earlier than its first text.
    """
    if not len(lengths):
        return []
    running = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.minimum(np.arange(len(lengths)) + window, len(lengths))
    sums = running[ends] - running[:-1]
    spans, start = [], None
    for line, total in enumerate(sums.tolist()):
        if start is None:
            if total >= surge and lengths[line]:
                start = line
        elif total == 0:
            spans.append((start, line))
            start = None
    if start is not None:
        spans.append((start, len(lengths)))
    return spans


def _stands_outside(lengths: np.ndarray, elements: np.ndarray) -> bool:
    """Whether unmarked lines hold the larger surge and more text than each of the marked elements, as beside teasers."""
    outside, inside = np.where(elements > 0, 0, lengths), np.where(elements > 0, lengths, 0)
    surges = [int(np.convolve(own, np.ones(WINDOW, np.int64)).max()) for own in (outside, inside)]
    return surges[0] > max(surges[1], SURGE - 1) and outside.sum() > np.bincount(elements, inside).max()


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by a space; empty if there is none."""
    lines, marks = page_lines(page or "")
    lengths, elements = np.fromiter(map(len, lines), np.int64, len(lines)), np.array(marks, np.int64)
    marked = elements > 0
    if marked.any() and not _stands_outside(lengths, elements):
        # the page says where its text is: short blocks count too
        weights = np.where(marked & (lengths > 0), np.maximum(lengths, SURGE), 0)
    else:
        weights = lengths
    spans = text_spans(weights, SURGE)
    if spans:  # what follows furniture inside or behind the text may be short
        first = spans[0][0]
        spans = [(first + start, first + end) for start, end in text_spans(weights[first:], 1)]
    kept = (lines[at] for start, end in spans for at in range(start, end) if weights[at])
    return " ".join(kept)


@F.pandas_udf(T.StringType())
def _main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None)


def extracted(page: Column | str) -> Column:
    return _main_text(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) per page.

    A null or empty page has an empty text. Repeated pages are extracted each; further columns are left out.
    """
    texts = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
