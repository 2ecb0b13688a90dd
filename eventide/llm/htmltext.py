"""Main text of web pages by smoothed text-to-tag ratios.

The page streams through the standard library's event parser. Events become
lines, one per block element: its text (references decoded, white space
turned into one space) and the number of tags met. Elements that never hold the
article (menus, forms, scripts, adverts, comments and so on, by tag or by
the words of class, id and role) give lines of ratio 0. The ratios of text to
tags are smoothed by a Gaussian over neighbouring lines and split into two
clusters (1-D 2-means, capped by the standard deviation); the split is the
threshold.

Regions are then chosen: where the page marks articles (``article``, ``main``), every
one with a line above the threshold, or else the one with most text, with all
its short lines. Elsewhere every container (``div``, ``section``, cell, body) with a
line above the threshold is kept with all its short lines, and so is what is
nested in one that has a long line of its own (a page whose paragraphs stand in
the body itself keeps all that is not skipped).

Rules: null or empty html has empty text; unclosed and stray tags are tolerated;
a page without any line above the threshold gives its largest region; nothing is
cut by length, however long the page; a line at the threshold stays out, equally large regions give the
first; repeated rows get equal texts; a column of the input named like the result is replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import table
from eventide.session import ship_package

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
                  "ol option p pre search section select summary table tbody textarea tfoot thead title tr ul".split())
CONTAINER = frozenset("article main section div td body".split())
SKIP = frozenset("script style noscript template head title nav footer aside form button select textarea option "
                 "iframe object svg canvas audio video map dialog menu search label legend".split())
KEEP = frozenset("html body main".split())  # never skipped for the words of their class
CUES = frozenset("ad ads adv advert advertisement advertising adbox adsense sponsor sponsored promo promotion banner "
                 "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
                 "subscription paywall sidebar sidebars widget widgets related recommended recommendations share sharing "
                 "social comment comments reply replies respond disqus breadcrumb breadcrumbs menu menus nav navbar "
                 "navigation footer footers masthead toolbar pagination pager login signin signup register search "
                 "complementary contentinfo skip hidden copyright".split())
# words that also tell a skipped article from the main one; the other cues may
# stand on a container that was never closed
FIRM = frozenset("comment comments reply replies respond disqus related recommended recommendations sponsored "
                 "sidebar sidebars advert advertisement promo promotion menu navigation footer".split())
ITEM = frozenset("li dt dd tr option".split())
CELL = frozenset(("td", "th"))
_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Lines(HTMLParser):
    """Collects (text, tags, region, container, skipped) per block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.open: list[tuple[str, int, int, int]] = []  # tag, skipped, region, container
        self.parts: list[str] = []
        self.tags = self.serial = self.articles = 0
        self.around: dict[int, int] = {}  # container -> the one it stands in

    def _state(self) -> tuple[int, int, int]:
        return self.open[-1][1:] if self.open else (0, 0, 0)

    def _flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            skipped, region, container = self._state()
            self.lines.append((text, max(1, self.tags), region, container, bool(skipped)))
            self.tags = 0

    def _leaves(self, tag: str, attrs) -> int:
        """0: may hold the article; 1: skipped until a first article; 2: skipped."""
        if tag in SKIP:
            return 2
        if tag in KEEP or not (attrs or tag == "header"):
            return 0
        inside = any(t in ("article", "main") for t, *_ in self.open)
        if tag == "header":
            return 0 if inside else 2
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return 2
            if name == "style" and value and _HIDDEN.search(value):
                return 2
            if name in ("class", "id", "role") and value:
                words = {w.lower() for w in _WORDS.findall(value)}
                if words & FIRM:
                    return 2
                if tag != "article" and (words & CUES or ("header" in words and not inside)):
                    return 1
        return 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self._flush()
            return
        if tag in BLOCK:
            self._flush()
            k = self._closed_by(tag)
            if k is not None:
                del self.open[k:]
        elif tag in CELL:
            self.parts.append(" ")
        skipped, region, container = self._state()
        if tag in ("article", "main"):
            # the first article of a page stands even behind an unclosed advert
            if skipped == 1 and not self.articles:
                skipped = 0
            if not skipped and not self._leaves(tag, attrs):
                self.articles += 1
                if region == 0:
                    self.serial += 1
                    region = self.serial
        skipped = max(skipped, self._leaves(tag, attrs)) if skipped < 2 else 2
        if tag in CONTAINER:
            self.serial += 1
            self.around[self.serial] = container
            container = self.serial
        self.open.append((tag, skipped, region, container))

    def _closed_by(self, tag: str) -> int | None:
        """Place of the open paragraph or item that a block start closes, with
        what hangs open in it."""
        for k in range(len(self.open) - 1, -1, -1):
            t = self.open[k][0]
            if t == "p" or (t == tag and t in ITEM):
                return k
            if t in BLOCK or t in CONTAINER:
                return None
        return None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self._flush()
        elif tag in CELL:
            self.parts.append(" ")
        for k in range(len(self.open) - 1, -1, -1):
            t = self.open[k][0]
            if t == tag:
                del self.open[k:]
                return
            if t in ("article", "main", "body", "td") and tag not in ("body", "html", "article", "main"):
                return  # a stray end tag does not close what stands around it

    def handle_data(self, data):
        # text of skipped elements only needs to be known as such
        if data:
            self.parts.append(data)

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def finish(self) -> list:
        self.close()
        self._flush()
        return self.lines


def smooth(x: np.ndarray, sigma: float = 1.0, radius: int = 2) -> np.ndarray:
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(x)), k)[radius:-radius]
    return np.convolve(x, k)[radius:-radius] / weight


def threshold(x: np.ndarray) -> float:
    """Where two clusters of the smoothed ratios part, at most their spread."""
    lo, hi = float(x.min()), float(x.max())
    for _ in range(50):
        cut = (lo + hi) / 2
        up = x > cut
        if not up.any() or up.all():
            break
        new = float(x[~up].mean()), float(x[up].mean())
        if new == (lo, hi):
            break
        lo, hi = new
    return min((lo + hi) / 2, float(x.std()))


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    if not any(not s for *_, s in lines):
        return ""
    plain = np.array([0.0 if s else len(t) / n for t, n, _, _, s in lines])
    ratio = smooth(plain)
    cut = threshold(ratio)
    size: dict[int, int] = {}
    chosen: set[int] = set()
    whole: set[int] = set()  # containers whose nested ones are kept too
    marked = any(r and not s for _, _, r, _, s in lines)
    for (t, _, region, container, skipped), r, own in zip(lines, ratio, plain):
        if skipped or (marked and not region):
            continue
        key = region if marked else container
        size[key] = size.get(key, 0) + len(t)
        if r > cut:
            chosen.add(key)
            if own > cut:
                whole.add(key)
    if not chosen:
        chosen = whole = {max(size, key=size.get)}
    if not marked:  # a container is numbered after the one it stands in
        for inner, outer in parser.around.items():
            if outer in whole:
                whole.add(inner)
        chosen |= whole
    return "\n".join(t for t, _, g, c, s in lines if not s and (g if marked else c) in chosen)


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with a string column ``name``."""
    ship_package(pages.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h) for h in htmls], dtype=object)

    return pages.withColumn(name, text(F.col(html_col)))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
