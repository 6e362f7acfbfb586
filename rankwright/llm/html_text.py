"""Main text of HTML pages: parser events, text-to-tag ratio per line, smoothing, clustering.

``html.parser`` streams events of the page; a *line* is the text between two block
boundaries.  Each line has its text-to-tag ratio (characters of text per tag of the
line); the ratios are smoothed with a Gaussian over neighbouring lines, and lines over
the threshold (mean minus half a standard deviation of the smoothed ratios, the
threshold that keeps short paragraphs between long ones) form clusters.  A cluster
selects its content region: the enclosing ``article``/``main`` element, or, for clusters
outside of any, the smallest block that holds them all (a region of one line grows to the
block around it).  Where a page has ``article`` or ``main``, clusters outside count only if they
hold more text than those inside.  A selected region is taken whole, so that headings and
short blocks inside it, also at its edges, stay; structural furniture (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments, hidden parts) never takes part, wherever it stands.

Blocks are joined in page order by one space; white space inside is one space;
character references are decoded.

Edge cases: null and empty pages give an empty text; broken markup is read as the
parser reports it (an end tag without its start is skipped, an open element ends with
its parent, and where every ``article`` or ``main`` lies in furniture that was left open, they
count all the same); pages of any length are read whole; repeated rows give equal texts;
other columns are left alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q ruby rp rt s
samp small span strike strong sub sup time tt u var wbr del""".split())
FURNITURE = frozenset("""nav footer aside form script style noscript template button select option textarea iframe
svg canvas head title dialog menu object audio video""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar
side-bar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices alert
newsletter subscribe subscription signup login share sharing social related recommended comment comments respond
disqus popup modal overlay toolbar pagination pager widget paywall gdpr skip""".split())
CONTAINERS = frozenset(("article", "main"))
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARAGRAPH_ENDS = frozenset("""p div ul ol li table h1 h2 h3 h4 h5 h6 section article main blockquote pre header footer nav aside
form figure dl dt dd hr address fieldset""".split())


def _is_furniture(tag: str, attrs: list, inside: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not inside):
        return True
    if not attrs or tag in ("html", "body") or tag in CONTAINERS:
        return False
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if not value:
            continue
        if name == "role":
            if value.lower() in ROLES:
                return True
        elif name == "style":
            if _HIDDEN.search(value):
                return True
        elif name in ("class", "id"):
            for word in value.lower().split():
                if word in MARKS:
                    return True
                parts = re.split(r"[-_]+", word)
                if parts[0] not in ("has", "with", "no", "is") and (parts[0] in MARKS or parts[-1] in MARKS):
                    return True
    return False


class Lines(HTMLParser):
    """Collects lines ``(text, tags, container, parent)`` from parser events.

    ``forgive`` lets a container start anew inside furniture that was never closed."""

    def __init__(self, forgive: bool = False):
        super().__init__(convert_charrefs=True)
        self.forgive = forgive
        self.stack: list[tuple[str, bool, int, int]] = []  # tag, skipped, container, block
        self.skip = False
        self.container = 0
        self.block = 0
        self.blocks = 0
        self.around = [0]  # the block around each block
        self.containers = 0
        self.lines: list[tuple[str, int, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0

    def flush(self):
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append((text, self.tags, self.container, self.block))
                self.tags = 0
            self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            self.parts.append(" ")
            self.tags += 1
            return
        if tag in _PARAGRAPH_ENDS and self.stack:
            self._close_paragraph()
        block = tag not in INLINE
        if block:
            self.flush()
        self.tags += 1
        self.stack.append((tag, self.skip, self.container, self.block))
        if self.forgive and tag in CONTAINERS:
            self.skip = False
        if not self.skip and _is_furniture(tag, attrs, self.container > 0):
            self.skip = True
        if block and tag != "p":
            self.blocks += 1
            self.around.append(self.block)
            self.block = self.blocks
        if tag in CONTAINERS and not self.skip and not self.container:
            self.containers += 1
            self.container = self.containers

    def _close_paragraph(self):
        """A block start ends an open ``p`` (with the inline elements left open in it)."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag == "p":
                self.flush()
                self._unwind(i)
                return
            if tag not in INLINE:
                return

    def _unwind(self, i: int):
        _, self.skip, self.container, self.block = self.stack[i]
        del self.stack[i:]

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in INLINE:
            self.parts.append(" " if tag in VOID else "")
            self.tags += 1
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._unwind(i)
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)

    def end(self) -> list[tuple[str, int, int, int]]:
        self.close()
        self.flush()
        return self.lines


def smoothed(ratios: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing; the kernel is renormalised at the ends."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        lo, hi = max(0, i - reach), min(len(ratios), i + reach + 1)
        weights = kernel[lo - i + reach:hi - i + reach]
        out.append(sum(w * r for w, r in zip(weights, ratios[lo:hi])) / sum(weights))
    return out


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """Main text of one page."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.end()
    if not parser.containers and ("<article" in html or "<main" in html):
        parser = Lines(forgive=True)
        parser.feed(html)
        lines = parser.end()
    if not lines:
        return ""
    scores = smoothed([len(t) / max(1, tags) for t, tags, _, _ in lines], sigma)
    mean = sum(scores) / len(scores)
    spread = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    seeds = [i for i, s in enumerate(scores) if s >= mean - 0.5 * spread]
    kept = {lines[i][2] for i in seeds} - {0}
    outside = [i for i in seeds if not lines[i][2]]
    if any(c for _, _, c, _ in lines):
        if 2 * sum(len(lines[i][0]) for i in outside) <= sum(len(lines[i][0]) for i in seeds):
            outside = []
        kept = kept or {max((s, c) for s, (_, _, c, _) in zip(scores, lines) if c)[1]}
    held = region([lines[i][3] for i in outside], [line[3] for line in lines], parser.around)
    return " ".join(t for t, _, c, b in lines if c in kept or not c and b in held)


def region(seeds: list[int], blocks: list[int], around: list[int]) -> range:
    """Numbers of the smallest block with all ``seeds`` and of the blocks inside it.

    ``blocks`` are the blocks of all lines; blocks are numbered in page order, so those
    inside a block follow it."""
    if not seeds:
        return range(0)
    last = list(range(len(around)))
    for b in range(len(around) - 1, 0, -1):
        last[around[b]] = max(last[around[b]], last[b])
    top = min(seeds)
    blocks = sorted(blocks)
    while top and (last[top] < max(seeds) or bisect_right(blocks, last[top]) - bisect_left(blocks, top) < 2):
        top = around[top]
    return range(top, last[top] + 1)


def extract(html: Column | str) -> Column:
    """Column of the main text of an HTML column."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return texts(html)
