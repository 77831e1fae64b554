"""HTML extraction by tag-path ratios.

A page becomes a sequence of blocks, each with its root-to-leaf path of block-level tags. Per path the text length and the
punctuation of its blocks are aggregated; the two ratios (text and punctuation per block of the path) are smoothed along the page
with a Gaussian, discounted by the share of link text and fused into one weight per path. Paths whose weight reaches a share of
the heaviest path's are content. What the markup itself says comes before: menus, asides and the like are left out, paths through
forms and through elements whose class, id or role speaks of adverts, notices, comments and the like weigh a tenth, and where a
page marks its article, paths through it are content and others weigh nothing. An article inside such a form or element is not
touched by it, nor is a page of which most of the text lies in one.

Each page is worked on alone, inside Arrow batches of bounded rows; nothing is shuffled.

Defined cases: null or empty html, or a page without text, gives an empty text; broken markup never fails (end tags without start
are skipped, open elements end with the page); a page of any length or nesting is taken whole, in time that grows with its length;
equal rows are separate pages; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Elements that never hold main text.
SKIPPED = frozenset(
    "head title script style noscript template nav menu header footer aside button select option textarea input label "
    "fieldset dialog iframe object embed svg math canvas audio video map".split())
#: Elements without content or end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line of text; they don't part blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr br img".split())
#: Words in class, id or role that mark what is no main text.
ODD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended share "
    "sharing social comment comments reply replies respond discussion disqus footer header masthead toolbar pagination pager "
    "subscribe newsletter signup login search complementary contentinfo".split())
#: Start tags that end an open element of the given kinds.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr",), "tbody": ("thead", "tr"), "tfoot": ("tbody", "tr"),
}
ARTICLE = frozenset(("article", "main"))
#: Ends the step of an element that its class, id or role discounts; no class name holds a space.
ODD = " "
#: What is left of the weight of a path through such an element,
DISCOUNT = 0.1
#: unless it holds this share of the page's (or its article's) text: then it is a wrapper of the page.
WRAPPER = 0.75


class Open(NamedTuple):
    """An open element: its tag, whether it or one above is skipped, its path, whether it lies in an odd inline element or in a link."""

    tag: str
    skipped: bool
    path: int
    odd: bool
    link: bool


TOP = Open("", False, 0, False, False)


class Blocks(HTMLParser):
    """The page's blocks in order: [path, text, characters of link text]. A path is a number in ``paths``: (path above, step); 0 is the page."""

    def __init__(self, odd_inline: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.odd_inline = odd_inline  # whether odd inline elements keep their text
        self.open: list[Open] = []
        self.places: dict[str, list[int]] = {}  # of each tag, where it is open
        self.paths: dict[tuple[int, str], int] = {(-1, ""): 0}
        self.found: list[list] = []
        self.text: list[str] = []
        self.links = 0

    def _top(self) -> Open:
        return self.open[-1] if self.open else TOP

    def _push(self, element: Open) -> None:
        self.places.setdefault(element.tag, []).append(len(self.open))
        self.open.append(element)

    def _cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append([self._top().path, text, self.links])
        self.text, self.links = [], 0

    def _pop(self, n: int) -> None:
        if any(x.tag not in INLINE for x in self.open[n:]):
            self._cut()
        for x in self.open[n:]:
            self.places[x.tag].pop()
        del self.open[n:]

    def _last(self, kinds: tuple, stop: tuple) -> int | None:
        """Where the last open element of the kinds is, unless one of ``stop`` is open in it."""
        n, wall = (max((self.places[k][-1] for k in tags if self.places.get(k)), default=-1) for tags in (kinds, stop))
        return n if n >= 0 and n >= wall else None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE and (n := self._last(("p",), ("table", "td", "th", "button", "object"))) is not None:
            self._pop(n)
        if tag in ENDS and (n := self._last(ENDS[tag], ("ul", "ol", "dl", "table", "select"))) is not None:
            self._pop(n)
        if tag in VOID:
            if tag not in INLINE:
                self._cut()
            elif tag == "br":
                self.text.append(" ")
            return
        has = {k: v or "" for k, v in attrs}
        said = f"{has.get('class', '')} {has.get('id', '')} {has.get('role', '')}".lower()
        odd = tag == "form" or tag not in ("html", "body") and tag not in ARTICLE and not ODD_WORDS.isdisjoint(re.split(r"[^a-z]+", said))
        hidden = "hidden" in has or has.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", has.get("style", ""))
        above = self._top()
        skipped = tag in SKIPPED or bool(hidden) or above.skipped
        if tag in INLINE:
            self._push(Open(tag, skipped, above.path, above.odd or odd and not self.odd_inline, above.link or tag == "a"))
            return
        self._cut()
        step = ".".join([tag, *sorted(has.get("class", "").split())])
        if odd or above.odd and tag not in ARTICLE:
            step += ODD
        self._push(Open(tag, skipped, self.paths.setdefault((above.path, step), len(self.paths)), False, above.link))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if (n := self._last((tag,), () if tag not in INLINE else ("p", "div", "td", "li", "article", "section"))) is not None:
            self._pop(n)

    def handle_data(self, data: str) -> None:
        above = self._top()
        if not (above.skipped or above.odd):
            self.text.append(data)
            if above.link:
                self.links += len(data.strip())


def blocks_of(html: str | None) -> tuple[list[list], list[tuple[int, str]]]:
    """The blocks and the paths; text of odd inline elements counts only where there is no other."""
    for odd_inline in (False, True):
        page = Blocks(odd_inline)
        page.feed(html or "")
        page.close()
        page._pop(0)
        page._cut()
        if page.found:
            break
    return page.found, list(page.paths)


def path_marks(paths: list[tuple[int, str]], text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each path, whether it leads through an article, and whether through an odd element below its last article.

    ``text`` has the characters right at each path. An odd element that holds most of the text is a wrapper and does not count. A path
    comes after the one above it, so one walk up and one down do.
    """
    article = np.array([step.split(".")[0] in ARTICLE for _, step in paths])
    marked = np.zeros(len(paths), bool)
    for k, (above, _) in enumerate(paths):
        marked[k] = article[k] or above >= 0 and marked[above]
    whole = text[marked].sum() or text.sum()
    held = text.astype(float)
    for k in range(len(paths) - 1, 0, -1):
        if not article[k]:
            held[paths[k][0]] += held[k]
    odd = np.zeros(len(paths), bool)
    for k, (above, step) in enumerate(paths):
        if above >= 0 and not article[k]:
            odd[k] = odd[above] or step.endswith(ODD) and held[k] < WRAPPER * whole
    return marked, odd


def path_weights(blocks: list[list], paths: list[tuple[int, str]], share: float, sigma: float = 1.0) -> dict[int, float]:
    """The fused weight of each path that has blocks."""
    kinds = {p: k for k, p in enumerate(dict.fromkeys(b[0] for b in blocks))}
    of = np.array([kinds[b[0]] for b in blocks])
    n = np.bincount(of)
    text = np.bincount(of, [len(b[1]) for b in blocks])
    marks = np.bincount(of, [sum(map(b[1].count, ".,;:!?")) for b in blocks])
    linked = np.clip(np.bincount(of, [b[2] for b in blocks]) / text, 0, 1)
    radius = int(np.ceil(3 * sigma)) if len(blocks) > 2 else 0
    bell = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)

    def smooth(ratio: np.ndarray) -> np.ndarray:
        """Of each path, the mean over its blocks of the ratio smoothed along the page."""
        along = np.pad(ratio[of], radius, mode="edge")
        return np.bincount(of, np.convolve(along, bell / bell.sum(), "valid")) / n

    fused = np.sqrt(smooth(text / n) * (1 + smooth(marks / n))) * (1 - linked)
    used = np.array(list(kinds))
    marked, odd = (x[used] for x in path_marks(paths, np.bincount(used, text, len(paths))))
    fused = np.where(odd, DISCOUNT * fused, fused)
    if marked.any():
        # The page says where its article is: paths through it are content, its lists of links too.
        fused = np.where(marked, np.where(odd, fused, np.maximum(fused, share * max(fused.max(), 1e-9))), 0)
    return {p: float(fused[k]) for p, k in kinds.items()}


def main_text(html: str | None, share: float = 0.3) -> str:
    """The main text: blocks of the paths that weigh at least ``share`` of the heaviest, in page order."""
    blocks, paths = blocks_of(html)
    if not blocks:
        return ""
    weight = path_weights(blocks, paths, share)
    least = share * max(weight.values())
    return "\n\n".join(b[1] for b in blocks if weight[b[0]] >= least)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string())], schema=schema)

    named = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return named.mapInArrow(run, "page_id long, url string, text string")


def op2_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
