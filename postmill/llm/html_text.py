"""Main text of web pages, by text-to-tag ratios over streamed parser events.

The standard library's parser sends events; block elements cut its text into lines. A line's ratio is its
characters over the tags met since the line before it. The ratios of all lines of the page are smoothed in page order with a
Gaussian kernel, and each line is kept or dropped by a threshold, the standard deviation of the smoothed ratios (not above
their mean). Before that, the smoothed ratio counts ``WEIGHT`` fold where the line stands in an article or main element, or in a
container that holds more than half of the text; so a heading or short paragraph of the body stays, and a run of bare
links in it does not. A container is the nearest article or main element, else the nearest section or div.

Elements that are never content are skipped with all they hold: by their tag, their role or a class or id (fixed lists below,
compared with whole names and with what a compound of several parts ends in: ``site-footer`` is a footer, ``comment-list`` a list of comments,
``has-sidebar`` no sidebar), or because they are hidden. Other than scripts, controls and the like, an element is not skipped that holds more than half of
the page's text, article and main counted ``WEIGHT`` fold: one with article or main text in it, or with at
least ``LEAST_SPARED`` characters unless its tag is for navigation and the like. Character references are decoded.

Defined results: a null or empty page, or one without content, gives an empty text; broken and cut-off markup is read as far
as it goes; pages are read whole; repeated rows each come back.
"""

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postmill.llm.common import quoted, slices, with_fields

SIGMA = 2.0
# The least power of two at which no line of an article of the test pages is lost.
WEIGHT = 16.0
LEAST_SPARED = 200

# Fixed lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
# Skipped whatever they hold.
NEVER = frozenset(
    "script style noscript template svg math canvas iframe object embed audio video head title button select textarea input label".split()
)
SKIPPED = NEVER | frozenset("nav header footer aside form fieldset dialog menu".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar alert alertdialog dialog form".split())
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright dialog disclaimer disqus footer gdpr header masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification overlay pagination pager paywall popup promo promotion recommended related "
    "replies reply respond search share sharing sidebar side signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split()
)
# Last parts of a compound that only say how its contents are laid out.
LAYOUT_WORDS = frozenset("area bar block box container inner item items label line link links list outer panel row section slot text unit wrap wrapper".split())
# First parts of a compound that names what its element has or lacks, and those whose header is part of an article.
PREPOSED = frozenset("after before has hide is no non not show with without".split())
OWN_HEADERS = frozenset("article content entry post section".split())
CONTENT = frozenset(("article", "main"))
CONTAINERS = CONTENT | {"section", "div", "body", "td"}
# A start tag that ends an open element of these kinds, as HTML allows the end tag to be left out.
IMPLIED_END = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
# A start tag that ends an open p, unless one of the others stands between.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre section table ul".split()
)
P_SCOPE = frozenset("button caption html object table td template th".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_PARTS = re.compile(r"[-_]+")
_CUT_OFF = re.compile(r"<[!/?a-zA-Z]")
# A class of the page as a whole says nothing of its content.
_CONTENT_ROOTS = frozenset(("body", "html"))


@lru_cache(maxsize=4096)
def _is_boilerplate(name: str) -> bool:
    """Whether a class or id, in lower case, is a listed word or a compound that ends in one."""
    if name in SKIPPED_WORDS:
        return True
    parts = [part for part in _PARTS.split(name) if part]
    while len(parts) > 1 and (parts[-1] in LAYOUT_WORDS or parts[-1].isdigit()):
        parts.pop()
    if not parts or parts[-1] not in SKIPPED_WORDS or not PREPOSED.isdisjoint(parts[:-1]):
        return False
    return parts[-1] not in ("header", "side", "share") or OWN_HEADERS.isdisjoint(parts[:-1])


def _is_skipped(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in SKIPPED:
        return True
    if tag in _CONTENT_ROOTS:
        return False
    for name, value in attrs:
        if name in ("class", "id"):
            if any(map(_is_boilerplate, (value or "").lower().split())):
                return True
        elif name == "role":
            if (value or "").lower() in SKIPPED_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and _HIDDEN.search((value or "").lower()):
            return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: (container, is in article or main, tags before it, text); ``lines_of`` takes out what is skipped."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[int, bool, int, str]] = []
        self.open: list[str] = []
        self.times_open: Counter[str] = Counter()
        self.containers: list[tuple[int, bool, int]] = [(0, False, -1)]  # number, in content, depth
        self.made = 0
        self.skipping: int | None = None  # depth of the element skipped whatever it holds
        self.marked: list[tuple[int, str, int, int]] = []  # open elements to skip: depth, tag, first line, tags before
        self.marks: list[tuple[str, int, int]] = []  # closed ones: tag, first line, end
        self.tags = 0
        self.text: list[str] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text.clear()
        if text:
            number, content, _ = self.containers[-1]
            self.lines.append((number, content, self.tags, text))
            self.tags = 0

    def end_p(self) -> None:
        for depth in range(len(self.open) - 1, -1 if self.skipping is None else self.skipping, -1):
            if self.open[depth] == "p":
                self.close_to(depth)
                return
            if self.open[depth] in P_SCOPE:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS and self.skipping is None:
            self.end_line()
        if tag in ENDS_P and self.times_open["p"] > 0:
            self.end_p()
        self.tags += self.skipping is None
        if tag in VOID:
            return
        if tag in IMPLIED_END and self.open and self.open[-1] in IMPLIED_END[tag]:
            self.close_to(len(self.open) - 1)
        self.open.append(tag)
        self.times_open[tag] += 1
        if self.skipping is not None:
            return
        if tag in NEVER:
            self.end_line()
            self.skipping = len(self.open) - 1
            return
        if _is_skipped(tag, attrs):
            self.end_line()
            self.marked.append((len(self.open) - 1, tag, len(self.lines), self.tags))
        if tag in CONTAINERS:
            inside = self.containers[-1][1]
            # What stands within an article or main belongs to it.
            if not inside:
                self.made += 1
                self.containers.append((self.made, tag in CONTENT, len(self.open) - 1))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # Only void elements end themselves in HTML; of others the slash means nothing.
        self.handle_starttag(tag, attrs)

    def close_to(self, depth: int) -> None:
        """Close all elements from ``depth`` on."""
        self.times_open.subtract(self.open[depth:])
        del self.open[depth:]
        if self.skipping is not None and depth <= self.skipping:
            self.skipping = None
        # Tags within a skipped element are no tags of the line after it.
        while self.marked and self.marked[-1][0] >= depth:
            self.end_line()
            _, tag, first, self.tags = self.marked.pop()
            if first < len(self.lines):
                self.marks.append((tag, first, len(self.lines)))
        while self.containers[-1][2] >= depth:
            self.end_line()
            self.containers.pop()

    def handle_endtag(self, tag: str) -> None:
        if self.skipping is None:
            if tag in BLOCKS:
                self.end_line()
            self.tags += 1
        for depth in range(len(self.open) - 1, -1, -1) if self.times_open[tag] else ():
            if self.open[depth] == tag:
                self.close_to(depth)
                break
            # An inline end tag does not reach beyond the block or the container it stands in.
            if tag not in BLOCKS and tag not in SKIPPED and self.open[depth] in CONTAINERS:
                break

    def handle_data(self, data: str) -> None:
        if self.skipping is None:
            self.text.append(data)


def lines_of(html: str) -> list[tuple[int, bool, int, str]]:
    parser = _Lines()
    parser.feed(html)
    # A tag or comment that the end of the page cuts off is no text.
    if cut := _CUT_OFF.search(parser.rawdata):
        parser.rawdata = parser.rawdata[: cut.start()]
    parser.close()
    parser.end_line()
    parser.close_to(0)
    return _unskipped(parser.lines, parser.marks)


def _unskipped(lines: list[tuple[int, bool, int, str]], marks: list[tuple[str, int, int]]) -> list[tuple[int, bool, int, str]]:
    """Lines outside of the marked elements, and within those that hold most of the page; smaller elements go first."""
    if not marks:
        return lines
    content = np.array([line[1] for line in lines])
    chars = np.array([len(line[3]) for line in lines])
    weights = np.where(content, WEIGHT, 1.0) * chars
    kept, total = np.ones(len(lines), bool), weights.sum()
    for tag, first, end in sorted(marks, key=lambda m: m[2] - m[1]):
        here = kept[first:end]
        own = weights[first:end][here].sum()
        enough = tag not in SKIPPED - {"form"} and chars[first:end][here].sum() >= LEAST_SPARED
        if own <= total / 2 or not (enough or content[first:end][here].any()):
            total -= own
            kept[first:end] = False
    return [line for line, keep in zip(lines, kept, strict=True) if keep]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the borders the kernel keeps its weight."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    lines = lines_of(html or "")
    if not lines:
        return ""
    number = np.array([line[0] for line in lines])
    content = np.array([line[1] for line in lines])
    chars = np.array([len(line[3]) for line in lines])
    values = smoothed(chars / np.maximum([line[2] for line in lines], 1), sigma)
    threshold = min(float(values.std()), float(values.mean()))
    body = np.bincount(number, chars)[number] > chars.sum() / 2
    kept = np.where(content | body, WEIGHT, 1.0) * values >= threshold
    return " ".join(line[3] for line, keep in zip(lines, kept, strict=True) if keep)


def extract(pages: DataFrame, html_column: str = "html", sigma: float = SIGMA) -> DataFrame:
    """``pages`` without the markup, with ``text`` and its length ``n_chars`` in code points."""
    kept = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html_column):
                texts = [main_text(h.as_py(), sigma) for h in part[html_column]]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*kept, "text", "n_chars"],
                )

    return pages.select(*quoted([*kept, html_column])).mapInArrow(run, with_fields(pages, kept, "text string, n_chars long"))
