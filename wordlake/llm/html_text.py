"""Operator 2, HTML extraction: parser events, text-to-tag ratios, smoothing, threshold clustering.

The standard library's parser streams events.  Block-level tags part the page into lines; each
line has a text-to-tag ratio (text outside links, over its tags).  Structure only weighs the
ratios: articles and mains raise them, classes and ids that speak against content lower them, and
menus, footers, asides, forms, scripts, styles and hidden elements have none.  The ratios are
smoothed with a Gaussian along the page and split into two clusters by a threshold; the lines of
the upper cluster are the seeds, and where their mass lies are the content regions: see
``line_chosen``.

Defined results: null or empty html gives an empty text, and so does a page without any text
outside links; unclosed and stray tags are taken as browsers do; pages of any length and depth are
parsed whole; lines whose smoothed ratios tie with the threshold are seeds; repeated rows are
extracted each on its own, null ids and urls are carried; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import pieces

CHUNK_BYTES = 4 << 20
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
REGIONS = frozenset("article main section div body td".split())
DROPPED = frozenset("head script style noscript template nav footer aside form menu dialog button select option textarea label svg math iframe object canvas audio video".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Elements whose class or id speaks for or against their lines; of headings, paragraphs and inline elements it is only an anchor or a style.
NAMED = frozenset("div section header ul ol dl table td figure details center".split())
#: Words of a class or id, and what they leave of the ratio of the lines inside.
UNLIKELY = {
    **dict.fromkeys("ad ads adv advert advertisement adsense sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr newsletter subscribe subscription signup login popup modal overlay comment comments disqus respond replies pagination pager toolbar".split(), 0.1),
    **dict.fromkeys("banner aside foot notice alert share sharing social related recommended reply widget skip search copyright legal hidden".split(), 0.4),
}
#: Words that go with these in a name; any other word beside them makes it the name of something else.
NEUTRAL = frozenset("area bar block body bottom box button buttons center column container content footer form foot group head header holder icon icons inner item items left link links list main menu message module nav outer page panel right row section site text thread top unit wrap wrapper".split())
#: Ids that are no anchors of an article's own sections.
SURE_IDS = frozenset("comments comment-list comments-list disqus_thread respond sidebar navigation newsletter cookie-banner cookie-notice".split())
#: Such parts in front of a name say how the element looks, not what it is.
STYLES = frozenset("has no with is without show not".split())
#: What articles and mains make of a ratio; the share of all mass that makes a zone; lines of a list that may be a menu;
#: the part of the threshold that lines next to content must reach.
RAISED, NEARLY_ALL, LONG_LIST, NEAR = 3.0, 0.85, 4, 0.15
CLOSES_P = BLOCKS - {"body", "html", "head"}
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SAME_STOPS = frozenset("ul ol dl table".split())


def name_factor(names: str) -> float:
    """What the words of a class or id leave of a ratio: 1 if none speaks against content.

    A name counts only if all its parts are such words or neutral ones: a share price is no share button.
    """
    out = 1.0
    for name in names.lower().split():
        parts = [x for x in re.split("[_-]+", name) if x]
        if parts and parts[0] not in STYLES and all(x in UNLIKELY or x in NEUTRAL or x.isdigit() for x in parts):
            out = min([out, *(UNLIKELY.get(x, 1.0) for x in parts)])
    return out


@dataclass
class Line:
    """A line of a page: its text, weighed ratio and weight, share of linked text, region, list, and outermost article or main (0: none of it)."""

    text: str
    ratio: float
    weight: float
    linked: float
    region: int
    group: int
    main: int


@dataclass
class State:
    """What holds inside an open element."""

    tag: str
    dropped: bool = False
    own_line: bool = False  # the innermost block element is dropped
    region: int = 0
    group: int = 0
    main: int = 0
    factor: float = 1.0
    link: bool = False


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [State("")]
        self.lines: list[Line] = []
        self.parent = [0]  # of each region
        self.buffer: list[str] = []
        self.tags = self.linked = self.groups = 0
        self.open: Counter[str] = Counter()

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                now = self.stack[-1]
                plain = max(0, len(text) - self.linked)
                weight = 0.0 if now.dropped else now.factor
                ratio = weight * (RAISED if now.main else 1.0) * plain / (1 + self.tags)
                self.lines.append(Line(text, ratio, weight, 1 - plain / len(text), now.region, now.group, now.main))
            self.buffer = []
        self.tags = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES_P:
                self.close("p", SAME_STOPS | {"div", "td", "li"})
            if tag in SAME_CLOSES:
                for other in SAME_CLOSES[tag]:
                    self.close(other, SAME_STOPS)
        self.tags += 1
        if tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        new = replace(self.stack[-1], tag=tag)
        if tag in REGIONS:
            self.parent.append(new.region)
            new.region = len(self.parent) - 1
            if tag in ("article", "main") and not new.main:
                new.main = new.region
        if tag in SAME_STOPS:
            self.groups += 1
            new.group = self.groups
        new.link = new.link or tag == "a"
        if not new.dropped and tag not in ("body", "html"):
            role = next((v or "" for k, v in attrs if k == "role"), "").lower()
            hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
            new.dropped = tag in DROPPED or hidden or role in DROPPED_ROLES or tag == "header" and not new.main
            if tag in NAMED:
                factor = name_factor(" ".join(v for k, v in attrs if v and (k == "class" or k == "id" and (not new.main or v.lower() in SURE_IDS))))
                new.factor *= factor
        if tag in BLOCKS:
            new.own_line = new.dropped
        self.stack.append(new)
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def close(self, tag: str, stops: frozenset | set) -> None:
        """Close the innermost open ``tag`` unless an element of ``stops`` lies inside it."""
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self.open.subtract(x.tag for x in self.stack[i:])
                if any(x.tag in BLOCKS for x in self.stack[i:]):
                    self.flush()
                del self.stack[i:]
                return
            if self.stack[i].tag in stops:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        self.close(tag, frozenset())

    def handle_data(self, data: str) -> None:
        now = self.stack[-1]
        if now.own_line or not now.dropped:  # text of a dropped inline element is no part of its line
            self.buffer.append(data)
            if now.link:
                self.linked += len(data)

    def page(self, html: str) -> list[Line]:
        self.feed(html)
        super().close()
        self.flush()
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing along the page, weights renewed at its ends."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel)[reach:-reach] / np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]


def threshold(values: np.ndarray) -> float:
    """The value between two clusters: the mean of the means on its two sides."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values <= cut], values[values > cut]
        if not len(high) or not len(low):
            break
        new = (float(low.mean()) + float(high.mean())) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def line_chosen(lines: list[Line], parent: list[int], sigma: float) -> list[bool]:
    """Which lines are content.

    Lines whose smoothed ratio lies in the upper cluster are seeds; what a region's seeds weigh
    together is its mass.  The zone is all articles and mains if these hold nearly all the mass,
    else the innermost region that does.  In the zone a line goes if its weight is lowered and its
    own ratio does not reach the threshold all the same; so does a list of some length that is
    nearly all links, and outside of articles a region without seeds, unless it lies next to what
    stays and its ratio is not far from the threshold.
    """
    values = smoothed(np.array([x.ratio for x in lines]), sigma)
    cut = threshold(values)
    seeds = [v >= cut and v > 0 for v in values.tolist()]
    mass = np.zeros(len(parent))
    np.add.at(mass, [x.region for x, s in zip(lines, seeds, strict=True) if s], values[seeds])
    for r in range(len(parent) - 1, 0, -1):  # regions are numbered from the outside in
        mass[parent[r]] += mass[r]
    if not mass[0]:
        return [False] * len(lines)
    mains = sum(v for x, s, v in zip(lines, seeds, values.tolist(), strict=True) if s and x.main) >= NEARLY_ALL * mass[0]
    root = max(np.flatnonzero(mass >= NEARLY_ALL * mass[0]).tolist())
    inside = np.zeros(len(parent), bool)
    for r in range(len(parent)):
        inside[r] = r == root or r > 0 and inside[parent[r]]
    groups: dict[int, list[float]] = {}
    for x, s in zip(lines, seeds, strict=True):
        sums = groups.setdefault(x.group, [0.0, 0.0, 0.0, 0.0])
        for i, v in enumerate((1, s, x.linked * len(x.text), len(x.text))):
            sums[i] += v
    links = {g for g, (n, s, linked, size) in groups.items() if g and n >= LONG_LIST and not s and linked >= 0.8 * size}

    def fits(x: Line, v: float) -> bool:
        return x.group not in links and (x.weight >= 1 or min(v, x.ratio) >= cut)

    if mains:
        return [x.main > 0 and fits(x, v) for x, v in zip(lines, values.tolist(), strict=True)]
    # regions below the root that hold seeds all the way up, and more than what their neighbours lend them
    own = np.zeros(len(parent))
    np.maximum.at(own, [x.region for x in lines], [x.ratio for x in lines])
    for r in range(len(parent) - 1, 0, -1):
        own[parent[r]] = max(own[parent[r]], own[r])
    fed = np.zeros(len(parent), bool)
    for r in range(len(parent)):
        fed[r] = r == root or inside[r] and fed[parent[r]] and mass[r] > 0 and own[r] >= NEAR * cut
    kept = [bool(fed[x.region]) and fits(x, v) and (x.region != root or s or parent[root] > 0 or x.ratio >= NEAR * cut) for x, v, s in zip(lines, values.tolist(), seeds, strict=True)]
    near = [x.weight >= 1 and x.group not in links and x.linked < 0.5 and x.ratio >= NEAR * cut for x in lines]
    for order in (range(1, len(lines)), range(len(lines) - 2, -1, -1)):  # what lies next to content, on either side
        step = -1 if order.step > 0 else 1
        for i in order:
            kept[i] = kept[i] or kept[i + step] and near[i]
    return kept


def main_text(html: str, sigma: float = 1.0) -> str:
    """The page's content lines, joined by newlines."""
    parser = Lines()
    lines = parser.page(html)
    if not lines:
        return ""
    return "\n".join(x.text for x, c in zip(lines, line_chosen(lines, parser.parent, sigma), strict=True) if c)


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, text."""
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html", CHUNK_BYTES):
            texts = [main_text(h) if h else "" for h in piece.column("html").to_pylist()]
            yield pa.record_batch([piece.column("page_id").cast(pa.int64()), piece.column("url").cast(pa.string()), pa.array(texts, pa.string())], schema=arrow)

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string")
