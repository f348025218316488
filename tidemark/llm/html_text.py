"""Main text of web pages by text-to-tag ratio."""

from __future__ import annotations

import bisect
import math
import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.annotate import annotate

FIELDS = "text string, n_chars long"

#: Lines on either side that smooth a line's ratio, and the width of the bell.
RADIUS, SIGMA = 2, 1.0

# Elements whose text is never part of an article.
_SILENT = frozenset(
    "head title script style noscript template svg canvas iframe object select option "
    "button textarea input dialog datalist".split()
)
# Elements of a head; the first other one ends it, closed or not.
_HEAD = frozenset("head html title meta link base style script noscript template".split())
# Elements that end a link left open.
_CLOSES_LINKS = frozenset("p li tr td".split())
# Elements that hold no blocks; a block ends them.
_INLINE_SILENT = frozenset("select option datalist".split())
_IN_LISTS = frozenset("option hr legend".split())
_BOILERPLATE = frozenset("nav footer aside form menu".split())
_MAIN = frozenset("article main".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements that end a line; those of _BOXES also hold others together.
_BOXES = frozenset(
    "html body article main section div nav header footer aside form table ul ol dl "
    "blockquote figure details fieldset menu center td".split()
)
_LINES = _BOXES | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr th pre hr br address figcaption caption summary "
    "legend option thead tbody tfoot address hgroup".split()
)
# Boxes judged as a whole; rows, cells and parts of a list go with what they are in.
_LAYOUT = frozenset("div section center header ul ol dl table".split())
_WHOLE = frozenset("table ul ol dl blockquote figure details".split())
# Names in class, id and role that mark what surrounds an article. A longer name is one
# if its other words say only which or where: "sticky-banner" is one, "has-sidebar" and
# "market-share" are none.
_AROUND = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored "
    "promo promoted promotion cookie cookies consent gdpr notice notices alert newsletter "
    "subscribe subscription signup social share sharing sidebar rail menu menubar nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead related recommended recommendations "
    "widget popup modal overlay pagination pager login search searchbox toolbar copyright "
    "legal disclaimer skip contentinfo complementary dialog hidden".split()
)
_PLACES = frozenset(
    "site page global bar box block wrapper wrap container list links link section area top "
    "bottom left right primary secondary inner outer item items buttons button form slot unit "
    "message thread posts post articles article stories story reader readers user users sticky "
    "fixed floating mobile desktop blog news zone panel strip row column col widget".split()
)
_COMMENTS = frozenset(
    "comment comments commentlist disqus discussion replies reply respond responses".split()
)
_HEADER = frozenset("header topbar".split())
_CONTROLS = frozenset("button input select textarea".split())
_PARAGRAPHS = frozenset(
    "p h1 h2 h3 h4 h5 h6 pre blockquote figcaption dd dt address hgroup".split()
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RIGHTS = re.compile(r"(©|\(c\)|copyright\b|all rights reserved)", re.IGNORECASE)


@dataclass
class Box:
    """An element that holds lines: how far to trust it, and its content's size.

    ``named`` boxes are boilerplate by their class, id or role alone, ``sure``
    ones by more; ``dropped`` and ``main`` follow from the boxes around. Boxes are
    numbered as they open: those inside are ``index`` + 1 to ``end``.
    """

    tag: str
    parent: Box | None
    sure: bool = False
    named: bool = False
    comments: bool = False
    header: bool = False
    dropped: bool = False
    main: bool = False
    controls: bool = False
    mass: int = 0
    index: int = 0
    end: int = 0


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    box: Box
    block: str = ""

    @property
    def links(self) -> bool:
        """Whether most of the line is text of links."""
        return 2 * self.linked > len(self.text)


def _names(attrs: list[tuple[str, str | None]]) -> list[set[str]]:
    """The words of every name in class, id and role."""
    return [
        {w.lower() for w in _WORD.findall(part)}
        for name, value in attrs
        if name in ("class", "id", "role") and value
        for part in value.split()
    ]


def _marked(names: list[set[str]], words: frozenset[str]) -> bool:
    return any(n & words and n <= words | _PLACES for n in names)


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(
        name == "hidden"
        or (name == "aria-hidden" and value == "true")
        or (name == "style" and "display:none" in (value or "").replace(" ", "").lower())
        for name, value in attrs
    )


class LineParser(HTMLParser):
    """Turns parser events into lines with the number of tags in and before them.

    Elements that hold others together are layout and do not count.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        root = Box("", None)
        self.box, self.boxes = root, [root]
        self.open: dict[str, int] = {}
        self.block = ""
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.tags, self.anchors = 0, False
        self.linked: list[str] = []
        self.silent: list[str] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        linked = len(" ".join("".join(self.linked).split()))
        self.text.clear()
        self.linked.clear()
        if text:
            self.lines.append(Line(text, self.tags, linked, self.box, self.block))
            self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += tag not in _BOXES
        if tag in _CONTROLS:
            self.box.controls = True
        if self.silent:
            first, last = self.silent[0], self.silent[-1]
            in_head = first in ("head", "title") and last in ("head", "title")
            in_list = last in _INLINE_SILENT and tag in _LINES and tag not in _IN_LISTS
            if tag == "body" or (in_head and tag not in _HEAD) or in_list:  # never closed
                self.silent.clear()
            else:
                if tag in _SILENT and tag not in _VOID:
                    self.silent.append(tag)
                return
        if tag in _SILENT:
            if tag not in _VOID:
                self.silent.append(tag)
            return
        if tag == "a" or tag in _CLOSES_LINKS:
            self.anchors = tag == "a" and any(name == "href" for name, _ in attrs)
        if tag not in _LINES:
            return
        self.end_line()
        if tag in _BOXES:
            self._open(tag, attrs)
        elif tag not in ("br", "hr"):
            self.block = tag

    def _open(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        page = tag in ("html", "body")
        names = [] if page else _names(attrs)
        self.box = Box(
            tag,
            self.box,
            sure=tag in _BOILERPLATE or (not page and _hidden(attrs)),
            named=_marked(names, _AROUND),
            comments=self.box.comments or _marked(names, _COMMENTS),
            header=tag == "header" or _marked(names, _HEADER),
            index=len(self.boxes),
        )
        self.boxes.append(self.box)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.block = ""

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if not self.silent and tag in _LINES:
            self.end_line()

    def handle_endtag(self, tag: str) -> None:
        self.tags += tag not in _BOXES
        if self.silent:
            if tag in self.silent:  # and with it what was not closed inside
                while self.silent.pop() != tag:
                    pass
            return
        if tag == "a" or tag in _BOXES:
            self.anchors = False
        if tag not in _LINES:
            return
        self.end_line()
        if tag not in ("br", "hr"):
            self.block = ""
        # Each box is left once, so that ends of what isn't open cost nothing.
        if self.open.get(tag):
            while True:
                left, self.box = self.box, self.box.parent
                self.open[left.tag] -= 1
                if left.tag == tag:
                    break

    def handle_data(self, data: str) -> None:
        if self.silent == ["head"] and data.strip():
            self.silent.clear()
        if not self.silent:
            self.text.append(data)
            if self.anchors:
                self.linked.append(data)

    def run(self, html: str) -> list[Line]:
        while True:
            try:
                self.feed(html)
                self.close()
                break
            except AssertionError:  # a marked section the parser doesn't know
                html = self.rawdata[1:]
                self.rawdata = ""
        self.end_line()
        return self.lines


def smoothed(ratios: list[float]) -> list[float]:
    """Each ratio as the mean of its neighbours under a Gaussian bell."""
    bell = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(ratios)):
        lo, hi = max(0, i - RADIUS), min(len(ratios), i + RADIUS + 1)
        near = bell[lo - i + RADIUS : hi - i + RADIUS]
        out.append(sum(w * r for w, r in zip(near, ratios[lo:hi], strict=True)) / sum(near))
    return out


def threshold(values: list[float]) -> float:
    """The middle between the centres of two clusters of values."""
    low, high = min(values), max(values)
    for _ in range(50):
        middle = (low + high) / 2
        below = [v for v in values if v < middle]
        above = [v for v in values if v >= middle]
        if not below:
            return low
        centres = sum(below) / len(below), sum(above) / len(above)
        if centres == (low, high):
            break
        low, high = centres
    return (low + high) / 2


def _weigh(boxes: list[Box], lines: list[tuple[Line, int]]) -> None:
    """Give every box the weight of the lines in it; boxes come after the ones around them."""
    for box in boxes:
        box.mass = 0
    for line, weight in lines:
        line.box.mass += weight
    for box in reversed(boxes):
        if box.parent is not None:
            box.parent.mass += box.mass


def _judge(boxes: list[Box]) -> None:
    """Say which boxes are dropped and which are of an article; parents come first."""
    for box in boxes[1:]:
        above = box.parent
        around = box.sure or box.named or (box.header and not above.main)
        main = box.tag in _MAIN and not (box.comments or box.sure or box.named)
        box.dropped = box.comments or ((above.dropped or around) and not main)
        box.main = main or (above.main and not around)


def _clear_names(boxes: list[Box], lines: list[Line]) -> bool:
    """Trust no class name of a box with most of the text, unless articles lie outside of it."""
    certain: set[int] = set()
    for box in boxes:
        if box.sure or box.comments or id(box.parent) in certain:
            certain.add(id(box))
    _weigh(boxes, [(x, len(x.text)) for x in lines if id(x.box) not in certain and not x.links])
    half = boxes[0].mass / 2
    large = [b for b in boxes if b.named and b.mass > half]
    if not large:
        return False
    articles = [x.box.index for x in lines if x.box.main and not x.box.dropped]
    low, high = min(articles, default=0), max(articles, default=0)
    wrong = [b for b in large if not articles or (b.index <= low and high <= b.end)]
    for box in wrong:
        box.named = False
    return bool(wrong)


def _number(boxes: list[Box]) -> None:
    """Say where the boxes inside each box end."""
    for box in reversed(boxes):
        box.end = max(box.end, box.index)
        if box.parent is not None:
            box.parent.end = max(box.parent.end, box.end)


def _innermost(boxes: list[Box], region: Box, tags: frozenset[str] | None = None) -> Box:
    """From a box down, as long as one box in it, of ``tags`` if given, has all its content."""
    k = region.index + 1
    while k <= region.end:
        box = boxes[k]
        if region.mass and box.mass == region.mass and (tags is None or box.tag in tags):
            region = box
        k += 1
    return region


def _articles(boxes: list[Box]) -> list[Box]:
    """The outermost article and main elements that have content."""
    out, k = [], 0
    while k < len(boxes):
        box = boxes[k]
        if box.tag in _MAIN and box.main and not box.dropped and box.mass:
            out.append(_innermost(boxes, box, _MAIN))
            k = box.end
        k += 1
    return out


def _parts(boxes: list[Box], region: Box) -> dict[int, Box]:
    """Per box of a region the one its lines are judged with: the innermost layout box
    around it, or the region.

    Rows, cells and items go with the list or table they are in.
    """
    out, whole = {region.index: region}, set()
    for box in boxes[region.index + 1 : region.end + 1]:
        above = out[box.parent.index]
        if box.parent.index in whole:
            whole.add(box.index)
        elif box.tag in _WHOLE:
            whole.add(box.index)
            above = box
        elif box.tag in _LAYOUT:
            above = box
        out[box.index] = above
    return out


def _chosen(boxes: list[Box], region: Box, lines: list[tuple[Line, bool]]) -> list[Line]:
    """The lines of a region by its clusters.

    A part with a line of the upper cluster stays whole, whatever else is in it. Other
    parts go if they hold nothing but links, or controls to press. So do those before
    the first and behind the last such line, unless they have paragraphs or headings
    that aren't about rights; bare links there go too.
    """
    dense = [k for k, (_, good) in enumerate(lines) if good]
    first, last = dense[0], dense[-1]
    of = _parts(boxes, region)
    parts = [of[x.box.index] for x, _ in lines]
    full = {id(parts[k]) for k in dense}
    told, heads = set(), set()  # parts with more than links, and with paragraphs
    for (x, _), part in zip(lines, parts, strict=True):
        if not x.links:
            told.add(id(part))
        if x.block in _PARAGRAPHS and not _RIGHTS.match(x.text):
            heads.add(id(part))
    out = []
    for k, ((x, _), part) in enumerate(zip(lines, parts, strict=True)):
        at_end = not first <= k <= last
        if id(part) in full or part is region:
            keep = not (at_end and (x.links and not x.block or _RIGHTS.match(x.text)))
        elif id(part) not in told or part.controls:
            keep = False
        else:
            keep = not at_end or id(part) in heads
        if keep:
            out.append(x)
    return out


def clusters(lines: list[Line]) -> list[bool]:
    """Flags of the lines whose ratio, alone and smoothed, is in the upper cluster.

    A line's ratio is its length by the tags in and before it.
    """
    own = [len(x.text) / max(1, x.tags) for x in lines]
    ratios = smoothed(own)
    least = threshold(ratios)
    dense = [min(r, o) >= least for r, o in zip(ratios, own, strict=True)]
    return dense if any(dense) else [r >= least for r in ratios]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in order, one per line.

    Lines end at block elements and line breaks. Their text-to-tag ratios are smoothed
    and split in two clusters. Lines of the upper one, and others that are not mostly
    links, are content; they choose the region. That is all article and main elements
    with content, if a main element is among them or they hold half of the content at
    least, else the innermost element that holds all content. In article elements all
    lines stay. Elsewhere the clusters decide, part by part (``_chosen``): parts with a
    line of the upper cluster stay whole, so no line beside it is lost, and of the
    others lists of links, notices to be clicked away and bare texts at the ends go.

    Elements known to stand around articles (menus, notices, adverts, forms, comments)
    are dropped anywhere, if known by a class name only unless most of the page is in
    them.
    """
    if not html:
        return ""
    parser = LineParser()
    every, boxes = parser.run(html), parser.boxes
    _number(boxes)
    _judge(boxes)
    while _clear_names(boxes, every):
        _judge(boxes)
    lines = [x for x in every if not x.box.dropped]
    if not lines:
        return ""
    dense = clusters(lines)
    content = [good or not x.links for x, good in zip(lines, dense, strict=True)]
    _weigh(boxes, [(x, len(x.text) * good) for x, good in zip(lines, content, strict=True)])
    regions = _articles(boxes)
    sure = any(b.tag == "main" for b in regions)
    if not regions or not (sure or 2 * sum(b.mass for b in regions) >= boxes[0].mass):
        regions = [_innermost(boxes, boxes[0])]
    starts = [r.index for r in regions]
    held: list[list[tuple[Line, bool]]] = [[] for _ in regions]
    for x, good in zip(lines, dense, strict=True):
        k = bisect.bisect_right(starts, x.box.index) - 1
        if k >= 0 and x.box.index <= regions[k].end:
            held[k].append((x, good))
    out = []
    for region, own in zip(regions, held, strict=True):
        if region.tag != "article" and any(good for _, good in own):
            out += _chosen(boxes, region, own)
        elif region.mass:
            out += [x for x, _ in own]
    return "\n".join(x.text for x in out)


def extract(column: pa.Array) -> dict[str, pa.Array]:
    texts = [main_text(h) for h in column.to_pylist()]
    return {
        "text": pa.array(texts, pa.string()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
    }


def with_main_text(pages: DataFrame, name: str = "main", html: str = "html") -> DataFrame:
    """``pages`` with a struct column of the main text and its number of characters.

    A null or empty page, and one without text outside of what is dropped, has
    the empty text. Broken markup is read as browsers would. Repeated rows,
    nulls in other columns and further columns pass through; an empty table
    stays empty. Pages of any length are read whole.
    """
    return annotate(pages, lambda part: extract(part[html]), FIELDS, name, text=html)
