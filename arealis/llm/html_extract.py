"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into blocks of text, one per block-level element. A block
weighs as many characters as it has outside links, twice the linked ones taken
off; markup only changes weights: blocks in menus, notices, adverts, forms,
comments and the like (by tag, role, or a class with support) weigh nothing, and
where a page marks its articles, blocks outside these weigh nothing and each
block inside that is not all links weighs as much as a surge needs.

On every page the weights are summed over a sliding window of ``WINDOW`` blocks.
A surge is a block of weight from which on the sum is at least ``SURGE``, if it
is long, a heading, marked, or next to a long one; the next dive is where the
sum falls below ``DIVE`` and the block before is not long either, which inside
an article takes a whole window of links. The text is what lies between surges and dives, and the
blocks of weight between two such ranges; blocks that weigh nothing by their
markup are never text.

Each page is read whole, in one pass over its tags and one over its elements,
in time proportional to its length whatever the depth. Pages are independent.

Defined results: null or empty html, and a page without text, give an empty
text; broken markup (missing ends, unknown tags, stray brackets, elements closed
by themselves) is read as far as it goes; repeated rows give repeated results;
null ids and urls stay null; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from arealis.llm.common import by_bytes

#: Blocks in a window, the sum of a surge, the sum of a dive, and the least weight of a first block where no article is marked.
WINDOW, SURGE, DIVE, FIRST = 3, 80, 30, 25

# Elements by their role in a page.
RAW = "script style noscript template iframe textarea title xmp noembed noframes".split()
SILENT = ("svg", "select")  # their text is none of the page; a block inside ends them
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LISTS = ("ul", "ol", "dl", "table", "div", "section", "article", "main")
#: Elements that an element of this kind closes.
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
INLINE_NAMES = {"a", "span", "b", "i", "em", "strong"}
NOISE_TAGS = set("nav aside footer menu button dialog label fieldset head".split())
WRAPPERS = {"form", "header"}  # noise, but some pages put all they have into one
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay alert "
    "sidebar sidebars aside widget widgets rail menu menus nav navbar navigation breadcrumb breadcrumbs "
    "header masthead topbar toolbar footer bottombar comment comments commentlist disqus reply replies respond responses discussion feedback "
    "share sharing social follow related recommended recommendations newsletter subscribe subscription signup login register search "
    "pagination pager paging skip copyright disclaimer teaser teasers".split()
)
#: Words that say enough as a part of a name, also around and inside an article.
SURE_WORDS = set("advert adverts advertisement advertising adsense adslot gdpr comments commentlist disqus newsletter sidebar sidebars breadcrumb breadcrumbs navbar pagination pager".split())
#: Words of marked elements that are not the article.
OTHER_ARTICLES = SURE_WORDS | set("comment reply replies response responses teaser teasers related recommended promo ad sponsored widget".split())
#: Beginnings of names for the state of a layout, which say nothing about the element.
STATES = ("with-", "has-", "no-", "is-", "without-", "js-")

#: Verdicts on an element; those after NOISE hold only with support.
CLEAN, NOISE, UNLESS_ARTICLE, UNLESS_MOST, IF_SMALL, IF_LINKS = range(6)
#: Text below which an element with a noisy name inside an article is small.
SMALL = 200

RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_NAME = re.compile(r"(/?)([a-z][a-z0-9:-]*)", re.I)
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([a-z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_MARK = re.compile(r"""(?:role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articleBody\b)""")


@dataclass(slots=True)
class Block:
    """A run of text without a block boundary inside."""

    text: str
    links: int
    element: int
    heading: bool
    noise: bool = False
    marked: bool = False


@dataclass(slots=True)
class Element:
    """An element's verdict, and the text and links inside it."""

    parent: int
    verdict: int
    mark: bool
    inside: bool  # of a marked element, or one itself
    size: int = 0
    links: int = 0
    holds_mark: bool = False


def tags_of(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, slash, name in lower case, and attributes of each tag; what is no element has an empty name."""
    last = {q: page.rfind(q) for q in "\"'"}
    at = 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, "", "", ""
            at = end
            continue
        name = _NAME.match(page, at + 1)
        if not name and page[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1
            continue
        stop = name.end() if name else at + 2
        while True:
            found = _STOP.search(page, stop)
            if found is None:
                stop = len(page)
                break
            stop = found.end()
            if found[0] == ">":
                break
            # A quote counts behind an equals sign, if it is closed.
            if last[found[0]] >= stop and page[:stop - 1][-40:].rstrip().endswith("="):
                stop = page.find(found[0], stop) + 1
        closed = page[stop - 1 : stop] == ">" and stop > at + 1
        if not name:
            yield at, stop, "", "", ""
        else:
            tag = name[2].lower()
            if tag in RAW_ENDS and not name[1]:
                end = RAW_ENDS[tag].search(page, stop)
                yield at, end.end() if end else len(page), "", "", ""
                stop = end.end() if end else len(page)
            elif closed:
                yield at, stop, name[1], tag, page[name.end() : stop - 1]
            else:
                yield at, stop, "", "", ""
        at = stop


def verdict_on(tag: str, attributes: str, inside: bool, mark: bool) -> int:
    """What an element's tag, role and names say."""
    if tag in NOISE_TAGS:
        return NOISE
    if tag in WRAPPERS and not (tag == "header" and (inside or mark)):
        return UNLESS_ARTICLE
    if not attributes.strip() or tag in ("html", "body"):
        return CLEAN
    found = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return NOISE
    if set(found.get("role", "").lower().split()) & NOISE_ROLES:
        return NOISE
    names = [t for t in found.get("class", "").split() if not t.lower().startswith(STATES)]
    if tag in HEADINGS and inside or tag in INLINE_NAMES and not names:
        return CLEAN
    tokens = {t.lower() for t in names}
    parts = {w.lower() for t in names for w in _WORDS.findall(t)}
    own = found.get("id", "")
    every = parts | {w.lower() for w in _WORDS.findall(own) if not own.lower().startswith(STATES)}
    if mark:
        return NOISE if every & OTHER_ARTICLES else CLEAN
    if inside:
        if parts & SURE_WORDS or own.lower() in SURE_WORDS:
            return NOISE
        known = NOISE_WORDS - {"header"}  # the heading of the article itself
        return IF_SMALL if tokens & known else IF_LINKS if every & known else CLEAN
    if (tokens | {own.lower()}) & NOISE_WORDS:
        return NOISE if (tokens | {own.lower()}) & SURE_WORDS else UNLESS_ARTICLE
    return UNLESS_MOST if every & NOISE_WORDS else CLEAN


class Page:
    """The blocks and elements of a page; every step on the stack of open elements takes constant time."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        self.elements = [Element(0, CLEAN, False, False)]
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: dict[str, list[int]] = {}  # places of a tag on the stack
        self.walls: list[int] = []  # places of block-level elements
        self.headings = 0
        self.parts: list[str] = []
        self.linked = 0
        at = 0
        for start, end, slash, tag, attributes in tags_of(page):
            self._text(page[at:start])
            at = end
            if tag and slash:
                self._end(tag)
            elif tag:
                self._begin(tag, attributes)
        self._text(page[at:])
        self._flush()
        self._settle()

    def _text(self, text: str) -> None:
        if text and not any(self.open.get(t) for t in SILENT):
            self.parts.append(text)
            if self.open.get("a"):
                self.linked += len(text.strip())

    def _flush(self) -> None:
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            self.parts.clear()
            if text:
                self.blocks.append(Block(text, min(self.linked, len(text)), self.stack[-1][1], self.headings > 0))
        self.linked = 0

    def _close(self, place: int) -> None:
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            self.open[tag].pop()
            self.headings -= tag in HEADINGS
        while self.walls and self.walls[-1] >= place:
            self.walls.pop()

    def _last(self, *tags: str) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _end(self, tag: str) -> None:
        place = self._last(tag)
        if tag in BLOCKS:
            self._flush()
        if place and (tag in BLOCKS or not self.walls or self.walls[-1] < place):
            self._close(place)

    def _begin(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append("\n")
            return
        if tag in BLOCKS:
            self._flush()
            if silent := min((self.open[t][0] for t in SILENT if self.open.get(t)), default=0):
                self._close(silent)
            if tag not in SAME and (p := self._last("p")):
                self._close(p)
            if tag in SAME and (same := self._last(*SAME[tag])) > self._last(*(t for t in LISTS if t != tag)):
                self._close(same)
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS:
            return
        if tag == "a" and (before := self._last("a")) and (not self.walls or self.walls[-1] < before):
            self._close(before)
        parent = self.stack[-1][1]
        inside = self.elements[parent].inside
        mark = tag in ("article", "main") or _MARK.search(attributes) is not None
        verdict = verdict_on(tag, attributes, inside, mark)
        mark = mark and verdict != NOISE
        if verdict or mark:
            self.elements.append(Element(parent, verdict, mark, inside or mark))
            parent = len(self.elements) - 1
        self.open.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.walls.append(len(self.stack))
        self.headings += tag in HEADINGS
        self.stack.append((tag, parent))

    def _settle(self) -> None:
        """Verdicts that need support, from the leaves to the root for sizes and back for their effect."""
        elements = self.elements
        for b in self.blocks:
            elements[b.element].size += len(b.text)
            elements[b.element].links += b.links
        hard = [False] * len(elements)
        for k, e in enumerate(elements):
            hard[k] = e.verdict == NOISE or k > 0 and hard[e.parent]
        total = sum(e.size for e, h in zip(elements, hard) if not h)
        for e in reversed(elements[1:]):
            up = elements[e.parent]
            up.size += e.size
            up.links += e.links
            up.holds_mark |= e.verdict != NOISE and (e.mark or e.holds_mark)
        noise, marked = [False] * len(elements), [False] * len(elements)
        outer = [e for e in elements if e.mark and not elements[e.parent].inside]
        written = any(2 * e.links < e.size for e in outer)
        for k, e in enumerate(elements[1:], 1):
            links = 2 * e.links >= e.size
            supported = {
                NOISE: True, UNLESS_ARTICLE: not e.holds_mark, UNLESS_MOST: not e.holds_mark and 2 * e.size <= total, IF_SMALL: links or e.size < SMALL, IF_LINKS: links,
            }.get(e.verdict, False)
            teaser = e.mark and not elements[e.parent].inside and links and written
            noise[k] = noise[e.parent] or supported or teaser
            marked[k] = marked[e.parent] or e.mark
        for b in self.blocks:
            b.noise, b.marked = noise[b.element], marked[b.element]


def weights_of(blocks: list[Block]) -> list[int]:
    """The weight of each block by its text, links and markup."""
    marks = any(b.marked and not b.noise for b in blocks)
    out = []
    for b in blocks:
        own = max(0, len(b.text) - 2 * b.links)
        if marks and b.marked and b.links < len(b.text):
            own = max(own, SURGE)
        out.append(0 if b.noise or marks and not b.marked else own)
    return out


def ranges_of(weights: list[int], may_begin: list[bool]) -> list[tuple[int, int]]:
    """The ranges of blocks from a surge of the window sums to the next dive, without weightless ends."""
    n = len(weights)
    before = [0]
    for w in weights:
        before.append(before[-1] + w)
    sums = [before[min(n, k + WINDOW)] - before[k] for k in range(n)]
    surge = min([SURGE, max(sums, default=0)])
    dive = min(DIVE, surge)
    out, start = [], None
    for k in range(n + 1):
        if start is None:
            if k < n and weights[k] and may_begin[k] and sums[k] >= surge:
                start = k
        elif k == n or sums[k] < dive and weights[k - 1] + weights[k] < surge:
            end = k
            while not weights[end - 1]:
                end -= 1
            out.append((start, end))
            start = None
    return out


def main_text(page: str | None) -> str:
    """The kept blocks, joined by an empty line."""
    blocks = Page(page or "").blocks
    marks = any(b.marked and not b.noise for b in blocks)
    weights = weights_of(blocks)
    usable = [not b.noise and (b.marked or not marks) for b in blocks]
    may_begin = [b.marked or b.heading or w >= FIRST or w + after >= SURGE for b, w, after in zip(blocks, weights, [*weights[1:], 0])]
    ranges = ranges_of(weights, may_begin) or ranges_of(weights, [True] * len(blocks))
    keep = [False] * len(blocks)
    for k, (start, end) in enumerate(ranges):
        low, high = (ranges[k - 1][1] if k else 0), (ranges[k + 1][0] if k + 1 < len(ranges) else len(blocks))
        while start > low and usable[start - 1] and blocks[start - 1].heading:
            start -= 1
        if marks:  # less than a window of links at the edge of an article is no dive
            edge = start
            while edge > low and usable[edge - 1] and not weights[edge - 1] and start - edge < WINDOW:
                edge -= 1
            start = edge if start - edge < WINDOW else start
            edge = end
            while edge < high and usable[edge] and not weights[edge] and edge - end < WINDOW:
                edge += 1
            end = edge if edge - end < WINDOW else end
        for i in range(start, end):
            keep[i] = True
        if k + 1 < len(ranges):
            for i in range(end, high):
                keep[i] = keep[i] or weights[i] > 0
    return "\n\n".join(b.text for b, kept, good in zip(blocks, keep, usable) if kept and good)


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Id, url, main text and its length in code points."""
    source = pages.select(pages[id_column], pages[url_column], pages[html_column])
    kinds = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for some in by_bytes(batch.column(2)) for x in some]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    out = source.mapInArrow(run, f"id {kinds[id_column]}, url {kinds[url_column]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_column, "url": url_column})
