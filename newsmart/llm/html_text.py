"""Main text of web pages by text-to-tag ratios (operator 9).

The standard library's streaming parser gives the events. They cut a page into lines, one
a block of text, each with the number of its tags and the elements it lies in. A line's
ratio is its text outside links to its tags, none where the markup itself says that it is
not the article (navigation, forms, scripts, adverts, comments of readers and the like).
The ratios are smoothed by a Gaussian window over the page and split into two clusters by
the threshold that separates them best; runs of lines above it are the content regions.

Names that may stand for links beside the article or for a part of it (``related``, ``share``, ``legal``)
exclude only what is half linked or more.

Ratios alone lose an article's short lines and may join two neighbours, so regions choose
*where* the article is, not its lines: the outermost article element that holds most of the
regions' text, else the outermost main element, else the smallest element that does, named
as the article first. From there it climbs while what an element adds is content: a title
or a lead beside the body belongs to the article; so does another article element with content in the
same main. All lines in it that the markup does not exclude are the
text, in page order.

Cases: null, empty and textless html give an empty text; broken nesting is closed by the
next end tag that matches; pages of one line are taken whole; very long pages are parsed whole, in
batches of 8 MB; equal rows stay; an empty
table gives no rows; other columns are not read."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsmart.llm.common import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that never hold the article's text.
NEVER = frozenset(
    "script style noscript template head title nav aside footer form button select option textarea input label iframe object "
    "svg canvas audio video map dialog menu".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Whole words of class and id values (parts between hyphens, underscores and case changes).
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation "
    "navi breadcrumb breadcrumbs sidebar aside widget widgets footer foot header masthead topbar toolbar notice notices cookie "
    "cookies consent gdpr popup modal overlay alert newsletter subscribe subscription signup login "
    "comment comments disqus reply replies respond responses feedback reactions discussion pagination pager skip "
    "copyright tagcloud paywall adslot adunit adbox".split()
)
NAME_STARTS = (
    "advert", "sponsor", "cookie", "comment", "newsletter", "subscri", "navig", "breadcrumb", "paginat", "sidebar", "recommend"
)
#: Names of blocks that may be links around the article or a part of it: they go where half of their text is linked.
MAYBE = frozenset("side share sharing social related recommended recommendations trending search legal disclaimer tags toc".split())
#: First words of class names that describe an element's surroundings, as in "has-sidebar", and ones that
#: only say who looks for the name, as in "js-banner".
ABOUT = frozenset("has with without no".split())
MARKS = frozenset("js is".split())
ARTICLE_NAMES = frozenset("article post entry story main content body text articlebody maincontent".split())
#: Elements whose open tag closes an open paragraph.
CLOSES_P = BLOCKS - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "li", "legend", "summary"}
#: Elements whose unlinked text is content wherever it stands beside the article's body.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
SIGMA = 1.0


class _Node:
    __slots__ = ("article", "excluded", "maybe", "parent", "tag")

    def __init__(self, tag: str, parent: _Node | None, excluded: bool, article: bool, maybe: bool = False):
        self.tag, self.parent, self.excluded, self.article = tag, parent, excluded, article
        #: The outermost element around it, or itself, that is named as what may be links beside the article.
        self.maybe: _Node | None = parent.maybe if parent is not None and parent.maybe is not None else self if maybe else None


class Line:
    __slots__ = ("excluded", "linked", "node", "tags", "text")

    def __init__(self, text: str, tags: int, linked: int, node: _Node):
        self.text, self.tags, self.linked, self.node, self.excluded = text, tags, linked, node, node.excluded


def _words(value: str) -> set[str]:
    """Words of the names in a class or id value, less names that tell of something beside it."""
    out: set[str] = set()
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name).lower()) if w]
        if words and words[0] not in ABOUT:
            out.update(words[1:] if words[0] in MARKS else words)
    return out


class Lines(HTMLParser):
    """Collects a page's lines from the parser's events. ``strict`` also leaves out forms and
    what class and id names call something else than the article."""

    def __init__(self, strict: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.strict = strict
        self.root = _Node("", None, False, False)
        self.node, self.lines = self.root, []
        self.parts: list[str] = []
        self.tags = self.linked = self.anchors = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, min(self.linked, len(text)), self.node))
        self.parts, self.tags, self.linked = [], 0, 0

    def _block(self) -> _Node:
        """The innermost open element that is not inline."""
        node = self.node
        while node.parent is not None and node.tag not in BLOCKS:
            node = node.parent
        return node

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in NEVER:
            self._flush()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self._close("p", BLOCKS - {"p"})
        elif tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            self._close(tag, frozenset(("ul", "ol", "dl", "table", "select", "menu")))
        excluded, article, maybe = self.node.excluded, tag in ("article", "main"), False
        if not excluded:
            excluded = tag in NEVER and (self.strict or tag != "form") or (tag == "header" and not self._within_article())
            if attrs and not excluded:
                excluded, named, maybe = self._attributes(tag, attrs)
                article = article or named
        self.node = _Node(tag, self.node, excluded, article and not excluded, maybe)
        if tag == "a":
            self.anchors += 1

    def _within_article(self) -> bool:
        node = self.node
        while node is not None:
            if node.tag in ("article", "main"):
                return True
            node = node.parent
        return False

    def _attributes(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool, bool]:
        """Whether an element's attributes exclude it, whether they name it the article, and whether they
        exclude it if it is links. Of prose within an article only a whole name says something: not
        ``share-price``, but ``ad``."""
        excluded = named = maybe = False
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
                words = _words(value)
                own = bool(words & ARTICLE_NAMES)
                if own or self._within_article():  # an article's own header is part of it
                    words = words - {"header", "masthead"}
                if self.strict:
                    if tag in PROSE and self._within_article():
                        words = {w for w in words if w in value.lower().split()}
                    excluded = excluded or bool(words & NAMES) or any(w.startswith(NAME_STARTS) for w in words)
                    maybe = maybe or bool(words & MAYBE)
                named = named or own
            elif name == "role":
                excluded = excluded or value.strip().lower() in ROLES
                named = named or value.strip().lower() in ("main", "article")
            elif name == "itemprop":
                named = named or value.strip().lower() == "articlebody"
            elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
                excluded = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                excluded = True
        return excluded, named and not excluded, maybe

    def _close(self, tag: str, stop: frozenset[str]) -> None:
        """Close an open ``tag`` and all in it, if no element of ``stop`` lies between."""
        node = self.node
        while node.parent is not None:
            if node.tag == tag:
                self.node = node.parent
                return
            if node.tag in stop or node.tag in NEVER:
                return
            node = node.parent

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in NEVER:
            self._flush()
        self.tags += 1
        if tag == "a":
            self.anchors = max(0, self.anchors - 1)
        node = self.node
        inline = tag not in BLOCKS and tag not in NEVER
        while node.parent is not None:
            if node.tag == tag:
                self.node = node.parent
                return
            if inline and node.tag in BLOCKS:  # an inline end tag does not close a block
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.anchors:
            self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._flush()
        texts: dict[_Node, list[int]] = {}
        for line in self.lines:
            if line.node.maybe is not None:
                sums = texts.setdefault(line.node.maybe, [0, 0])
                sums[0] += line.linked
                sums[1] += len(line.text)
        for line in self.lines:
            if line.node.maybe is not None:
                linked, chars = texts[line.node.maybe]
                line.excluded = line.excluded or 2 * linked >= chars


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing that does not fade at the ends."""
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, weights, "full")[reach : reach + len(ratios)] / np.convolve(np.ones(len(ratios)), weights, "full")[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The border between two clusters with the least squared distance within them."""
    x = np.sort(values)
    if not len(x) or x[0] == x[-1]:
        return -1.0
    n, total = len(x), np.cumsum(x)
    k = np.arange(1, n)
    low, high = total[:-1] / k, (total[-1] - total[:-1]) / (n - k)
    at = int(np.argmax(k * (n - k) * (high - low) ** 2))
    return float((x[at] + x[at + 1]) / 2)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    for strict in (True, False):  # a page may lie in a form, or in an element with a misleading name
        parser = Lines(strict)
        parser.feed(html)
        parser.close()
        lines = parser.lines
        if any(not x.excluded for x in lines):
            break
    else:
        return ""
    ratios = np.array([0.0 if x.excluded else (len(x.text) - x.linked) / max(1, x.tags) for x in lines])
    smoothed = smooth(np.log1p(ratios))
    border = threshold(smoothed)
    weight: dict[_Node, int] = {}
    depth: dict[_Node, int] = {}
    total = 0
    for line, value in zip(lines, smoothed.tolist(), strict=True):
        if line.excluded or value <= border:
            continue
        chars = len(line.text) - line.linked
        total += chars
        node, path = line.node, []
        while node is not None:
            weight[node] = weight.get(node, 0) + chars
            path.append(node)
            node = node.parent
        for k, x in enumerate(reversed(path)):
            depth[x] = k
    if not total:
        weight, depth = {parser.root: 1}, {parser.root: 0}
    named = [x for x in weight if x.article and 2 * weight[x] >= total]
    most = [x for x in named or weight if 5 * weight[x] >= 4 * total] or named or [parser.root]
    own = [x for x in most if x.tag == "article"] or [x for x in most if x.tag == "main"]
    chosen = min(own, key=lambda x: depth[x]) if own else max(most, key=lambda x: depth[x])
    if chosen.tag in ("p", "li", "td", "h1", "h2", "h3") and chosen.parent is not None:
        chosen = chosen.parent
    above = [not x.excluded and v > border for x, v in zip(lines, smoothed.tolist(), strict=True)]
    chosen = _climb(chosen, lines, above)
    chosen = _with_siblings(chosen, lines, above)
    return "\n".join(x.text for x in lines if not x.excluded and _inside(x.node, chosen))


def _block_of(node: _Node) -> _Node:
    while node.parent is not None and node.tag not in BLOCKS:
        node = node.parent
    return node


def _climb(chosen: _Node, lines: list[Line], above: list[bool]) -> _Node:
    """The highest element up to which each one adds content lines: in the regions or prose,
    mostly unlinked. An element named as the article may add other lines besides; another one
    must add more content than other text. An article element climbs only within its main,
    for lines that stand directly beside it."""
    chain: list[_Node] = []
    node: _Node | None = chosen
    while node is not None:
        chain.append(node)
        node = node.parent
    strict = chosen.tag in ("article", "main")
    if strict:
        mains = [k for k, x in enumerate(chain) if x.tag == "main"]
        chain = chain[: mains[-1] + 1] if mains else chain[:1]
    level: dict[_Node | None, int] = {x: k for k, x in enumerate(chain)} | {None: len(chain)}
    content, added = [0] * len(chain), [0] * len(chain)
    for line, region in zip(lines, above, strict=True):
        if line.excluded:
            continue
        path: list[_Node] = []
        node = line.node
        while node not in level:
            path.append(node)
            node = node.parent
        at = level[node]
        level.update((x, at) for x in path)
        if at == len(chain):
            continue
        block = _block_of(line.node)
        beside = block if block is chain[at] or block.parent is None or block.parent.tag != "header" else block.parent
        direct = beside is chain[at] or beside.parent is chain[at]
        added[at] += len(line.text)
        if 2 * line.linked < len(line.text) and (block.tag in PROSE and direct or (not strict and (region or block.tag in PROSE))):
            content[at] += len(line.text)
    for k in range(1, len(chain)):
        if not added[k]:
            continue
        if not content[k] or not (chain[k].article or 2 * content[k] >= added[k]):
            break
        chosen = chain[k]
    return chosen


def _with_siblings(chosen: _Node, lines: list[Line], above: list[bool]) -> _Node:
    """The main element around a chosen article, where it holds another article with content lines: a
    text in several articles."""
    main = chosen
    while main is not None and main.tag != "main":
        main = main.parent
    if main is None or chosen.tag != "article":
        return chosen
    for line, region in zip(lines, above, strict=True):
        if not line.excluded and region and not _inside(line.node, chosen):
            node = line.node
            while node is not None and node is not main:
                if node.tag == "article" and _inside(node, main):
                    return main
                node = node.parent
    return chosen


def _inside(node: _Node | None, of: _Node) -> bool:
    while node is not None:
        if node is of:
            return True
        node = node.parent
    return False


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    kept = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:2])
    return kept.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
