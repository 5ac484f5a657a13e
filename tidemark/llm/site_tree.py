"""Main text of web pages by site style trees.

The DOMs of a host are merged into one tree: elements at the same place, by tag,
class and id, are one node.  A node's presentation styles are the sequences of
tags that its elements hold, its content features the texts of its blocks.
Entropy over the host's pages gives importance: what every page presents and
says alike has little, what differs from page to page has much.  A node's
importance mixes that of its presentation and that of its content, the former
the more the more styles it has; nodes below a threshold are removed from every
page, whatever a page's own text there.

The trees are counted with DataFrame aggregates: pages of equal blocks count
once, so copies of a page do not make its article look like a menu; the counts
are summed up before they are shuffled, so a host with a third of all pages is
spread over tasks by node and feature.  What comes back to the pages is one list
of removed nodes per host, joined by host; Spark broadcasts it below its own
threshold, and beyond it splits hot hosts.

Entropy says nothing of nodes seen on few pages, and reader comments, forms or
related links differ from page to page as articles do.  For these, declared
labels decide (element names, and words of class, id and role), except around an
article.  Scripts, styles, form controls and comments of the markup are no text.

Defined results: a null or empty html has an empty text; a page without a host is
judged by labels alone; unclosed and unmatched tags are mended as browsers do;
a tag cut off by the end of the page is markup; white space includes no-break
spaces; repeated rows have equal results; very long and deeply nested pages are
read in one pass; an empty table gives an empty result; other columns pass
through untouched, also those named like this operator's own.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh
from tidemark.session import materialise

# nodes of less importance are removed: their typical text is on the 0.4th power of the node's pages or more;
# inside an article or main element the bar is lower
THRESHOLD, INSIDE_THRESHOLD = 0.6, 0.1
# entropy over fewer different pages is no evidence: a few copies with small changes would look like a menu
LEAST_PAGES = 8
# weight of a node's content against its presentation, per style
GAMMA = 0.9

# Element names of HTML, and label words that pages use for other parts than the main text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes title textarea xmp".split())
NO_TEXT = frozenset("audio button canvas datalist head map object option select svg video".split())
OTHER_PARTS = frozenset("nav footer aside form header dialog menu".split())
LABEL_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts advertising banner breadcrumb breadcrumbs comment commentlist"
    " comments consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar"
    " navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related replies"
    " respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar".split()
)
# inside an article these name parts of the article
HEAD_WORDS = frozenset("header masthead banner".split())
# first words of class names that say how a page is laid out, not what an element is
LAYOUT_WORDS = frozenset("has with no without is show hide hidden".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
# containers that are told apart by their place among their like when they have no class or id
PLACED = frozenset("div section table ul ol".split())

_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|([^\s"'>/=]++)""")
_LABELS = ("class", "id", "role")
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[^a-z]+")
_TELLING = re.compile("class|id|role|hidden|display", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)

CONTENT, STYLE, PRESENT = range(3)


def _digest(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


@lru_cache(1 << 16)
def _node(parent: int, label: str) -> int:
    return _digest(parent.to_bytes(8, "little", signed=True) + label.encode("utf-8", "surrogatepass"))


@lru_cache(1 << 12)
def _labelled(names: str, inside: bool) -> bool:
    """Whether one of the class names, ids or roles says that this is another part than the main text."""
    telling = LABEL_WORDS - HEAD_WORDS if inside else LABEL_WORDS
    for name in names.lower().split():
        words = [w for w in _PARTS.split(name) if w]
        if words and words[0] not in LAYOUT_WORDS and any(w in telling for w in words):
            return True
    return False


@lru_cache(1 << 12)
def _attributes(tag_rest: str) -> tuple[str, bool]:
    """Class, id and role in a row, and whether the element is hidden."""
    if not _TELLING.search(tag_rest):
        return "", False
    found: dict[str, str] = {}
    for name, double, single, bare, alone in _ATTRIBUTE.findall(tag_rest):
        found.setdefault((name or alone).lower(), double or single or bare)
    names = " ".join(found[n] for n in _LABELS if found.get(n))
    return names, "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))


@dataclass(slots=True)
class _Element:
    tag: str
    node: int
    parent: _Element | None
    inside: bool
    labelled: bool
    hidden: bool
    holds_article: bool = False
    holds_heading: bool = False
    held: list[str] = field(default_factory=list)
    places: dict[str, int] = field(default_factory=dict)
    other_part: bool | None = None


@dataclass(slots=True)
class Block:
    """One block's text, the node of the site tree it belongs to, and whether labels rule it out."""

    node: int
    inside: bool
    other_part: bool
    text: str


class Page:
    """Blocks and presentation styles of one page, read in one pass over its markup."""

    def __init__(self, markup: str):
        self._found: list[tuple[_Element, str]] = []
        self._elements: list[_Element] = []
        self._has_article = False
        root = _Element("", 0, None, False, False, False)
        self._stack, self._open = [root], {}
        self._pieces: list[str] = []
        # open elements without text, and labelled ones within a line
        self._mute: list[str] = []
        # where the next end tag of an element without text is
        self._ends: dict[str, int] = {}
        self._markup = markup
        self._read(markup)
        while len(self._stack) > 1:
            self._pop()
        self._flush()
        for element in self._elements:
            # parents come first
            holds = element.holds_article or (element.holds_heading and (element.inside or not self._has_article))
            element.other_part = element.parent.other_part or element.hidden or (element.labelled and not holds) if element.parent else False
        self.blocks = [Block(e.node, e.inside, bool(e.other_part), text) for e, text in self._found]
        self.styles = [(e.node, _digest(" ".join(e.held).encode("utf-8", "surrogatepass"))) for e in self._elements]

    def _read(self, markup: str) -> None:
        at, size = 0, len(markup)
        while at < size:
            opening = _OPEN.search(markup, at)
            if opening is None:
                self._text(markup[at:])
                return
            start = opening.start()
            if start > at:
                self._text(markup[at:start])
            if markup.startswith("<!--", start):
                end = markup.find("-->", start + 2)
                at = size if end < 0 else end + 3
                continue
            tag = _TAG.match(markup, start)
            if tag is None:
                # a declaration, or a tag that the page's end cuts off
                end = markup.find(">", start)
                at = size if end < 0 else end + 1
                continue
            at = tag.end()
            closing, name, rest = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
            name = name.lower()
            if closing:
                self._end(name)
            elif name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(markup, at)
                at = size if end is None else end.end()
            else:
                self._start(name, rest, at)

    def _ends_after(self, name: str, at: int) -> bool:
        """Whether an element without text is closed at all; otherwise it would swallow the rest of the page."""
        known = self._ends.get(name, -1)
        if known < at:
            found = re.compile(f"</{name}(?=[\\s/>])", re.I).search(self._markup, at)
            known = self._ends[name] = len(self._markup) + 1 if found is None else found.start()
        return known <= len(self._markup)

    def _text(self, text: str) -> None:
        if not self._mute:
            self._pieces.append(text)

    def _flush(self) -> None:
        """The pieces so far are a block of the innermost element."""
        if self._pieces:
            text = " ".join(references.unescape("".join(self._pieces)).split())
            if text:
                self._found.append((self._stack[-1], text))
            self._pieces = []

    def _start(self, name: str, rest: str, at: int) -> None:
        if name in NO_TEXT:
            if not rest.endswith("/") and self._ends_after(name, at):
                self._mute.append(name)
            return
        if name in VOID:
            if name == "hr":
                self._flush()
            elif name in ("br", "wbr", "img"):
                self._stack[-1].held.append(name)
                if name == "br":
                    self._text(" ")
            return
        names, hidden = _attributes(rest) if rest.strip() else ("", False)
        if name not in BLOCKS:
            self._stack[-1].held.append(name)
            if (hidden or (names and _labelled(names, self._stack[-1].inside))) and not rest.endswith("/"):
                self._mute.append(name)
            elif self._mute and name == self._mute[-1]:
                self._mute.append(name)
            return
        self._mute = [m for m in self._mute if m in NO_TEXT]
        if self._mute:
            return
        self._flush()
        self._close_for(name)
        parent = self._stack[-1]
        parent.held.append(name)
        label = f"{name}.{_DIGITS.sub('', names).lower()}" if names else name
        if not names and name in PLACED:
            place = parent.places[name] = parent.places.get(name, 0) + 1
            label = f"{name}:{place}"
        main = name in ("article", "main") or "main" in names.lower().split()
        labelled = name not in ("html", "body", "article", "main") and (
            bool(names and _labelled(names, parent.inside)) or (name in OTHER_PARTS and not (name == "header" and parent.inside))
        )
        element = _Element(name, _node(parent.node, label), parent, parent.inside or main, labelled, hidden)
        self._stack.append(element)
        self._elements.append(element)
        self._open[name] = self._open.get(name, 0) + 1
        if main:
            self._has_article = True
            up: _Element | None = element
            while up is not None and not up.holds_article:
                up.holds_article = True
                up = up.parent
        if name == "h1":
            up = element
            while up is not None and not up.holds_heading:
                up.holds_heading = True
                up = up.parent

    def _close_for(self, name: str) -> None:
        """What the start of ``name`` ends: an open paragraph, and its own like up to their container."""
        if self._stack[-1].tag == "p":
            self._pop()
        if name not in CLOSES:
            return
        like, container = CLOSES[name]
        if not any(self._open.get(tag) for tag in like):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[depth].tag
            if tag in container:
                return
            if tag in like:
                while len(self._stack) > depth:
                    self._pop()
                return

    def _pop(self) -> None:
        self._flush()
        element = self._stack.pop()
        self._open[element.tag] -= 1

    def _end(self, name: str) -> None:
        if name not in BLOCKS:
            if self._mute and self._mute[-1] == name:
                self._mute.pop()
            return
        if any(m in NO_TEXT for m in self._mute) and name not in ("body", "html"):
            return
        self._mute = []
        self._flush()
        if not self._open.get(name):
            return
        while self._stack[-1].tag != name:
            self._pop()
        self._pop()

    def features(self) -> set[tuple[int, int, int, bool]]:
        """What the page adds to its host's tree: node, kind, feature, and whether inside an article."""
        texts = {(b.node, CONTENT, _digest(b.text.encode("utf-8", "surrogatepass")), b.inside) for b in self.blocks}
        inside = {b.node: b.inside for b in self.blocks}
        styles = {(node, STYLE, style, inside[node]) for node, style in self.styles if node in inside}
        return texts | styles | {(node, PRESENT, 0, within) for node, within in inside.items()}

    def main_text(self, removed: set[int]) -> tuple[str, int, int]:
        """The text without removed nodes and other parts, and how many blocks the tree and the labels took."""
        kept, by_tree, by_label = [], 0, 0
        for block in self.blocks:
            if block.node in removed:
                by_tree += 1
            elif block.other_part:
                by_label += 1
            else:
                kept.append(block.text)
        return "\n".join(kept), by_tree, by_label


def host_of(url: Column) -> Column:
    """The host of an address in lower case; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node and feature of a page, with a digest of all its blocks."""
    for batch in batches:
        hosts, pages, rows = [], [], []
        for host, markup in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            page = Page(markup.as_py() or "")
            digest = _digest(repr([(b.node, b.text) for b in page.blocks]).encode("utf-8", "surrogatepass"))
            found = page.features()
            rows += found
            hosts += [host] * len(found)
            pages += [digest] * len(found)
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_pydict(
            {
                "host": pa.array(hosts, pa.int64()),
                "page": pa.array(pages, pa.int64()),
                "node": pa.array(columns[0], pa.int64()),
                "kind": pa.array(columns[1], pa.int8()),
                "feature": pa.array(columns[2], pa.int64()),
                "inside": pa.array(columns[3], pa.bool_()),
            }
        )


def importances(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The nodes with text of every host's tree: host (its hash), node, pages, inside, presentation, content, importance."""
    read = pages.where(host_of(F.col(url)).isNotNull()).select(F.xxhash64(host_of(F.col(url))).alias("host"), F.col(html).alias("html"))
    rows = read.mapInArrow(_features, "host long, page long, node long, kind byte, feature long, inside boolean")
    counted = rows.groupBy("host", "node", "inside", "kind", "feature").agg(F.count_distinct("page").cast("double").alias("n"))

    def of(kind: int, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    n = F.col("n")
    summed = counted.groupBy("host", "node", "inside").agg(
        F.max(of(PRESENT, n)).cast("long").alias("pages"),
        F.count(of(CONTENT, n)).alias("features"),
        F.sum(of(CONTENT, F.log(n))).alias("feature_logs"),
        F.count(of(STYLE, n)).alias("styles"),
        F.sum(of(STYLE, n)).alias("styled"),
        F.sum(of(STYLE, n * F.log(n))).alias("style_logs"),
    )
    most = F.log(F.col("pages").cast("double"))
    alone = F.col("pages") <= 1
    entropy = F.log("styled") - F.col("style_logs") / F.col("styled")
    presentation = F.when(alone | (F.col("styles") == 0), 0.0).otherwise(F.least(F.lit(1.0), entropy / most))
    content = F.when(alone, 1.0).otherwise(1 - F.col("feature_logs") / F.col("features") / most)
    share = F.pow(F.lit(GAMMA), F.col("styles") - 1)
    measured = summed.select("host", "node", "inside", "pages", presentation.alias("presentation"), content.alias("content"), share.alias("share"))
    mixed = (1 - F.col("share")) * F.col("presentation") + F.col("share") * F.col("content")
    return measured.withColumn("importance", F.when(alone, 1.0).otherwise(mixed)).drop("share")


def removed_nodes(tree: DataFrame, threshold: float = THRESHOLD, inside_threshold: float = INSIDE_THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per host the nodes of too little importance, written, so that Spark knows their size."""
    bar = F.when(F.col("inside"), inside_threshold).otherwise(threshold)
    low = tree.where((F.col("pages") >= least_pages) & (F.col("importance") < bar))
    return materialise(low.groupBy("host").agg(F.collect_set("node").alias("removed")), "site-tree-removed")


def extract(pages: DataFrame, url: str = "url", html: str = "html", **limits: float) -> DataFrame:
    """``pages`` with their main text: ``main`` of text, n_chars, by_tree and by_label (blocks taken out)."""
    low = removed_nodes(importances(pages, url, html), **limits)

    @F.arrow_udf("struct<text:string,n_chars:bigint,by_tree:bigint,by_label:bigint>")
    def cleaned(markups: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for markup, nodes in zip(markups, removed, strict=True):
            text, by_tree, by_label = Page(markup.as_py() or "").main_text(set(nodes.as_py() or ()))
            out.append({"text": text, "n_chars": len(text), "by_tree": by_tree, "by_label": by_label})
        kinds = [("text", pa.string()), *((n, pa.int64()) for n in ("n_chars", "by_tree", "by_label"))]
        return pa.array(out, pa.struct(kinds))

    host, nodes, main = fresh(pages, "_host"), fresh(pages, "_removed"), fresh(pages, "main")
    known = low.select(F.col("host").alias(host), F.col("removed").alias(nodes))
    joined = pages.withColumn(host, F.when(host_of(F.col(url)).isNotNull(), F.xxhash64(host_of(F.col(url))))).join(known, host, "left")
    return joined.withColumn(main, cleaned(F.col(html), F.col(nodes))).drop(host, nodes)
