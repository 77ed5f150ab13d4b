"""Main text of web pages by wrapper induction.

Pages of one host share a template. Their block structures are aligned by simple tree matching (the largest
order-preserving matching of equal labels, found by dynamic programming over the children of matched nodes)
and merged into one wrapper tree per host. A wrapper node knows how many pages have it, whether its text ever
changes, and for a sample of the different contents of these pages the text it has beside each. Nodes that are
constant on most of the different pages are template; so are slots whose values come back beside other contents
(menus, adverts and notices are drawn from few, an article belongs to one content). The content is the lowest
node that holds all other slots.

Two things can't be told by how values vary, and hints (tags and names) decide there: slots that vary as
articles do (reader comments), and hosts with too few different pages.

Tasks merge the pages they read before anything is shuffled, so a host costs one small tree per task, and the
trees of a hot host meet in two steps. The page itself is never shuffled to build wrappers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plantmetrics.llm import dom
from plantmetrics.llm.arrow import record_batch
from plantmetrics.sources import stage

# Elements without text of their own, elements and names of page furniture, and of content.
MARKUP = frozenset("head button select dialog".split())
FURNITURE = frozenset("nav footer aside form menu search".split())
FURNITURE_NAMES = frozenset(
    "ad ads adsense advert advertisement advertorial banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer form gdpr menu modal nav navbar navigation newsletter notice "
    "pager pagination popup promo promotion related replies reply respond search share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
CONTENT = frozenset({"article", "main"})
TOP_ONLY = frozenset({"header"})


@dataclass(frozen=True)
class Hints:
    """What tags and names say about a block; without any, the wrapper decides alone."""

    furniture: frozenset[str] = FURNITURE
    #: Furniture outside content only.
    top_only: frozenset[str] = TOP_ONLY
    furniture_names: frozenset[str] = FURNITURE_NAMES
    #: Tags or names of content; they decide on hosts with too few different pages.
    content: frozenset[str] = CONTENT


NO_HINTS = Hints(frozenset(), frozenset(), frozenset(), frozenset())

#: Children of a node that differ in their neighbours' labels, beyond which equal labels anywhere are folded.
MOST_CHILDREN = 64
#: Pages of a host with different contents that must agree before a node counts as constant.
MIN_PAGES = 3
#: Different contents beside which a slot must be seen before its values are judged.
MIN_CONTENTS = 12
#: A slot is template if it has at most this share of values to contents.
MOST_VALUES = 0.9
#: Contents that a node samples with its text beside each: those with the least digests, so a fair sample.
VOTES = 64
#: Hosts a task holds before it hands on what it has merged.
MOST_HOSTS = 2_000


class Node:
    """A wrapper node: label, pages that have it, least and greatest text hash, words, children in order; of the
    pages that have it, the words of their contents and ``votes``: a sample of these contents' digests with the
    text hash of the node beside each (the least, where copies of a content differ in it)."""

    __slots__ = ("label", "pages", "low", "high", "words", "children", "elements", "around", "votes")

    def __init__(self, label, pages=1, low=0, high=0, words=0, children=None, elements=None, around=0, votes=None):
        self.label, self.pages, self.low, self.high, self.words = label, pages, low, high, words
        self.children, self.elements = children or [], elements or []
        self.around, self.votes = around, votes or {}

    @property
    def constant(self) -> bool:
        return self.low == self.high

    def plain(self) -> list:
        inside = [c.plain() for c in self.children]
        return [self.label, self.pages, self.low, self.high, self.words, inside, self.around, sorted(self.votes.items())]

    @classmethod
    def read(cls, plain: list) -> Node:
        return cls(*plain[:5], [cls.read(one) for one in plain[5]], None, plain[6], dict(plain[7]))


def matching(left: list[Node], right: list[Node]) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two sequences of siblings: (matched nodes, pairs of positions)."""
    weights = [[0] * len(right) for _ in left]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if a.label == b.label:
                weights[i][j] = 1 + (matching(a.children, b.children)[0] if a.children and b.children else 0)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weights[i][j])
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[-1][-1], pairs[::-1]


def align(left: list[Node], right: list[Node]) -> list[tuple[int, int]]:
    labels = [n.label for n in left]
    if labels == [n.label for n in right]:
        return [(k, k) for k in range(len(left))]
    return matching(left, right)[1]


def merge(into: Node, other: Node) -> Node:
    """``into`` with ``other`` (of the same label) merged into it; nodes only one of them has stay optional."""
    into.pages += other.pages
    into.words += other.words
    into.low, into.high = min(into.low, other.low), max(into.high, other.high)
    into.around += other.around
    both = into.votes | other.votes
    for content in into.votes.keys() & other.votes.keys():
        both[content] = min(into.votes[content], other.votes[content])
    into.votes = both if len(both) <= VOTES else {content: both[content] for content in sorted(both)[:VOTES]}
    children, at = [], 0
    pairs = align(into.children, other.children) + [(len(into.children), len(other.children))]
    seen = 0
    for i, j in pairs:
        children += into.children[at:i] + other.children[seen:j]
        if i < len(into.children):
            children.append(merge(into.children[i], other.children[j]))
        at, seen = i + 1, j + 1
    into.children = children
    return into


def _fold(a: Node, b: Node) -> Node:
    """Two siblings of one page with the same label, as one node."""
    a.low = a.high = (a.low * 31 + b.low + 1) & 0x7FFFFFFFFFFFFFFF
    a.words += b.words
    a.elements = a.elements + b.elements
    a.children = _folded(a.children + b.children)
    return a


def _folded(children: list[Node]) -> list[Node]:
    """Runs of equal labels as one node; beyond ``MOST_CHILDREN`` nodes, equal labels wherever they stand."""
    found: list[Node] = []
    for one in children:
        if found and found[-1].label == one.label:
            _fold(found[-1], one)
        else:
            found.append(one)
    if len(found) > MOST_CHILDREN:
        by_label: dict[str, Node] = {}
        for one in found:
            if one.label in by_label:
                _fold(by_label[one.label], one)
            else:
                by_label[one.label] = one
        found = list(by_label.values())
    return found


def furniture(element: dom.Element, hints: Hints, in_content: bool) -> bool:
    """Whether the element's own tag or names say that it isn't part of a text."""
    if element.tag in MARKUP or element.tag in hints.furniture or (element.tag in hints.top_only and not in_content):
        return True
    return not hints.furniture_names.isdisjoint(element.names) and element.tag not in ("html", "body", "article", "main")


def skeleton(top: dom.Element, hints: Hints, in_content: bool = False) -> Node:
    """The folded block structure below an element; furniture is marked to be dropped and left out."""
    in_content = in_content or top.tag in hints.content
    children, hashes, words, work = [], [], 0, list(reversed(top.inside))
    while work:  # inline elements add to the block around them
        one = work.pop()
        if isinstance(one, str):
            text = one.split()
            if text:
                words += len(text)
                hashes.append(xxhash.xxh3_64_intdigest(" ".join(text)))
        elif furniture(one, hints, in_content):
            one.drop = True
        elif one.tag in dom.BLOCK:
            child = skeleton(one, hints, in_content)
            words += child.words
            hashes.append(child.low)
            children.append(child)
        else:
            work.extend(reversed(one.inside))
    label = ".".join([top.tag, *top.names])
    digest = xxhash.xxh3_64_intdigest(repr(hashes)) >> 2 if hashes else 0
    return Node(label, 1, digest, digest, words, _folded(children), [top])


def named_content(top: Node, hints: Hints) -> list[Node]:
    """The highest nodes that say they are content."""
    found, work = [], [top]
    while work:
        one = work.pop()
        if one.words and not hints.content.isdisjoint(one.label.split(".")):
            found.append(one)
        else:
            work.extend(one.children)
    return found


def page_content(page: Node, hints: Hints) -> list[Node]:
    """The content of a page read by itself: what says so, else the lowest node with over half of its words."""
    found = named_content(page, hints)
    if found:
        return found
    here = page
    while True:
        heavy = [c for c in here.children if 2 * c.words > page.words]
        if not heavy:
            return [here]
        here = heavy[0]


def wrapper_content(wrapper: Node, hints: Hints) -> list[Node]:
    """The lowest node with all but template in it. Only on hosts with too few different pages to judge slots,
    nodes that say they are content come first."""
    if len(wrapper.votes) < MIN_CONTENTS:
        found = named_content(wrapper, hints)
        if found:
            return found
    here = wrapper
    while True:
        slots = [c for c in here.children if c.words and not is_template(c, here) and not comes_back(c)]
        own = here.words - sum(c.words for c in here.children)
        if own or len(slots) != 1 or not slots[0].children:
            return [here]
        here = slots[0]


def voted(page: Node, hints: Hints) -> Node:
    """A page's skeleton, with the words and the digest of its content noted at each node."""
    nodes = page_content(page, hints)
    around = sum(one.words for one in nodes)
    content = xxhash.xxh3_64_intdigest(repr([one.low for one in nodes])) >> 16
    work = [page]
    while work:
        one = work.pop()
        one.around, one.votes = around, {content: one.low >> 14} if around else {}
        work.extend(one.children)
    return page


def is_template(one: Node, above: Node) -> bool:
    """Whether a node is constant, on most of the different pages that have the node ``above`` it. Copies of a
    page count once. A node with over half of the words of its pages is never one, nor is a heading: pages of a
    host may well be versions of one text."""
    if not one.constant or len(one.votes) < MIN_PAGES or one.label.split(".")[0] in dom.HEADINGS:
        return False
    return 2 * len(one.votes.keys() & above.votes.keys()) > len(above.votes) and 2 * one.words <= one.around


def comes_back(one: Node) -> bool:
    """Whether a node's values come back beside different contents, so that it doesn't belong to one of them. A
    heading or a node with over half of the words of its pages never does."""
    if len(one.votes) < MIN_CONTENTS or one.label.split(".")[0] in dom.HEADINGS or 2 * one.words > one.around:
        return False
    return len(set(one.votes.values())) <= MOST_VALUES * len(one.votes)


def template_nodes(content: Node, hints: Hints) -> list[Node]:
    """The template below a content node that varies. Children whose values come back go as well, unless the node
    says that it is content: there, a line such as an author's name may come back."""
    if content.constant:
        return []
    outer = hints.content.isdisjoint(content.label.split("."))
    found = [c for c in content.children if outer and comes_back(c)]
    work = [c for c in content.children if c not in found]
    while work:
        one = work.pop()
        if is_template(one, content):
            found.append(one)
        else:
            work.extend(one.children)
    return found


#: What a wrapper node is to the pages that align with it.
OTHER, SLOTS, TEMPLATE = 0, 1, 2


def decided(wrapper: Node, hints: Hints) -> list:
    """A wrapper as ``[label, kind, children]``: all that pages need to be read by it, without its samples."""
    content = wrapper_content(wrapper, hints)
    kinds = {id(t): TEMPLATE for c in content for t in template_nodes(c, hints)} | {id(c): SLOTS for c in content}

    def plain(one: Node) -> list:
        return [one.label, kinds.get(id(one), OTHER), [plain(c) for c in one.children]]

    return plain(wrapper)


def _mapped(page: Node, wrapper: Node) -> Iterator[tuple[Node, Node]]:
    """Pairs of a page's nodes and the wrapper's that they align with."""
    yield page, wrapper
    for i, j in align(page.children, wrapper.children):
        yield from _mapped(page.children[i], wrapper.children[j])


class Extractor:
    """Reads pages of one host by its decided wrapper."""

    def __init__(self, plain: list, hints: Hints):
        self.kinds: dict[int, int] = {}
        self.hints, self.wrapper = hints, self._read(plain)

    def _read(self, plain: list) -> Node:
        node = Node(plain[0], children=[self._read(one) for one in plain[2]])
        self.kinds[id(node)] = plain[1]
        return node

    def text(self, html: str | None) -> str:
        if not html:
            return ""
        page = skeleton(dom.parse(html), self.hints)
        tops = []
        for node, slot in _mapped(page, self.wrapper):
            kind = self.kinds[id(slot)]
            if kind == TEMPLATE:
                for element in node.elements:
                    element.drop = True
            elif kind == SLOTS:
                tops.extend(node.elements)
        if not tops:  # the page lacks what its host's pages have: it is read by itself
            tops = [e for node in page_content(page, self.hints) for e in node.elements]
        return " ".join(block for top in tops for block in dom.blocks(top))


def page_host(url: Column) -> Column:
    """Host of a url in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _merged(kind: StructType, trees: dict[str, Node]) -> pa.RecordBatch:
    return record_batch(
        [list(trees), [json.dumps(tree.plain()) for tree in trees.values()]], to_arrow_schema(kind)
    )


def induce_wrappers(pages: DataFrame, hints: Hints = Hints()) -> DataFrame:
    """``(host, wrapper)`` from ``pages`` (host, html): every page counts."""
    kind = StructType.fromDDL("host string, wrapper string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Node] = {}
        for batch in batches:
            for host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = voted(skeleton(dom.parse(html or ""), hints), hints)
                for node, _ in _mapped(page, page):
                    node.elements = []
                trees[host] = merge(trees[host], page) if host in trees else page
            if len(trees) > MOST_HOSTS:
                yield _merged(kind, trees)
                trees = {}
        yield _merged(kind, trees)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Node]]:
        """One tree per host; rows come sorted by host."""
        last, tree = None, None
        for batch in batches:
            for host, plain in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = Node.read(json.loads(plain))
                if tree is not None and host == last:
                    tree = merge(tree, new)
                    continue
                if tree is not None:
                    yield last, tree
                last, tree = host, new
        if tree is not None:
            yield last, tree

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for host, tree in joined(batches):
            yield _merged(kind, {host: tree})

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for host, tree in joined(batches):
            yield record_batch([[host], [json.dumps(decided(tree, hints))]], to_arrow_schema(kind))

    parts = pages.select("host", "html").mapInArrow(read, kind)
    some = parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(64))).repartition("host", "part")
    some = some.sortWithinPartitions("host", "wrapper").select("host", "wrapper").mapInArrow(join, kind)
    return some.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(decide, kind)


def extract_main_text(pages: DataFrame, hints: Hints = Hints()) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages`` (page_id, url, html).

    A null or empty html gives an empty text, as does a page without any. Pages without a host in their url,
    null urls too, are taken as pages of one nameless host. Repeated rows give repeated results; other columns
    are ignored; an empty table gives an empty result. Elements nested deeper than ``dom.DEPTH`` are read as
    text of the element around them. Wrappers are joined by host: a hot host has one wrapper row, and its
    pages are split between tasks where the join isn't a broadcast one. Beside a page goes the decided wrapper,
    without the samples it was decided by.
    """
    rows = pages.select("page_id", "url", "html", page_host(F.col("url")).alias("host"))
    wrappers = stage(induce_wrappers(rows, hints), "wrappers")
    kind = StructType.fromDDL("page_id long, url string, text string, n_chars long")
    arrow = to_arrow_schema(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Extractor] = {}
        for batch in batches:
            ids, urls, htmls, plains = (c.to_pylist() for c in batch.columns)
            texts = []
            for html, plain in zip(htmls, plains, strict=True):
                if plain not in known:
                    if len(known) > MOST_HOSTS:
                        known.clear()
                    known[plain] = Extractor(json.loads(plain), hints)
                texts.append(known[plain].text(html))
            yield record_batch([ids, urls, texts, [len(one) for one in texts]], arrow)

    joined = rows.join(wrappers, "host").select(F.col("page_id").cast("long"), "url", "html", "wrapper")
    return joined.mapInArrow(read, kind)
