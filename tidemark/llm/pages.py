"""HTML extraction by wrapper induction.

Every page is parsed into a tree of block elements.  The pages of a host, and those of each
layout of a host (pages with the same labels outside articles and prose), are aligned with
one reference page by simple tree matching (the largest order-keeping
match of equally labelled nodes); it is the page of smallest id among those of the commonest shape.
A text that a matched node has on nearly all distinct pages of the host or
of the layout is template there; what varies is a slot and holds
content, also where a few pages deviate from a template text.  Elements that by their tag, role or whole class or id are navigation,
header, footer, sidebar, notice, advert, form, script, style or reader comments are template on every page, but
a role or name alone drops neither an article or main nor, reader comments aside, most of a page's text; what is named as comments goes with
the articles in it.  If articles outside elements so named hold ``ARTICLES`` of the text of a page, or of its main, content comes from
inside them, or else from its main.

Statistics are partial sums over (host, node, text) and (host, layout, node, text), so a host with a third of
all pages is split like any other.

Text: character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by a line break.

Defined cases: null and empty pages have empty text; a null URL belongs to the empty host;
pages without an id are never a reference; broken and cut-off markup is closed where it ends, and takes time in proportion to its length; hosts and layouts with fewer
than ``MIN_PAGES`` distinct pages, or whose pages vary nowhere, have no template nodes; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import html as html_text
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.urls import host_and_path
from tidemark.session import cut_lineage

MIN_PAGES = 4
STEADY = 0.9  # share of the distinct pages of a host or layout that must have a template text at its node
ARTICLES = 0.2  # share of the text of a page, or its main, that its articles must have to be its content
_KNOWN_TREES = 500

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "script style title textarea noscript iframe head template nav aside form button select option input object svg canvas dialog menu".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Opening one of these closes an open paragraph; the others close their own kind.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = frozenset("ul ol dl table tbody thead tfoot article section div body html main select".split())
BOILERPLATE = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr menu nav navbar "
    "navigation newsletter notice notices popup promo promoted related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# A class or id marks an element if all its parts are words above or of these, and one is above: site-footer, ad-box, comment-list.
PLACES = frozenset("site page global main top bottom left right side primary secondary area bar block box button buttons container item items link links list section signup slot wrap wrapper".split())
COMMENTS = frozenset("comment comments disqus respond".split())
OUTSIDE_ONLY = frozenset({"header"})  # an article's own header is content
ROLES = frozenset("banner navigation complementary contentinfo search form alert dialog menu".split())
CONTENT_ROOTS = frozenset({"article", "main"})
_NAMING = BOILERPLATE | OUTSIDE_ONLY | PLACES
PROSE = frozenset("p ul ol li dl dt dd blockquote pre h1 h2 h3 h4 h5 h6 hr figure figcaption table thead tbody tfoot tr td th caption address details summary".split())
_PATH = 200  # last characters of a path that tell layouts apart

_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
# Most tags: no angle bracket in their names or values.  Without going back, so in time proportional to what is read.
_PLAIN = re.compile(r"<(/?+)([a-zA-Z][^\s/<>\"']*+)(?=[\s/>])([^<>\"']*+(?:\"[^\"<>]*+\"[^<>\"']*+|'[^'<>]*+'[^<>\"']*+)*+)>")
_SPECIAL = re.compile(r"[>\"']")
_CUT_OFF = re.compile(r"<(?:[a-zA-Z/!?][^<]*)?\Z", re.DOTALL)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


class Node:
    """A block element: label for matching, child blocks, and its own text in pieces between the children."""

    __slots__ = ("tag", "label", "dropped", "marked", "children", "items", "number", "shape", "size")

    def __init__(self, tag: str, label: str, dropped: bool, marked: str = ""):
        self.tag, self.label, self.dropped = tag, label, dropped
        self.marked = marked  # by its names: "names", "comments" or not at all
        self.children: list[Node] = []
        self.items: list[str | Node] = []
        self.number, self.shape, self.size = -1, 0, 1  # shape: hash of the labels of the subtree


class _Ends:
    """Where tags end: at the first ``>`` that stands in no quotes.

    What follows a quote or ``>`` does not depend on where the tag began, so each of these places is worked out
    once, and pages of any markup take time in proportion to their length.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.known: dict[int, int] = {}
        self.clear = (0, -1)  # from the first place up to the second one no quote or > stands

    def after(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose names begin at ``at``; -1 if none does."""
        passed, found = [], -1
        while at <= self.last[">"]:
            if not self.clear[0] <= at <= self.clear[1]:
                self.clear = (at, _SPECIAL.search(self.page, at).start())
            place = self.clear[1]
            if place in self.known:
                found = self.known[place]
                break
            passed.append(place)
            mark = self.page[place]
            if mark == ">":
                found = place
                break
            if place == self.last[mark]:
                break  # a quote that nothing closes
            at = self.page.find(mark, place + 1) + 1
        for place in passed:
            self.known[place] = found
        return found


def _tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of all markup in order; comments and declarations without a tag.

    The content of ``RAW`` elements is passed over, to the end of the page where nothing closes them.  A ``<`` that begins
    no markup is text.
    """
    ends, at = None, page.find("<")
    while at >= 0:
        if plain := _PLAIN.match(page, at):
            slash, tag, names = plain.groups()
            tag, start, at = tag.lower(), at, plain.end()
            yield start, at, slash, tag, names
            if tag not in RAW or slash:
                at = page.find("<", at)
                continue
        else:
            ends = ends or _Ends(page)
            stop, slash, tag, names = -1, "", "", ""
            if page.startswith("<!--", at):
                stop = page.find("-->", at + 4)
                stop = len(page) - 1 if stop < 0 else stop + 2
            elif named := _NAME.match(page, at + 1):
                stop = ends.after(named.end())
                if stop >= 0:
                    slash, tag, names = page[at + 1] if page[at + 1] == "/" else "", named[1].lower(), page[named.end() : stop]
            if stop < 0 and page[at + 1 : at + 2] in ("!", "?", "/") and at < ends.last[">"]:
                stop = page.find(">", at)
            if stop < 0:
                at = page.find("<", at + 1)
                continue
            yield at, stop + 1, slash, tag, names
            at = stop + 1
            if tag not in RAW or slash:
                at = page.find("<", at)
                continue
        close = _RAW_ENDS[tag].search(page, at)
        if close is None:
            yield at, len(page), "", "", ""
            return
        if close.start() > at:
            yield at, close.start(), "", "", ""
        at = close.start()


class _Open(list):
    """The open elements, outermost first, and how many there are of each tag."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.tags: defaultdict[str, int] = defaultdict(int)

    def append(self, node: Node) -> None:
        super().append(node)
        self.tags[node.tag] += 1

    def cut(self, at: int) -> None:
        for node in self[at:]:
            self.tags[node.tag] -= 1
        del self[at:]


def parse(page: str) -> Node:
    """The tree of block elements; inline elements only lend their text."""
    root = Node("#page", "#page", False)
    open_nodes, at = _Open(root), 0
    for start, end, slash, tag, names in _tokens(page):
        if start > at:
            open_nodes[-1].items.append(page[at:start])
        at = end
        if not tag:
            continue
        if slash:
            _close(open_nodes, tag)
        elif tag in INLINE:
            if tag in ("br", "wbr", "img"):
                open_nodes[-1].items.append(" " if tag == "br" else "")
        else:
            _open(open_nodes, tag, names)
    open_nodes[-1].items.append(_CUT_OFF.sub("", page[at:]))
    _drop_marked(root)
    return root


def _drop_marked(root: Node) -> None:
    """Drops what its names mark, but nothing that holds an article or main, or most of the page's text.

    Reader comments may be most of a page and articles themselves: what is marked as comments goes with its articles, unless it
    holds a main or nothing else is left.  Marks that stay tell where else to look for articles first.
    """
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        if not node.dropped:
            waiting.extend(node.children)
    if not any(n.marked for n in order):
        return
    length, roots, mains = {}, set(), set()
    for node in reversed(order):
        length[id(node)] = 0 if node.dropped else sum(len("".join(x.split())) if isinstance(x, str) else length[id(x)] for x in node.items)
    for node in reversed(order):
        if not node.dropped and (node.tag in CONTENT_ROOTS or any(id(n) in roots for n in node.children)):
            roots.add(id(node))
        if not node.dropped and (node.tag == "main" or any(id(n) in mains for n in node.children)):
            mains.add(id(node))
    gone = 0
    for node in order:
        if not node.marked or node.dropped:
            continue
        if node.marked == "names" and 2 * length[id(node)] > length[id(root)]:
            node.marked = ""
        elif id(node) not in roots:
            node.dropped = True
        elif node.marked == "comments" and id(node) not in mains and length[id(node)] < length[id(root)] - gone:
            node.dropped, gone = True, gone + length[id(node)]


def _open(open_nodes: _Open, tag: str, attributes: str) -> None:
    if tag in CLOSES_P and open_nodes.tags["p"]:
        for i in range(len(open_nodes) - 1, 0, -1):
            if open_nodes[i].tag == "p":
                open_nodes.cut(i)
                break
            if open_nodes[i].tag in STOPS:
                break
    closes = CLOSES_OWN.get(tag)
    if closes and any([open_nodes.tags[t] for t in closes]):
        for i in range(len(open_nodes) - 1, 0, -1):
            if open_nodes[i].tag in closes:
                open_nodes.cut(i)
                break
            if open_nodes[i].tag in STOPS:
                break
    names, words, role = set(), set(), ""
    for name, *values in _NAMES.findall(attributes) if "=" in attributes else ():
        value = "".join(values).lower()
        if name.lower() == "role":
            role = value.strip()
            continue
        for whole in value.split():
            parts = {x for x in re.split(r"[^a-z0-9]+", whole) if x and not x.isdigit()}
            names.update(parts)
            if parts <= _NAMING:
                words.update(parts - PLACES)
    inside = open_nodes.tags["article"] > 0 or open_nodes.tags["main"] > 0
    by_name = set() if tag in ("html", "body", "article", "main") else words & BOILERPLATE
    if role in ROLES and tag not in ("html", "body", "article", "main"):
        by_name.add(role)
    if not inside and tag not in ("html", "body"):
        by_name |= words & OUTSIDE_ONLY
    marked = "" if not by_name else "comments" if by_name <= COMMENTS else "names"
    node = Node(tag, f"{tag}.{'.'.join(sorted(names))}", tag in DROPPED or tag == "footer" or (tag in OUTSIDE_ONLY and not inside), marked)
    open_nodes[-1].children.append(node)
    open_nodes[-1].items.append(node)
    if tag not in VOID:
        open_nodes.append(node)


def _close(open_nodes: _Open, tag: str) -> None:
    if tag in INLINE or not open_nodes.tags[tag]:
        return
    for i in range(len(open_nodes) - 1, 0, -1):
        if open_nodes[i].tag == tag:
            open_nodes.cut(i)
            return


def numbered(root: Node) -> Node:
    """The tree with its nodes numbered in page order, and the shape and size of each subtree."""
    waiting, order = [root], []
    while waiting:
        node = waiting.pop()
        node.number = len(order)
        order.append(node)
        waiting.extend(reversed(node.children))
    for node in reversed(order):
        node.shape = hash((node.label, *[n.shape for n in node.children]))
        node.size = 1 + sum([n.size for n in node.children])
    return root


def match(page: Node, reference: Node) -> dict[int, int]:
    """Simple tree matching: numbers of ``page``'s nodes to those of ``reference``, both ``numbered``.

    Pairs are worked out bottom-up from an explicit stack, once per pair of shapes.
    """
    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def weight(a: Node, b: Node) -> int | None:
        if a.label != b.label:
            return 0
        if a.shape == b.shape:
            return a.size
        if not a.children or not b.children:
            return 1
        found = known.get((a.shape, b.shape))
        return found and found[0]

    waiting = [(page, reference)]
    while waiting:
        a, b = waiting[-1]
        if weight(a, b) is not None:
            waiting.pop()
            continue
        low, high = _equal_ends(a.children, b.children)
        left, right = a.children[low : len(a.children) - high], b.children[low : len(b.children) - high]
        ours, theirs = {n.shape: n for n in left}, {n.shape: n for n in right}
        weights = {(x, y): weight(m, n) for x, m in ours.items() for y, n in theirs.items()}
        missing = [(ours[x], theirs[y]) for (x, y), found in weights.items() if found is None]
        if missing:
            waiting.extend(missing)
            continue
        waiting.pop()
        total, pairs = _best_pairs([n.shape for n in left], [n.shape for n in right], weights)
        ends = [(i, i) for i in range(low)] + [(len(a.children) - i, len(b.children) - i) for i in range(1, high + 1)]
        total += 1 + sum(a.children[i].size for i, _ in ends)
        known[a.shape, b.shape] = total, [*ends, *((i + low, j + low) for i, j in pairs)]

    out: dict[int, int] = {}
    both = [(page, reference)] if page.label == reference.label else []
    while both:
        a, b = both.pop()
        if a.shape == b.shape:
            out.update(zip(range(a.number, a.number + a.size), range(b.number, b.number + b.size), strict=True))
            continue
        out[a.number] = b.number
        if a.children and b.children:
            both.extend((a.children[i], b.children[j]) for i, j in known[a.shape, b.shape][1])
    return out


def _equal_ends(left: list[Node], right: list[Node]) -> tuple[int, int]:
    """How many subtrees at the front and at the end are equal; these always belong to a largest match."""
    most, low, high = min(len(left), len(right)), 0, 0
    while low < most and left[low].shape == right[low].shape:
        low += 1
    while high < most - low and left[-1 - high].shape == right[-1 - high].shape:
        high += 1
    return low, high


def _best_pairs(left: list[int], right: list[int], weights: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """Largest total weight of order-keeping pairs of two lists of shapes, and the pairs' places.

    One row of the table is kept, and two bits of each cell for the way back.
    """
    if not left or not right:
        return 0, []
    kinds = {y: k for k, y in enumerate(dict.fromkeys(right))}
    of = np.array([kinds[y] for y in right])
    rows = {x: np.array([weights[x, y] for y in kinds], dtype=np.int64)[of] for x in set(left)}
    above = np.zeros(len(right) + 1, dtype=np.int64)
    paired, lifted = [], []
    for x in left:
        row = rows[x]
        here = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + row), out=here[1:])
        paired.append(np.packbits((row > 0) & (here[1:] == above[:-1] + row)))
        lifted.append(np.packbits(here[1:] == above[1:]))
        above = here
    pairs, i, j = [], len(left) - 1, len(right) - 1
    while i >= 0 and j >= 0:
        byte, bit = j >> 3, 128 >> (j & 7)
        if paired[i][byte] & bit:
            pairs.append((i, j))
            i, j = i - 1, j - 1
        elif lifted[i][byte] & bit:
            i -= 1
        else:
            j -= 1
    return int(above[-1]), pairs


def blocks(root: Node) -> list[tuple[int, str]]:
    """(node number, text) of each block outside dropped elements, in page order; inside articles if there are any."""
    roots = _content_roots(root) or [root]
    out: list[tuple[int, str]] = []
    for top in roots:
        waiting: list = [top]
        while waiting:
            item = waiting.pop()
            if isinstance(item, tuple):
                out.append(item)
                continue
            if item.dropped:
                continue
            steps: list = []
            pieces: list[str] = []
            for part in [*item.items, None]:
                if isinstance(part, str):
                    pieces.append(part)
                    continue
                text = " ".join(html_text.unescape("".join(pieces)).split())
                pieces = []
                if text:
                    steps.append((item.number, text))
                if part is not None:
                    steps.append(part)
            waiting.extend(reversed(steps))
    return out


def _content_roots(root: Node) -> list[Node]:
    """Outermost articles outside dropped and marked elements if they hold ``ARTICLES`` of the text around them, or else main elements.

    Around them is the main element, or the page; a card or teaser beside the story is no reason to drop the story.
    """
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        if not node.dropped:
            waiting.extend(reversed(node.children))
    mains = _outermost(root, "main")
    articles = _outermost(root, "article")
    if not articles:
        return mains
    length: dict[int, int] = {}
    for node in reversed(order):
        length[id(node)] = 0 if node.dropped else sum([len(x.strip()) if isinstance(x, str) else length[id(x)] for x in node.items])
    around = sum(length[id(n)] for n in mains or [root])
    if sum(length[id(n)] for n in articles) >= ARTICLES * around:
        return articles
    return mains


def _outermost(root: Node, tag: str) -> list[Node]:
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.dropped or node.marked:
            continue
        if node.tag == tag:
            found.append(node)
        else:
            waiting.extend(reversed(node.children))
    return found


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, steady: float = STEADY) -> DataFrame:
    """page_id, url and the main text of every page."""
    ship(pages.sparkSession)
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), "html").withColumn("signature", F.pandas_udf(_signatures, "struct<layout:long,shape:long>")("html"))
    rows = rows.select("page_id", "url", "host", "html", "signature.*")
    named = rows.filter(F.col("page_id").isNotNull() & F.col("html").isNotNull())
    # Written, so that its size is known and pages are not shuffled to meet a few rows.
    shapes = cut_lineage(named.groupBy("host", "layout", "shape").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("page_id")))
    commonest = F.min(F.struct(-F.col("n"), F.col("page_id")))["page_id"].alias("page_id")
    of_host = shapes.groupBy("host").agg(commonest)
    several = shapes.groupBy("host").agg(F.count_distinct("layout").alias("layouts")).filter("layouts > 1")
    of_layout = shapes.join(several, "host", "left_semi").groupBy("host", "layout").agg(commonest, F.sum("n").alias("n"))
    of_layout = cut_lineage(of_layout.filter(F.col("n") >= min_pages).select("host", "layout", "page_id"))
    chosen = cut_lineage(of_host.union(of_layout.select("host", "page_id")).distinct())
    # Signatures are not used here, so pages are not parsed for it.
    html = named.select("host", "page_id", "html").join(chosen, ["host", "page_id"], "left_semi").groupBy("host", "page_id").agg(F.min("html").alias("html"))
    html = cut_lineage(html)
    of_host = cut_lineage(html.join(of_host, ["host", "page_id"]).select("host", F.col("html").alias("reference")))
    of_layout = cut_lineage(html.join(of_layout, ["host", "page_id"]).select("host", "layout", F.col("html").alias("own_reference")))
    met = rows.join(of_host, "host", "left").join(of_layout, ["host", "layout"], "left")
    found = cut_lineage(met.mapInPandas(_align, "page_id long, url string, host string, layout long, content string, blocks array<struct<node:int,own:int,text:string>>"))
    template = cut_lineage(_templates(found, ["host"], "node", min_pages, steady))
    own = cut_lineage(_templates(found.filter("layout is not null"), ["host", "layout"], "own", min_pages, steady).withColumnRenamed("template", "own_template"))
    left = found.join(template, "host", "left").join(own, ["host", "layout"], "left")
    for known, node in (("template", "node"), ("own_template", "own")):
        varying = F.filter("blocks", lambda b: ~F.array_contains(known, _said(b, node)))  # noqa: B023
        left = left.withColumn("blocks", F.when(F.col(known).isNull(), F.col("blocks")).otherwise(varying))
    text = F.array_join(F.transform("blocks", lambda b: b["text"]), "\n")
    return left.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def _templates(found: DataFrame, group: list[str], node: str, min_pages: int, steady: float) -> DataFrame:
    """For each group the hashes of (node, text) pairs that nearly all of its distinct pages have."""
    said = F.array_distinct(F.transform("blocks", lambda b: F.struct(b[node].alias("node"), _said(b, node).alias("said"))))
    distinct = found.groupBy(*group, "content").agg(F.min(said).alias("said"))
    pairs = distinct.select(*group, F.inline("said")).groupBy(*group, "node", "said").agg(F.count(F.lit(1)).alias("n"))
    # Texts too rare for any template are one row per node before anything meets by group.
    often = F.when(F.col("n") >= min_pages * steady, F.col("said"))
    pairs = pairs.groupBy(*group, "node", often.alias("said")).agg(F.sum("n").alias("n"))
    sizes = cut_lineage(found.groupBy(*group).agg(F.count_distinct("content").alias("pages")).filter(F.col("pages") >= min_pages))
    is_template = (F.col("node") >= 0) & F.col("said").isNotNull() & (F.col("n") >= F.col("pages") * steady)
    nodes = pairs.join(sizes, group).groupBy(*group, "pages", "node").agg(
        F.collect_list(F.when(is_template, F.col("said"))).alias("steady"), F.sum(F.when(~is_template, F.col("n"))).alias("other")
    )
    # A slot has other texts on more pages than a few deviating ones.
    judged = nodes.groupBy(*group).agg(
        F.flatten(F.collect_list("steady")).alias("template"), F.max(F.col("other") > F.col("pages") * (1 - steady)).alias("varies")
    )
    return judged.filter((F.size("template") > 0) & F.col("varies")).select(*group, "template")


def _said(block: Column, node: str) -> Column:
    return F.xxhash64(block[node], block["text"])


def signature(root: Node) -> tuple[int, int]:
    """Numbers of the page's layout and of its shape, the set of all its labels.

    The layout is the set of labelled paths outside articles and dropped elements: every block where
    the page first branches, below that blocks that have a name or are no prose.
    """
    top, above = root, ""
    while top.tag not in CONTENT_ROOTS:
        below = [n for n in top.children if not n.dropped]
        if len(below) != 1:
            break
        top, above = below[0], f"{above}/{below[0].label}"[-_PATH:]
    layout, shape = {above}, set()
    waiting = [(root, None)]
    while waiting:
        node, path = waiting.pop()
        shape.add(node.label)
        if node is top:
            path = above
        elif path is not None:
            known = node.tag not in PROSE or node.label != f"{node.tag}." or path == above
            path = f"{path}/{node.label}"[-_PATH:] if known else None
            if known:
                layout.add(path)
        inner = None if node.tag in CONTENT_ROOTS else path
        waiting.extend((n, inner) for n in node.children if not n.dropped)
    numbers = [hashlib.blake2b("\n".join(sorted(x)).encode("utf-8", "surrogatepass"), digest_size=8).digest() for x in (layout, layout | {"", *shape})]
    return tuple(int.from_bytes(x, "big", signed=True) for x in numbers)


def _signatures(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([signature(parse(page or "")) for page in html], columns=["layout", "shape"], dtype="int64")


_references: dict[str, Node] = {}


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for page, *references in zip(batch["html"], batch["reference"], batch["own_reference"], strict=True):
            tree = numbered(parse(page or ""))
            said = blocks(tree)
            host, own = references
            matched = match(tree, _reference(host)) if host is not None else {}
            nearer = matched if own == host else match(tree, _reference(own)) if own is not None else {}
            content = hashlib.md5("\n".join(text for _, text in said).encode("utf-8", "surrogatepass")).hexdigest()
            out.append((content, [{"node": matched.get(number, -1), "own": nearer.get(number, -1), "text": text} for number, text in said]))
        frame = batch[["page_id", "url", "host", "layout"]].astype({"page_id": "Int64", "layout": "Int64"})
        frame["layout"] = frame["layout"].where(batch["own_reference"].notna())
        yield frame.assign(content=[c for c, _ in out], blocks=[b for _, b in out])


def _reference(page: str) -> Node:
    key = hashlib.md5(page.encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _references:
        if len(_references) >= _KNOWN_TREES:
            _references.clear()
        _references[key] = numbered(parse(page))
    return _references[key]
