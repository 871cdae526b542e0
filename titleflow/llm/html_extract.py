"""HTML extraction by a tree-structured graphical model.

Every DOM node has a hidden label: a neutral wrapper, content, or boilerplate.
Unary potentials come from the node's features (class and id words, text size, shares of links and of the page),
parent-child potentials from the labels' transition given the child's tag.
Sum-product messages go up from the leaves and down from the root; the text of
nodes whose content marginal is over one half is kept, in page order.

The potentials are smoothed counts over labelled pages; words and tags that HTML
authors name parts by, but no training page shows, have fixed priors.  ``label_nodes`` labels
pages whose markup names its parts (article, main, nav, footer, class
``comments``, ...); any other labelling function can be given.  Each training
page counts twice, once as it is and once with the naming tags made ``div``
and without class and id, so that the other features are learned as well.
Counting is a Spark aggregation; the model has at most ``2 * FEATURES``
entries per label and tag table, whatever the corpus.

Cases: null or empty html gives an empty text; pages that are plain text, have
unclosed, crossed or stray tags are read as browsers do in the main (a head, svg or
math without an end tag ends at the first tag that cannot stand in it, an unclosed
object with its parent); repeated rows are extracted each; without training pages the priors below decide.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import bound_batches, map_texts, picked, slices

# HTML's own vocabulary.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNSEEN = {"head", "script", "style", "template", "noscript", "title", "iframe", "object", "svg", "math", "canvas", "audio", "video"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
#: What may stand in a head; anything else that starts there ends it.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: Drawings and formulas, the HTML tags that end them, and the parts in which HTML may stand after all.
FOREIGN = {"svg", "math"}
BREAKOUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strike strong sub sup table tt u ul var".split()
)
WITH_HTML = {"foreignobject", "desc", "title", "annotation-xml", "mi", "mo", "mn", "ms", "mtext"}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "select", "article", "section", "div"}
OUT_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "textarea", "menu", "dialog", "label", "input"}
IN_TAGS = {"article", "main"}
OUT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice notices alert "
    "sidebar side widget comment comments reply replies discussion disqus nav navbar navigation menu breadcrumb breadcrumbs header masthead "
    "footer copyright related share sharing social popup modal subscribe newsletter signup login search form pagination pager toolbar tags".split()
)
IN_WORDS = set("article content main post entry story body text".split())
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
IN_ROLES = {"main", "article"}

FEATURES = 1 << 12
SMOOTH = 0.5
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Node:
    tag: str
    parent: int
    words: list[str] = field(default_factory=list)  # of class, id and role
    roles: set[str] = field(default_factory=set)
    own: int = 0  # characters of text in the node but not in blocks below
    text: int = 0  # with those
    linked: int = 0  # of these, in links


class Tree(HTMLParser):
    """The block nodes in page order, and the text runs as (node, text); None ends a block.

    Inline elements are no nodes: their text is their block's.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#root", -1)]
        self.runs: list[tuple[int, str | None]] = []
        self.open: list[tuple[str, int]] = [("#root", 0)]  # tag, node that holds its text
        self.unseen = self.links = 0
        self.feed(html)
        self.close()
        for node in reversed(self.nodes):
            node.text += node.own
            if node.parent >= 0:
                up = self.nodes[node.parent]
                up.text, up.linked = up.text + node.text, up.linked + node.linked

    def _pop_to(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"
        del self.open[depth:]

    def _close_implied(self, tag: str) -> None:
        ends = CLOSES.get(tag)
        for d in range(len(self.open) - 1, 0, -1):
            t = self.open[d][0]
            if ends:
                if t in ends:
                    return self._pop_to(d)
                if t in SCOPE:
                    return None
            elif t == "p":  # a block ends an open paragraph
                return self._pop_to(d)
            elif t not in INLINE:
                return None
        return None

    def _close_unseen(self, tag: str) -> None:
        """A head, drawing or formula without its end tag ends where a tag begins that cannot stand in it."""
        if tag in BREAKOUT:
            at = 0
            for d in range(len(self.open) - 1, 0, -1):
                if self.open[d][0] in WITH_HTML:
                    break
                at = d if self.open[d][0] in FOREIGN else at
            if at:
                self._pop_to(at)
        if tag == "body":
            heads = [d for d, (t, _) in enumerate(self.open) if t == "head"]
            if heads:
                self._pop_to(heads[0])
        elif tag not in IN_HEAD and self.open[-1][0] == "head":
            self._pop_to(len(self.open) - 1)

    def handle_starttag(self, tag, attrs):
        self._close_unseen(tag)
        if tag not in INLINE:
            if tag not in VOID:
                self._close_implied(tag)
            self.runs.append((0, None))
        if tag in VOID:
            return
        self.unseen += tag in UNSEEN
        self.links += tag == "a"
        if tag in INLINE:
            self.open.append((tag, self.open[-1][1]))
            return
        node = Node(tag, self.open[-1][1])
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                words = [w for w in _SPLIT.split(value.lower()) if w]
                node.words += words
                if name == "role":
                    node.roles.update(words)
        self.open.append((tag, len(self.nodes)))
        self.nodes.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.runs.append((0, None))
        for d in range(len(self.open) - 1, 0, -1):
            if self.open[d][0] == tag:
                return self._pop_to(d)
        return None

    def handle_data(self, data):
        if self.open[-1][0] == "head" and data.strip(" \t\n\r\f"):  # text cannot stand in a head either
            self._pop_to(len(self.open) - 1)
        if not self.unseen and data:
            at = self.open[-1][1]
            size = len(data.strip())
            self.runs.append((at, data))
            self.nodes[at].own += size
            self.nodes[at].linked += size if self.links else 0


NEUTRAL, CONTENT, BOILERPLATE = 0, 1, 2
LABELS = (NEUTRAL, CONTENT, BOILERPLATE)


def label_nodes(tree: Tree) -> list[int] | None:
    """The label of each node by the part of the page that its markup names; None if the page names no content."""
    labels = [NEUTRAL]
    for node in tree.nodes[1:]:
        up = labels[node.parent]
        words = set(node.words)
        if up == BOILERPLATE or node.tag in OUT_TAGS or words & OUT_WORDS or node.roles & OUT_ROLES:
            labels.append(BOILERPLATE)
        elif up == CONTENT or node.tag in IN_TAGS or node.roles & IN_ROLES:
            labels.append(CONTENT)
        else:
            labels.append(NEUTRAL)
    return labels if CONTENT in labels else None


def features(node: Node, page_size: int, named: bool = True) -> list[str]:
    """Bins of the node's own text together with its share of links, and of its share of the page; class and id words."""
    density = node.linked / node.text if node.text else 0.0
    out = [f"own{min(node.own, 2000).bit_length()}-link{round(density * 4)}", f"share{round(8 * node.text / max(page_size, 1))}"]
    if named:
        out += [f"w:{w}" for w in dict.fromkeys(node.words)]
    return out


def tag_of(node: Node, named: bool = True) -> str:
    return node.tag if named or node.tag not in OUT_TAGS | IN_TAGS else "div"


def slot(feature: str) -> int:
    return crc32(feature.encode()) % FEATURES


Triple = tuple[float, float, float]


@dataclass
class Potentials:
    """unary[slot]: a triple over labels; edge[tag slot]: for each parent label the child's triple."""

    unary: dict[int, Triple]
    edge: dict[int, tuple[Triple, Triple, Triple]]


#: Edge potentials of tags never seen in training, by parent label: parts keep their label, boilerplate nearly always.
DEFAULT_EDGE: tuple[Triple, Triple, Triple] = ((0.6, 0.2, 0.2), (0.01, 0.9, 0.09), (0.005, 0.005, 0.99))
NAMED_OUT: Triple = (1e-7, 1e-7, 1.0)
NAMED_IN: Triple = (0.2, 1.0, 0.05)
NEVER = 1e-30
#: The features of a page's nodes say much the same; each counts as this share of an independent one.
TEMPER = 0.3


def _scaled(x: list[float]) -> list[float]:
    top = max(x)
    return [max(v / top, NEVER) for v in x]


def marginals(tree: Tree, model: Potentials) -> list[float]:
    """P(content) of every node: sum-product with one message up and one down each edge."""
    nodes = tree.nodes
    n = len(nodes)
    below: list[list[float]] = []  # unary times the messages of the children so far
    edges = []
    for node in nodes:
        u = [1.0, 1.0, 1.0]
        for f in features(node, nodes[0].text):
            p = model.unary.get(slot(f))
            if p:
                u = [u[0] * p[0], u[1] * p[1], u[2] * p[2]]
        below.append(_scaled(u))
        edges.append(model.edge.get(slot(tag_of(node)), DEFAULT_EDGE))
    up: list[list[float]] = [[1.0, 1.0, 1.0]] * n
    for i in range(n - 1, 0, -1):
        b0, b1, b2 = below[i]
        up[i] = _scaled([e[0] * b0 + e[1] * b1 + e[2] * b2 for e in edges[i]])
        p = nodes[i].parent
        below[p] = _scaled([x * y for x, y in zip(below[p], up[i])])
    out = [0.0] * n
    down: list[list[float]] = [[1.0, 0.5, 0.1]] * n  # the root is mostly a wrapper
    for i in range(n):
        if i:
            p = nodes[i].parent
            # All that the parent knows but for what this child told it.
            q = [b * d / m for b, d, m in zip(below[p], down[p], up[i])]
            e0, e1, e2 = edges[i]
            down[i] = _scaled([q[0] * e0[k] + q[1] * e1[k] + q[2] * e2[k] for k in LABELS])
        z = [b * d for b, d in zip(below[i], down[i])]
        out[i] = z[CONTENT] / sum(z)
    return out


def page_text(html: str, model: Potentials) -> str:
    """The kept text: white space inside a block as one space, blocks joined by one."""
    if not html:
        return ""
    tree = Tree(html)
    content = marginals(tree, model)
    pieces = [" " if text is None else text for node, text in tree.runs if text is None or content[node] > 0.5]
    return " ".join("".join(pieces).split())


def _tally(html: str, label: Callable[[Tree], list[int] | None]) -> Counter:
    """Counts (kind, slot, parent label, label) of a labelled page, named and unnamed."""
    tree = Tree(html)
    labels = label(tree)
    out: Counter = Counter()
    if labels is None:
        return out
    for node, own in zip(tree.nodes[1:], labels[1:]):
        for named in (True, False):
            out[1, slot(tag_of(node, named)), labels[node.parent], own] += 1
            for f in features(node, tree.nodes[0].text, named):
                out[0, slot(f), -1, own] += 1
    return out


def train(pages: DataFrame, html: str = "html", max_pages: int = 2000, label: Callable[[Tree], list[int] | None] = label_nodes) -> Potentials:
    """Potentials from about ``max_pages`` distinct pages at most, picked by hash."""
    bound_batches(pages.sparkSession)
    chosen = picked(pages.select(F.col(html).cast("string").alias("h")), "h", max_pages)

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for _, texts in slices(batch, "h"):
                for t in texts:
                    counts.update(_tally(t.decode(), label))
        columns = list(zip(*[(*k, v) for k, v in counts.items()])) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["kind", "slot", "up", "label", "n"])

    counted = chosen.mapInArrow(run, "kind bigint, slot bigint, up bigint, label bigint, n bigint")
    rows = counted.groupBy("kind", "slot", "up", "label").agg(F.sum("n").alias("n")).collect()  # bounded by FEATURES
    return potentials({tuple(r)[:4]: r["n"] for r in rows})


def potentials(n: dict[tuple[int, int, int, int], int]) -> Potentials:
    """Smoothed potentials of the counts (kind, slot, parent label, label)."""
    totals = [sum(v for (kind, _, _, own), v in n.items() if kind == 0 and own == k) + SMOOTH * FEATURES for k in LABELS]
    unary: dict[int, Triple] = {}
    for words, prior in ((OUT_WORDS, NAMED_OUT), (IN_WORDS, NAMED_IN)):
        unary |= {slot(f"w:{w}"): prior for w in words}
    for s in {s for kind, s, _, _ in n if kind == 0}:
        seen = [(n.get((0, s, -1, k), 0) + SMOOTH) / totals[k] for k in LABELS]
        prior = unary.get(s, (1.0, 1.0, 1.0))
        unary[s] = tuple((v / max(seen)) ** TEMPER * p for v, p in zip(seen, prior))
    edge = {}
    for tags, prior in ((OUT_TAGS, NAMED_OUT), (IN_TAGS, NAMED_IN)):
        edge |= {slot(t): tuple(tuple(a * b for a, b in zip(row, prior)) for row in DEFAULT_EDGE) for t in tags}
    for s in {s for kind, s, _, _ in n if kind == 1}:
        # Under a wrapper that a tag was seldom seen with, lean on the tag's labels elsewhere; within a part, on the part.
        usual = [sum(n.get((1, s, p, k), 0) for p in LABELS) + SMOOTH for k in LABELS]
        default = edge.get(s, DEFAULT_EDGE)
        rows_of = []
        for p in LABELS:
            prior = [default[p][k] * (usual[k] if p == NEUTRAL else 1.0) for k in LABELS]
            seen = [n.get((1, s, p, k), 0) + 2 * SMOOTH * prior[k] / sum(prior) for k in LABELS]
            rows_of.append(tuple(v / sum(seen) for v in seen))
        edge[s] = tuple(rows_of)
    return Potentials(unary, edge)


def extract(pages: DataFrame, model: Potentials, keep: list[str], html: str = "html") -> DataFrame:
    """Columns ``keep`` and ``main_text``, the main text of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value
        return lambda texts: [[page_text(t.decode(), own) for t in texts]]

    return map_texts(pages, html, keep, [("main_text", "string", pa.string())], make)
