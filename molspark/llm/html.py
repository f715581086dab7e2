"""Main-text extraction with a tree-structured graphical model.

Every DOM node is content or not. A node's features give its potential, and
each parent-child pair has a potential for the two labels together; sum-product
messages go up and then down the tree and yield each node's marginal. The
weights are trained by the exact likelihood gradient on labelled pages. Text
whose node is more likely content than not is kept, whole and in page order.
"""

from __future__ import annotations

import html as _entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp as _exp
from math import log1p as _log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg math iframe object select".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                    "q s samp small span strike strong sub sup time tt u var").split())
#: A new one of these ends an open one of the same group within the same parent.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
            "thead": {"tr", "td", "th", "thead", "tbody", "tfoot"},
            "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot"},
            "tfoot": {"tr", "td", "th", "thead", "tbody", "tfoot"}}
#: Elements that closing an inner sibling does not reach across.
SCOPE = frozenset("ul ol dl table div article section main body nav aside form td th".split())
#: Block elements that end an open paragraph.
ENDS_P = frozenset(("address article aside blockquote details div dl fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul").split())

_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|itemprop|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    names: frozenset[str] = frozenset()
    hidden: bool = False
    label: str | None = None
    texts: list[tuple[int, str]] = field(default_factory=list)  # (place in page, text)


def _node(tag: str, attributes: str, parent: int) -> Node:
    node = Node(tag, parent)
    if attributes.strip():
        names: list[str] = []
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role", "itemprop"):
                names += [t.lower() for t in _TOKENS.findall(value)]
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" \
                    or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                node.hidden = True
        node.names = frozenset(names)
        if m := re.search(r'data-label="(\w+)"', attributes):
            node.label = m[1]
    return node


def _tag_end(page: str, at: int, unclosed: set[int]) -> int:
    """Place of the ``>`` that ends the tag whose attributes start at ``at``;
    values in quotes, of any length, may hold one. -1 if a quote never closes or
    the page ends before. ``unclosed`` keeps the quotes from which that is known,
    so all calls on a page together are linear in it."""
    met = []
    while m := _QUOTE_OR_END.search(page, at):
        begin = m.start()
        if m[0] == ">":
            return begin
        met.append(begin)
        if begin in unclosed or (at := page.find(m[0], begin + 1) + 1) == 0:
            break
    unclosed.update(met)
    return -1


def parse(page: str | None) -> list[Node]:
    """Nodes of a page in document order, the root first; inline elements but
    links belong to the block around them. Forgiving: unclosed, stray and cut
    tags never raise, and text outside any element belongs to the root."""
    page = page or ""
    nodes, stack, at, place = [Node("#root", -1)], [0], 0, 0
    opened: Counter[str] = Counter()  # open elements by tag
    unclosed: set[int] = set()

    def text(piece: str) -> None:
        nonlocal place
        if piece:
            nodes[stack[-1]].texts.append((place, _entities.unescape(piece)))
            place += 1

    def close(names: frozenset[str] | set[str], stop: frozenset[str] = frozenset()) -> None:
        if not any(opened[x] for x in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if nodes[stack[depth]].tag in names:
                opened.subtract(nodes[i].tag for i in stack[depth:])
                del stack[depth:]
                return
            if nodes[stack[depth]].tag in stop:
                return

    end = len(page)
    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            text(page[at:])
            break
        text(page[at:begin])
        if m := _MARKUP.match(page, begin):
            at = m.end()
            continue
        if not (m := _NAME.match(page, begin)):
            text("<")
            at = begin + 1
            continue
        if (stop := _tag_end(page, m.end(), unclosed)) < 0 and (stop := page.find(">", m.end())) < 0:
            stop = end
        attributes, at = page[m.end():stop], stop + 1
        tag = m[1].lower()
        if page[begin + 1] == "/":
            if tag not in INLINE or tag == "a":
                close({tag}, frozenset() if tag != "a" else SCOPE)
            continue
        if tag == "br":
            text("\n")
            continue
        if tag in INLINE and tag != "a" or tag in ("html",):
            continue
        if tag in ENDS_P:
            close({"p"}, SCOPE)
        if tag in SIBLINGS:
            close(SIBLINGS[tag], SCOPE - SIBLINGS[tag] if tag not in ("li", "dt", "dd") else SCOPE)
        if tag == "a":
            close({"a"}, SCOPE)
        if tag == "body":
            close({"head"})
        nodes.append(_node(tag, attributes, stack[-1]))
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if stop or tag in ("script", "style", "textarea", "title"):
                at = stop.end() if stop else end
            continue
        stack.append(len(nodes) - 1)
        opened[tag] += 1
    return nodes


# --- features ---------------------------------------------------------------

#: Names that sites give to parts that are or are not the article.
GOOD = frozenset("article content main body entry post story text prose markdown copy page".split())
BAD = frozenset((
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header head masthead banner footer foot copyright "
    "sidebar aside side widget rail ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
    "promoted cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login search form comment comments commentlist reply replies respond discussion disqus "
    "feedback related recommended recommendations trending popular more share sharing social follow tags tag "
    "pagination pager toolbar toc skip legal disclaimer hidden meta byline author teaser").split())
_TAGS = ("article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure "
         "figcaption a nav header footer aside form button fieldset details summary address body head dialog").split()
_TAG_AT = {t: i for i, t in enumerate(_TAGS)}
_NAMES = ["good", "bad", "hidden", "raw", "empty", "links", "linked", "short", "long", "sentences",
          "sparse", "role_bad", "legal", "bias"]
_WIDTH = len(_TAGS) + len(_NAMES)
#: Groups of parent-child potentials: the child's kind.
_KINDS = ("block", "link", "heading", "item", "frame")
_KIND_AT = ({t: 2 for t in "h1 h2 h3 h4 h5 h6".split()} | {"a": 1} | {t: 3 for t in "li dt dd tr td th".split()}
            | {t: 4 for t in "article main nav header footer aside form body head dialog".split()})


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature rows, kinds, parents, text lengths) of a page's nodes."""
    n = len(nodes)
    parents = np.array([x.parent for x in nodes])
    own = np.array([sum(len(t.strip()) for _, t in x.texts) for x in nodes], float)
    link = np.array([x.tag == "a" for x in nodes])
    total, linked, links = own.copy(), np.where(link, own, 0.0), link.astype(float)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        total[p] += total[i]
        linked[p] += linked[i]
        links[p] += links[i]
    rows = np.zeros((n, _WIDTH))
    base = len(_TAGS)
    for i, x in enumerate(nodes):
        if (t := _TAG_AT.get(x.tag)) is not None:
            rows[i, t] = 1
        if x.names:
            rows[i, base] = bool(x.names & GOOD)
            rows[i, base + 1] = bool(x.names & BAD)
        rows[i, base + 2] = x.hidden
        rows[i, base + 3] = x.tag in RAW
        if x.texts:
            joined = " ".join(t for _, t in x.texts)
            rows[i, base + 9] = min(1.0, len(re.findall(r"[.!?](?:\s|$)", joined)) / 3)
            rows[i, base + 12] = "©" in joined or "all rights reserved" in joined.lower()
    rows[:, base + 4] = total == 0
    rows[:, base + 5] = links > 0
    rows[:, base + 6] = linked / np.maximum(total, 1)
    rows[:, base + 7] = (total > 0) & (total < 25)
    rows[:, base + 8] = np.minimum(1.0, total / 400)
    rows[:, base + 10] = (own == 0) & (total > 0)
    rows[:, base + 13] = 1
    kinds = np.array([_KIND_AT.get(x.tag, 0) for x in nodes])
    return rows, kinds, parents, own


# --- the model --------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``node``: weights of a node's features for content against not.
    ``edge[kind]``: 2 x 2 log potentials of (parent's label, child's label)."""

    node: np.ndarray
    edge: np.ndarray


def marginals(model: Model, rows: np.ndarray, kinds: np.ndarray,
              parents: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sum-product on the tree: (content marginal of each node, joint marginals
    of each node's (parent, own) labels, log partition). Children come after
    their parents, so one sweep from the end goes up and one from the start down."""
    n = len(parents)
    score = rows @ model.node
    belief = [[0.0, float(s)] for s in score]  # node potential plus messages from children
    up = [(0.0, 0.0)] * n
    edge = model.edge.tolist()
    for i in range(n - 1, 0, -1):
        e, (b0, b1) = edge[kinds[i]], belief[i]
        u = (_lse(e[0][0] + b0, e[0][1] + b1), _lse(e[1][0] + b0, e[1][1] + b1))
        up[i] = u
        parent = belief[parents[i]]
        parent[0] += u[0]
        parent[1] += u[1]
    log_z = _lse(*belief[0])
    full = [(0.0, 0.0)] * n  # log marginals
    full[0] = (belief[0][0] - log_z, belief[0][1] - log_z)
    joint = np.zeros((n, 2, 2))
    content = np.empty(n)
    content[0] = np.exp(full[0][1])
    for i in range(1, n):
        e, f, u, (b0, b1) = edge[kinds[i]], full[parents[i]], up[i], belief[i]
        r0, r1 = f[0] - u[0], f[1] - u[1]  # the parent's marginal without this child
        j00, j01, j10, j11 = r0 + e[0][0] + b0, r0 + e[0][1] + b1, r1 + e[1][0] + b0, r1 + e[1][1] + b1
        full[i] = (_lse(j00, j10), _lse(j01, j11))
        joint[i] = ((j00, j01), (j10, j11))
        content[i] = full[i][1]
    content[1:] = np.exp(content[1:])
    joint[1:] = np.exp(joint[1:])
    return content, joint, log_z


def _lse(a: float, b: float) -> float:
    big, small = (a, b) if a > b else (b, a)
    return big + _log1p(_exp(small - big))


def labels(nodes: list[Node]) -> np.ndarray:
    """Labels of a labelled page: ``data-label="content"`` or ``"other"`` on a
    node holds for all below it until the next one; the root is other. Raw
    elements are never content."""
    out = np.zeros(len(nodes))
    for i, x in enumerate(nodes):
        if x.tag in RAW:
            continue
        out[i] = x.label == "content" if x.label else (out[x.parent] if i else 0)
    return out


def train(pages: list[str], rounds: int = 80, rate: float = 0.5, decay: float = 0.002) -> Model:
    """Maximum likelihood on labelled pages by gradient ascent with momentum
    (Adam steps); ``decay`` pulls weights to zero. The pages are a bounded set."""
    data = []
    for page in pages:
        nodes = parse(page)
        rows, kinds, parents, _ = features(nodes)
        data.append((rows, kinds, parents, labels(nodes).astype(int)))
    node, edge = np.zeros(_WIDTH), np.zeros((len(_KINDS), 2, 2))
    first = [np.zeros_like(node), np.zeros_like(edge)]
    second = [np.zeros_like(node), np.zeros_like(edge)]
    for step in range(1, rounds + 1):
        g_node, g_edge = -decay * len(data) * node, -decay * len(data) * edge
        for rows, kinds, parents, y in data:
            content, joint, _ = marginals(Model(node, edge), rows, kinds, parents)
            g_node += rows.T @ (y - content)
            seen = np.zeros_like(joint)
            seen[np.arange(1, len(y)), y[parents[1:]], y[1:]] = 1
            np.add.at(g_edge, kinds[1:], (seen - joint)[1:])
        for k, (w, g) in enumerate(((node, g_node), (edge, g_edge))):
            g = g / len(data)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w += rate * 0.3 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model(node, edge)


def main_text(page: str | None, model: Model) -> str:
    """Content blocks of a page in page order, white space in each turned into
    one space, joined by one space. Empty for null, empty and content-free pages."""
    nodes = parse(page)
    rows, kinds, parents, own = features(nodes)
    if not own.any():
        return ""
    keep = marginals(model, rows, kinds, parents)[0] > 0.5
    for i, x in enumerate(nodes):
        if x.tag == "a" and own[x.parent]:
            keep[i] = keep[x.parent]  # a link inside running text goes with it
    blocks: dict[int, int] = {}
    pieces: list[tuple[int, int, str]] = []
    for i, x in enumerate(nodes):
        blocks[i] = blocks.get(x.parent, i) if x.tag == "a" else i  # links belong to the block around them
        if keep[i]:
            pieces += [(place, blocks[i], t) for place, t in x.texts]
    pieces.sort()
    out: list[str] = []
    last = None
    for _, block, t in pieces:
        if block == last:
            out[-1] += t
        else:
            out.append(t)
            last = block
    return " ".join(t for t in (_SPACE.sub(" ", t).strip() for t in out) if t)


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points); columns of these names
    are replaced. One row out per row in; null html gives an empty text."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def read(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in column:
            yield pd.Series([main_text(p, shared.value) for p in batch], dtype=object)

    return (pages.drop("text", "n_chars").withColumn("text", read(F.col(html)))
            .withColumn("n_chars", F.length("text").cast("long")))
