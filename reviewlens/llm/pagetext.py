"""Main text of web pages: boosted trees over features of DOM nodes, and a decoding that respects the tree.

Pages bring no labels. The teacher is their own markup: on pages with an article, a main part or a part named like
one, what stands in it is text and what stands in navigation, headers, footers, asides, forms and parts with telling
names is not. A part around the text (a form around the page, a layout "has-sidebar") says nothing of what is in it: the
text in it stays text. Each page teaches several times: as it is; with tags and names hidden, so the trees also learn what
text looks like by its density, its links, its place and its neighbours, and can judge pages without telling markup; with
some of its text once more in a small part named like no text, beside the text and in it; and with its text, or all of it,
inside a part named like no text. So the trees learn from the size of a part how far such a name is to be believed.

A node's score is what the trees say, less a penalty for a tag or names of its own that tell of no text; the penalty is
less than the trees can say, and what stands under the node has none. Keeping a node is worth its score for the letters
under it plus what its children are worth; a node is kept if that is positive and its parent is kept. So no text is kept
inside a part that is dropped, and a part is dropped as a whole only if all of it together is not worth keeping. A part
that is text by its own score and by what markup tells, but of which no block would be left, contradicts itself: then its
own score decides, and all in it stays but what tells of no text.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import slices, stored
from reviewlens.llm.dom import Tree, parse, text_of

# Words in class, id and role attributes that tell what a part of a page is for.
TEXT_NAMES = frozenset("article articlebody body content entry main maincontent post story text".split())
COMMENT_NAMES = frozenset("comment comments disqus discussion replies reply respond responses".split())
OTHER_NAMES = frozenset((
    "ad ads adv advert advertisement aside author banner banners bio breadcrumb breadcrumbs byline complementary consent "
    "contentinfo cookie cookies cta dialog footer footnav gdpr header login masthead menu meta modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promoted promotion rail recommended "
    "related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser "
    "toolbar topbar widget widgets").split())
_NO_TEXT = frozenset({"sidebar"})  # the names of parts that lessons add
TEXT_TAGS = frozenset({"article", "main"})
OTHER_TAGS = frozenset("nav header footer aside form dialog menu search fieldset".split())

_GROUPS = (
    frozenset({"h1", "h2", "h3", "h4", "h5", "h6"}), frozenset({"p", "pre", "blockquote"}), frozenset({"ul", "ol", "dl"}),
    frozenset({"li", "dt", "dd"}), frozenset({"table", "tr", "td", "th", "tbody", "thead"}),
    frozenset({"figure", "figcaption"}), TEXT_TAGS, frozenset({"section"}), OTHER_TAGS)
_SHAPES = 18
_TOLD = _SHAPES + 6  # the first feature that says what tags and names tell
WIDTH = _SHAPES + len(_GROUPS) + 9
_SURE = 4.0  # what the trees say about a node counts no more than this
_STOPS = frozenset(".,;:!?")


@dataclass(frozen=True)
class PageConfig:
    """`fit_pages` bounds the pages that the trees learn from, taken by a hash of the page's key."""

    fit_pages: int = 400
    trees: int = 32
    depth: int = 4
    named: float = 3.0  # what a node's own names weigh, below the 4 that the trees may say
    seed: int = 11


def telling(names: frozenset[str]) -> bool:
    return not names.isdisjoint(OTHER_NAMES) or not names.isdisjoint(COMMENT_NAMES)


@dataclass
class Page:
    tree: Tree
    features: np.ndarray
    letters: np.ndarray  # of each node and all under it
    other: np.ndarray  # the node's own tag or names tell of no text
    label: np.ndarray  # a part with text by what tags and names tell


def read_page(html: str | None) -> Page:
    """The tree of a page, the features of its nodes, and what its tags and names tell about each node."""
    return page_of(parse(html, telling))


def page_of(tree: Tree) -> Page:
    n = len(tree.tag)
    parent = np.array(tree.parent)
    own, stops, words = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, text in tree.parts:
        if node >= 0:
            own[node] += len(text)
            words[node] += text.count(" ")
            stops[node] += sum(map(text.count, _STOPS))
    sums = np.stack([own, np.array(tree.linked, dtype=float), stops, words, 1.0 + np.array(tree.inside),
                     np.array([t == "li" for t in tree.tag], dtype=float), (own > 0).astype(float)])
    depth = np.zeros(n)
    place, count, alike = np.zeros(n), np.zeros(n), np.zeros(n)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
        children[parent[i]].append(i)
    for i in range(n - 1, 0, -1):
        sums[:, parent[i]] += sums[:, i]
    letters, linked, stops, words, elements, items, filled = sums
    before, after = np.full(n, -1), np.full(n, -1)
    for own_children in children:
        kinds: dict[str, int] = {}
        for c in own_children:
            kinds[tree.tag[c]] = kinds.get(tree.tag[c], 0) + 1
        for k, c in enumerate(own_children):
            place[c], count[c] = k / len(own_children), len(own_children)
            alike[c] = kinds[tree.tag[c]] / len(own_children)
            if k:
                before[c], after[own_children[k - 1]] = own_children[k - 1], c
    some = np.maximum(letters, 1)
    links = np.minimum(linked / some, 1)
    up = np.maximum(parent, 0)

    def beside(values: np.ndarray, other: np.ndarray) -> np.ndarray:
        return np.where(other >= 0, values[other], -1)

    size = np.log1p(letters)
    shapes = [np.log1p(depth), size, links, np.log1p(letters / elements), 100 * stops / some, own / some,
              letters / max(letters[0], 1), letters / np.maximum(letters[up], 1), place, np.log1p(count), alike,
              np.log1p(words / np.maximum(filled, 1)), items / elements, beside(links, before), beside(links, after),
              beside(size, before), beside(size, after), links[up]]
    groups = [np.array([t in g for t in tree.tag], dtype=float) for g in _GROUPS]
    text = np.array([t in TEXT_TAGS or not names.isdisjoint(TEXT_NAMES) and not telling(names)
                     for t, names in zip(tree.tag, tree.names)])
    other = np.array([t in OTHER_TAGS or telling(names) for t, names in zip(tree.tag, tree.names)])
    comment = np.array([not names.isdisjoint(COMMENT_NAMES) for names in tree.names])
    share = letters / max(letters[0], 1)
    # A part that holds most of the page, and text by its names, is around the text and tells nothing of what is in it.
    holds = text.copy()
    for i in range(n - 1, 0, -1):
        holds[parent[i]] |= holds[i]
    around = other & ~comment & holds & (share >= 0.5)
    told_text, told_other, label_other = text.copy(), other.copy(), other & ~around
    nearest, close = np.where(other, share, 0), text & ~other
    for i in range(1, n):
        up = parent[i]
        told_text[i] |= told_text[up]
        told_other[i] |= told_other[up]
        label_other[i] |= label_other[up]
        if not other[i]:
            nearest[i] = nearest[up]
            close[i] |= close[up]
    told = [text, other, comment, told_text & ~text, told_other & ~other, told_text & ~told_other, told_other, nearest, close]
    features = np.stack([*shapes, *groups, *(t.astype(float) for t in told)], axis=1)
    return Page(tree, features, letters, other, told_text & ~label_other)


def hidden(features: np.ndarray) -> np.ndarray:
    """The features as they would be if all telling tags and names were those of plain blocks."""
    out = features.copy()
    out[:, _TOLD:] = 0
    return out


def plain(tree: Tree) -> Tree:
    """The tree with its telling tags and all names hidden."""
    tags = ["div" if t in TEXT_TAGS or t in OTHER_TAGS else t for t in tree.tag]
    return replace(tree, tag=tags, names=[frozenset()] * len(tags))


def wrapped(tree: Tree, roots: list[int]) -> tuple[Tree, np.ndarray]:
    """The tree with a part named like no text around each of these nodes, and the old number of every node (-1: new)."""
    order: list[int] = []
    heads, place = set(roots), {}
    for i in range(len(tree.tag)):
        if i in heads:
            order.append(-1)
        place[i] = len(order)
        order.append(i)
    parent = [-1 if i == 0 else place[i] - 1 if i in heads else place[tree.parent[i]] if i > 0 else 0 for i in order]
    for i in heads:
        parent[place[i] - 1] = place[tree.parent[i]]

    def moved(values: list, new) -> list:
        return [values[i] if i >= 0 else new for i in order]

    parts = [(place[node] if node >= 0 else node, text) for node, text in tree.parts]
    return Tree(moved(tree.tag, "div"), moved(tree.names, _NO_TEXT), parent, moved(tree.inside, 0),
                moved(tree.linked, 0), parts), np.array(order)


def one_wrapper(tree: Tree) -> tuple[Tree, np.ndarray]:
    """As `wrapped`, with one part around all that the page holds."""
    parts = [(node + 1 if node >= 0 else node, text) for node, text in tree.parts]
    return Tree(["#root", "div", *tree.tag[1:]], [frozenset(), _NO_TEXT, *tree.names[1:]],
                [-1, 0, *(p + 1 for p in tree.parent[1:])], [0, *tree.inside], [0, *tree.linked], parts), np.array(
                    [0, -1, *range(1, len(tree.tag))])


def with_copy(tree: Tree, nodes: list[int], under: int = 0) -> Tree:
    """The tree with a part named like no text under a node that holds these nodes, whole subtrees, once more."""
    n = len(tree.tag)
    place = {i: n + 1 + k for k, i in enumerate(nodes)}
    parts = [*tree.parts, (-1, ""), *((place[i], text) for i, text in tree.parts if i in place), (-1, "")]
    return Tree(
        [*tree.tag, "div", *(tree.tag[i] for i in nodes)], [*tree.names, _NO_TEXT, *(tree.names[i] for i in nodes)],
        [*tree.parent, under, *(place.get(tree.parent[i], n) for i in nodes)], [*tree.inside, 0, *(tree.inside[i] for i in nodes)],
        [*tree.linked, 0, *(tree.linked[i] for i in nodes)], parts)


#: Shares of links that lessons put into the text's own parts, in turn; in the second way its last parts are all links.
_LINK_SHARES = (0.0, 0.0, 0.1, 0.5, 0.25)
_SOURCES = 5


def with_links(tree: Tree, nodes: list[int], sources: bool) -> Tree:
    """The tree with links in these nodes' own text: a share of each in turn, or all of the last fifth and little else."""
    own = [0] * len(tree.tag)
    for node, text in tree.parts:
        if node >= 0:
            own[node] += len(text)
    linked, filled = list(tree.linked), [i for i in nodes if own[i]]
    for k, i in enumerate(filled):
        share = _LINK_SHARES[k % len(_LINK_SHARES)]
        if sources:
            share = 1.0 if k >= len(filled) - max(1, len(filled) // _SOURCES) else share / 2
        linked[i] = max(linked[i], int(share * own[i]))
    return replace(tree, linked=linked)


def lessons(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes with text, in all the ways that a page teaches; none without a text part."""
    with_text = page.letters > 0
    with_text[0] = False
    tree, label = page.tree, page.label
    # A node around the text part is neither: it holds the text and all else.
    around = np.zeros(len(label), dtype=bool)
    for i in np.flatnonzero(label).tolist():
        up = tree.parent[i]
        while up >= 0 and not label[up] and not around[up]:
            around[up] = True
            up = tree.parent[up]
    taken = with_text & ~around
    if not (label & taken).any():
        return np.zeros((0, WIDTH)), np.zeros(0)
    rows, labels = [page.features[taken], hidden(page.features[taken])], [label[taken], label[taken]]
    # A small part with text like the page's own: parts of the text, up to a quarter of it.
    roots = [i for i in np.flatnonzero(label).tolist() if not label[tree.parent[i]]]
    copied: dict[int, None] = {}
    left, whole = sum(page.letters[i] for i in roots) / 4, set(roots)
    for i in range(1, len(label)):
        if tree.parent[i] in copied:
            copied[i] = None
        elif label[i] and taken[i] and i not in whole and page.letters[i] <= left:
            left -= page.letters[i]
            copied[i] = None
    added = 1 + len(copied) if copied else 0
    taught, said = np.append(taken, np.ones(added, dtype=bool)), np.append(label, np.zeros(added, dtype=bool))
    # That part beside the text and in it; all of this as it is, with a wrapper around the text, and with one around all.
    said_text = np.flatnonzero(label).tolist()
    for inner in (tree, plain(tree)):
        # Text has links too, up to whole parts of them where it names its sources.
        for sources in (False, True):
            rows.append(page_of(with_links(inner, said_text, sources)).features[taken])
            labels.append(label[taken])
        for under in (0, roots[0]):
            full = with_copy(inner, list(copied), under) if copied else inner
            for outer, order in ((full, np.arange(len(said))), wrapped(full, roots), one_wrapper(full)):
                old = np.maximum(order, 0)
                kept = (order >= 0) & taught[old]
                rows.append(page_of(outer).features[kept])
                labels.append(said[old][kept])
    return np.concatenate(rows), np.concatenate(labels).astype(float)


# ---------------------------------------------------------------- boosted trees


@dataclass
class Boosted:
    """Trees as arrays, one row per tree: the feature of each node (-1: a leaf), threshold, children, value."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), dtype=np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    left: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), dtype=np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), dtype=np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Twice the margin, as the model defines its probability. If nothing was learned, 1 for every node but those
        in a part told to be no text that holds less than half of the page or is mostly links; -1 for these."""
        if not len(self.feature):
            other = (x[:, -3] > 0) & (x[:, -1] == 0)
            return np.where(other & ((x[:, -2] < 0.5) | (x[:, 2] > 0.5)), -1.0, 1.0)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, left, right, value in zip(
                self.feature, self.threshold, self.left, self.right, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                below = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += value[at]
        return 2 * total


def _exported(model) -> Boosted:
    """The fitted trees, read node by node."""
    trees = []
    for tree, weight in zip(model.trees, model.treeWeights):
        rows: list[list[float]] = []
        waiting = [(tree._call_java("rootNode"), -1, 0)]
        while waiting:
            node, parent, side = waiting.pop()
            here = len(rows)
            if parent >= 0:
                rows[parent][side] = here
            if node.subtreeDepth() == 0:
                rows.append([-1, 0.0, here, here, weight * node.prediction()])
                continue
            split = node.split()
            rows.append([split.featureIndex(), split.threshold(), 0, 0, 0.0])
            waiting += [(node.leftChild(), here, 2), (node.rightChild(), here, 3)]
        trees.append(rows)
    size = max(len(t) for t in trees)
    table = np.array([t + [[-1, 0.0, 0, 0, 0.0]] * (size - len(t)) for t in trees])
    return Boosted(table[:, :, 0].astype(np.int64), table[:, :, 1], table[:, :, 2].astype(np.int64),
                   table[:, :, 3].astype(np.int64), table[:, :, 4])


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", cfg: PageConfig = PageConfig()) -> Boosted:
    """Fit boosted trees to the nodes of at most `cfg.fit_pages` pages.

    Without pages that show text and other parts there is nothing to learn, and nodes are judged by their names alone.
    """
    page = F.col(html).cast("string")
    taken = pages.select(page.alias("html"), F.xxhash64(F.col(key), page).alias("h")).orderBy("h").limit(cfg.fit_pages)
    taken = taken.select("html")

    def run(batches):
        for batch in slices(batches, 64):
            features, label = zip(*(lessons(read_page(h)) for h in batch.column(0).to_pylist()))
            rows = np.concatenate(features)
            bounds = np.arange(0, rows.size + 1, WIDTH)
            yield pa.record_batch(
                [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(rows.ravel())),
                 pa.array(np.concatenate(label))], names=["x", "label"])

    nodes = stored(taken.mapInArrow(run, "x array<double>, label double"), "nodes")
    if nodes.select("label").distinct().count() < 2:
        return Boosted()
    rows = nodes.select(array_to_vector("x").alias("features"), "label").coalesce(8)
    return _exported(GBTClassifier(maxIter=cfg.trees, maxDepth=cfg.depth, seed=cfg.seed).fit(rows))


def decode(page: Page, log_odds: np.ndarray, named: float) -> np.ndarray:
    """Which nodes to keep: the best choice in which every kept node's parent is kept."""
    tree = page.tree
    score = np.clip(log_odds, -_SURE, _SURE) - min(named, _SURE - 1) * page.other
    own = page.letters.copy()
    for i in range(len(own) - 1, 0, -1):
        own[tree.parent[i]] -= page.letters[i]
    worth = score * (own + 0.5 * page.letters)
    worth[0] = score[0] * own[0]
    for i in range(len(worth) - 1, 0, -1):
        worth[tree.parent[i]] += max(worth[i], 0)
    kept = worth > 0
    kept[0] = True
    # The root's own text stands outside all blocks and is judged for itself.
    for i in range(1, len(kept)):
        kept[i] &= kept[tree.parent[i]]
    if score[0] <= 0:
        kept[0] = False
    left = np.where(kept, own, 0)
    for i in range(len(own) - 1, 0, -1):
        left[tree.parent[i]] += left[i]
    saved = np.zeros(len(kept), dtype=bool)
    for i in range(1, len(kept)):
        up = tree.parent[i]
        top = page.label[i] and not page.label[up]
        saved[i] = page.label[i] and (saved[up] or top and score[i] > 0 and left[i] == 0 and page.letters[i] > 0)
        if saved[i] and top:
            while up > 0:
                kept[up], up = True, tree.parent[up]
    return kept | saved


def main_text(pages: DataFrame, model: Boosted, html: str = "html", out: str = "text",
              cfg: PageConfig = PageConfig()) -> DataFrame:
    """Add the main text of every whole page; empty for a null or empty page and where nothing is worth keeping.

    Character references are decoded, white space within a block is one space, blocks are joined by line ends in page
    order. Other columns stay; one named like the new one is replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rest = pages.drop(out) if out != html else pages
    columns, place = rest.columns, rest.columns.index(html)

    def run(batches):
        for batch in slices(batches, 64):
            read = [read_page(h) for h in batch.column(place).cast(pa.string()).to_pylist()]
            odds = shared.value.log_odds(np.concatenate([p.features for p in read]))
            bounds = np.cumsum([0, *(len(p.features) for p in read)])
            texts = [text_of(p.tree.parts, decode(p, odds[a:b], cfg.named))
                     for p, a, b in zip(read, bounds[:-1], bounds[1:])]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*columns, out])

    return rest.mapInArrow(run, rest.withColumn(out, F.lit("").cast("string")).schema)
