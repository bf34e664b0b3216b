"""Main text of pages by a tree-structured graphical model over DOM nodes."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from merkmal.llm.common import read_table, small_batches
from merkmal.llm.labelled_pages import PAGES

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
             "time tt u var".split())
SILENT = set("script style template noscript head title textarea select button iframe object svg math audio video canvas datalist".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
CLOSES_P = set("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
               "main menu nav ol p pre section table ul".split())
SECTIONS = set("article aside div footer form header main nav section body html".split())
ALPHA = 0.1


class Tree(HTMLParser):
    """Block elements as nodes (parents before children) and text runs with their node.

    Inline elements belong to the block around them. Silent elements leave no
    text. Missing end tags are closed as browsers do for paragraphs and items.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.marks, self.main = ["#root"], [-1], [()], [None]
        self.words, self.linked = [0], [0]
        self.runs: list[tuple[int, list[str]]] = []
        self.open: list[tuple[str, int]] = []
        self.node, self.silent, self.links = 0, 0, 0
        self.feed(html)
        self.close()

    def _pop(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[depth:]
        self.node = self.open[-1][1] if self.open else 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_open({"p"}, {"article", "body", "div", "section", "td", "th", "li", "main", "blockquote", "table"})
        if tag in ITEMS:
            self._close_open(ITEMS[tag], HOLDERS[tag])
        if tag in VOID:
            if tag in ("br", "hr"):
                self.handle_data("\n")
            return
        if tag not in INLINE and tag not in SILENT and not self.silent:
            values = dict(attrs)
            marks = re.findall(r"[a-z]+", f"{values.get('class') or ''} {values.get('id') or ''} {values.get('role') or ''}".lower())
            self.tags.append(tag)
            self.parents.append(self.node)
            self.marks.append(tuple(sorted(set(marks))))
            self.main.append(values.get("data-main"))
            self.words.append(0)
            self.linked.append(0)
            self.node = len(self.tags) - 1
        self.silent += tag in SILENT
        self.links += tag == "a"
        self.open.append((tag, self.node))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash means nothing but on void elements

    def _close_open(self, tags: set[str], until: set[str]) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth][0]
            if tag in tags:
                self._pop(depth)
                return
            if tag in until:
                return

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._pop(depth)
                return
            if tag in INLINE and self.open[depth][0] not in INLINE:
                return

    def handle_data(self, data):
        if self.silent or not data:
            return
        if not self.runs or self.runs[-1][0] != self.node:
            self.runs.append((self.node, []))
        self.runs[-1][1].append(data)
        n = len(data.split())
        self.words[self.node] += n
        self.linked[self.node] += n if self.links else 0


def features(tree: Tree) -> list[list[str]]:
    """Features of each node: tag, class and id words, size and link share of its subtree."""
    words, linked = list(tree.words), list(tree.linked)
    for i in range(len(tree.tags) - 1, 0, -1):
        words[tree.parents[i]] += words[i]
        linked[tree.parents[i]] += linked[i]
    out = []
    for i, tag in enumerate(tree.tags):
        share = linked[i] / words[i] if words[i] else 0.0
        own = [f"tag={tag}", "size=" + ("none" if not words[i] else "some"), "links=" + ("most" if share > 0.6 else "few")]
        out.append(own + [f"mark={m}" for m in tree.marks[i]])
    return out


def kind(tag: str) -> str:
    """Edge class of a child: section elements change the topic more often than blocks do."""
    return tag if tag in SECTIONS else "block"


def labels(tree: Tree) -> list[int]:
    """Content labels of a training page: inherited from the nearest marked ancestor."""
    out = [0] * len(tree.tags)
    for i in range(1, len(tree.tags)):
        out[i] = out[tree.parents[i]] if tree.main[i] is None else int(tree.main[i])
    return out


def fit(pages: list[str]) -> dict:
    """Log potentials from labelled pages, smoothed counts in closed form.

    Node potentials are log likelihood ratios of features; edge potentials are
    log P(child label | parent label) per edge class.
    """
    totals, seen, edges = [0, 0], {}, {}
    for page in pages:
        tree = Tree(page)
        y = labels(tree)
        for i, names in enumerate(features(tree)):
            totals[y[i]] += 1
            for name in names:
                seen.setdefault(name, [0, 0])[y[i]] += 1
            if i:
                edges.setdefault(kind(tree.tags[i]), [[0, 0], [0, 0]])[y[tree.parents[i]]][y[i]] += 1
    node = {f: math.log((c[1] + ALPHA) / (totals[1] + 2 * ALPHA)) - math.log((c[0] + ALPHA) / (totals[0] + 2 * ALPHA))
            for f, c in seen.items()}
    edge = {}
    for k, c in edges.items():
        edge[k] = [[math.log((c[p][x] + ALPHA) / (sum(c[p]) + 2 * ALPHA)) for x in (0, 1)] for p in (0, 1)]
    return {"node": node, "edge": edge}


def _add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(tree: Tree, model: dict) -> list[float]:
    """P(content) of every node by one upward and one downward pass of sum-product messages."""
    node, edge = model["node"], model["edge"]
    n = len(tree.tags)
    local = [[0.0, sum(node.get(f, 0.0) for f in names)] for names in features(tree)]
    local[0] = [0.0, -20.0]
    pair = [edge.get(kind(t)) or edge["block"] for t in tree.tags]
    gathered = [list(x) for x in local]  # own potential and the children's messages
    message = [[0.0, 0.0] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        g, e = gathered[i], pair[i]
        message[i] = [_add(g[0] + e[p][0], g[1] + e[p][1]) for p in (0, 1)]
        above = gathered[tree.parents[i]]
        above[0] += message[i][0]
        above[1] += message[i][1]
    belief = [list(x) for x in gathered]
    for i in range(1, n):
        up, e = belief[tree.parents[i]], pair[i]
        rest = [up[0] - message[i][0], up[1] - message[i][1]]
        for x in (0, 1):
            belief[i][x] += _add(rest[0] + e[0][x], rest[1] + e[1][x])
        low = max(belief[i])
        belief[i] = [belief[i][0] - low, belief[i][1] - low]
    return [1.0 / (1.0 + math.exp(min(700.0, b[0] - b[1]))) for b in belief]


def main_text(html: str, model: dict) -> str:
    """Text runs of nodes that are likelier content than not, in page order."""
    tree = Tree(html)
    keep = [p > 0.5 for p in marginals(tree, model)]
    blocks = (" ".join("".join(parts).split()) for node, parts in tree.runs if keep[node])
    return " ".join(b for b in blocks if b)


def extract(pages: DataFrame, model: dict) -> DataFrame:
    """page_id, url, text and n_chars of every page; null html gives an empty text."""

    def run(batches):
        for batch in small_batches(batches):
            texts = [main_text(h, model) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with a model fitted on the labelled pages of this package."""
    return extract(read_table(spark, sf_dir, "pages"), fit(PAGES))
