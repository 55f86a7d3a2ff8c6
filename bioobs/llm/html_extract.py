"""Main text of pages by a tree-structured graphical model.

Each block element and each piece of text of a page is a binary variable: content
or not. A node has a potential from its features (tag, words in its class, id and
role, length and links of its text), a parent and child one from how often both
agree. On a tree sum-product is exact: messages go up from the leaves, then down
from the root, and give every node's marginal. Text whose marginal is over one half
is the page's main text. Unwanted elements are ruled out with all below them before,
however much they hold; they send no message to what is around them. An ``article``
or ``main`` elsewhere is content, however many children speak against it. Only where
a page has none elsewhere do those inside unwanted elements (a form around the whole
page) count.

The potentials are trained from labelled pages: those with an ``article`` element,
where content is what lies in it outside of unwanted elements. The sample is bounded
by ``SAMPLE`` pages. Feature weights are fitted by logistic regression towards prior
weights, and only on pieces of text: what length, ending and links say of them.
Weights of elements are the prior's, for a tag that a sample has only in its menus
(``li``) is no evidence in an article.

Defined cases: a missing or empty page has no text; without labelled pages the prior
weights decide alone; repeated pages give repeated rows; columns other than the
three named are not read. Nothing is dropped or capped by size, and work and memory
per page are linear in its length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from bioobs.llm.common import map_rows
from bioobs.llm.html_tree import CONTENT_TAGS, Node, parse_page

# the classifier's documented bound: labelled pages it learns from
SAMPLE = 1_000

# fixed values: element and attribute words that mark parts of a page
UNWANTED_TAGS = frozenset(
    "nav header footer aside form menu dialog button select option input label fieldset noscript object canvas".split()
)
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td dd dt figcaption".split())
UNWANTED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comentarios "
    "commentaires consent cookie cookies discussion disqus footer gdpr header kommentare login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification outbrain paywall popup popups privacy promo promoted promotion "
    "recommended related replies reply respond respondents search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription taboola toolbar toc topbar tracking widget widgets".split()
)
CONTENT_WORDS = frozenset("article articlebody content entry main maintext post story text".split())
_WORDS = re.compile(r"[a-z]+")

# prior weights
PRIOR = {
    "bias": 0.0,
    "content word": 2.0,
    "text tag": 0.5,
    "piece": 0.5,
    "long text": 1.0,
    "short text": -0.3,
    "sentence": 0.5,
    "mostly links": -3.0,
}
PULL = 0.02  # towards the prior
STEPS, RATE = 300, 0.5


def _unwanted(node: Node) -> bool:
    """By tag, name or being hidden. A header within an article is the article's own."""
    if node.hidden or (node.tag in UNWANTED_TAGS and not (node.tag == "header" and node.within)):
        return True
    if not node.names or node.tag in ("html", "body") or node.tag in CONTENT_TAGS:
        return False
    words = UNWANTED_WORDS.intersection(_WORDS.findall(node.names))
    return bool(words - {"header"} if node.within else words)


def ruled_out(nodes: list[Node]) -> list[bool]:
    """Whether a node is unwanted, or in what is unwanted."""
    out = [False] * len(nodes)
    for i, node in enumerate(nodes):
        out[i] = (node.parent >= 0 and out[node.parent]) or _unwanted(node)
    if all(o for n, o in zip(nodes, out) if n.tag in CONTENT_TAGS):
        for i, node in enumerate(nodes):
            above = node.parent >= 0 and out[node.parent] and node.tag not in CONTENT_TAGS
            out[i] = above or _unwanted(node)
    return out


def features(node: Node) -> tuple[str, ...]:
    if node.text is None:
        out = ["bias"]
        if node.tag in TEXT_TAGS:
            out.append("text tag")
        if node.names and not CONTENT_WORDS.isdisjoint(_WORDS.findall(node.names)):
            out.append("content word")
        return tuple(out)
    out = ["piece"]
    if len(node.text) >= 80:
        out.append("long text")
    elif len(node.text) < 25:
        out.append("short text")
    if node.text[-1] in ".!?…:;\"'”»)":
        out.append("sentence")
    if node.linked > 0.5:
        out.append("mostly links")
    return tuple(out)


def place(parent: Node) -> str:
    """Parents that hold a whole page agree less with their children than others."""
    return "page" if parent.tag in ("page", "html", "body") else "inner"


def labels(nodes: list[Node]) -> list[int] | None:
    """1 for content, 0 for the rest; None if the page has no ``article``.

    An element that holds content, and is not unwanted itself, is content.
    """
    if not any(n.tag == "article" for n in nodes):
        return None
    inside = [-o for o in ruled_out(nodes)]
    for i, node in enumerate(nodes):
        if inside[i] < 0:
            continue
        if node.parent >= 0 and inside[node.parent] > 0:
            inside[i] = 1
        elif node.tag == "article":
            inside[i] = 1
    found = [int(s > 0) for s in inside]
    for i in range(len(nodes) - 1, 0, -1):
        if found[i] and inside[nodes[i].parent] >= 0:
            found[nodes[i].parent] = 1
    return found


@dataclass(frozen=True)
class Model:
    """Log-odds by feature, and by place the log-potentials of (parent, child)."""

    weights: dict[str, float]
    pairs: dict[str, tuple[tuple[float, float], tuple[float, float]]]


def _log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _message(above: tuple[float, float], below: tuple[float, float], odds: float) -> float:
    """Log-ratio of two potentials, each summed over a variable with these log-odds."""
    if math.isinf(odds):
        return above[odds > 0] - below[odds > 0]
    return _log_add(above[0], above[1] + odds) - _log_add(below[0], below[1] + odds)


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Log-odds of content for every node, by messages up and down the tree."""
    weight = model.weights.get
    out = ruled_out(nodes)
    belief = [  # from the node and all below it
        -math.inf if o else math.inf if n.tag in CONTENT_TAGS else sum(weight(f, 0.0) for f in features(n))
        for n, o in zip(nodes, out)
    ]
    linked = [i for i in range(1, len(nodes)) if not out[i] and not out[nodes[i].parent]]
    pairs = {i: model.pairs[place(nodes[nodes[i].parent])] for i in linked}
    up = [0.0] * len(nodes)  # log-odds of the parent that the child's subtree adds
    for i in reversed(linked):
        none, some = pairs[i]
        up[i] = _message(some, none, belief[i])
        belief[nodes[i].parent] += up[i]
    for i in linked:
        (aa, ab), (ba, bb) = pairs[i]
        above = belief[nodes[i].parent] - up[i]  # the parent without this subtree
        belief[i] += _message((ab, bb), (aa, ba), above)
    return belief


def main_text(page: str | None, model: Model) -> str:
    nodes = parse_page(page)
    if len(nodes) == 1:
        return ""
    return "\n\n".join(n.text for n, odds in zip(nodes, marginals(nodes, model)) if n.text is not None and odds > 0)


def _pair_potentials(counts: Counter) -> dict[str, tuple[tuple[float, float], tuple[float, float]]]:
    """Smoothed shares; what was never seen stays possible, content below what is not least."""
    out = {}
    for where in ("page", "inner"):
        rows = []
        for parent in (0, 1):
            n = [counts[where, parent, child] for child in (0, 1)]
            base = max(1.0, sum(n))
            floor = (0.001, 0.05)[parent] * base
            total = sum(n) + 2 * floor
            rows.append((math.log((n[0] + floor) / total), math.log((n[1] + floor) / total)))
        out[where] = (rows[0], rows[1])
    return out


def fit(seen: Counter, pairs: Counter) -> Model:
    """``seen`` counts (features, label) of nodes, ``pairs`` (place, parent, child)."""
    names = sorted(set(PRIOR) | {f for own, _ in seen for f in own})
    prior = np.array([PRIOR.get(f, 0.0) for f in names])
    weights = prior.copy()
    if seen:
        column = {f: k for k, f in enumerate(names)}
        rows = sorted(seen)
        x = np.zeros((len(rows), len(names)))
        for r, (own, _) in enumerate(rows):
            x[r, [column[f] for f in own]] = 1
        y = np.array([label for _, label in rows], float)
        share = np.array([seen[r] for r in rows], float)
        share /= share.sum()
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
            weights += RATE * (x.T @ (share * (y - p)) - PULL * (weights - prior))
    return Model(dict(zip(names, weights.tolist())), _pair_potentials(pairs))


def train(pages: list[str]) -> Model:
    seen, pairs = Counter(), Counter()
    for page in pages:
        nodes = parse_page(page)
        truth = labels(nodes)
        if truth is None:
            continue
        out = ruled_out(nodes)
        for i, node in enumerate(nodes):
            if node.text is not None:
                seen[features(node), truth[i]] += 1
            if i and out[i] == out[node.parent]:
                pairs[place(nodes[node.parent]), truth[node.parent], truth[i]] += 1
    return fit(seen, pairs)


def labelled_pages(pages: DataFrame, id_column: str, html_column: str, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` pages with an ``article``, chosen by a hash of their ids."""
    with_label = pages.where(F.instr(F.lower(html_column), "<article") > 0).select(id_column, html_column)
    ids = with_label.select(id_column).distinct().orderBy(F.xxhash64(id_column), id_column).limit(sample)
    chosen = with_label.join(F.broadcast(ids), with_label[id_column].eqNullSafe(ids[id_column]), "left_semi")
    return [r[0] for r in chosen.select(html_column).distinct().limit(sample).collect()]


def extract_pages(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    model = train(labelled_pages(pages, id_column, html_column))

    def row(page_id, url, page):
        text = main_text(page, model)
        return page_id, url, text, len(text)

    schema = f"{id_column} long, {url_column} string, text string, n_chars long"
    return map_rows(pages, [id_column, url_column, html_column], row, schema, chunk=128)
