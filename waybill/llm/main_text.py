"""Main text of web pages: a tree-structured model over DOM nodes.

Each block element and each run of text in it is a node with a hidden state: ``STRUCTURE`` (holds
content and other things), ``CONTENT`` or ``REST``. Potentials on parent and child and on a node's
own features are trained from labelled pages; sum-product messages up and down the tree give every
run's marginal probability of being content.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, ship

STRUCTURE, CONTENT, REST = range(3)
LABELLED_PAGES = 1000
ROUNDS = 60

# How HTML elements behave.
BLOCKS = frozenset(
    "html body header nav main article section aside footer div p h1 h2 h3 h4 h5 h6 hgroup ul ol li menu dl dt dd "
    "table caption thead tbody tfoot tr td th blockquote pre figure figcaption address form fieldset legend button "
    "select option optgroup details summary dialog center hr".split()
)
UNREAD = frozenset("script style title textarea template noscript iframe object svg math canvas video audio head xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("br img hr input wbr".split())
CLOSED_BY_BLOCK = frozenset("p".split())
SAME_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table select".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>", re.S
)
_NAME_END, _QUOTE_OR_END = re.compile(r"[\s/>]"), re.compile(r"[\"'>]")
_NAMES = re.compile(r"\b(class|id|role|aria-label|itemprop|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LAST_SENTENCE = re.compile(r"[.!?:;\"”»]\s*\Z")


@dataclass
class Page:
    """Nodes in page order, parents first. ``run`` is the text of a text node, None for an element."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    run: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, features: list[str], run: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.features.append(features)
        self.run.append(run)
        self.linked.append(linked)
        return len(self.parent) - 1


def _element_features(tag: str, attributes: str) -> list[str]:
    found = [f"tag {tag}"]
    if attributes:
        for match in _NAMES.finditer(attributes):
            name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
            if name == "hidden" or name == "style" and "none" in value:
                found.append("hidden")
            elif name != "style":
                found += {f"named {t.lower()}" for t in _TOKEN.findall(value)}
    return found


def _size_class(n: int) -> int:
    return min(n.bit_length(), 12)


class Markup:
    """The tags, comments and declarations of a page in order, in time that grows with its length.

    A tag that is never closed would be looked for up to the page's end, and so would every other one
    after it. So after the first of them it is worked out once, from the end of the page backwards,
    behind which places a tag is closed at all.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.signs: list[int] | None = None

    def _look_ahead(self) -> None:
        self.name_ends = [m.start() for m in _NAME_END.finditer(self.html)]
        found = [(m.start(), m[0]) for m in _QUOTE_OR_END.finditer(self.html)]
        self.signs = [place for place, _ in found]
        # Whether a tag is closed after each of these signs: outside quotes, inside either kind.
        plain, double, single = False, False, False
        closed = [False]
        for _, sign in reversed(found):
            if sign == ">":
                plain = True
            elif sign == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            closed.append(plain)
        self.closed = closed[::-1]

    def _may_close(self, start: int) -> bool:
        if start > self.last:
            return False
        if self.signs is None:
            return True
        end = bisect_left(self.name_ends, start + 2)  # behind "</" or the first letter
        behind = self.name_ends[end] if end < len(self.name_ends) else len(self.html)
        return self.closed[bisect_left(self.signs, behind)]

    def next(self, at: int) -> re.Match | None:
        html = self.html
        while (at := html.find("<", at)) >= 0:
            sign = html[at + 1 : at + 2]
            if sign in ("!", "?") and sign:
                return _MARKUP.match(html, at)
            if (sign == "/" or sign.isalpha()) and self._may_close(at):
                if match := _MARKUP.match(html, at):
                    return match
                if self.signs is None and sign != "/":
                    self._look_ahead()
            at += 1
        return None


def parsed(html: str) -> Page:
    """The tree of blocks and runs. Broken markup is mended as browsers do: paragraphs end where a
    block begins, unknown end tags are skipped, what is left open ends with the page."""
    page = Page()
    page.add(-1, ["tag page"])
    open_tags, open_nodes = ["page"], [0]
    pieces: list[str] = []
    links = linked = 0
    at, size = 0, len(html)
    markup = Markup(html)

    def end_run() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                share = min(4, 5 * linked // max(len(text), 1))
                ends = "sentence" if _LAST_SENTENCE.search(text) else "open"
                page.add(
                    open_nodes[-1],
                    [f"length {_size_class(len(text))}", f"links {share}", f"end {ends}", f"in {open_tags[-1]}", f"in {open_tags[-1]} links {share}"],
                    text,
                    min(linked, len(text)),
                )
        linked = 0

    while at < size:
        match = markup.next(at)
        stop = match.start() if match else size
        if stop > at:
            pieces.append(html[at:stop])
            if links:
                linked += stop - at
        if not match:
            break
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS and tag in open_tags:
                end_run()
                while open_tags.pop() != tag:
                    open_nodes.pop()
                open_nodes.pop()
            continue
        if tag in UNREAD:
            if tag == "head":
                continue
            if not match[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = close.end() if close else size
            continue
        if tag == "a":
            links += 1
        elif tag in BREAKS and tag != "hr":
            pieces.append(" ")
        elif tag in BLOCKS:
            end_run()
            links = 0
            if open_tags[-1] in CLOSED_BY_BLOCK:
                open_tags.pop()
                open_nodes.pop()
            if closes := SAME_CLOSES.get(tag):
                for back in range(len(open_tags) - 1, 0, -1):
                    if open_tags[back] in closes:
                        del open_tags[back:], open_nodes[back:]
                        if tag not in ("tr", "tbody"):
                            break
                    elif open_tags[back] in SCOPES:
                        break
            if tag not in VOID:
                open_nodes.append(page.add(open_nodes[-1], _element_features(tag, match[3])))
                open_tags.append(tag)
    end_run()
    return page


@dataclass
class Forest:
    """The nodes of many pages side by side."""

    pages: list[Page]
    parent: np.ndarray
    levels: list[np.ndarray]
    first: np.ndarray


def forest(pages: list[Page]) -> Forest:
    first = np.concatenate([[0], np.cumsum([len(p.parent) for p in pages])]).astype(np.int64)
    parent = np.concatenate([np.array(p.parent, np.int64) + f for p, f in zip(pages, first)])
    depth = np.concatenate([np.array(p.depth, np.int64) for p in pages])
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
    return Forest(pages, parent, levels, first)


def subtree_features(trees: Forest) -> list[list[str]]:
    """Per node: own features, and for elements the share of the page's text and of links below it."""
    own = [f for p in trees.pages for f in p.features]
    runs = [r for p in trees.pages for r in p.run]
    text = np.array([len(r) if r else 0 for r in runs], np.int64)
    linked = np.array([n for p in trees.pages for n in p.linked], np.int64)
    for level in reversed(trees.levels[1:]):
        np.add.at(text, trees.parent[level], text[level])
        np.add.at(linked, trees.parent[level], linked[level])
    whole = np.repeat(text[trees.first[:-1]], np.diff(trees.first))
    share = np.minimum(4, 5 * text // np.maximum(whole, 1)).tolist()
    links = np.minimum(4, 5 * linked // np.maximum(text, 1)).tolist()
    return [
        f if r is not None else [*f, f"share {s}", f"{f[0]} linked {n}" if w else "empty"]
        for f, r, s, n, w in zip(own, runs, share, links, text.tolist())
    ]


@dataclass
class Model:
    """Logarithms of the potentials: ``root`` and ``edge[parent state, child state]``, and for every
    known feature its row of ``emission``."""

    root: np.ndarray
    edge: np.ndarray
    rows: dict[str, int]
    emission: np.ndarray

    def known(self, trees: Forest) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, rows of ``emission``) of all features that the model knows."""
        pairs = [
            (node, row)
            for node, features in enumerate(subtree_features(trees))
            for feature in features
            if (row := self.rows.get(feature)) is not None
        ]
        return tuple(np.array(pairs, np.int64).reshape(-1, 2).T)

    def beliefs(self, trees: Forest, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Each node's probabilities of the three states, and those of its parent's and its own together."""
        nodes, rows = known
        up = np.column_stack([np.bincount(nodes, self.emission[rows, s], len(trees.parent)) for s in range(3)])
        # Upward: what a node's subtree says about it, and what that says about its parent.
        message = np.zeros_like(up)
        for level in reversed(trees.levels[1:]):
            message[level] = _log_sum(up[level][:, None, :] + self.edge[None, :, :])
            np.add.at(up, trees.parent[level], message[level])
        # Downward: the rest of the tree.
        belief, both = up.copy(), np.zeros((len(up), 3, 3))
        belief[trees.levels[0]] += self.root
        for level in trees.levels[1:]:
            rest = belief[trees.parent[level]] - message[level]
            joint = rest[:, :, None] + self.edge[None, :, :]
            belief[level] = up[level] + _log_sum(joint, axis=1)
            both[level] = joint + up[level][:, None, :]
        return _probabilities(belief), _probabilities(both.reshape(-1, 9)).reshape(-1, 3, 3)

    def marginals(self, trees: Forest) -> np.ndarray:
        return self.beliefs(trees, self.known(trees))[0]


def _probabilities(logs: np.ndarray) -> np.ndarray:
    out = np.exp(logs - logs.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _log_sum(values: np.ndarray, axis: int = 2) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def states(page: Page, main_text: str) -> np.ndarray:
    """A labelled page's states: runs that are lines of the main text are content; an element is
    content or rest if all its runs are, else structure. Elements without runs: as the parent."""
    lines = set(main_text.split("\n"))
    state = np.full(len(page.parent), -1)
    for node in range(len(page.parent) - 1, -1, -1):
        if page.run[node] is not None:
            state[node] = CONTENT if page.run[node] in lines else REST
        parent = page.parent[node]
        if parent >= 0 and state[node] >= 0:
            state[parent] = state[node] if state[parent] in (-1, state[node]) else STRUCTURE
    for node in range(len(page.parent)):
        if state[node] < 0:
            state[node] = state[page.parent[node]] if node else STRUCTURE
    return state


def learnt_model(
    labelled: DataFrame, html_column: str = "html", text_column: str = "text", sample: int = LABELLED_PAGES, rounds: int = ROUNDS
) -> Model:
    """Potentials from at most ``sample`` pages with their main text (its blocks joined by line ends).

    They start as logarithms of counts and climb the likelihood of the pages' states: observed minus
    expected counts, the latter from the same sum-product messages that label pages later.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(labelled[html_column].alias("html"), labelled[text_column].alias("text"))
    rows = rows.orderBy(F.xxhash64("html"), "html").limit(sample).toArrow()
    pages = [parsed(h or "") for h in rows.column("html").to_pylist()]
    if not pages:
        return Model(np.zeros(3), np.zeros((3, 3)), {}, np.zeros((0, 3)))
    trees = forest(pages)
    state = np.concatenate([states(p, t or "") for p, t in zip(pages, rows.column("text").to_pylist())])
    names = Counter(f for features in subtree_features(trees) for f in features)
    model = Model(np.zeros(3), np.zeros((3, 3)), {f: i for i, f in enumerate(sorted(f for f, n in names.items() if n > 4))}, np.zeros((0, 3)))
    nodes, row = model.known(trees)
    inner = np.concatenate(trees.levels[1:]) if len(trees.levels) > 1 else np.zeros(0, np.int64)
    seen = np.zeros((len(model.rows), 3))
    np.add.at(seen, (row, state[nodes]), 1)
    edges = np.zeros((3, 3))
    np.add.at(edges, (state[trees.parent[inner]], state[inner]), 1)
    roots = np.bincount(state[trees.levels[0]], minlength=3)
    model.root = np.log((roots + 1) / (roots + 1).sum())
    model.edge = np.log((edges + 1) / (edges + 1).sum(axis=1, keepdims=True))
    # Features of a node overlap, so that the counts' logarithms start at a part of their weight.
    model.emission = 0.4 * (np.log(seen + 0.5) - np.log(np.bincount(state, minlength=3) + 1))
    sizes = [np.full(model.emission.shape, 1e-6), np.full((3, 3), 1e-6)]
    for _ in range(rounds):
        single, pair = model.beliefs(trees, (nodes, row))
        expected = np.column_stack([np.bincount(row, single[nodes, s], len(seen)) for s in range(3)])
        slopes = (seen - expected - 0.5 * model.emission, edges - pair[inner].sum(axis=0) - 0.5 * model.edge)
        for potential, slope, size in zip((model.emission, model.edge), slopes, sizes):
            size += slope**2
            potential += 0.3 * slope / np.sqrt(size)
    return model


def main_texts(
    pages: DataFrame, model: Model, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: runs that are content with at least even odds.

    Character references are decoded, white space inside a run becomes one space, runs are joined
    in page order by one line end. A null, empty or unreadable page gives an empty text. Rows that
    repeat are read each. An empty table gives no rows.
    """
    ship(pages.sparkSession)
    rows = pages.select(
        pages[id_column].cast("long").alias("page_id"),
        pages[url_column].cast("string").alias("url"),
        F.coalesce(pages[html_column].cast("string"), F.lit("")).alias("html"),
    )

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            read = [parsed(h) for h in part.column("html").to_pylist()]
            trees = forest(read)
            content = model.marginals(trees)[:, CONTENT] >= 0.5
            texts = []
            for page, first in zip(read, trees.first.tolist()):
                texts.append("\n".join(r for i, r in enumerate(page.run) if r is not None and content[first + i]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return by_batch(rows, work, "page_id long, url string, text string, n_chars long")
