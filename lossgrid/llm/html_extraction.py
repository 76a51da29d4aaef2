"""Main text of web pages by boosted trees over DOM nodes and hierarchical decoding.

Every block element of a page is a node. A node is *mixed* (holds the article and other things), *content* (the article
or a part of it) or *other* (nothing of the article). Boosted trees give each node the probabilities of the three from
its subtree (size, text and link density, punctuation, kinds of elements), its attribute tokens and those of its
ancestors and descendants, its depth, its place on the page and its siblings. Decoding then takes the most probable
labelling of the whole tree among those without contradiction: below *other* everything is other, below *content*
nothing is mixed. It is found by one pass up the tree and one down, exactly.

The trees are fitted on generated layouts with known roles, filled with sentences of at most ``SAMPLE_PAGES`` pages of
the table, and on those of the pages that mark their article by elements of their own. Pages are read where they are: no
shuffle; the fitted trees (some hundred kB) go to the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm import html_layouts
from lossgrid.llm.arrow import schema_with, small, spans_by_size
from lossgrid.llm.boosting import Trees, boost
from lossgrid.llm.html_dom import HEADINGS, PUNCTUATION, Page, joined

MIXED, CONTENT, OTHER = 0, 1, 2
#: Bounds of the training sample: pages of the table, their characters each, generated layouts, nodes.
SAMPLE_PAGES, SAMPLE_CHARS, LAYOUTS, SAMPLE_NODES = 120, 30_000, 900, 20_000
PAGE_BLOCK = 1 << 20
FLOOR = np.log(1e-4)
#: Elements whose meaning a page's author has declared (fixed values of HTML).
DECLARED_CONTENT, DECLARED_OTHER = {"article"}, {"nav", "footer", "aside", "form", "header"}


# --- features ---------------------------------------------------------------------------------------------


@dataclass
class Forest:
    """The trees of several pages laid end to end, with counts per node."""

    parent: np.ndarray  # -1 for the root of a page
    levels: list[np.ndarray]  # nodes by depth
    page: np.ndarray
    own: dict[str, np.ndarray]
    tags: list[str]
    parts: list[tuple[str, ...]]

    @classmethod
    def of(cls, pages: Sequence[Page]) -> Forest:
        offsets = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages])]).astype(np.int64)
        total = int(offsets[-1])
        parent = np.full(total, -1, np.int64)
        names = "chars links words stops pieces inline controls images p_chars items heads blocks start".split()
        own = {name: np.zeros(total) for name in names}
        for page, low in zip(pages, offsets, strict=False):
            high = low + len(page.tag)
            up = np.array(page.parent)
            parent[low:high] = np.where(up < 0, -1, up + low)
            own["inline"][low:high], own["controls"][low:high], own["images"][low:high] = page.inline, page.controls, page.images
            chars, links, words, stops, count = own["chars"], own["links"], own["words"], own["stops"], own["pieces"]
            first: dict[int, int] = {}
            seen = 0
            for (node, _, text), linked in zip(page.pieces, page.linked, strict=True):
                at = low + node
                size = len(text) - text.count(" ")
                first.setdefault(node, seen)
                if not size:
                    continue
                seen += size
                chars[at] += size
                count[at] += 1
                if linked:
                    links[at] += size
                words[at] += text.count(" ") + 1
                stops[at] += len(PUNCTUATION.findall(text))
            # Where a node begins: at its first own text, or at the next node's beginning.
            begin = seen
            starts = own["start"]
            for node in range(len(page.tag) - 1, -1, -1):
                begin = min(begin, first.get(node, begin))
                starts[low + node] = begin
        depth = np.zeros(total, np.int64)
        tags = [t for p in pages for t in p.tag]
        for i, up in enumerate(parent.tolist()):
            if up >= 0:
                depth[i] = depth[up] + 1
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1))) if total else []
        own["depth"] = depth.astype(float)
        is_p = np.fromiter((t == "p" for t in tags), bool, total)
        own["p_chars"] = np.where(is_p, own["chars"], 0)
        own["items"] = np.fromiter((t in ("li", "dd", "dt") for t in tags), float, total)
        own["heads"] = np.fromiter((t in HEADINGS for t in tags), float, total)
        own["blocks"] = np.ones(total)
        return cls(parent, levels, np.repeat(np.arange(len(pages)), np.diff(offsets)), own, tags, [x for p in pages for x in p.parts])

    def gathered(self, value: np.ndarray) -> np.ndarray:
        """Sum over each subtree."""
        out = value.astype(float).copy()
        for nodes in reversed(self.levels[1:]):
            np.add.at(out, self.parent[nodes], out[nodes])
        return out

    def over_children(self, value: np.ndarray, start: float, combine: np.ufunc) -> np.ndarray:
        out = np.full(len(value), start)
        has = np.flatnonzero(self.parent >= 0)
        combine.at(out, self.parent[has], value[has])
        return out


@dataclass
class Extractor:
    """Scores of attribute and element names, and the trees."""

    names: dict[str, tuple[float, float]]  # log-odds of content against other, of mixed against both
    trees: Trees

    def log_probabilities(self, forest: Forest) -> np.ndarray:
        return np.maximum(self.trees.log_probabilities(features(forest, self.names)), FLOOR)


def _names_of(tag: str, parts: Sequence[str]) -> list[str]:
    return [f"<{tag}", *parts]


def features(forest: Forest, names: dict[str, tuple[float, float]]) -> np.ndarray:
    """One row per node."""
    own, parent = forest.own, forest.parent
    total = len(parent)
    g = {k: forest.gathered(own[k]) for k in ("chars", "links", "words", "stops", "pieces", "inline", "controls", "images", "p_chars", "items", "heads", "blocks")}
    root = np.zeros(total, np.int64)
    for nodes in forest.levels[1:]:
        root[nodes] = np.where(parent[parent[nodes]] < 0, parent[nodes], root[parent[nodes]])
    root = np.where(parent < 0, np.arange(total), root)
    all_chars = np.maximum(g["chars"][root], 1)
    none = (0.0, 0.0)
    tag_score = np.array([names.get(f"<{t}", none)[0] for t in forest.tags])
    own_score = np.array([sum(names.get(x, none)[0] for x in p) for p in forest.parts])
    wrap_score = np.array([sum(names.get(x, none)[1] for x in _names_of(t, p)) for t, p in zip(forest.tags, forest.parts, strict=True)])
    both = tag_score + own_score
    low, high, nearest = (np.zeros(total) for _ in range(3))  # over the ancestors
    for nodes in forest.levels[1:]:
        up = parent[nodes]
        low[nodes], high[nodes] = np.minimum(low[up], both[up]), np.maximum(high[up], both[up])
        nearest[nodes] = np.where(own_score[up] != 0, own_score[up], nearest[up])
    below_low, below_high = np.zeros(total), np.zeros(total)
    for nodes in reversed(forest.levels[1:]):
        up = parent[nodes]
        np.minimum.at(below_low, up, np.minimum(below_low[nodes], both[nodes]))
        np.maximum.at(below_high, up, np.maximum(below_high[nodes], both[nodes]))

    at = np.arange(total)
    up = np.where(parent < 0, at, parent)
    siblings = forest.over_children(np.ones(total), 0.0, np.add)
    largest = forest.over_children(g["chars"], 0.0, np.maximum)
    order = np.lexsort((at, parent))
    same = parent[order][1:] == parent[order][:-1]
    before, after, place = (np.zeros(total) for _ in range(3))
    before[order[1:][same]] = g["chars"][order[:-1][same]]
    after[order[:-1][same]] = g["chars"][order[1:][same]]
    starts = np.flatnonzero(np.append(True, ~same)) if total else np.zeros(0, np.int64)
    place[order] = at - np.repeat(starts, np.diff(np.append(starts, total)))
    p_children = forest.over_children(np.array([float(t == "p") for t in forest.tags]), 0.0, np.add)
    chars = np.maximum(g["chars"], 1)
    columns = [
        own["depth"], np.log1p(g["chars"]), np.log1p(own["chars"]), g["chars"] / all_chars, g["chars"] / np.maximum(g["chars"][up], 1),
        g["links"] / chars, g["chars"] / (g["blocks"] + g["inline"]), g["chars"] / np.maximum(g["pieces"], 1), g["words"] / np.maximum(g["pieces"], 1),
        g["stops"] / chars, g["p_chars"] / chars, g["items"] / g["blocks"], g["heads"], np.log1p(g["controls"]), g["images"], np.log1p(g["blocks"]),
        own["inline"], own["start"] / all_chars, (own["start"] + g["chars"]) / all_chars, place, siblings[up], g["chars"] / np.maximum(largest[up], 1),
        np.log1p(before), np.log1p(after), siblings, p_children, largest / chars,
        tag_score, own_score, wrap_score, low, high, nearest, both[up], below_low, below_high, np.log1p(all_chars),
        g["links"][up] / np.maximum(g["chars"][up], 1), p_children[up], np.log1p(g["controls"][up]),
    ]
    return np.column_stack(columns)


# --- decoding ---------------------------------------------------------------------------------------------


def decode(forest: Forest, log_p: np.ndarray) -> np.ndarray:
    """The most probable labels of all nodes together, with no contradiction between a node and what is below it.

    Nodes without text say nothing. Of equal totals the label that comes first is taken.
    """
    gain = np.where(forest.gathered(forest.own["chars"])[:, None] > 0, log_p, 0.0)
    best = gain.copy()
    for nodes in reversed(forest.levels[1:]):
        up, b = forest.parent[nodes], best[nodes]
        np.add.at(best[:, MIXED], up, b.max(axis=1))
        np.add.at(best[:, CONTENT], up, np.maximum(b[:, CONTENT], b[:, OTHER]))
        np.add.at(best[:, OTHER], up, b[:, OTHER])
    label = best.argmax(axis=1)
    for nodes in forest.levels[1:]:
        above, b = label[forest.parent[nodes]], best[nodes].copy()
        b[above != MIXED, MIXED] = -np.inf
        b[above == OTHER, CONTENT] = -np.inf
        label[nodes] = b.argmax(axis=1)
    return label


# --- fitting ----------------------------------------------------------------------------------------------


def labels_of(page: Page) -> np.ndarray:
    """Labels from marks: 'c' begins content, 'x' begins other; what is above content is mixed."""
    out = np.full(len(page.tag), OTHER)
    for i, (up, mark) in enumerate(zip(page.parent, page.marks, strict=True)):
        if mark == "c" or (up >= 0 and out[up] == CONTENT and mark != "x"):
            out[i] = CONTENT
    for i in range(len(out) - 1, 0, -1):
        up = page.parent[i]
        if out[i] != OTHER and out[up] == OTHER and page.marks[up] != "x":
            out[up] = MIXED
    return out


def _declared(page: Page) -> bool:
    """Mark what the page's own elements declare; whether it has one article outside other parts."""
    kind = [DECLARED_CONTENT, DECLARED_OTHER]
    page.marks = ["c" if t in kind[0] else "x" if t in kind[1] else "" for t in page.tag]
    outermost = 0
    for i, up in enumerate(page.parent):
        while up >= 0 and not page.marks[up]:
            up = page.parent[up]
        outermost += page.marks[i] == "c" and up < 0
    return outermost == 1


def fit_pages(pages: Sequence[str], *, layouts: int = LAYOUTS, first_seed: int = 1) -> Extractor:
    """Fit on generated layouts filled with sentences of ``pages``, and on the pages that declare one article."""
    sentences: dict[str, None] = {}
    trees: list[Page] = []
    for source in pages:
        page = Page(source)
        for _, _, text in page.pieces:
            text = " ".join(text.split())
            for part in text.replace(". ", ".\n").split("\n")[:40]:
                if part:
                    sentences.setdefault(part)
        if _declared(page):
            trees.append(page)
    pool = list(sentences)[:20_000] or ["No text."]
    trees += [Page(html_layouts.labelled_page(first_seed + i, pool), marked=True) for i in range(layouts)]
    forest = Forest.of(trees)
    label = np.concatenate([labels_of(p) for p in trees])
    text = forest.gathered(forest.own["chars"]) > 0
    seen: dict[str, Counter[int]] = {}
    for i in np.flatnonzero(text):
        # Of a uniform subtree only the top says what its name means.
        up = forest.parent[i]
        if up >= 0 and label[up] == label[i] and label[i] != MIXED and not forest.parts[i] and forest.tags[i] not in DECLARED_OTHER | DECLARED_CONTENT:
            continue
        for name in set(_names_of(forest.tags[i], forest.parts[i])):
            seen.setdefault(name, Counter())[label[i]] += 1
    names = {}
    for name, n in seen.items():
        if n.total() >= 4:
            names[name] = (float(np.log((n[CONTENT] + 1) / (n[OTHER] + 1))), float(np.log((n[MIXED] + 1) / (n[CONTENT] + n[OTHER] + 1))))
    x = features(forest, names)
    rows = np.flatnonzero(text)
    if len(rows) > SAMPLE_NODES:
        rows = rows[np.random.default_rng(7).permutation(len(rows))[:SAMPLE_NODES]]
    return Extractor(names, boost(x[rows], label[rows], 3))


def fit(pages: DataFrame, *, html_col: str = "html") -> Extractor:
    """Fit on a sample of the table: of the pages of up to ``SAMPLE_CHARS`` characters the ``SAMPLE_PAGES`` with the smallest hashes.

    Rows are thinned by hash before they are compared, so that a task sends few however many tasks there are.
    """
    source = F.col(f"`{html_col}`").cast("string")
    some = pages.select(source.alias("html")).filter(F.length("html").between(1, SAMPLE_CHARS))
    share = min(1.0, 8 * SAMPLE_PAGES / max(1, pages.count()))
    drawn = F.xxhash64("html", F.lit("sample"))
    few = some.filter(F.pmod(drawn, F.lit(1 << 40)) < int(share * (1 << 40))).distinct()
    rows = few.orderBy(drawn, "html").limit(SAMPLE_PAGES).collect()
    return fit_pages([r.html for r in rows])


# --- operator ---------------------------------------------------------------------------------------------


def main_texts(sources: Sequence[str], model: Extractor) -> list[str]:
    pages = [Page(source) for source in sources]
    forest = Forest.of(pages)
    content = decode(forest, model.log_probabilities(forest)) == CONTENT
    out, low = [], 0
    for page in pages:
        kept = content[low : low + len(page.tag)].tolist()
        out.append(joined(page.pieces, [kept[node] for node, _, _ in page.pieces]))
        low += len(page.tag)
    return out


def extract(
    pages: DataFrame, model: Extractor | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    The text is that of all content nodes in page order: character references decoded, white space inside a block one
    space, blocks joined by one space. NULL, empty and wordless pages have '' and 0; repeated rows count each; no rows
    give none. Broken markup is read as far as it goes and nothing is cut. ``model`` is fitted on the table if not given.
    """
    if model is None:
        model = fit(pages, html_col=html_col)
    base = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
        F.col(f"`{url_col}`").alias("url"),
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            sources = part.column(1).to_pylist()
            texts: list[str] = []
            for low, high in spans_by_size(map(len, sources), PAGE_BLOCK):
                texts += main_texts(sources[low:high], model)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return base.mapInArrow(rows, schema_with(base, ["page_id", "url"], "text string, n_chars bigint"))
