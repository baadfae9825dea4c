"""Main text of web pages by a tree-structured graphical model over the DOM.

Every node of a page's tree (``dom``: block elements, and blocks of text below them) has a hidden label, main text or not.
A node's features give its own potential, and a table for the kind of the child the potential of each pair of parent
and child.  Sum-product messages go from the deepest nodes up to the root and down again, one level of depth of
a whole batch of pages at a time, and give each node's exact marginal.  Blocks of text whose marginal is above
``THRESHOLD`` are the main text.

The weights maximise the likelihood of labelled pages (the gradient is what the labels show less what the marginals
expect): ``SEED_PAGES`` pages put together from layouts written by hand (``labelled_pages``), and at most ``TRAIN_PAGES`` pages of
the table whose own markup tells their article, taken by a hash of page_id, url and html (of many copies one).  Half of the latter are read once more
with the names of the telling elements blanked, so that the text's own features are learnt too.
An element counts as main text if it lies within the smallest element around all main text and most of its text is main.

Prediction is a map over the pages with the weights in the closure: no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.common import bound_batches
from loanscope.llm.dom import FEATURES, KINDS, Page, read_page
from loanscope.llm.labelled_pages import MARK, labelled_pages
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

TRAIN_PAGES = 300  # of the table, at most
TRAIN_CHARS = 100_000  # longer pages are not learnt from
SEED_PAGES = 700
STEPS = 200
RATE = 0.1
RIDGE = 1e-5
THRESHOLD = 0.5
NODES_AT_ONCE = 200_000
HTML_AT_ONCE = 4 << 20


@dataclass(frozen=True)
class Forest:
    """Nodes of several pages, numbered on; a root's parent is -1."""
    parent: np.ndarray
    kind: np.ndarray
    first: np.ndarray
    active: np.ndarray
    levels: list[np.ndarray]  # node numbers by depth, roots first

    @staticmethod
    def of(pages: list[Page]) -> Forest:
        starts = np.cumsum([0] + [len(p.parent) for p in pages])
        parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + s) for p, s in zip(pages, starts)] or [np.empty(0, np.int64)])
        used = np.cumsum([0] + [len(p.active) for p in pages])
        first = np.concatenate([[0]] + [np.array(p.first[1:], np.int64) + u for p, u in zip(pages, used)])
        active = np.concatenate([np.array(p.active, np.int64) for p in pages] or [np.empty(0, np.int64)])
        kind = np.concatenate([np.array(p.kind, np.int64) for p in pages] or [np.empty(0, np.int64)])
        depth = np.concatenate([np.array(p.depth, np.int64) for p in pages] or [np.empty(0, np.int64)])
        return Forest(parent.astype(np.int64), kind, first, active, by_depth(depth))


def by_depth(depth: np.ndarray) -> list[np.ndarray]:
    """Node numbers of each depth."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []


@dataclass
class ContentModel:
    weights: np.ndarray  # of each feature, for main text
    pairs: np.ndarray  # kind of child x label of parent x label of child
    root: float

    def potentials(self, forest: Forest) -> np.ndarray:
        """Log potential of each node's label main text (that of the other is 0)."""
        total = np.concatenate([[0.0], np.cumsum(self.weights[forest.active])])
        own = total[forest.first[1:]] - total[forest.first[:-1]]
        if forest.levels:
            own[forest.levels[0]] += self.root
        return own

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Of each node: P(main text); joint with its parent, node x label of parent x label of child (roots: zeros).

        Upward: a node's belief from its own potential and its children's messages, the message to its parent.
        Downward: the parent's belief without that message, through the pair's table.
        """
        n = len(forest.parent)
        up = np.zeros((n, 2))
        up[:, 1] = self.potentials(forest)
        tables = self.pairs[forest.kind]
        message = np.zeros((n, 2))
        for level in reversed(forest.levels[1:]):
            message[level] = np.logaddexp(tables[level, :, 0] + up[level, None, 0], tables[level, :, 1] + up[level, None, 1])
            message[level] -= message[level].max(1, keepdims=True)
            for label in (0, 1):
                np.add.at(up[:, label], forest.parent[level], message[level, label])
        belief = up.copy()
        joint = np.zeros((n, 2, 2))
        for level in forest.levels[1:]:
            above = belief[forest.parent[level]] - message[level]
            both = above[:, :, None] + tables[level] + up[level][:, None, :]
            both -= both.max((1, 2), keepdims=True)
            both = np.exp(both)
            both /= both.sum((1, 2), keepdims=True)
            joint[level] = both
            down = np.log(np.maximum(both.sum(1), 1e-300))
            belief[level] = down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), joint


def element_labels(page: Page, main: set[int]) -> np.ndarray:
    """Labels of all nodes from those of the blocks in ``main``."""
    n = len(page.parent)
    own, whole, inside = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in page.blocks:
        whole[i] = len(text)
        if i in main:
            own[i], inside[i] = len(text), 1
    for i in range(n - 1, 0, -1):
        own[page.parent[i]] += own[i]
        whole[page.parent[i]] += whole[i]
        inside[page.parent[i]] += inside[i]
    label = (own * 2 > whole).astype(np.int64)
    # Above the smallest element that holds all main text nothing is main.
    around = 0
    for i in range(n):
        if page.tags[i] and main and inside[i] == len(main):
            around = i
    i = page.parent[around] if n else -1
    while i >= 0:
        label[i] = 0
        i = page.parent[i]
    return label


def marked_page(source: str) -> tuple[Page, np.ndarray]:
    """A page of ``labelled_pages`` without its marks, and its nodes' labels."""
    marked = read_page(source)
    page = read_page(source.replace(MARK, ""))
    return page, element_labels(page, {i for i, text in marked.blocks if text.startswith(MARK)})


TELLING = re.compile(r"<(/?)(article|main|nav|header|footer|aside)\b", re.I)
NAMED = re.compile(r"""\s(?:class|id|role)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", re.I)


def told_page(source: str) -> tuple[Page, np.ndarray] | None:
    """A page whose only article (or else main) element tells its main text, and its nodes' labels."""
    page = read_page(source)
    for tag in ("article", "main"):
        found = [i for i, t in enumerate(page.tags) if t == tag]
        if len(found) == 1:
            break
    else:
        return None
    within = np.zeros(len(page.tags), bool)
    within[found[0]] = True
    for i in range(found[0] + 1, len(page.tags)):
        within[i] = page.parent[i] >= 0 and within[page.parent[i]] and page.tags[i] not in ("nav", "aside", "footer", "form") and not boilerplate(page, i)
    return page, element_labels(page, {i for i, _ in page.blocks if within[i]})


NOT_MAIN = {FEATURES[f"name {g}"] for g in ("menu", "footer", "side", "advert", "comment", "notice", "form", "share", "hidden")}


def boilerplate(page: Page, i: int) -> bool:
    return not NOT_MAIN.isdisjoint(page.active[page.first[i]:page.first[i + 1]])


def blanked(source: str) -> str:
    """``source`` with divisions in place of telling elements, and without names."""
    return NAMED.sub("", TELLING.sub(r"<\1div", source))


def learn(examples: list[tuple[Page, np.ndarray]], steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> ContentModel:
    """Weights of the greatest likelihood, less a ridge, by Adam."""
    forest = Forest.of([p for p, _ in examples])
    label = np.concatenate([y for _, y in examples] or [np.empty(0, np.int64)])
    sizes = np.diff(forest.first)
    model = ContentModel(np.zeros(len(FEATURES)), np.zeros((len(KINDS), 2, 2)), 0.0)
    if not len(label):
        return model
    below = np.flatnonzero(forest.parent >= 0)
    shown = np.zeros_like(model.pairs)
    np.add.at(shown, (forest.kind[below], label[forest.parent[below]], label[below]), 1)
    cut = len(FEATURES), len(FEATURES) + model.pairs.size
    now, mean, square = np.zeros(cut[1] + 1), np.zeros(cut[1] + 1), np.zeros(cut[1] + 1)
    for step in range(1, steps + 1):
        model = ContentModel(now[:cut[0]], now[cut[0]:cut[1]].reshape(model.pairs.shape), float(now[-1]))
        p, joint = model.marginals(forest)
        gap = label - p
        expected = np.stack([joint[below][forest.kind[below] == k].sum(0) for k in range(len(KINDS))])
        slope = np.concatenate([np.bincount(forest.active, np.repeat(gap, sizes), len(FEATURES)), (shown - expected).ravel(), [gap[forest.levels[0]].sum()]])
        slope = slope / len(label) - ridge * now
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        now = now + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return ContentModel(now[:cut[0]], now[cut[0]:cut[1]].reshape(model.pairs.shape), float(now[-1]))


def training_pages(pages: DataFrame, bound: int = TRAIN_PAGES) -> list[str]:
    """At most ``bound`` different pages of the table that hold an article or main element, those of the least hashes.

    Only rows whose hash falls below a share of the table of about twice ``bound`` rows are looked at, so
    that what tasks hand over does not grow with the table.
    """
    total = pages.count()
    low, high = -(1 << 63), (1 << 63) - 1
    below = high if total <= 2 * bound else low + int((high - low) * (2 * bound / total))
    h = F.xxhash64("page_id", "url", "html")
    named = F.col("html").rlike("(?i)<(article|main)[ >]") & (F.length("html") <= TRAIN_CHARS)
    rows = pages.select("page_id", "url", "html").filter(h <= below).filter(named).distinct()
    return [r["html"] for r in rows.orderBy(h, "html").limit(bound).collect()]


def fit(pages: DataFrame, bound: int = TRAIN_PAGES, seed_pages: int = SEED_PAGES) -> ContentModel:
    """Learn from the seed pages and at most ``bound`` pages of the table."""
    examples = [marked_page(s) for s in labelled_pages(seed_pages)]
    for i, source in enumerate(training_pages(pages, bound) if bound else []):
        told = told_page(source)
        if told:
            examples.append(told)
            if i % 2:
                again = read_page(blanked(source))
                if len(again.parent) == len(told[1]):
                    examples.append((again, told[1]))
    return learn(examples)


def block_probabilities(pages: list[Page], model: ContentModel) -> list[np.ndarray]:
    """P(main text) of each page's blocks."""
    forest = Forest.of(pages)
    p, _ = model.marginals(forest)
    out, start = [], 0
    for page in pages:
        out.append(p[[start + i for i, _ in page.blocks]] if page.blocks else np.empty(0))
        start += len(page.parent)
    return out


def read_in_turn(sources: Iterator[str], model: ContentModel) -> Iterator[tuple[Page, np.ndarray]]:
    """Pages and their blocks' probabilities, as many at a time as hold ``NODES_AT_ONCE`` nodes."""
    held, nodes = [], 0
    for source in sources:
        page = read_page(source or "")
        held.append(page)
        nodes += len(page.parent)
        if nodes >= NODES_AT_ONCE:
            yield from zip(held, block_probabilities(held, model))
            held, nodes = [], 0
    if held:
        yield from zip(held, block_probabilities(held, model))


def blocks(pages: DataFrame, model: ContentModel) -> DataFrame:
    """One row per block of text: page_id, url, block (its number in the page), text, probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls = batch.column(0), batch.column(1)
            for k, (page, p) in enumerate(read_in_turn((h.as_py() for h in batch.column(2)), model)):
                if page.blocks:
                    n = len(page.blocks)
                    yield pa.RecordBatch.from_arrays([pa.array([ids[k].as_py()] * n, pa.int64()), pa.array([urls[k].as_py()] * n, pa.string()), pa.array(range(n), pa.int64()),
                                                      pa.array([t for _, t in page.blocks], pa.string()), pa.array(p, pa.float64())],
                                                     names=["page_id", "url", "block", "text", "probability"])

    prepare(pages.sparkSession)
    return slim(pages).mapInArrow(run, "page_id long, url string, block long, text string, probability double")


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bound_batches(spark)


def slim(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))


def extract(pages: DataFrame, model: ContentModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, n_blocks, n_main, certainty (least distance of a block from the threshold).

    ``text``: the blocks above the threshold in page order, joined by newlines, white space inside a block as one
    space.  Null and empty pages, and pages without main text, have an empty text; unclosed and stray tags,
    comments and quotes are read leniently; a cut page is read as far as it goes.  Repeated rows and null ids are rows like any
    other.  An empty table gives an empty result.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, mains, certain, size, done = [], [], [], [], 0, 0

            def told():
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(texts)), batch.column(1).slice(done, len(texts)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(mains, pa.int64()), pa.array(certain, pa.float64())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_main", "certainty"])

            for page, p in read_in_turn((h.as_py() for h in batch.column(2)), model):
                main = [t for (_, t), x in zip(page.blocks, p.tolist()) if x > threshold]
                texts.append("\n".join(main))
                counts.append(len(page.blocks))
                mains.append(len(main))
                certain.append(float(np.abs(p - threshold).min()) if len(p) else threshold)
                size += len(texts[-1])
                if size > HTML_AT_ONCE:
                    yield told()
                    done += len(texts)
                    texts, counts, mains, certain, size = [], [], [], [], 0
            if texts:
                yield told()

    prepare(pages.sparkSession)
    return slim(pages).mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_main long, certainty double")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
