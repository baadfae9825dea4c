"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks, exact check.

An item of W words has the weighted multiset of its five-word shingles (fewer words: the whole
sequence).  A window is any run of W words of a document, the whole document if it has fewer.  Candidates are windows whose SimHash is
within ``radius`` bits of the item's: the 64 bits are cut into blocks, and two fingerprints
within the radius differ in some block by at most radius // blocks bits, so looking each block up
among the item blocks that near finds all of them.  A candidate counts if its
weighted Jaccard similarity with the item is at least ``similarity``; shingles weigh
log(1 + items / items that have it), counted over the whole benchmark.

A window without a shingle of an item of its size has similarity 0 with all of them, so only
windows over such a shingle are fingerprinted: a document without any costs one pass of hashing.

Documents are only mapped over: no shuffle, no group.  The benchmark is the stated query set; it
goes to the tasks in blocks of a bounded number of bytes, one pass over the documents for each, with the counts of all
shingles that several items have (16 bytes each).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loanscope.llm import grams
from loanscope.llm.common import bound_batches, text_of
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 8
BLOCK_BYTES = 8 << 20  # benchmark text held by a task at a time
MATCH_SCHEMA = "doc_id long, item_id long, first_word long, n_words long, similarity double"

FILTER_BITS = 20


def simhashes(bits: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of each run of ``size`` rows of ``bits`` (rows x 64 of 0/1)."""
    total = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:], dtype=np.int32)
    ones = total[size:] - total[:-size]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view(np.uint64)[:, 0]


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


class HammingIndex:
    """Fingerprints within ``radius`` bits of a query, by look-ups of near block values."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.prints, self.radius = prints, radius
        self.width, self.near = 64 // blocks, radius // blocks
        self.own = [self._block(prints, b) for b in range(blocks)]
        self.tables: list[dict[int, np.ndarray]] = [{} for _ in range(blocks)]  # filled as values are asked for

    def _block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)

    def _near(self, b: int, value: int) -> np.ndarray:
        table = self.tables[b]
        if value not in table:
            table[value] = np.flatnonzero(np.bitwise_count(self.own[b] ^ np.uint64(value)) <= self.near)
        return table[value]

    def within(self, queries: np.ndarray) -> list[tuple[int, int, int]]:
        """(query, print, bits) for every pair within the radius."""
        found = set()
        for b in range(len(self.own)):
            blocks = self._block(queries, b)
            for v in np.unique(blocks).tolist():
                near = self._near(b, v)
                if len(near):
                    rows = np.flatnonzero(blocks == v)
                    bits = np.bitwise_count(queries[rows][:, None] ^ self.prints[near][None, :])
                    for r, c in zip(*np.nonzero(bits <= self.radius)):
                        found.add((int(rows[r]), int(near[c]), int(bits[r, c])))
        return sorted(found)


class Frequencies(NamedTuple):
    """The number of items with words in the whole benchmark, its shingles that several of them have (sorted), and how many have each."""

    n_items: int
    shingles: np.ndarray
    having: np.ndarray


def item_shingles(h: np.ndarray, words: int) -> tuple[int, np.ndarray]:
    """Words a shingle and the shingles of an item with word hashes ``h``."""
    k = min(words, len(h))
    return k, grams.shingles(h, k)


class Items:
    """A block of benchmark items, ready to be searched for in documents."""

    def __init__(self, items: list[tuple[int, bytes]], known: Frequencies, words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                 radius: int = RADIUS):
        self.similarity, self.frequencies = similarity, known
        self.by_size: dict[tuple[int, int], list[int]] = defaultdict(list)  # (shingle words, shingles) -> items
        self.ids, self.counts = [], []
        has: dict[int, list[int]] = defaultdict(list)
        prints = []
        for ident, text in items:
            h, _, _ = grams.words(text)
            if not len(h):
                continue  # an item without words is in no document
            k, s = item_shingles(h, words)
            at = len(self.ids)
            self.ids.append(ident)
            self.counts.append(Counter(s.tolist()))
            self.by_size[k, len(s)].append(at)
            prints.append(int(simhashes(bits_of(s), len(s))[0]))
            for x in self.counts[-1]:
                has[x].append(at)
        self.has = dict(has)
        self.size_of = {i: size for size, members in self.by_size.items() for i in members}
        self.weights: dict[int, float] = {}  # filled as shingles are asked for
        self.index = {size: HammingIndex(np.array([prints[i] for i in members], np.uint64), radius)
                      for size, members in self.by_size.items()}
        self.shingle_words = sorted({k for k, _ in self.by_size})
        self.known = np.sort(np.array(list(self.has), np.uint64))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def weight(self, x: int) -> float:
        """By the whole benchmark, also for shingles of other blocks; one that no item has weighs as that of a single item."""
        if x not in self.weights:
            n, shingles, having = self.frequencies
            at = int(np.searchsorted(shingles, np.uint64(x)))
            self.weights[x] = float(np.log1p(n / having[at] if at < len(shingles) and int(shingles[at]) == x else n))
        return self.weights[x]

    def similarity_of(self, item: int, window: Counter) -> float:
        """Weighted Jaccard similarity of multisets of shingles."""
        own = self.counts[item]
        least = most = 0.0
        for x in own.keys() | window.keys():
            w = self.weight(x)
            least += w * min(own[x], window[x])
            most += w * max(own[x], window[x])
        return least / most

    def anchors(self, s: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        maybe = np.flatnonzero(self.filter[(s >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, s[maybe]), len(self.known) - 1)
        return maybe[self.known[at] == s[maybe]]

    def search(self, s: np.ndarray, k: int, anchors: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(item, first shingle, shingles, similarity): the best window of each item in one document's shingles.
        An item that is longer than the document has the whole document as its window."""
        starts: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for p in anchors.tolist():
            for size in {self.size_of[i] for i in self.has[int(s[p])]}:
                if size[0] == k:
                    length = min(size[1], len(s))
                    starts[size].append((max(0, p - length + 1), min(p, len(s) - length)))
        best: dict[int, tuple[float, int]] = {}
        for size, ranges in starts.items():
            length = min(size[1], len(s))
            for lo, hi in merged(ranges):
                prints = simhashes(bits_of(s[lo:hi + length]), length)
                members = self.by_size[size]
                for window, member, _ in self.index[size].within(prints):
                    item, first = members[member], lo + window
                    sim = self.similarity_of(item, Counter(s[first:first + length].tolist()))
                    if sim >= self.similarity and sim > best.get(item, (0.0, 0))[0]:
                        best[item] = sim, first
        for item, (sim, first) in sorted(best.items()):
            yield item, first, min(self.size_of[item][1], len(s)), sim

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, item id, first word, words, similarity) for a batch of texts."""
        if not self.ids:
            return
        for first, last in grams.chunks(texts):
            group = texts[first:last]
            h, start, _ = grams.words(b"\n".join(group))
            ends = np.cumsum([len(t) + 1 for t in group])
            bounds = np.concatenate([[0], np.searchsorted(start, ends)])
            for k in self.shingle_words:
                s = grams.shingles(h, k)
                found = self.anchors(s)
                text_at = np.searchsorted(bounds, found, "right") - 1
                inside = found + k <= bounds[text_at + 1]
                found, text_at = found[inside], text_at[inside]
                for t in np.unique(text_at).tolist():
                    lo, hi = int(bounds[t]), int(bounds[t + 1]) - k + 1
                    for item, at, length, sim in self.search(s[lo:hi], k, found[text_at == t] - lo):
                        yield first + t, self.ids[item], at, k + length - 1, sim


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def frequencies(benchmark: DataFrame, words: int = SHINGLE_WORDS) -> Frequencies:
    """Counted in Spark; shingles of one item weigh as unknown ones, so only those of several come to the driver."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = []
            n = 0
            for text in batch.column(0).to_pylist():
                h, _, _ = grams.words(text)
                if len(h):
                    out.append(np.unique(item_shingles(h, words)[1]).view(np.int64))
                    n += 1
            # A null for each item that has words.
            shingle = pa.concat_arrays([pa.array(x, pa.int64()) for x in out] + [pa.nulls(n, pa.int64())])
            yield pa.RecordBatch.from_arrays([shingle], names=["shingle"])

    b = benchmark.select(F.lower(text_of(benchmark)).cast("binary").alias("text"))
    counted = b.mapInArrow(each, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.filter(F.col("shingle").isNull() | (F.col("n") > 1)).collect()
    shared = [(r[0], r[1]) for r in rows if r[0] is not None]
    shingles = np.array([x for x, _ in shared], np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return Frequencies(sum(r[1] for r in rows if r[0] is None), shingles[order], np.array([n for _, n in shared], np.int64)[order])


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's (item_id, text) in blocks of about ``block_bytes``, one at a time on the driver."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(text_of(benchmark)).cast("binary").alias("text"))
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for i in range(n):
        part = b if n == 1 else b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r[0], bytes(r[1])) for r in part.collect()]


def contaminations(docs: DataFrame, benchmark: DataFrame, words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                   radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity): for each document and item whose similarity is
    reached, the most similar window, the first of equals.

    Null and empty texts and items without words have no windows.  Repeated rows give repeated
    results.  An empty benchmark or table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    known = frequencies(benchmark, words)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(text_of(docs)).cast("binary").alias("text"))

    def search(block: list[tuple[int, bytes]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(block, known, words, similarity, radius)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[t], *rest) for t, *rest in items.matches(batch.column(1).to_pylist())]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["doc_id", "item_id", "first_word", "n_words", "similarity"])

        return run

    return reduce(DataFrame.unionByName, [d.mapInArrow(search(b), MATCH_SCHEMA) for b in item_blocks(benchmark)])


def holds_item(block: list[tuple[int, bytes]], known: Frequencies, words: int, similarity: float, radius: int):
    """A function of a binary text column: whether any of the block's items is in it."""
    kept: list[Items] = []  # built once in a task

    @pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        if not kept:
            kept.append(Items(block, known, words, similarity, radius))
        hit = np.zeros(len(texts), bool)
        for t, *_ in kept[0].matches(texts.tolist()):
            hit[t] = True
        return pd.Series(hit)

    return holds


def without_benchmark(docs: DataFrame, benchmark: DataFrame, words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                      radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    known = frequencies(benchmark, words)
    out = docs
    for block in item_blocks(benchmark):
        if block:
            out = out.filter(~holds_item(block, known, words, similarity, radius)(F.lower(text_of(out)).cast("binary")))
    return out


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
