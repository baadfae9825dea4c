"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of all items' terms.

A text's ASCII letters are lower-cased and every character that belongs to no term becomes a space; the automaton
holds each term between two spaces, so what it finds in a text between spaces are whole terms, and
one pass over the text counts all of them (neighbours share a space, which overlapping matches allow).
Each of the automaton's outputs maps to the items that have the term.  There is no index of the documents.

Two scans of the documents: the first sums, over all documents, how many there are, their terms, and the documents
of each of the items' terms (one row per term and task); the second scores each document for all items
and keeps a task's best ``k`` of each item, whose union holds the best ``k`` of all.

Only the automaton's terms go to the tasks.  Items are taken in blocks of about ``BLOCK_BYTES`` of text by a hash of
their id, each with its own two scans, and a block's ranks are landed before the next is read, so the driver and
the tasks hold one block however large the benchmark is.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.llm.common import bound_batches, text_of
from loanscope.session import join_path, shared_dir, ship_package
from loanscope.sources.tables import read_table

K = 50
BLOCK_BYTES = 4 << 20  # of items' texts, whose terms one automaton holds
PIECE = 1 << 20  # bytes of a text scanned at a time
KEEP_AT_ONCE = 200_000  # candidates a task gathers before it drops all but the best
SALTS = 64  # partial ranks of one item
EXACT = 2 ** 53
NO_TERM = -1

# Every byte as the scan sees it: A-Z as a-z, digits and all bytes of other characters as they are, the rest spaces.
SEEN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(SEEN).split()


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` as the scan sees it, between spaces, in runs of about ``size`` bytes cut at spaces."""
    seen = b" " + text.translate(SEEN) + b" "
    at = 0
    while at < len(seen) - 1:
        end = seen.find(b" ", min(at + size, len(seen) - 1))
        yield seen[at:end + 1]
        at = end


@dataclass(frozen=True)
class Items:
    """A block of items: ids, the terms, and for the term i the items ``held[first[i]:first[i + 1]]``."""
    ids: list
    terms: list[str]
    first: np.ndarray
    held: np.ndarray

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        """``rows`` of (item_id, text); rows of one id are one item."""
        own: dict = {}
        for ident, text in rows:
            own.setdefault(ident, set()).update(terms(text or b""))
        ids = [i for i, t in own.items() if t]
        holders: dict[bytes, list[int]] = {}
        for n, ident in enumerate(ids):
            for t in own[ident]:
                holders.setdefault(t, []).append(n)
        known = sorted(holders)
        first = np.concatenate([[0], np.cumsum([len(holders[t]) for t in known])]).astype(np.int64)
        held = np.array([n for t in known for n in holders[t]], np.int64)
        return Items(ids, [t.decode("utf-8", "replace") for t in known], first, held)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        found.add_word("  ", NO_TERM)  # an automaton cannot be empty
        for i, t in enumerate(self.terms):
            found.add_word(f" {t} ", i)
        found.make_automaton()
        return found

    def most_terms(self) -> int:
        return int(np.bincount(self.held).max()) if len(self.held) else 0


def counts(automaton: ahocorasick.Automaton, text: bytes) -> tuple[int, Counter]:
    """Number of terms of ``text``, and how often each of the automaton's occurs."""
    n, tf = 0, Counter()
    for piece in pieces(text):
        n += len(piece.split())
        tf.update(map(itemgetter(1), automaton.iter(piece.decode("utf-8", "replace"))))
    tf.pop(NO_TERM, None)
    return n, tf


def corpus_counts(docs: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """(documents with a term, their terms, documents of each item term) over all ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = items.automaton()
        size = len(items.terms)
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                n, tf = counts(automaton, text.as_py())
                if n:
                    total[list(tf)] += 1
                    total[size] += 1
                    total[size + 1] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["i", "n"])

    rows = docs.select("text").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    out = np.zeros(len(items.terms) + 2, np.int64)
    for r in rows.collect():  # a block's terms at most
        out[r["i"]] = r["n"]
    return int(out[-2]), int(out[-1]), out[:-2]


class Best:
    """The ``k`` best documents of each item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)  # a lower score cannot enter
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, scores: np.ndarray, ident: int | None) -> None:
        enters = np.flatnonzero(scores >= self.least)
        if len(enters):
            n = len(enters)
            self.parts.append((enters, scores[enters], np.full(n, ident or 0, np.int64), np.full(n, ident is None)))
            self.size += n
            if self.size > KEEP_AT_ONCE + len(self.least) * self.k:
                self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))
        item, score, ident, null = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ident, null, -score, item))
        item, score, ident, null = item[order], score[order], ident[order], null[order]
        starts = np.flatnonzero(np.diff(item, prepend=-1))
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(starts, append=len(item)))
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[item[last]] = score[last]
        kept = item[keep], score[keep], ident[keep], null[keep]
        self.parts, self.size = [kept], int(keep.sum())
        return kept


def best_of_tasks(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best ``k`` documents of each item in each task."""
    n_docs, n_terms, df = corpus_counts(docs, items)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    floats = items.most_terms() * int(weight.max(initial=0)) * 10 ** 6 < EXACT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = items.automaton()
        best = Best(len(items.ids), k)
        for batch in batches:
            for ident, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, tf = counts(automaton, text.as_py())
                if not tf:
                    continue
                m = 50 + (50 * n * n_docs) // n_terms
                at = np.fromiter(tf.keys(), np.int64, len(tf))
                often = np.fromiter(tf.values(), np.int64, len(tf))
                part = weight[at] * ((1_000_000_000 * often) // (1000 * often + 20 * m))
                # The items of all found terms, one after another.
                width = items.first[at + 1] - items.first[at]
                ends = np.cumsum(width)
                place = np.arange(ends[-1]) + np.repeat(items.first[at] - ends + width, width)
                if floats:  # sums of whole numbers below 2**53 are exact
                    scores = np.bincount(items.held[place], np.repeat(part, width), len(items.ids)).astype(np.int64)
                else:
                    scores = np.zeros(len(items.ids), np.int64)
                    np.add.at(scores, items.held[place], np.repeat(part, width))
                best.add(scores, ident)
        item, score, doc, null = best.prune()
        for a in range(0, len(item), 10_000):
            b = slice(a, a + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array([items.ids[i] for i in item[b].tolist()], pa.int64()), pa.array(doc[b], pa.int64(), mask=null[b]),
                                              pa.array(score[b], pa.int64())], names=["item_id", "doc_id", "score"])

    return docs.mapInArrow(run, "item_id long, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each item, first of each of ``SALTS`` parts of it."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order)))
    last = some.filter(F.col("rank") <= k).drop("rank", "salt")
    last = last.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return last.filter(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents with a score above 0, ranks from 1.

    A null or empty text has no terms: such a document is found by no item and counts nowhere, such an item
    finds nothing.  Items of one id are one item with all their terms.  Repeated documents count and rank
    each for itself, with ranks of their own; equal scores are in order of doc_id, null ids
    last.  An empty table of either kind gives an empty result.  Other columns are not read.  Texts are
    whole; a long one is scanned in pieces cut at spaces.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), text_of(items).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    path = join_path(shared_dir(spark), "llm", f"search-{uuid.uuid4().hex[:12]}")
    for block in range(blocks):
        mine = texts.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = ranked(best_of_tasks(slim, Items.of([tuple(r) for r in mine.collect()]), k), k)
        if blocks == 1:
            return found
        found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH seen AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, row_number() OVER () AS r,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM seen),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term),
docs AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2e0 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
wanted AS (
  SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, r, any_value(tf.doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN docs USING (r), total
  GROUP BY item_id, r),
best AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 50
"""
