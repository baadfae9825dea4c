"""Toxicity: severity grades by cumulative-link ordinal regression on sparse text features.

Proportional odds: P(grade >= j | x) = sigmoid(w . x - theta_j) for j = 1..3, one weight vector shared by
ordered thresholds theta_1 < theta_2 < theta_3.  The expected severity is the sum over j of P(grade >= j).

Features of a text are the distinct hashes of its words and of its words' first four and five bytes
(inflected and compounded forms share them).  Only features that tell toxic from other rows in
training are kept: document frequencies by label are counted by Spark, and of those that are more frequent in toxic rows
the ``FEATURES`` with the largest likelihood ratio (G-test), at least ``LEAST_RATIO``, make the model.  The label is binary; among toxic training rows the grade is
1, 2 or 3 as the text holds one, two or more words with a feature of positive log-odds.

Training is on at most ``TRAINING_ROWS`` labelled rows (the smallest hashes of their ids): their sparse
rows over the kept features go to the driver, where gradient steps fit weights and thresholds.  Scoring is a
map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loanscope.llm import grams
from loanscope.llm.common import bound_batches, land, text_of
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

TRAINING_ROWS = 20_000
FEATURES = 2048
LEAST_RATIO = 12.0  # likelihood ratio that a feature must reach
LEAST_ROWS = 4  # toxic rows that a feature must be in
GRADES = 3
RIDGE = 0.01
PREFIXES = (4, 5)
FILTER_BITS = 16


def word_features(text: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """For a buffer of texts: the hash of each word and of its first bytes (the word's own if shorter); word starts."""
    h, starts, ends = grams.words(text)
    out = [h]
    raw = grams.LOWER[np.frombuffer(text, np.uint8)].astype(np.uint64)
    for n in PREFIXES:
        p = np.full(len(h), n, np.uint64)
        longer = ends - starts > n
        for k in range(n):
            p[longer] = p[longer] * grams.BASE + raw[starts[longer] + k]
        out.append(np.where(longer, grams.mixed(p), h))
    return out, starts


def features_by_text(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(text, words x kinds of features)."""
    for first, last in grams.chunks(texts):
        group = texts[first:last]
        kinds, starts = word_features(b"\n".join(group))
        bounds = np.concatenate([[0], np.searchsorted(starts, np.cumsum([len(t) + 1 for t in group]))])
        table = np.stack(kinds, axis=1) if len(starts) else np.empty((0, len(kinds)), np.uint64)
        for i in range(len(group)):
            yield first + i, table[bounds[i]:bounds[i + 1]]


def labelled(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> DataFrame:
    """(toxic, text) of at most ``bound`` labelled documents, chosen by a hash of the id; of several labels the largest, of
    several rows of one id the one with the least text, so that there are no more rows than ids."""
    own = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.select("doc_id", F.lower(text_of(docs)).cast("binary").alias("text"))
    # At most ``bound`` (id, label) rows: a proven size.
    own = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return own.select("toxic", "text")


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, plain, toxic): in how many training rows of each label a feature occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column(0).to_pylist(), np.int64) > 0
            parts: list[list[np.ndarray]] = [[], []]
            for i, table in features_by_text(batch.column(1).to_pylist()):
                parts[int(toxic[i])].append(np.unique(table))
            every = [np.concatenate(p) if p else np.empty(0, np.uint64) for p in parts]
            keys, inverse = np.unique(np.concatenate(every), return_inverse=True)
            plain = np.bincount(inverse[:len(every[0])], minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(plain), pa.array(np.bincount(inverse, minlength=len(keys)) - plain)],
                names=["feature", "plain", "toxic"])

    return rows.mapInArrow(run, "feature long, plain long, toxic long").groupBy("feature").agg(
        F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))


def likelihood_ratio(toxic: Column, plain: Column, n_toxic: int, n_plain: int) -> Column:
    """G statistic of a feature's occurrence against the label; 0 where it is not more frequent in toxic rows."""
    n, has = n_toxic + n_plain, toxic + plain
    cells = [(toxic, has, n_toxic), (plain, has, n_plain), (n_toxic - toxic, n - has, n_toxic), (n_plain - plain, n - has, n_plain)]
    g = sum((F.when(seen > 0, seen * F.log(seen * n / (margin * total))).otherwise(0.0) for seen, margin, total in cells), F.lit(0.0))
    return F.when(toxic * n_plain > plain * n_toxic, 2 * g).otherwise(0.0)


def telling_features(rows: DataFrame, most: int = FEATURES) -> list[int]:
    """At most ``most`` features, by falling likelihood ratio."""
    counts = {bool(r["t"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n0, n1 = counts.get(False, 0), counts.get(True, 0)
    if not n0 or not n1:
        return []
    g = likelihood_ratio(F.col("toxic").cast("double"), F.col("plain").cast("double"), n1, n0)
    top = (feature_counts(rows).filter(F.col("toxic") >= LEAST_ROWS).select("feature", g.alias("g"))
           .filter(F.col("g") >= LEAST_RATIO).orderBy(F.desc("g"), "feature").limit(most))
    return [r["feature"] for r in top.collect()]


class Vocabulary:
    """The kept features, for look-ups of whole batches."""

    def __init__(self, features: list[int]):
        self.keys = np.sort(np.array(features, np.int64).view(np.uint64))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def positions(self, table: np.ndarray) -> np.ndarray:
        """Position of each entry among the kept features, -1 for others."""
        out = np.full(table.shape, -1, np.int64)
        if len(self.keys):
            maybe = self.filter[(table >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            at = np.minimum(np.searchsorted(self.keys, table[maybe]), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == table[maybe], at, -1)
        return out

    def rows(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, int]]:
        """(text, its distinct features, its words with any)."""
        for i, table in features_by_text(texts):
            p = self.positions(table)
            yield i, np.unique(p[p >= 0]), int((p >= 0).any(axis=1).sum())


@dataclass(frozen=True)
class SeverityModel:
    vocabulary: Vocabulary
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def at_least(self, texts: list[bytes]) -> np.ndarray:
        """P(grade >= j) for j = 1.. of each text."""
        x = np.zeros(len(texts))
        for i, own, _ in self.vocabulary.rows(texts):
            x[i] = self.weights[own].sum()
        return sigmoid(x[:, None] - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_cumulative(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, features: int, grades: int = GRADES,
                   ridge: float = RIDGE, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ascending thresholds) of the ridge-penalised cumulative-logit likelihood.

    ``row`` and ``feature`` list the ones of the sparse 0/1 matrix; ``grade`` has each row's.  Thresholds are
    theta_1 and the logarithms of their gaps, so they stay in order.  Gradient steps with momentum, each parameter's
    scaled by a bound of its curvature; a step that raises the loss is taken back and the rate halved.
    """
    n, d = len(grade), features
    scale = np.concatenate([np.bincount(feature, minlength=d) / 4 + ridge, np.full(grades, max(n / 16, 1.0))])
    p = np.concatenate([np.zeros(d), [1.0], np.zeros(grades - 1)])
    velocity, rate, best, kept = np.zeros_like(p), 0.5, np.inf, p.copy()

    def loss_and_slope(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, gaps = p[:d], np.exp(p[d + 1:])
        theta = p[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.bincount(row, w[feature], n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        # P(grade = g) = sigmoid(s - edge_g) - sigmoid(s - edge_{g+1})
        up, down = sigmoid(s - edge[grade]), sigmoid(s - edge[grade + 1])
        up[grade == 0], down[grade == grades] = 1.0, 0.0
        q = np.maximum(up - down, 1e-12)
        du, dd = up * (1 - up) / q, down * (1 - down) / q
        by_theta = np.array([dd[grade == j].sum() - du[grade == j + 1].sum() for j in range(grades)])
        tail = np.cumsum(by_theta[::-1])[::-1]  # theta_j holds theta_1 and the gaps up to it
        slope = np.concatenate([np.bincount(feature, (du - dd)[row], d) - ridge * w, tail[:1], tail[1:] * gaps])
        return -np.log(q).sum() + ridge * (w @ w) / 2, slope

    for _ in range(steps):
        loss, slope = loss_and_slope(p)
        if loss > best + 1e-9:
            rate, velocity, p = rate / 2, np.zeros_like(p), kept.copy()
            if rate < 1e-6:
                break
            continue
        best, kept = loss, p.copy()
        velocity = 0.8 * velocity + rate * slope / scale
        p = p + velocity
    return kept[:d], kept[d] + np.concatenate([[0.0], np.cumsum(np.exp(kept[d + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> SeverityModel | None:
    """Learn from labelled rows; None if one of the two labels is missing or nothing tells them apart."""
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    rows = land(labelled(docs, labels, bound), "toxicity-training")
    telling = telling_features(rows)
    if not telling:
        return None
    vocabulary = Vocabulary(telling)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_pylist()
            found = list(vocabulary.rows(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([toxic[i] for i, _, _ in found], pa.int64()), pa.array([own.tolist() for _, own, _ in found], pa.list_(pa.int32())),
                 pa.array([n for _, _, n in found], pa.int64())], names=["toxic", "own", "n"])

    # At most ``bound`` rows of a few feature numbers each.
    sample = rows.mapInArrow(sparse, "toxic long, own array<int>, n long").collect()
    row = np.repeat(np.arange(len(sample)), [len(r["own"]) for r in sample])
    feature = np.array([f for r in sample for f in r["own"]], np.int64)
    grade = np.array([min(max(r["n"], 1), GRADES) if r["toxic"] > 0 else 0 for r in sample], np.int64)
    weights, thresholds = fit_cumulative(row, feature, grade, len(vocabulary.keys))
    return SeverityModel(vocabulary, weights, thresholds)


def severity(model: SeverityModel | None, text: Column) -> Column:
    """Struct (severity, p_toxic, grade) of a text column; null text counts as empty."""
    if model is None:
        return F.struct(F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic"), F.lit(0).cast("long").alias("grade"))

    @pandas_udf("severity double, p_toxic double, grade long")
    def score(texts: pd.Series) -> pd.DataFrame:
        p = model.at_least(texts.tolist())
        return pd.DataFrame({"severity": p.sum(1), "p_toxic": p[:, 0], "grade": (p >= 0.5).sum(1)})

    return score(F.lower(F.coalesce(text, F.lit(""))).cast("binary"))


def toxicity(docs: DataFrame, model: SeverityModel | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, severity (expected grade, 0 to 3), p_toxic, grade, toxic.

    Null text counts as empty.  Without a model (no labels of both kinds) all severities are 0.
    Repeated rows are scored alike; an empty table gives an empty result; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    s = docs.select(F.col("doc_id").cast("long").alias("doc_id"), severity(model, docs["text"]).alias("s"))
    return s.select("doc_id", "s.severity", "s.p_toxic", "s.grade", (F.col("s.p_toxic") >= 0.5).alias("toxic"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, read_table(spark, sf_dir, "labels")))
