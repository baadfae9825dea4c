"""Language ID by error-correcting output codes.

Every language gets a codeword of +1/-1 bits, far from the others' in Hamming distance.  One binary
classifier for each bit tells the languages with +1 from those with -1 by the byte n-grams of the
lower-cased text: its margin is the mean, over the text's n-grams, of log p(gram | +1) - log p(gram | -1),
times ``SHARPNESS``.  Loss-weighted decoding chooses the codeword with the least sum of
log(1 + exp(-bit * margin)), each classifier weighted by how well it separates its two sides;
the score is the codeword's share of exp(-loss), and a text whose best two codewords are close is ambiguous.

Every given language is learnt.  Training counts n-grams of all training rows by (language, bucket): each task
hands out its sums, Spark adds them up, and each bucket's weights of all bits follow from its counts of all
languages, also in Spark.  The driver sees the languages' names and totals and buckets x bits weights, bits being some
ten times the logarithm of the languages.  Prediction is a map over the documents with the weights in the closure: no shuffle.
A long text is counted in pieces that overlap by the two bytes an n-gram reaches over.
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

from loanscope.llm.common import bound_batches, land, packed, text_of, unpacked
from loanscope.llm.grams import chunks
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

BUCKET_BITS = 14
HELD_LANGUAGES = 64  # whose counts a task holds at a time
SHARPNESS = 4.0
DECODED_AT_ONCE = 256  # texts, times the languages
AMBIGUOUS = 0.2  # least gap between the best two codewords' scores
UNDETERMINED = "und"
PER_CHUNK = 1 << 20  # bytes of texts taken together, and of a piece of a longer one
DRAWS = 200  # of codewords; a single one beyond LARGE_CODE languages
LARGE_CODE = 512


def buckets(text: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram of three bytes at each place of ``text`` but the last two; other ASCII than letters is one class."""
    t = CLASS[text].astype(np.uint32)
    gram = (t[:-2] << np.uint32(16)) | (t[1:-1] << np.uint32(8)) | t[2:]
    return (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


CLASS = np.arange(256, dtype=np.uint8)
CLASS[:128] = 32
CLASS[97:123] = np.arange(97, 123)
CLASS[65:91] = np.arange(97, 123)


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of ``texts``, each between spaces, and the offset of each text's first; a text of b bytes has b."""
    joined = np.frombuffer(b" " + b"  ".join(texts) + b" ", np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths + 2)])[:-1]
    return buckets(joined), offsets


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: a language is given and crc32(doc_id as text) mod 4 is not 2."""
    return docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """How often each bucket occurs in ``texts``."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    short = [t for t in texts if 0 < len(t) <= PER_CHUNK]
    for first, last in chunks(short, PER_CHUNK):
        b, offsets = padded(short[first:last])
        valid = np.zeros(len(b), bool)
        for o, t in zip(offsets.tolist(), short[first:last]):
            valid[o:o + len(t)] = True
        total += np.bincount(b[valid], minlength=1 << BUCKET_BITS)
    for t in texts:
        if len(t) > PER_CHUNK:
            total += long_counts(t)
    return total


def long_counts(text: bytes) -> np.ndarray:
    """``bucket_counts`` of one text, in pieces."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for at in range(0, len(text), PER_CHUNK):
        piece = (text[at - 1:at] or b" ") + text[at:at + PER_CHUNK + 1]
        piece += b" " if at + PER_CHUNK >= len(text) else b""
        total += np.bincount(buckets(np.frombuffer(piece, np.uint8)), minlength=1 << BUCKET_BITS)
    return total


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n): how often each bucket occurs in the texts of each language."""

    def told(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        # One row for each language and task: few rows, whose sums are made by Spark.
        for lang, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([counts], pa.list_(pa.int64()))], names=["lang", "counts"])
        total.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own: dict[str, list[bytes]] = {}
            for lang, t in zip(langs, texts):
                own.setdefault(lang, []).append(t)
            for lang, group in own.items():
                total[lang] = total.get(lang, 0) + bucket_counts(group)
                if len(total) > HELD_LANGUAGES:
                    yield from told(total)
        yield from told(total)

    parts = rows.select("lang", F.lower(text_of(rows)).cast("binary").alias("text")).mapInArrow(run, "lang string, counts array<bigint>")
    return parts.select("lang", F.posexplode("counts").alias("bucket", "n")).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).filter("n > 0")


def bit_sums(counts: DataFrame, languages: list[str], scale: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket and bit: the sums of ``scale`` times the count over the languages with +1 and over those with -1."""
    place = {lang: i for i, lang in enumerate(languages)}
    plus = code > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sums = [], []
            for bucket, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                share = np.zeros(len(place))
                for x in held.as_py():
                    i = place[x["lang"]]
                    share[i] = x["n"] * scale[i]
                at.append(bucket)
                sums.append(np.concatenate([share @ plus, share @ ~plus]))
            if at:
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums, pa.list_(pa.float64()))], names=["bucket", "sums"])

    # A bucket's row has a count per language at most.
    by_bucket = counts.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.collect_list(F.struct("lang", "n")).alias("held"))
    out = np.zeros((1 << BUCKET_BITS, 2 * code.shape[1]))
    for r in by_bucket.mapInArrow(run, "bucket long, sums array<double>").collect():
        out[r["bucket"]] = r["sums"]
    return out[:, :code.shape[1]], out[:, code.shape[1]:]


def codewords(n: int) -> np.ndarray:
    """n x bits of +1/-1, rows far apart: all different splits for few languages, else the best of many draws."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        return np.array([[1 if i == n - 1 or column >> i & 1 else -1 for column in range(2 ** (n - 1) - 1)] for i in range(n)], float)
    bits = int(np.ceil(10 * np.log2(n)))
    random = np.random.RandomState(n)
    best, least = None, 0  # no two alike
    for _ in range(DRAWS):
        code = random.choice([-1.0, 1.0], (n, bits))
        if (np.abs(code.sum(0)) == n).any():
            continue
        distance = least_distance(code)
        if distance > least:
            best, least = code, distance
            if n > LARGE_CODE:
                break
    return best


def least_distance(code: np.ndarray, rows: int = 1024) -> int:
    """Fewest bits in which two codewords differ."""
    n, bits = code.shape
    least = bits
    for a in range(0, n, rows):
        alike = code[a:a + rows] @ code.T
        alike[np.arange(len(alike)), np.arange(a, a + len(alike))] = -bits
        least = min(least, int((bits - alike.max()) / 2))
    return least


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # bits

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, ambiguous) by the least weighted loss."""
        lang, score, ambiguous = [], [], []
        for a in range(0, len(margins), DECODED_AT_ONCE):
            m = margins[a:a + DECODED_AT_ONCE]
            # The loss of a bit is one of two values.
            plus = self.code > 0
            loss = (np.logaddexp(0, -m) * self.trust) @ plus.T + (np.logaddexp(0, m) * self.trust) @ ~plus.T
            share = np.exp(loss.min(1, keepdims=True) - loss)
            share /= share.sum(1, keepdims=True)
            best = loss.argmin(1)
            top = share[np.arange(len(m)), best]
            share[np.arange(len(m)), best] = 0
            lang.append(best)
            score.append(top)
            ambiguous.append(top - share.max(1) < AMBIGUOUS)
        return tuple(np.concatenate(x) for x in (lang, score, ambiguous)) if lang else (np.empty(0, int), np.empty(0), np.empty(0, bool))

    def margins(self, texts: list[bytes]) -> np.ndarray:
        bits = self.weights.shape[1]
        out = np.zeros((len(texts), bits))
        most = max(1 << 12, PER_CHUNK * 8 // max(8, bits))  # bytes whose weights of all bits are held
        some = [i for i, t in enumerate(texts) if 0 < len(t) <= most]
        for first, last in chunks([texts[i] for i in some], most):
            group = [texts[i] for i in some[first:last]]
            b, offsets = padded(group)
            w = np.take(self.weights, b, axis=0)
            lengths = np.array([len(t) for t in group])
            # Grams between two texts belong to neither.
            cuts = np.ravel(np.column_stack([offsets, offsets + lengths]))
            if cuts[-1] >= len(w):
                cuts = cuts[:-1]
            out[some[first:last]] = np.add.reduceat(w, cuts, axis=0, dtype=np.float64)[0::2] / lengths[:, None]
        for i, t in enumerate(texts):
            if len(t) > most:
                out[i] = long_counts(t) @ self.weights.astype(np.float64) / len(t)
        return out * SHARPNESS


def fit(docs: DataFrame) -> LanguageModel | None:
    """Learn from ``training_rows``; None without any."""
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    counts = land(gram_counts(training_rows(docs)), "language-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return None
    size = 1 << BUCKET_BITS
    total = np.array([totals[lang] for lang in languages], np.float64) + 0.5 * size
    code = codewords(len(languages))
    plus, minus = bit_sums(counts, languages, 1 / total, code)
    weights = np.zeros((size, code.shape[1]), np.float32)
    trust = np.ones(code.shape[1])
    for k in range(code.shape[1]):
        own = code[:, k] > 0
        if own.any() and not own.all():
            p = (plus[:, k] + 0.5 * (1 / total)[own].sum()) / own.sum()
            m = (minus[:, k] + 0.5 * (1 / total)[~own].sum()) / (~own).sum()
            weights[:, k] = np.log(p / m)
            # How far the two sides are apart, in nats a gram (symmetric divergence).
            trust[k] = ((p - m) * np.log(p / m)).sum()
    return LanguageModel(languages, code, weights, trust / trust.mean())


def prediction(model: LanguageModel | None, text: Column) -> Column:
    """Struct (lang_pred, score, ambiguous, rejected) of a text column; rejected: null or without a letter."""
    kind = "lang_pred string, score double, ambiguous boolean, rejected boolean"
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"), (~letters).alias("rejected"))
    if model is None:
        return unknown

    @pandas_udf(kind)
    def predict(texts: pd.Series) -> pd.DataFrame:
        lang, score, ambiguous = model.decode(model.margins(texts.tolist()))
        return pd.DataFrame({"lang_pred": [model.languages[i] for i in lang], "score": score, "ambiguous": ambiguous, "rejected": False})

    found = predict(F.lower(F.when(letters, text).otherwise("")).cast("binary"))
    return F.when(letters, found).otherwise(unknown)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    A null text or one without a letter is 'und' with score 0, ambiguous; so is every text without training
    rows.  A null doc_id is not held out and never learned from.  Repeated rows are predicted
    alike; lang and source are not read here.  An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    p = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), prediction(model, docs["text"]).alias("p"))
    return p.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous")


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, all columns: null texts and those without a letter go, whatever
    languages were learnt (also none, or one that is called 'und')."""
    bound_batches(docs.sparkSession)
    model = fit(docs)
    rows = packed(docs).withColumn("p", prediction(model, F.col("row.text")))
    return unpacked(rows.filter(~F.col("p.rejected")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
