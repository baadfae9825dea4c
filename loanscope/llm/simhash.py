"""SimHash near-dedup by covering locality-sensitive hashing.

Every document gets a 64-bit SimHash of its word shingles.  Two fingerprints link when at most
``radius`` bits differ; a document's component is what links reach.

Covering masks: bit i of the fingerprint is given a vector m(i) of radius + 1 bits, and table v
(v runs over the 2**(radius + 1) - 1 nonzero vectors) keeps the bits with odd <m(i), v>.  Any
``radius`` differing positions span at most ``radius`` dimensions, so some v is orthogonal to
all their vectors and its table keeps none of them: every pair within the radius has the same
key in some table, with certainty.

1. Equal fingerprints collapse first (map-side), so copies never reach the tables.
2. A table's keys are counted; only keys that several fingerprints share go on.
3. Keys of at most ``small`` fingerprints compare them in place and give out true links only.
   A larger key (its size is unbounded) takes a linear way, exact for a radius up to 2: fingerprints
   within two bits of each other share a point at most one bit from both, so each fingerprint is
   sent to the points one free bit away; a point receives at most 65 fingerprints, which
   are linked to the smallest, as all of them reach each other through it.
4. Components by alternating large-star and small-star steps over the links, each landed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from xxhash import xxh64_intdigest

from loanscope.llm.common import bound_batches, land, packed, text_of, unpacked
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

SHINGLE_WORDS = 3
RADIUS = 2
SMALL_KEY = 32
SEED = 42
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash: a bit is 1 if set in over half of the shingles' XXH64."""
    ws = text.lower().split()  # on bytes: lower-cases A-Z, splits at \x20 and \x09-\x0D
    n = max(len(ws) - words + 1, 1)
    if not ws:
        return 0
    shingles = map(b" ".join, zip(*(ws[i:] for i in range(words)))) if len(ws) >= words else iter([b" ".join(ws)])
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        k = min(SHINGLES_AT_ONCE, n - at)
        h = np.fromiter(map(xxh64_intdigest, shingles_take(shingles, k), repeat(SEED)), np.uint64, k)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def shingles_take(shingles: Iterator[bytes], k: int) -> Iterator[bytes]:
    for _, s in zip(range(k), shingles):
        yield s


def fingerprint_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return simhash(text.cast("binary"))


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The tables' masks; m(i) cycles over the nonzero vectors, so each mask keeps about half the bits."""
    size = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if (v & (1 + i % size)).bit_count() % 2) for v in range(1, size + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def table_keys(prints: DataFrame, masks: list[int]) -> DataFrame:
    """(fp, v, key) for each table."""
    rows = [F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for v, m in enumerate(masks)]
    return prints.select("fp", F.inline(F.array(*rows)))


def links(prints: DataFrame, radius: int = RADIUS, small: int = SMALL_KEY) -> DataFrame:
    """Links (a, b), a < b, whose components are those of all pairs of ``prints`` within ``radius`` bits."""
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    masks = covering_masks(radius)
    keyed = table_keys(prints, masks)
    shared = keyed.groupBy("v", "key").agg(F.count("*").alias("size")).filter("size > 1")
    members = land(keyed.join(shared, ["v", "key"]), "simhash-members")

    within = members.filter(F.col("size") <= small).groupBy("v", "key").agg(F.sort_array(F.collect_set("fp")).alias("fps"))
    near = F.filter(F.transform(F.slice("fps", F.col("i") + 2, F.size("fps")), lambda b: F.struct(F.col("a"), b.alias("b"))),
                    lambda p: F.bit_count(p["a"].bitwiseXOR(p["b"])) <= radius)
    pairs = (within.select("fps", F.posexplode("fps").alias("i", "a"))
             .select(near.alias("near")).filter(F.size("near") > 0).select(F.inline("near")))

    large = members.filter(F.col("size") > small)
    free = F.array(*[F.array(*[F.lit(signed(1 << i)) for i in range(64) if not m >> i & 1]) for m in masks])
    points = large.select("fp", F.explode(F.concat(
        F.array("fp"), F.transform(free[F.col("v")], lambda b: F.col("fp").bitwiseXOR(b)))).alias("z"))
    stars = points.groupBy("z").agg(F.collect_set("fp").alias("fps"))
    if radius < 2:  # then a pair links through a point that is one of its two
        stars = stars.filter(F.array_contains("fps", F.col("z")) & (radius > 0))
    wide = (stars.filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .filter("a <> b"))
    return pairs.unionByName(wide).distinct()


def components(edges: DataFrame, limit: int = 50) -> DataFrame:
    """(fp, root) of every node of ``edges`` (a, b), root its component's smallest node."""
    e = land(edges, "simhash-links")
    seen = None
    for _ in range(limit):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("w")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("w")))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("w > u").select(F.col("m").alias("a"), F.col("w").alias("b")).filter("a <> b")
        e = land(large.distinct(), "simhash-large")
        down = e.groupBy("b").agg(F.min("a").alias("m"))
        small = e.join(down, "b")
        e = land(small.select(F.col("m").alias("a"), "b").unionByName(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
                 .filter("a <> b").distinct(), "simhash-small")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    return e.select(F.col("b").alias("fp"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("fp"), F.col("a").alias("root")).distinct())


def near_groups(prints: DataFrame, radius: int = RADIUS, small: int = SMALL_KEY) -> DataFrame:
    """(fp, component_id) for ``prints`` (doc_id, fp): the smallest doc_id reachable."""
    classes = land(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius, small))
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id")


def simhash_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, small: int = SMALL_KEY) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, text_hash.

    Null and empty texts, and texts without words, have fingerprint zero, linked like any other.
    Null ids are never a component's id unless it has no other.  Repeated rows are rows of one
    fingerprint.  An empty table gives an empty result; other columns are not read.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    text = text_of(docs)
    prints = land(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                              fingerprint_column(text, words).alias("fp")), "simhash-prints")
    out = prints.join(near_groups(prints.select("doc_id", "fp"), radius, small), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash")


def keep_components(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the document with the smallest doc_id.

    Rows that repeat a doc_id and its text are one document and share its fate.
    """
    found = simhash_dedup(docs, words, radius)
    out = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    losers = out.select(F.col("doc_id").alias("lost"), F.col("text_hash").alias("hash")).distinct()
    same = F.col("row.doc_id").eqNullSafe(F.col("lost")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("hash"))
    return unpacked(packed(docs).join(losers, same, "left_anti"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
