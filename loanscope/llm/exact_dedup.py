"""Exact dedup: Patricia-trie owners.

Texts are equal when identical after replacing each run of ASCII white space by one space.
Each text belongs to the partition of its (length, content hash); within it full byte strings
go into path-compressed radix tries whose terminal nodes hold the smallest identifier, so
equality never rests on a hash.

1. Map side: a task's texts go into one trie per (length, hash).  One owner row per distinct
   text leaves the task, however many copies it holds, so a group with a third of all rows
   reaches the shuffle as one row per task.  When the tries of a task exceed a memory budget
   the largest subtrees are spilled downstream as owner rows.
2. The owner rows are shuffled by (length, hash), sorted by (hash, length, text) and inserted
   again.  In that order a (length, hash) subtree is complete when the next key begins; it is
   emitted and dropped, so a task holds one subtree.
3. Only texts with several rows come back (digest, owner, size).  Rows find their owner by
   (length, SHA-256): a slim join whose build side holds repeated texts alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.common import DOCUMENT_COLUMNS, bound_batches, land, packed, text_of, unpacked
from loanscope.llm.tries import Trie
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

# Bytes of text a map task's tries may hold before subtrees are spilled.
TRIE_BYTES = 64 << 20

OWNER_SCHEMA = "len long, h long, text binary, doc_id long, n long, n_id long"
GROUP_SCHEMA = "len long, sha string, keep_id long, n long, n_id long"


def normalised(text: Column) -> Column:
    """White-space runs to one space.  Runs that are one space already are not matched."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def local_owners(batches: Iterator[pa.RecordBatch], budget: int = TRIE_BYTES) -> Iterator[pa.RecordBatch]:
    """Per task: tries by (length, hash); yields owner rows, at the end or when over ``budget``."""
    tries: dict[tuple, Trie] = {}
    held = 0

    def spill(down_to: int):
        nonlocal held
        by_size = sorted(tries, key=lambda k: tries[k].bytes, reverse=True)
        out: list[tuple] = []
        size = 0
        for key in by_size:
            if held <= down_to and down_to:
                break
            trie = tries.pop(key)
            held -= trie.bytes
            for s, (ident, n, n_id) in trie.owners():
                out.append((*key, s, ident, n, n_id))
                size += len(s)
            if size > 4 << 20 or len(out) >= 10_000:
                yield out
                out, size = [], 0
        if out:
            yield out

    for batch in batches:
        for length, h, text, ident in zip(*(batch.column(i).to_pylist() for i in range(4))):
            trie = tries.get((length, h))
            if trie is None:
                trie = tries[(length, h)] = Trie()
            before = trie.bytes
            trie.insert(text, ident)
            held += trie.bytes - before
        if held > budget:
            for rows in spill(budget // 2):
                yield _batch(rows)
    for rows in spill(0):
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = ("len", "h", "text", "doc_id", "n", "n_id")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=list(names))


def merged_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted owner rows in; one row per text that several rows share out."""
    key, trie, out = None, Trie(), []

    def close():
        for s, (ident, n, n_id) in trie.owners():
            if n > 1:
                out.append((key[0], hashlib.sha256(s).hexdigest(), ident, n, n_id))

    def flush():
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                          names=["len", "sha", "keep_id", "n", "n_id"])

    for batch in batches:
        for length, h, text, ident, n, n_id in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if key != (length, h):
                if key is not None:
                    close()
                key, trie = (length, h), Trie()
            trie.insert(text, ident, n, n_id)
        if len(out) >= 10_000:
            yield flush()
            out.clear()
    if key is not None:
        close()
    if out:
        yield flush()


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """(len, sha, keep_id, n, n_id) of each text that several rows of ``docs`` share."""
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(text_of(docs)).alias("t"))
    keyed = norm.select(F.octet_length("t").cast("long").alias("len"), F.xxhash64("t").alias("h"),
                        F.col("t").cast("binary").alias("text"), "doc_id")
    owners = keyed.mapInArrow(local_owners, OWNER_SCHEMA)
    # Hash first: in order of length the longest texts of a partition would share its batches.
    placed = owners.repartition("len", "h").sortWithinPartitions("h", "len", "text")
    return land(placed.mapInArrow(merged_groups, GROUP_SCHEMA), "exact-groups")


def with_owner(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """row (of ``docs``), keep, n, n_id and sha (digest of the normalised text)."""
    t = packed(docs).withColumn("t", normalised(F.coalesce("row.text", F.lit(""))))
    t = t.select("row", F.octet_length("t").cast("long").alias("len"), F.sha2(F.col("t").cast("binary"), 256).alias("sha"))
    return t.join(groups.withColumnRenamed("keep_id", "keep"), ["len", "sha"], "left").drop("len")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty.  Null ids never own a text that has another id; a text whose ids
    are all null has a null keep_id and one kept row.  Where the owner's (doc_id, text) is itself
    repeated, one of those rows is kept.  An empty table gives an empty result; columns other
    than doc_id and text are not read.
    """
    slim = docs.select("doc_id", "text")
    groups = duplicate_groups(slim)
    ident = F.col("row.doc_id")
    rows = with_owner(slim, groups).select(
        ident.cast("long").alias("doc_id"),
        F.when(F.col("n").isNull(), ident).otherwise(F.col("keep")).cast("long").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("n").isNull() | ident.eqNullSafe(F.col("keep")), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"), F.coalesce("n_id", F.lit(1)).alias("__n_id"))
    if groups.filter("n_id > 1").isEmpty():
        return rows.drop("__n_id")
    rows = land(rows, "exact-rows")
    again = F.col("kept") & (F.col("__n_id") > 1)
    first = (rows.filter(again).groupBy("doc_id", "keep_id", "group_size", "text_sha256").agg(F.count("*").alias("c"))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("c"))))
             .select("doc_id", "keep_id", "group_size", (F.col("i") == 1).alias("kept"), "text_sha256"))
    return rows.filter(~again).drop("__n_id").unionByName(first)


def keep_owners(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of equal texts the one with the smallest doc_id."""
    groups = duplicate_groups(docs)
    ident = F.col("row.doc_id")
    kept = with_owner(docs, groups).filter(F.col("n").isNull() | ident.eqNullSafe(F.col("keep")))
    if not groups.filter("n_id > 1").isEmpty():
        # The owner's row itself is repeated: one of the repeats stays.
        kept = kept.withColumn("id", ident).dropDuplicates(["sha", "id"])
    return unpacked(kept)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS[:2]))


OP5_SQL = r"""
WITH d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       coalesce(doc_id = min(doc_id) OVER w, true) AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
