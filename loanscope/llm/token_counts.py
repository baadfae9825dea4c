"""Edit-aware token counts: pre-token segment trees, re-encoding only what edits touch.

A byte-level BPE encodes each pre-token by itself.  Between a non-space, one space and a non-space a
pre-token always begins at the space, whatever stands around; such places cut a text into pieces
whose counts add up.  ``LEAF`` pieces make a leaf, and a segment tree over the leaves keeps
subtree sums: node i has children 2i and 2i + 1, node 1 is the document's count.

An edit (start, end, put) in code points touches the leaves within two characters of it, so the cuts
at both ends of a run of touched leaves stay cuts.  Only those runs are encoded again; a run's
count goes to its first leaf and the sums above the touched leaves are updated, in
O(touched * log leaves).  The other leaves keep their counts without being read.

Documents are only mapped over.  Distinct pieces are encoded once for a task's batch (a bounded
cache).  Tokenizer ranks are read by the driver and go to the tasks with the function.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.common import bound_batches, text_of
from loanscope.llm.pii import KINDS, base_spans
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The vocabulary's own pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 64
CACHED_PIECES = 1 << 18

CUT = re.compile(r"(?<=\S) (?=\S)")
UNSAFE = re.compile(r" \s|\s |\A | \Z")
EDITS = "array<struct<start:int,end:int,put:string>>"
TREE = "array<int>"


class Counter:
    """Token counts of pieces, by an encoder built from rank lines."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.cache: dict[str, int] = {}

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def piece_counts(self, pieces: list[str], first: bool) -> list[int]:
        """Counts of pieces that follow a space (the very first of a text does not)."""
        cache, out = self.cache, []
        if len(cache) > CACHED_PIECES:
            cache.clear()
        get = cache.get
        for p in pieces:
            n = get(p)
            if n is None:
                n = cache[p] = self.count(" " + p)
            out.append(n)
        if first and pieces:
            out[0] = self.count(pieces[0])
        return out


_counters: dict[str, Counter] = {}


def counter(ranks: bytes) -> Counter:
    """One for each vocabulary in a worker, whatever number of tasks it runs."""
    key = hashlib.sha256(ranks).hexdigest()
    if key not in _counters:
        _counters[key] = Counter(ranks)
    return _counters[key]


def pieces_of(text: str) -> list[str]:
    return CUT.split(text) if UNSAFE.search(text) else text.split(" ")


def leaves_of(text: str, c: Counter, first: bool = True, leaf: int = LEAF) -> tuple[list[int], list[int]]:
    """(lengths in code points, token counts) of a text's leaves; a later leaf begins with its space."""
    pieces = pieces_of(text)
    counts = c.piece_counts(pieces, first)
    lengths, sums = [], []
    for i in range(0, len(pieces), leaf):
        group = pieces[i:i + leaf]
        lengths.append(sum(map(len, group)) + len(group) - (i == 0))
        sums.append(sum(counts[i:i + leaf]))
    return lengths, sums


def tree_of(counts: list[int]) -> list[int]:
    """Heap-ordered sums: the root at 1, the leaves in the last half; padded to a power of two."""
    size = 1 << max(0, len(counts) - 1).bit_length()
    tree = [0] * size + counts + [0] * (size - len(counts))
    for i in range(size - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def recount(text: str, lengths: list[int], tree: list[int], edits: list[tuple[int, int, str]], c: Counter) -> tuple[str, list[int], list[int], int]:
    """(edited text, lengths, tree, characters encoded again) after ``edits``, sorted and apart from each other."""
    size = len(tree) // 2
    starts = [0]
    for n in lengths:
        starts.append(starts[-1] + n)
    lengths, tree = list(lengths), list(tree)
    runs: list[list] = []  # [first leaf, last leaf, edits]
    at = 0
    for start, end, put in edits:
        while at + 1 < len(lengths) and starts[at + 1] <= start - 2:
            at += 1
        last = at
        while last + 1 < len(lengths) and starts[last + 1] < end + 2:
            last += 1
        if runs and at <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
            runs[-1][2].append((start, end, put))
        else:
            runs.append([at, last, [(start, end, put)]])
    out, copied, encoded = [], 0, 0
    for first, last, own in runs:
        lo, hi = starts[first], starts[last + 1]
        said, here = [], lo
        for start, end, put in own:
            said += [text[here:start], put]
            here = end
        said = "".join(said) + text[here:hi]
        out += [text[copied:lo], said]
        copied = hi
        encoded += len(said)
        for leaf in range(first, last + 1):
            lengths[leaf] = len(said) if leaf == first else 0
            tree[size + leaf] = c.count(said) if leaf == first else 0
        for i in {(size + leaf) >> 1 for leaf in range(first, last + 1)}:
            while i:
                tree[i] = tree[2 * i] + tree[2 * i + 1]
                i >>= 1
    return "".join(out) + text[copied:], lengths, tree, encoded


def merged_edits(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """In order, within the text; one that overlaps an earlier one is left out."""
    out: list[tuple[int, int, str]] = []
    for e in sorted(edits or [], key=lambda e: (e["start"], e["end"])):
        if 0 <= e["start"] <= e["end"] <= length and (not out or e["start"] >= out[-1][1]):
            out.append((e["start"], e["end"], e["put"] or ""))
    return out


def read_ranks(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def with_trees(docs: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, text, edits of ``docs`` with ``lengths`` and ``tree`` (to be kept with the documents).

    Null text counts as empty and has one empty leaf; other columns are not read.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(ranks)
        for batch in batches:
            found = [leaves_of(t, c) for t in batch.column(1).to_pylist()]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n for n, _ in found], kind), pa.array([tree_of(s) for _, s in found], kind)],
                names=["doc_id", "text", "edits", "lengths", "tree"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"), F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, f"doc_id long, text string, edits {EDITS}, lengths {TREE}, tree {TREE}")


def recounted(kept: DataFrame, ranks: bytes) -> DataFrame:
    """Apply each row's ``edits`` to its kept tree: doc_id, n_tokens, n_edits, n_tokens_after, n_encoded
    (characters encoded again), text, lengths, tree (all after the edits).

    Edits out of the text or overlapping an earlier one are left out; null edits are none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(ranks)
        names = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_encoded", "text", "lengths", "tree"]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in batches:
            rows = []
            for ident, text, edits, lengths, tree in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = merged_edits(edits, len(text))
                after = (text, lengths, tree, 0) if not own else recount(text, lengths, tree, own, c)
                rows.append((ident, tree[1], len(own), after[2][1], after[3], *after[:3]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    return kept.mapInArrow(run, f"doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_encoded long, text string, lengths {TREE}, tree {TREE}")


def masking_edits(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``edits`` of ``docs``: each e-mail, address, card and phone number becomes its kind's mark.  Other columns are not read."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    edits = F.transform(base_spans(text_of(docs)), lambda x: F.struct(
        x["s"].alias("start"), x["e"].alias("end"), F.get(names, x["k"]).alias("put")))
    return docs.select("doc_id", "text", edits.alias("edits"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = masking_edits(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    ranks = read_ranks()
    return recounted(with_trees(docs, ranks), ranks).select(
        "doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_encoded", F.size("lengths").cast("long").alias("n_leaves"))
