import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from loanscope.llm import simhash


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@given(st.text(alphabet="aAbÉé \t\n .", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) & ((1 << 64) - 1) == brute_fingerprint(text)


def test_fingerprint_of_a_long_text(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=500))
    want = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text.encode()) == want
    assert want & ((1 << 64) - 1) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for i in range(64):
        for j in range(i, 64 if radius == 2 else i + 1):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def brute_components(prints, radius):
    n, root = len(prints), list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("small", [2, 32])
def test_components_against_all_pairs(spark, radius, small):
    rng = np.random.RandomState(4)
    centres = rng.randint(0, 1 << 62, 30, dtype=np.int64).view(np.uint64)
    prints = []
    for c in centres:  # chains and clusters of near fingerprints
        for _ in range(rng.randint(1, 25)):
            c = c ^ np.uint64(1 << int(rng.randint(64)))
            prints += [c] if rng.rand() < .7 else [c, c]
    prints = np.array(prints, np.uint64)
    rows = [(100 + i, int(p)) for i, p in enumerate(prints.view(np.int64))]
    got = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, fp long"), radius, small)
    component = {r["fp"]: r["component_id"] for r in got.collect()}
    assert [component[fp] for _, fp in rows] == [100 + i for i in brute_components(prints, radius)]


def test_documents(spark):
    texts = ["", None, "  ", "one", "One", "a b c d e f", "a b c d  e f", "quite another text altogether here"] + ["hot text of many copies"] * 50
    got = {r["doc_id"]: r for r in simhash.simhash_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i]["component_id"] for i in range(9)] == [0, 0, 0, 3, 3, 5, 5, 7, 8]
    assert {got[i]["component_id"] for i in range(8, 58)} == {8}
    kept = simhash.keep_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 5, 7, 8]
