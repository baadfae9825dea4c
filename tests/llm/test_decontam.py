import random
import re
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from loanscope.llm import decontam, grams


def words_of(text):
    return re.findall(r"[0-9a-zÀ-ɏ]+", (text or "").lower())


def shingles(words, k):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def brute(docs, items, similarity=decontam.SIMILARITY):
    """Every window of every document against every item; no fingerprints."""
    sizes = {i: min(5, len(words_of(t))) for i, t in items}
    counts = {i: Counter(shingles(words_of(t), sizes[i])) for i, t in items if words_of(t)}
    df = Counter(x for c in counts.values() for x in c)
    weight = lambda x: np.log1p(len(counts) / df[x]) if x in df else np.log1p(len(counts))
    texts, out = dict(items), {}
    for d, text in docs:
        words = words_of(text)
        for i, own in counts.items():
            n = len(words_of(texts[i]))
            if own.keys().isdisjoint(shingles(words, sizes[i])):
                continue  # similarity 0 with every window
            for at in range(len(words) - n + 1):
                window = Counter(shingles(words[at:at + n], sizes[i]))
                both = own.keys() | window.keys()
                sim = sum(weight(x) * min(own[x], window[x]) for x in both) / sum(weight(x) * max(own[x], window[x]) for x in both)
                if sim >= similarity and sim > out.get((d, i), (0,))[0] + 1e-12:
                    out[d, i] = sim, at, n
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 5))) for _ in range(120)]
    said = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(said(rng.choice([1, 3, 4, 5, 6, 15, 30, 45])))) for i in range(25)]
    items = [(i, t) for i, t in items if len(t.split()) > 2 or i == 0] + [(90, items[-1][1]), (91, None), (92, "?!")]
    docs = []
    for d in range(200):
        words = said(rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            copy = rng.choice(items)[1]
            copy = (copy or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):  # edits: changed, dropped and added words
                if copy:
                    k = rng.randrange(len(copy))
                    copy[k:k + rng.randint(0, 2)] = said(rng.randint(0, 2))
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if rng.random() < .2 else w for w in copy]
        docs.append((d, rng.choice([" ", "\n", ", "]).join(words)))
    got = decontam.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"], r["n_words"]) for r in got.collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and len(want) > 30
    assert any(s < 1 for s, _, _ in want.values())
    for k in want:
        assert abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1:] == want[k][1:]


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    items = [(i, f"{i} alpha beta gamma delta epsilon zeta {i}") for i in range(12)]
    docs = [(i, f"say {i} alpha beta gamma delta epsilon zeta {i} again") for i in range(20)]
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    whole = sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminations(d, b).collect())
    assert len(list(decontam.item_blocks(b, 100))) > 2
    blocks = list(decontam.item_blocks(b, 100))
    monkeypatch.setattr(decontam, "item_blocks", lambda _: iter(blocks))
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminations(d, b).collect() if r["doc_id"] == r["item_id"]) == [
        (x, y) for x, y in whole if x == y] == [(i, i) for i in range(12)]


def test_weights_are_those_of_the_whole_benchmark(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    stock = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(6)]
    items = [(i, " ".join([rng.choice(stock), *rng.choices(vocabulary, k=12), rng.choice(stock)])) for i in range(40)]
    docs = []
    for d in range(80):
        words = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 1])):
            words[rng.randrange(len(words))] = "new"
        # Ends with shingles of other items, of other blocks.
        words[len(words) - rng.randint(1, 5):] = rng.choice(stock).split()[:5]
        docs.append((d, " ".join(["x"] * 9 + words + ["x"] * 9)))
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    pairs = lambda: {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["first_word"], r["n_words"]) for r in decontam.contaminations(d, b).collect()}
    whole = pairs()
    assert len(whole) > 10 and any(s < 1 for s, _, _ in whole.values())
    blocks = list(decontam.item_blocks(b, 900))
    assert len(blocks) > 5
    monkeypatch.setattr(decontam, "item_blocks", lambda _: iter(blocks))
    assert pairs() == whole
    assert {k: v[0] for k, v in whole.items()} == {k: round(v[0], 9) for k, v in brute(docs, items).items()}


def test_documents_shorter_than_an_item(spark):
    words = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(words)), (2, "one two three four"), (3, " ".join(f"v{i}" for i in range(40)))]
    docs = [(1, " ".join(words[:38])), (2, " ".join(words[1:])), (3, " ".join(words[:20])), (4, "one two three"), (5, "")]
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["first_word"], r["n_words"], round(r["similarity"], 9)) for r in decontam.contaminations(d, b).collect())
    assert got == [(1, 1, 0, 38, round(34 / 36, 9)), (2, 1, 0, 39, round(35 / 36, 9))]
    assert sorted(r["doc_id"] for r in decontam.without_benchmark(d, b).collect()) == [3, 4, 5]


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 11), st.sets(st.integers(0, 63), max_size=30)), min_size=1, max_size=12))
def test_index_guarantees_the_radius(prints, near):
    prints = np.array(prints, np.uint64)
    queries = np.array([int(prints[i % len(prints)]) ^ sum(1 << b for b in bits) for i, bits in near], np.uint64)
    got = {(q, p) for q, p, _ in decontam.HammingIndex(prints).within(queries)}
    assert got == {(q, p) for q in range(len(queries)) for p in range(len(prints)) if int(queries[q] ^ prints[p]).bit_count() <= decontam.RADIUS}


@given(st.text(alphabet="aZ9é. \n«“x", max_size=40))
def test_words(text):
    h, starts, ends = grams.words(text.encode())
    raw = text.encode()
    assert [raw[a:b].decode().lower() for a, b in zip(starts, ends)] == [w.lower() for w in re.findall(r"[aZ9éx]+", text)]
    assert len(set(h.tolist())) == len({raw[a:b].lower() for a, b in zip(starts, ends)})
