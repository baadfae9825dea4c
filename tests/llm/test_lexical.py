import math
import random
import re
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st

from loanscope.llm import lexical

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def terms_of(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def brute(docs, items, k=50):
    counted = [(d, Counter(terms_of(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms_of(t))
    out = []
    for i, own in wanted.items():
        scores = []
        for d, c in counted:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms if c else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def by_item(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abÉé9 ", k=rng.randint(1, 3))) for _ in range(60)]
    said = lambda n: "".join(rng.choice(words).upper() + rng.choice([" ", ".", "\n", " - ", "\u007f", "_"]) for _ in range(n))
    docs = [(i, said(rng.randint(0, 30))) for i in range(150)]
    docs += [(200, docs[3][1]), (201, docs[3][1]), (201, docs[3][1]), (None, docs[3][1]), (300, None), (301, " .\x00 ")]
    items = [(i, said(rng.randint(1, 12))) for i in range(12)] + [(20, None), (21, "?!"), (22, "absentword"), (0, "99 a"), (None, said(4))]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    for k in (3, 50):
        got = found(lexical.search(*tables(spark, docs, items), k=k))
        assert got == by_item(brute(docs, items, k)) and len(got) > 30


def test_blocks_of_items_give_the_same(spark):
    docs, items = corpus(6)
    got = found(lexical.search(*tables(spark, docs, items), k=10, block_bytes=60))
    assert got == by_item(brute(docs, items, 10))


def test_drops_among_ties_and_many_candidates(spark, monkeypatch):
    monkeypatch.setattr(lexical, "KEEP_AT_ONCE", 10)
    docs = [(i, "same text here" if i % 3 else f"same {i} text") for i in range(500)]
    items = [(1, "same here"), (2, "text 3 6 9")]
    got = found(lexical.search(*tables(spark, docs, items), k=7))
    assert got == by_item(brute(docs, items, 7))


def test_sums_beyond_exact_doubles(spark, monkeypatch):
    docs, items = corpus(7)
    monkeypatch.setattr(lexical, "EXACT", 1)
    assert found(lexical.search(*tables(spark, docs, items), k=5)) == by_item(brute(docs, items, 5))


def test_long_texts_are_whole(spark):
    docs = [(1, "wörd " * 600_000 + "last"), (2, "x" * 2_500_000 + " last"), (3, "last wörd")]
    items = [(1, "LAST"), (2, "wörd x")]
    assert found(lexical.search(*tables(spark, docs, items))) == by_item(brute(docs, items))


def test_empty_tables_and_other_columns(spark):
    docs, items = tables(spark, [(1, "a b")], [(1, "a")])
    assert found(lexical.search(docs.limit(0), items)) == [] == found(lexical.search(docs, items.limit(0)))
    docs = docs.selectExpr("*", "1 AS score", "2 AS rank", "3 AS item_id", "'x' AS salt", "4 AS `a.b`")
    assert [r[:3] for r in found(lexical.search(docs, items.selectExpr("*", "5 AS doc_id", "6 AS rank")))] == [(1, 1, 1)]


@given(st.text(alphabet="aZ9é  .\x00\x7f", max_size=60), st.integers(1, 9))
def test_pieces_hold_every_term_once(text, size):
    assert [t.decode() for p in lexical.pieces(text.encode(), size) for t in p.split()] == terms_of(text)
