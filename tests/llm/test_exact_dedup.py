import hashlib
import random
import re

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from loanscope.llm import exact_dedup
from loanscope.llm.tries import Trie, common_prefix


@given(st.lists(st.tuples(st.binary(max_size=6), st.one_of(st.none(), st.integers(0, 5))), max_size=40))
def test_trie_owners(rows):
    trie, want = Trie(), {}
    for s, i in rows:
        trie.insert(s, i)
        want.setdefault(s, []).append(i)
    got = dict(trie.owners())
    assert set(got) == set(want)
    for s, ids in want.items():
        least = min((i for i in ids if i is not None), default=None)
        assert got[s] == [least, len(ids), ids.count(least)]
    assert trie.bytes <= sum(map(len, want))


@given(st.binary(max_size=20), st.binary(max_size=20))
def test_common_prefix(a, b):
    k = common_prefix(a, b)
    assert a[:k] == b[:k] and (k == min(len(a), len(b)) or a[k] != b[k])


def test_spilled_subtrees_lose_nothing():
    texts = [b"x%d" % (i % 50) * 30 for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array([len(t) for t in texts]), pa.array([hash(t) % 7 for t in texts]), pa.array(texts), pa.array(range(1000))],
                                       names=["len", "h", "text", "doc_id"])
    rows = [r for b in exact_dedup.local_owners(iter(batch.slice(i, 100) for i in range(0, 1000, 100)), budget=500) for r in b.to_pylist()]
    assert len(rows) > 50 and sum(r["n"] for r in rows) == 1000
    assert {r["text"] for r in rows} == set(texts)


def test_against_brute_force(spark):
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\t", "\n", "\r\n", "\x0b", " ", "é"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in rng.sample(range(10_000), 3000)]
    rows += [(20_000 + i, "one hot text " * 50) for i in range(1500)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    groups = {}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = {(i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows}
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    kept = exact_dedup.keep_owners(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(v) for v in groups.values())
