import pytest
from hypothesis import given
from hypothesis import strategies as st

from loanscope.llm import token_counts as tc

PIECES = st.lists(st.sampled_from([" ", "  ", "\n", " \n", "\t", "a", "the", " the", "'s", "1", "23", ".", "…", "é", "日本", " ", "\x1c", "word "]), max_size=50).map("".join)
EDITS = st.lists(st.tuples(st.integers(0, 80), st.integers(0, 9), PIECES), max_size=4)


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(tc.read_ranks())


@given(PIECES)
def test_leaves_add_up(counter, text):
    lengths, counts = tc.leaves_of(text, counter, leaf=2)
    assert sum(lengths) == len(text) and sum(counts) == counter.count(text)


@given(PIECES, EDITS)
def test_recount_equals_counting_anew(counter, text, edits):
    lengths, counts = tc.leaves_of(text, counter, leaf=2)
    own = tc.merged_edits([{"start": a, "end": a + n, "put": p} for a, n, p in edits], len(text))
    after, lengths, tree, encoded = tc.recount(text, lengths, tc.tree_of(counts), own, counter)
    want = text
    for a, b, p in reversed(own):
        want = want[:a] + p + want[b:]
    assert after == want and tree[1] == counter.count(want) and sum(lengths) == len(want)
    size = len(tree) // 2
    assert all(tree[i] == tree[2 * i] + tree[2 * i + 1] for i in range(1, size))
    assert encoded <= len(want) and (own or not encoded)


def test_edits_read_only_their_surroundings(counter):
    text = "some words of a long text, " * 4000
    lengths, counts = tc.leaves_of(text, counter)
    _, _, tree, encoded = tc.recount(text, lengths, tc.tree_of(counts), [(50_000, 50_003, "XYZ")], counter)
    assert encoded < 1000 and tree[1] == counter.count(text[:50_000] + "XYZ" + text[50_003:])


def test_documents_against_counting_whole_texts(spark, counter):
    docs = tc.masking_edits(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ranks = tc.read_ranks()
    rows = tc.recounted(tc.with_trees(docs, ranks), ranks).collect()
    assert len(rows) == len(texts) and sum(r["n_edits"] for r in rows) > 50
    for r in rows:
        assert (r["n_tokens"], r["n_tokens_after"]) == (counter.count(texts[r["doc_id"]]), counter.count(r["text"]))
        assert (r["text"] != texts[r["doc_id"]]) == (r["n_edits"] > 0)
