"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import STAGES
from loanscope.llm import chat, decontam, exact_dedup, langid, license_scan, mixing, pii, simhash, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves, as further columns of the input.
CLASHES = ["t", "w", "h", "n", "fp", "row", "key", "spans", "edits", "kept", "len", "sha", "toxic", "topic", "probability",
           "lang_pred", "score", "idx", "seg", "cost", "component_id", "item_id", "tree", "p", "s", "c", "ctx", "__P", "__sha", "__t", "__n", "__n_id",
           "__len", "__keep", "__id", "__h", "__source", "__lang", "__topic", "__tokens", "__weight", "__probability", "__sampled", "id", "keep", "n_id",
           "lost", "hash", "tokens", "weight", "gap", "sampled", "rejected", "a.b", "a b", "`q`", "DOC_IDS", "held", "lengths", "text_hash"]
LONG = "All rights reserved by the owner of this text. " * 5000
ROWS = [
    (1, "The cat sat on the mat and looked at the dog", "en", "a", 10), (2, None, "en", "a", 0), (3, "", None, None, None),
    (4, " \t\n ", "de", "b", 4), (5, LONG, "en", "a", len(LONG)), (6, "x" * 120_000, "fr", None, 120_000),
    (7, "Der Hund und die Katze sitzen auf der Matte", "de", "b", 20), (7, "Der Hund und die Katze sitzen auf der Matte", "de", "b", 20),
    (None, "Le chat est sur le tapis avec le chien", "fr", "c", 30), (None, "Le chat est sur le tapis avec le chien", "fr", "c", 30),
    (8, "The cat sat on the mat and looked at the dog", "en", "a", 10), (9, "12345 67890 !!", None, "c", 14),
    (10, "mail joe@example.org or +1 (555) 123-4567", "en", "c", 41), (11, "\U0001f600 École 你好", "fr", "c", 9),
]
TURNS = [(1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", ""), (None, 0, "user", "hello"),
         (None, None, None, "who"), (2, 0, "assistant", LONG), (3, 0, "system", "only"), (4, 5, "user", "a <| b \\| c <\\| \\\\"), (4, 5, "assistant", "<|im_end|>")]


def with_clashes(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def docs(spark):
    return with_clashes(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return with_clashes(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "sat on the mat and looked"), (2, None), (3, ""), (None, "no such words anywhere at all"),
                                  (4, "katze")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, None, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")


def all_operators(docs, benchmark, labels):
    return {
        "license_scan": license_scan.scan_digest(license_scan.license_scan(docs)),
        "mixing": mixing.mixed(docs),
        "toxicity": toxicity.toxicity(docs, toxicity.fit(docs, labels)),
        "pii": pii.pii_digest(pii.pii_spans(docs)),
        "exact_dedup": exact_dedup.exact_dedup(docs),
        "langid": langid.identify(docs, langid.fit(docs)),
        "token_counts": token_counts.recounted(token_counts.with_trees(token_counts.masking_edits(docs), token_counts.read_ranks()),
                                               token_counts.read_ranks()),
        "simhash": simhash.simhash_dedup(docs),
    }


@pytest.fixture(scope="module")
def results(docs, benchmark, labels):
    return {k: [r.asDict() for r in df.collect()] for k, df in all_operators(docs, benchmark, labels).items()}


def by_id(rows, ident):
    return [r for r in rows if r["doc_id"] == ident]


def test_one_row_for_each_row(results):
    for name, rows in results.items():
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS), name


def test_empty_tables(none, benchmark, labels):
    for name, df in all_operators(none, benchmark, labels).items():
        assert df.count() == 0, name
    assert decontam.contaminations(none, benchmark).count() == 0


def test_license_scan(results):
    rows = results["license_scan"]
    assert [(r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) for i in (2, 3, 4) for r in by_id(rows, i)] == [(0, 0, None, "", 0.0)] * 3
    long = by_id(rows, 5)[0]
    assert (long["n_words"], long["n_base"], long["first_word"], long["last_word"]) == (45_000, 5000, 0, 44_991)
    assert by_id(rows, 6)[0]["n_words"] == 1


def test_pii(results):
    rows = results["pii"]
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r["base_sha256"], r["spans"], r["n_email"]) for i in (2, 3, 4, 6) for r in by_id(rows, i)] == [(empty, "", 0)] * 4
    assert by_id(rows, 10)[0]["spans"] == "email:5:20,phone:24:41"


def test_exact_dedup(results):
    rows = results["exact_dedup"]
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in by_id(rows, 8)] == [(1, 2, False)]
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in by_id(rows, 7)) == [(7, 2, False), (7, 2, True)]
    assert sorted(r["kept"] for r in by_id(rows, None)) == [False, True]
    assert {(r["keep_id"], r["group_size"]) for i in (2, 3) for r in by_id(rows, i)} == {(2, 2)}
    assert by_id(rows, 4)[0]["text_sha256"] == hashlib.sha256(b" ").hexdigest()


def test_simhash(results):
    rows = results["simhash"]
    assert [(r["fingerprint"], r["component_id"]) for i in (2, 3, 4) for r in by_id(rows, i)] == [("0" * 16, 2)] * 3
    assert by_id(rows, 8)[0]["component_id"] == 1
    assert [r["component_id"] for r in by_id(rows, None)] == [None, None]


def test_langid(results):
    rows = results["langid"]
    assert [(r["lang_pred"], r["score"]) for i in (2, 3, 4, 9) for r in by_id(rows, i)] == [("und", 0.0)] * 4
    assert all(r["lang_pred"] in ("en", "de", "fr") and 0 <= r["score"] <= 1 for i in (1, 5, 6, 7, 11) for r in by_id(rows, i))
    assert [r["held_out"] for r in by_id(rows, None)] == [False, False]


def test_language_id_without_training_rows(docs):
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}


def test_token_counts(results):
    rows = results["token_counts"]
    assert [(r["n_tokens"], r["n_tokens_after"], r["n_edits"]) for i in (2, 3) for r in by_id(rows, i)] == [(0, 0, 0)] * 2
    assert by_id(rows, 10)[0]["n_edits"] == 2 and "<email>" in by_id(rows, 10)[0]["text"]


def test_mixing(results):
    rows = results["mixing"]
    assert all(0 <= r["probability"] <= 1 + 1e-9 for r in rows)
    assert [(r["n_tokens"], r["sampled"]) for r in by_id(rows, 2)][0][0] == 0
    assert {r["source"] for r in by_id(rows, 3)} == {None}


def test_toxicity_without_both_labels(results):
    assert {(r["severity"], r["toxic"]) for r in results["toxicity"]} == {(0.0, False)}


def test_decontamination(docs, benchmark, spark):
    found = [(r["doc_id"], r["item_id"]) for r in decontam.contaminations(docs, benchmark).collect()]
    assert sorted(found) == [(1, 1), (7, 4), (7, 4), (8, 1)]
    kept = decontam.without_benchmark(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in ROWS if r[0] not in (1, 7, 8))
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminations(docs, empty).count() == 0
    assert decontam.without_benchmark(docs, empty).count() == len(ROWS)


def test_chat(spark):
    c = with_clashes(spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string"))
    rows = {r["conv_id"]: r for r in chat.read_back(chat.windows(c)).collect()}
    assert {k: r["n_turns"] for k, r in rows.items()} == {1: 4, None: 2, 2: 1, 3: 1, 4: 2}
    said = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in sorted((t for t in TURNS if t[0] == 4), key=lambda t: t[2]))
    assert rows[4]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert rows[2]["loss_chars"] == len(LONG) and rows[3]["loss_chars"] == 0
    assert rows[None]["turns_sha256"] == hashlib.sha256(b"\nwho\nuser\nhello\n").hexdigest()
    assert chat.read_back(chat.windows(c.filter("false"))).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in STAGES[:-1]], ids=[n for n, _ in STAGES[:-1]])
def test_stages_keep_columns(spark, docs, none, stage):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, plain, "/root/testdata/sf0.001").columns == plain.columns
    out = stage(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns and 0 < out.count() <= len(ROWS)
    further = out.select(*[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(CLASHES)])
    assert {x for r in further.collect() for x in r} == {"clash"}
    assert stage(spark, none, "/root/testdata/sf0.001").count() == 0


def test_last_stage(spark, docs, none):
    out = STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert out.columns == [c for c in docs.columns if c not in ("topic", "probability", "gap")] + ["topic", "probability", "gap"]
    assert {(r["__source"], r["a.b"], r["weight"]) for r in out.collect()} == {("clash",) * 3}
    assert out.filter("doc_id is not null").count() <= len(ROWS)
    assert STAGES[-1][1](spark, none, "/root/testdata/sf0.001").count() == 0
