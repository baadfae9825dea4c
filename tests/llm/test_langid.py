import zlib

import numpy as np
import pytest

from loanscope.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 20])
def test_codewords_are_far_apart(n):
    code = langid.codewords(n)
    distance = (code[:, None] != code[None]).sum(2) + 1000 * np.eye(n, dtype=int)
    assert distance.min() >= {2: 1, 3: 2, 4: 4, 5: 8}.get(n, code.shape[1] // 4)
    assert (np.abs(code.sum(0)) < n).all()


def test_decoding_corrects_a_wrong_bit():
    code = langid.codewords(4)
    model = langid.LanguageModel(list("abcd"), code, np.zeros((1, 7)), np.ones(7))
    margins = 3 * code.copy()
    margins[np.arange(4), [0, 2, 4, 6]] *= -1
    lang, score, ambiguous = model.decode(margins)
    assert lang.tolist() == [0, 1, 2, 3] and (score > 0.9).all() and not ambiguous.any()
    assert model.decode(np.zeros((1, 7)))[2].all()


def test_margins_are_means_over_grams():
    rng = np.random.RandomState(1)
    model = langid.LanguageModel(["a", "b"], langid.codewords(2), rng.randn(1 << langid.BUCKET_BITS, 1).astype(np.float32), np.ones(1))
    texts = [b"one", b"", "École des".encode(), b"x", b"the last one here"]
    got = model.margins(texts)
    for t, m in zip(texts, got):
        b = langid.buckets(np.frombuffer(b" " + t + b" ", np.uint8)) if t else []
        assert np.allclose(m, langid.SHARPNESS * model.weights[b].mean(0) if len(b) else 0, atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs, langid.fit(docs)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 200 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in out]) > 0.97
    assert langid.identified(docs).count() == len(rows)


def test_neither_source_nor_held_out_rows_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    from pyspark.sql import functions as F
    wrong = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = (sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(d, langid.fit(d)).collect()) for d in (docs, wrong))
    assert a == b


def test_every_language_is_learnt(spark):
    rng = np.random.RandomState(3)
    words = {f"l{i:03d}": ["".join(rng.choice(list("abcdefghijklmnop"), 3)) for _ in range(6)] for i in range(300)}
    rows = [(i * 10 + k, " ".join(rng.choice(w, 40)), lang) for i, (lang, w) in enumerate(words.items()) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    seen = sorted({lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2})
    assert model.languages == seen and len(seen) > 290
    found = langid.identify(docs, model).collect()
    truth = {i: lang for i, _, lang in rows}
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in found]) > 0.97


def test_model_against_brute_force(spark):
    rows = [(0, "ab abc", "x"), (1, "b c é", "y"), (3, None, "x"), (4, "", "z"), (5, "Cab", "z"), (6, "ca ca", "x"), (7, "not learnt", None)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    counts = {}
    for _, text, lang in rows:
        if lang and text:
            raw = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
            counts.setdefault(lang, np.zeros(1 << langid.BUCKET_BITS))
            np.add.at(counts[lang], langid.buckets(raw), 1)
    assert model.languages == sorted(counts)
    share = np.stack([(counts[x] + .5) / (counts[x] + .5).sum() for x in model.languages])
    for k in range(model.code.shape[1]):
        p, m = share[model.code[:, k] > 0].mean(0), share[model.code[:, k] < 0].mean(0)
        assert np.allclose(model.weights[:, k], np.log(p / m), atol=1e-5)


def test_nothing_learnt_rejects_no_text(spark):
    rows = [(1, "some text", None), (2, "123", None), (3, None, None), (4, "e", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in langid.identified(docs).collect()) == [1, 4]
    named = docs.selectExpr("doc_id", "text", "'und' as lang")
    assert sorted(r["doc_id"] for r in langid.identified(named).collect()) == [1, 4]


def test_long_texts_in_pieces_are_the_whole(monkeypatch):
    rng = np.random.RandomState(1)
    texts = ["".join(rng.choice(list("ab cé"), n)).encode() for n in (1, 2, 3, 63, 64, 65, 127, 128, 129, 1000)] + [b""]
    whole = [langid.bucket_counts([t]) for t in texts]
    model = langid.LanguageModel(["a", "b"], langid.codewords(2), rng.randn(1 << langid.BUCKET_BITS, 1).astype(np.float32), np.ones(1))
    margins = model.margins(texts)
    monkeypatch.setattr(langid, "PER_CHUNK", 64)
    assert all((langid.bucket_counts([t]) == w).all() for t, w in zip(texts, whole))
    assert (langid.bucket_counts(texts) == sum(whole)).all()
    assert np.allclose(model.margins([t * 9 for t in texts]), np.array([langid.SHARPNESS * langid.bucket_counts([t * 9]) @ model.weights / max(1, 9 * len(t)) for t in texts]), atol=1e-5)
    assert np.allclose(model.margins(texts), margins, atol=1e-5)
