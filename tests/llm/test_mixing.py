import numpy as np
import pytest

from loanscope.llm import mixing

SF = "/root/testdata/sf0.01"


def rake(cells, targets):
    """Iterative proportional fitting with dictionaries."""
    w = dict(cells)
    total = sum(cells.values())
    for _ in range(200):
        for d in range(3):
            has = {}
            for k, v in w.items():
                has[k[d]] = has.get(k[d], 0) + v
            want = {v: targets[d].get(v, 0) for v in has}
            scale = total / sum(want.values())
            w = {k: v * want[k[d]] * scale / has[k[d]] for k, v in w.items()}
    return w


@pytest.mark.parametrize("given", [None, {"lang": {"en": 1.0, "fr": 1.0, "de": 2.0, "es": 2.0, "xx": 9.0}}])
def test_raking_against_brute_force(spark, given):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mixed(docs, given).collect()
    cells = {}
    for r in rows:
        k = (r["source"], r["lang"], r["topic"])
        cells[k] = cells.get(k, 0) + r["n_tokens"]
    targets = []
    for d, name in enumerate(mixing.DIMENSIONS):
        marginal = {}
        for k, v in cells.items():
            marginal[k[d]] = marginal.get(k[d], 0) + v
        targets.append({v: t ** mixing.FLATTEN for v, t in marginal.items()} if not (given or {}).get(name) else given[name])
    want = rake(cells, targets)
    top = max(w / cells[k] for k, w in want.items())
    for r in rows:
        k = (r["source"], r["lang"], r["topic"])
        assert r["weight"] == pytest.approx(want[k] / cells[k], rel=1e-4)
        assert r["probability"] == pytest.approx(want[k] / cells[k] / top, rel=1e-4) and r["probability"] <= 1 + 1e-9
    # The sample's tokens follow the targets; its size follows the probabilities.
    p = np.array([r["probability"] for r in rows])
    assert abs(sum(r["sampled"] for r in rows) - p.sum()) < 4 * np.sqrt((p * (1 - p)).sum())
    assert mixing.sampled_mix(docs, given).count() == sum(r["sampled"] for r in rows)


def test_samples_are_nested_and_calibrated(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'some words here' as text", "if(id % 3 = 0, 'a', 'b') as source",
                                          "if(id % 2 = 0, 'en', null) as lang")
    given = {"source": {"a": 0.5, "b": 0.5}, "lang": {"": 0.5, "en": 0.5}}
    one = {r["doc_id"]: r for r in mixing.mixed(docs, given).collect()}
    half = {r["doc_id"]: r["sampled"] for r in mixing.mixed(docs, given, share=0.5).collect()}
    chosen = [r for r in one.values() if r["sampled"]]
    assert all(one[i]["sampled"] for i, s in half.items() if s)
    assert abs(np.mean([r["source"] == "a" for r in chosen]) - 0.5) < 0.02 and abs(np.mean([r["lang"] is None for r in chosen]) - 0.5) < 0.02


def test_values_without_target_get_nothing(spark):
    docs = spark.createDataFrame([(1, "x y", "a", "en"), (2, "x y", "b", "en"), (3, "", "a", "en")], "doc_id long, text string, source string, lang string")
    rows = {r["doc_id"]: r for r in mixing.mixed(docs, {"source": {"a": 1.0}}, topic=lambda t: mixing.F.lit("one")).collect()}
    assert (rows[1]["probability"], rows[2]["probability"], rows[3]["n_tokens"]) == (1.0, 0.0, 0)


def test_contradictory_targets_are_told(spark):
    docs = spark.createDataFrame([(i, "x y", "a" if i % 2 else "b", "en" if i % 2 else "fr") for i in range(20)], "doc_id long, text string, source string, lang string")
    given = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "fr": 0.9}}
    one = lambda t: mixing.F.lit("one")
    assert {round(r["gap"], 6) for r in mixing.mixed(docs, given, one).collect()} == {0.8}
    with pytest.raises(ValueError, match="targets"):
        mixing.sampled_mix(docs, given, one, most_gap=0.01)
    met = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.9, "fr": 0.1}}
    assert all(r["gap"] < 1e-6 for r in mixing.mixed(docs, met, one, most_gap=0.01).collect())
