import numpy as np

from loanscope.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_fit_orders_thresholds_and_finds_the_optimum():
    rng = np.random.RandomState(0)
    x = (rng.rand(4000, 6) < 0.3).astype(float)
    s = x @ np.array([3.0, 2, 1, 0, 0, -1]) + rng.logistic(size=4000)
    grade = np.searchsorted([1.5, 2.5, 4.0], s)
    row, feature = np.nonzero(x)
    w, theta = toxicity.fit_cumulative(row, feature, grade, 6, ridge=0.1)
    assert (np.diff(theta) > 0).all() and np.allclose(theta, [1.5, 2.5, 4.0], atol=0.35) and np.allclose(w, [3, 2, 1, 0, 0, -1], atol=0.35)

    def loss(w, theta):
        z = x @ w
        p = np.column_stack([np.ones(4000)] + [1 / (1 + np.exp(t - z)) for t in theta] + [np.zeros(4000)])
        return -np.log(p[np.arange(4000), grade] - p[np.arange(4000), grade + 1]).sum() + 0.05 * (w ** 2).sum()

    best = loss(w, theta)
    for _ in range(50):
        assert loss(w + rng.randn(6) * 0.02, theta + rng.randn(3) * 0.01) > best - 0.05


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    alone = [next(toxicity.features_by_text([t]))[1] for t in (b"one two", "École naïve".encode(), b"three")]
    together = [f for _, f in toxicity.features_by_text([b"one two", b"", "École naïve".encode(), b"three"])]
    assert [a.tolist() for a in alone] == [together[i].tolist() for i in (0, 2, 3)] and together[1].size == 0


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.toxicity(docs, model).collect() if r["doc_id"] % 2 and r["doc_id"] in truth]
    hit = np.array([r["toxic"] for r in rows])
    true = np.array([truth[r["doc_id"]] == 1 for r in rows])
    # Some rows are labelled toxic without any of the words that the others share.
    assert hit[true].mean() > 0.85 and hit[~true].mean() < 0.01
    assert all(0 <= r["p_toxic"] <= r["severity"] <= 3 for r in rows)


def test_the_bound_is_on_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "two"), (3, "three"), (None, "none")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.labelled(docs, labels, 3).collect()
    assert sorted((r["toxic"], bytes(r["text"]).decode()) for r in rows) == [(0, "two"), (1, "text 0"), (1, "three")]
    assert len(toxicity.labelled(docs, labels, 2).collect()) <= 2
