"""run() against the stages worked out by brute force, in plain Python."""

import re
import unicodedata

import numpy as np
import xxhash

import __spark_entry__
import corpus_pipeline
from loanscope.llm import mixing
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_mixing import rake
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def surface(text):
    if any(x in text for x in ("icensed", "opyright", "ights reserved")):
        return "legal"
    return "contact" if "@" in text else "figures" if re.search("[0-9]{4}", text) else "longform" if len(text) >= 8000 else "note" if len(text) < 500 else "prose"


def brute_mix(rows):
    """doc_id to probability of the sampled rows."""
    cells, of = {}, {}
    for r in rows:
        of[r["doc_id"]] = (r["source"] or "", r["lang"] or "", surface(r["text"]))
        cells[of[r["doc_id"]]] = cells.get(of[r["doc_id"]], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    cells = {k: n for k, n in cells.items() if n}
    targets = []
    for d in range(3):
        marginal = {}
        for k, n in cells.items():
            marginal[k[d]] = marginal.get(k[d], 0) + n
        targets.append({v: n ** mixing.FLATTEN for v, n in marginal.items()})
    weight = {k: w / cells[k] for k, w in rake(cells, targets).items()}
    chance = {i: weight.get(k, 0) / max(weight.values()) for i, k in of.items()}
    hashed = lambda i: xxhash.xxh64_intdigest(mixing.SEED.to_bytes(4, "little"), xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42))
    return {i: p for i, p in chance.items() if (hashed(i) >> 11) / 2 ** 53 < p}


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    rows = [r for r in rows if r["text"] and any(unicodedata.category(c)[0] == "L" for c in r["text"])]

    first = {}
    for r in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r)
    rows = list(first.values())

    prints = np.array([brute_fingerprint(r["text"]) for r in rows], np.uint64)
    root = brute_components(prints, 2)
    rows = [r for i, r in enumerate(rows) if root[i] == i]

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _ in contaminated([(r["doc_id"], r["text"]) for r in rows], items)}
    assert hit
    rows = [r for r in rows if r["doc_id"] not in hit]

    want = brute_mix(rows)
    got = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(got.columns)
    got = {r["doc_id"]: r["probability"] for r in got.collect()}
    assert set(got) == set(want)
    assert all(abs(got[i] - want[i]) < 1e-4 for i in got)


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
