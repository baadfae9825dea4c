"""Sinks and payload jobs: CSV exports, JSON payload round trip."""

import glob
import os

from loanscope.plans import jobs, views as V
from loanscope.plans.warehouse import fixture_warehouse
from loanscope.sources import sinks
from tests.conftest import SF_SMALL


def _read_single_csv(path):
    (f,) = glob.glob(os.path.join(path, "part-*"))
    return open(f).read().splitlines()


def test_compare_csv(spark, scratch):
    wh = fixture_warehouse(spark, SF_SMALL)
    states = ["CA", "TX", "ZZ"]
    table = V.compare_table(wh.table("state"), states, "originations")
    out = os.path.join(scratch, "cmp")
    sinks.write_compare_csv(table, states, out)
    lines = _read_single_csv(out)
    assert lines[0] == "Year,CA - California,TX - Texas"
    assert len(lines) == 1 + table.count()


def test_series_csv_quotes_and_nulls(spark, scratch):
    df = spark.createDataFrame([("a,b", 1.0), ('say "hi"', None), ("two\nlines", 2.0)], "k string, v double")
    out = os.path.join(scratch, "series")
    sinks.write_series_csv(df, out)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out)
    assert back.columns == ["Category", "v"]
    got = sorted((r[0], r[1]) for r in back.collect())
    assert got == sorted([("a,b", "1"), ('say "hi"', None), ("two\nlines", "2")])


def test_plain_numbers(spark):
    values = [150.0, 1.575e7, 0.1, -2.5, 0.0, 12.345678901234567, None, 1e15, 3.0e-5, -100.0, 22908437000000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(sinks.plain_number(df["v"])).collect()]
    assert got == ["150", "15750000", "0.1", "-2.5", "0", "12.345678901234567", "", "1000000000000000", "0.00003", "-100", "22908437000000"]


def test_documents_are_json(spark, scratch):
    """All six payloads, written as documents and parsed whole."""
    import json

    from loanscope import schema
    wh = fixture_warehouse(spark, SF_SMALL)
    docs = {}
    for name, path in jobs.write_documents(wh, os.path.join(scratch, "docs")).items():
        docs[name] = json.loads("".join(open(f).read() for f in sorted(glob.glob(os.path.join(path, "part-*")))))
    assert list(docs) == ["national", "geographic", "cube", "lenders", "quality", "investor"]
    assert set(docs["lenders"]) == {"names", "cube", "states"}
    assert docs["quality"]["orders"] == {"dti": list(schema.DTI_ORDER), "ltv": list(schema.LTV_ORDER), "spread": list(schema.SPREAD_ORDER),
                                         "non_am": list(schema.NON_AM_ORDER)}
    assert list(docs["quality"]["labels"]) == ["purchaser", "lien", "non_am"]
    assert docs["investor"]["labels"]["biz_purpose"] == schema.BIZ_PURPOSE_LABELS
    for payload, member, table in [("quality", "cube", "quality"), ("cube", "main", "main"), ("lenders", "cube", "lender"),
                                   ("geographic", "county_cube", "county"), ("investor", "state_cube", "inv_state")]:
        assert len(docs[payload][member]) == wh.table(table).count()
    states = docs["lenders"]["states"][0]["states"]
    assert states == sorted(states, key=lambda s: -s["count"]) and 1 <= len(states) <= 5
    assert len(glob.glob(os.path.join(scratch, "docs", "national", "part-*"))) == 1


def test_run_all_payload_round_trip(spark, scratch):
    wh = fixture_warehouse(spark, SF_SMALL)
    written = jobs.run_all(wh, os.path.join(scratch, "payload"), fmt="json")
    assert list(written) == ["national", "geographic", "cube", "lenders", "quality", "investor"]
    loaded = jobs.load_payload(spark, written, fmt="json")
    assert loaded["cube"]["main"].count() == wh.table("main").count()
    states = loaded["lenders"]["states"].first()
    assert 1 <= len(states["states"]) <= 5


def test_national_document_shape(spark, scratch):
    import json
    wh = fixture_warehouse(spark, SF_SMALL)
    out = os.path.join(scratch, "national")
    sinks.write_document(jobs.documents(wh)["national"], out, indent=True, bounded=True)
    (f,) = glob.glob(os.path.join(out, "part-*"))
    text = open(f).read()
    doc = json.loads(text)
    assert text.count("\n") > 50
    assert list(sorted(doc)) == sorted(["summary", "by_action", "by_loan_type", "by_loan_purpose",
                                        "rate_distribution", "denial_reasons"])
    assert set(doc["summary"]) == {"total_apps", "originated", "denied", "lender_count", "avg_loan",
                                   "total_volume_b", "avg_rate"}
    assert set(doc["by_action"][0]) == {"code", "count", "pct", "avg_loan", "label"}
    counts = [e["count"] for e in doc["by_action"]]
    assert counts == sorted(counts, reverse=True) and sum(counts) == doc["summary"]["total_apps"]
    buckets = [e["bucket"] for e in doc["rate_distribution"]]
    assert buckets == sorted(buckets)
    assert sum(e["count"] for e in doc["rate_distribution"]) == doc["summary"]["originated"]


def test_dashboard_renders_every_view(spark):
    from loanscope.operators.filters import Filters
    wh = fixture_warehouse(spark, SF_SMALL)
    views = V.dashboard(wh, Filters(year="2021", loan_purpose="1"), lens="all3", min_apps=10, min_orig=5)
    assert len(views) == 33
    for name, df in views.items():
        df.collect()
