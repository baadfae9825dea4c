"""Display order of ordered views and reports (the oracle gate is order-insensitive)."""

from loanscope.operators import reports
from loanscope.operators.filters import Filters
from loanscope.plans import views as V
from loanscope.plans.warehouse import fixture_warehouse
from loanscope.sources.registers import year_summary
from tests.conftest import SF_ORACLE


def _is_sorted(keys):
    return keys == sorted(keys)


def test_orderings(spark):
    wh = fixture_warehouse(spark, SF_ORACLE)
    main = wh.table("main")
    rows = V.state_table(wh.table("state"), Filters(year="2020")).collect()
    assert _is_sorted([(-r["apps"], r["state"]) for r in rows]) and len(rows) > 5
    assert _is_sorted([r["y"] for r in V.volume_trend(main).collect()])
    assert _is_sorted([r["y"] for r in V.rate_trend(main).collect()])
    assert _is_sorted([r["pos"] for r in V.rate_histogram(wh.table("rates")).collect()])
    det = V.quality_detail(wh.table("quality")).collect()
    assert _is_sorted([(r["dim_pos"], r["pos"]) for r in det])
    assert _is_sorted([(-r["count"], r["code"]) for r in V.outcome_table(main).collect()])
    for fn in (reports.by_action, reports.by_loan_type, reports.by_loan_purpose):
        assert _is_sorted([(-r["count"], r["code"]) for r in fn(main).collect()])
    assert _is_sorted([(-r["count"], r["code"]) for r in reports.denial_reasons(wh.table("denials")).collect()])
    assert _is_sorted([r["bucket"] for r in reports.rate_distribution(wh.fact()).collect()])
    assert _is_sorted([r["y"] for r in V.investor_trend(wh.table("inv_national")).collect()])
    assert _is_sorted([r["y"] for r in V.compare_table(wh.table("state"), ["CA", "TX"]).collect()])
    assert _is_sorted([r["activity_year"] for r in year_summary(wh.fact()).collect()])
    lt = V.lender_table(wh.table("lender_base"), wh.table("lender_dim")).collect()
    assert _is_sorted([(-r["apps"], r["lei"]) for r in lt]) and len(lt) == 100
