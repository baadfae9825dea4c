"""One-pass cross-filter (P9), lenders by bitmaps (A12, V11), cuboid selection."""

import re

import pytest
from pyspark.sql import functions as F

from loanscope.operators import bitmaps, crossfilter, reports
from loanscope.operators.filters import Filters
from loanscope.plans import cuboids
from loanscope.plans import views as V
from loanscope.plans.warehouse import fixture_warehouse
from tests.conftest import SF_SMALL
from tests.helpers import canon
from tests.test_plans import plan

DIMS = [d[0] for d in V.QUALITY_VIEW_DIMS]
STATES = [Filters(), Filters(year="2021"), Filters(action="1", loan_type="2"), Filters(dti="36-50", lien="1"),
          Filters(year="2022", action="3", ltv="80-90", non_am="vanilla", purchaser="0"), Filters(dti="no such band"), Filters(year="1999", dti="NA")]


def rows(df):
    return canon(df.toPandas())


@pytest.mark.parametrize("f", STATES, ids=str)
def test_panels_are_the_views(spark, f):
    wh = fixture_warehouse(spark, SF_SMALL)
    q = wh.table("quality")
    cells = wh.scratch("test-panels", V.quality_panel_cells(q, f))
    assert rows(V.panel_summary(cells)) == rows(V.quality_summary(q, f))
    assert rows(V.panel_detail(cells)) == rows(V.quality_detail(q, f))
    for dim in DIMS:
        assert rows(V.panel_series(cells, dim)) == rows(V.quality_series(q, f, dim)), dim


def test_one_scan_for_all_panels(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    f = STATES[4]
    p = plan(V.quality_panel_cells(wh.table("quality"), f))
    assert len(re.findall(r"\(\d+\) Scan parquet", p)) == 1 and "EqualTo(a,3)" in p
    out = V.dashboard(wh, f)
    panels = [n for n in out if n.startswith("quality_")]
    assert len(panels) == 8
    for name in panels:  # they read the landed cells, not the cube
        assert "quality-panels" in plan(out[name]) and "/quality]" not in plan(out[name])


def test_cells_with_null_codes_fail_filters(spark):
    cube = spark.createDataFrame([("2020", "1", "1", "1", None, "x", 2, 1.0, 1.0, 1), ("2020", "1", "1", "1", "a", "x", 3, 1.0, 1.0, 1)],
                                 "y string, a string, t string, p string, d string, l string, c long, s double, r double, rc long")
    cells = crossfilter.panel_cells(cube, Filters(dti="a"), {"dti": "d", "ltv": "l"}).collect()
    assert sorted((r["dim"], str(r["code"]), r["c"], r["fc"]) for r in cells) == [("dti", "None", 2, None), ("dti", "a", 3, 3), ("ltv", "x", 3, 3)]


@pytest.mark.parametrize("f", STATES[:3] + [Filters(year="1999")], ids=str)
def test_lenders_by_bitmaps(spark, f):
    wh = fixture_warehouse(spark, SF_SMALL)
    got = V.lender_summary_from_bitmaps(wh.table("main"), wh.table("lender_bitmaps"), f)
    assert rows(got) == rows(V.lender_summary(wh.table("lender_base"), f))
    p = plan(got)
    assert "lei" not in p and "lender_base" not in p


def test_bitmaps_of_many_lenders(spark):
    base = spark.range(100_000).selectExpr("concat('L', id % 70000) as lei", "cast(id % 3 as string) as y", "cast(id % 5 as string) as a", "'1' as t",
                                           "cast(id % 2 as string) as p").union(spark.sql("select cast(null as string), '0', '0', '1', '0'"))
    ordinals = bitmaps.lender_ordinals(base.repartition(6)).cache()
    found = bitmaps.lender_bitmaps(base, ordinals)
    for keys in ([], ["y"], ["a", "p"]):
        want = base.groupBy(*keys).agg(F.count_distinct("lei").alias("lenders"))
        assert rows(bitmaps.count_lenders(found, keys)) == rows(want)
    assert found.select("bucket").distinct().count() >= 3
    assert bitmaps.count_lenders(found.limit(0)).collect()[0]["lenders"] == 0


def test_summary_from_bitmaps(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    assert rows(reports.summary_from_bitmaps(wh.table("main"), wh.table("lender_bitmaps"))) == rows(reports.summary(wh.table("lender_base")))


def test_greedy_choice():
    d = lambda *x: frozenset(x)
    views = [d("year"), d("year", "dti"), d("year", "dti"), d("lien")]
    size = {d("year"): 8, d("year", "dti"): 50, d("lien"): 3, d("year", "lien"): 24}
    assert cuboids.choose(size, views, 1000, 100) == [d("lien"), d("year"), d("year", "dti")]
    assert cuboids.choose(size, views, 1000, 10) == [d("lien")]
    assert cuboids.choose(size, views, 1000, 0) == []
    assert cuboids.choose({d("dti"): 2000}, [d("dti")], 1000, 5000) == []  # larger than the cube
    # Brute force: no other set of tables within the budget spares the views more than the greedy one by over 1 / (1 - 1/e).
    import itertools
    cost = lambda chosen: sum(min([size[c] for c in chosen if v <= c], default=1000) for v in views)
    best = min(cost(c) for n in range(5) for c in itertools.combinations(size, n) if sum(size[x] for x in c) <= 100)
    assert 4000 - cost(cuboids.choose(size, views, 1000, 100)) >= 0.63 * (4000 - best)


def test_views_read_the_smallest_cuboid(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    f = Filters(action="1")
    views = cuboids.quality_view_needs(f, DIMS)
    built = cuboids.build(wh, views, 5_000)
    assert built.tables and sum(built.size.values()) <= 5_000 and cuboids.build(wh, views, 5_000) is built
    for dim in DIMS:
        need = cuboids.needs(f, ("year", dim), ("year", dim))
        table = built.covering(need)
        fits = [d for d in built.tables if need <= d]
        assert set(cuboids.columns_of(need)) <= set(table.columns)
        if fits:
            smallest = min(fits, key=lambda d: (built.size[d], sorted(d)))
            assert f"quality-by-{'-'.join(cuboids.columns_of(smallest))}" in plan(V.quality_series(table, f, dim))
        assert rows(V.quality_series(table, f, dim)) == rows(V.quality_series(wh.table("quality"), f, dim))
    assert built.covering(cuboids.needs(Filters(), DIMS + ["year", "action", "loan_type", "loan_purpose"])).columns == wh.table("quality").columns
    exact = {d: cuboids.rolled_up(wh.table("quality"), d).count() for d in built.tables}
    assert all(abs(built.size[d] - n) <= max(3, 0.1 * n) for d, n in exact.items())
