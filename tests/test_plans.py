"""Plan shape at scale: broadcast only bounded sides, top-k as WindowGroupLimit,
filters and column pruning pushed into Parquet scans."""

import contextlib
import io

from loanscope.operators import cubes, ranking
from loanscope.operators.filters import Filters
from loanscope.plans import views as V
from loanscope.plans.warehouse import fixture_warehouse
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_county_top_n_is_broadcast_semi_join(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    p = plan(cubes.county_cube(wh.table("geo_base"), wh.table("state_prefix"), 200))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "TakeOrderedAndProject" in p


def test_top_states_uses_window_group_limit(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    assert "WindowGroupLimit" in plan(ranking.lender_top_states(cubes.lender_state_counts(wh.fact())))


def test_rate_cube_pushes_filter_and_prunes_columns(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    p = plan(cubes.rate_cube(wh.fact()))
    assert "PushedFilters: [IsNotNull(action_taken), EqualTo(action_taken,1)" in p
    read_schema = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert "county_code" not in read_schema and "lei" not in read_schema


def test_view_filter_reaches_cube_scan(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    p = plan(V.state_table(wh.table("state"), Filters(year="2020", loan_type="1")))
    assert "EqualTo(y,2020)" in p and "EqualTo(t,1)" in p


def test_partition_pruning_on_fact(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    from pyspark.sql import functions as F
    p = plan(wh.fact().where(F.col("activity_year") == "2021").groupBy("action_taken").count())
    assert "PartitionFilters: [(coalesce(activity_year" in p and "2021" in p


def test_top_n_counties_come_from_the_base(spark):
    """The list and the cube are grouped from the base: no shuffle of the whole cube before the semi join."""
    wh = fixture_warehouse(spark, SF_SMALL)
    for df in (cubes.county_cube(wh.table("geo_base"), wh.table("state_prefix"), 200),
               cubes.investor_county_cube(wh.table("investor_base"), wh.table("state_prefix"), 200)):
        logical = df._jdf.queryExecution().optimizedPlan().toString()
        semi = logical.index("LeftSemi")
        assert "Aggregate" in logical[:semi] and "Aggregate" not in logical[semi:logical.index("Relation", semi)].split("LeftSemi")[0]
        exchanges = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert exchanges <= 3


def test_lookups_follow_the_limit(spark):
    """Names are looked up for the rows shown: the join stands above the limit."""
    wh = fixture_warehouse(spark, SF_SMALL)
    lb, ld = wh.table("lender_base"), wh.table("lender_dim")
    for df in (V.lender_table(lb, ld), V.top_lenders(lb, ld), V.highest_denial_lenders(lb, ld, min_apps=1),
               V.county_table(wh.table("county"), wh.table("county_names")),
               V.investor_counties(wh.table("inv_county"), wh.table("county_names"), min_orig=1)):
        logical = df._jdf.queryExecution().optimizedPlan().toString()
        assert logical.index("Join LeftOuter") < logical.index("GlobalLimit")


def test_reference_lookups_carry_no_hint(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    df = V.county_table(wh.table("county"), wh.table("county_names"))
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


@contextlib.contextmanager
def shuffled_joins_only(spark):
    """As with lender tables beyond the broadcast threshold."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def operators(df) -> list[str]:
    """The operators of the physical plan, from the result down."""
    tree = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-*0123456789()") for line in tree.splitlines() if line.strip()]


def test_lender_views_move_no_row_by_lender(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    base, dim = wh.table("lender_base"), wh.table("lender_dim")
    f = Filters(year="2020", loan_type="1")
    with shuffled_joins_only(spark):
        # Grouped by lender: no exchange at all.
        assert not [o for o in operators(V.lender_stats(base, f)) if "Exchange" in o]
        # Searched: names are joined bucket by bucket, only the result is put in order.
        search = operators(V.lender_table(base, dim, f, search="a"))
        assert [o for o in search if o.startswith("SortMergeJoin")]
        exchanges = [o for o in search if "Exchange" in o]
        assert len(exchanges) == 1 and exchanges[0].startswith("Exchange rangepartitioning")
        # Ranked: the n rows shown go to the dimension's buckets, no row of the cube or of the dimension moves.
        for df in (V.lender_table(base, dim, f), V.top_lenders(base, dim, f), V.highest_denial_lenders(base, dim, f, min_apps=1)):
            found = operators(df)
            top = max(i for i, o in enumerate(found) if o.startswith("TakeOrderedAndProject"))
            assert "HashAggregate" in " ".join(found[top:])
            assert len([o for o in found if o.startswith("Exchange hashpartitioning")]) <= 1
            below = found[top:found.index(next(o for o in found[top:] if "FileScan" in o)) + 1]
            assert not [o for o in below if "Exchange" in o]


def test_lender_tables_are_bucketed_and_keep_their_rows(spark, tmp_path):
    from loanscope.plans.warehouse import BY_LENDER, Warehouse, fixture_sources
    wh = Warehouse(spark, str(tmp_path / "wh"), fixture_sources(spark, SF_SMALL), lender_buckets=3)
    for name in BY_LENDER:
        table = wh.table(name)
        files = [p.name for p in (tmp_path / "wh" / name).glob("*.parquet")]
        assert 0 < len(files) <= 3
        assert table.exceptAll(fixture_warehouse(spark, SF_SMALL).table(name)).count() == 0
        assert table.count() == fixture_warehouse(spark, SF_SMALL).table(name).count()
