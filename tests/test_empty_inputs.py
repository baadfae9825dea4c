"""Empty and unknown years, states and names; sums that do not depend on partitioning beyond rounding."""

import os

import pytest
from pyspark.sql import functions as F

from loanscope.operators import cubes
from loanscope.operators.filters import Filters
from loanscope.plans import views as V
from loanscope.plans.warehouse import Sources, Warehouse, fixture_warehouse
from loanscope.sources import fixture
from tests.conftest import SF_SMALL


@pytest.fixture()
def blank_year(spark, scratch):
    """A warehouse with one year's rows under an empty year."""
    fact = fixture.lar(spark, SF_SMALL).withColumn("activity_year", F.when(F.col("activity_year") == "2019", "").otherwise(F.col("activity_year")))
    return Warehouse(spark, os.path.join(scratch, "wh"), Sources(
        fact=lambda: fact, county=lambda: fixture.county(spark, SF_SMALL), filers=lambda: fixture.filers(spark, SF_SMALL)))


def test_an_empty_year_survives(blank_year, spark):
    wh, whole = blank_year, fixture_warehouse(spark, SF_SMALL)
    assert {r["y"] for r in wh.table("main").select("y").distinct().collect()} == {"", "2018", *map(str, range(2020, 2026))}
    assert wh.fact().where(F.col("activity_year") == "").count() == whole.fact().where(F.col("activity_year") == "2019").count()
    blank = lambda rows: sorted(tuple("" if v == "2019" else v for v in r) for r in rows)
    for view in (V.outcome_series, V.loan_type_series, V.loan_purpose_series):
        assert sorted(map(tuple, view(wh.table("main")).collect())) == blank(view(whole.table("main")).collect())
    assert V.outcome_series(wh.table("main").withColumn("y", F.nullif("y", F.lit("")))).count() == V.outcome_series(wh.table("main")).count()
    for df in V.dashboard(wh, Filters(), min_apps=1, min_orig=1).values():
        df.collect()


@pytest.mark.parametrize("states", [[], ["ZZ"], ["ZZ", "QQ"]])
def test_no_known_state_selected(spark, states):
    state = fixture_warehouse(spark, SF_SMALL).table("state")
    long = V.compare_states(state, states)
    assert long.columns == ["state", "pos", "y", "value"] and long.count() == 0
    table = V.compare_table(state, states)
    assert table.columns == ["y"] and table.count() == 0


def test_sums_differ_by_rounding_alone(spark):
    """Rates with one to three decimals: any partitioning gives the same sum to 12 digits, and the same payload cell."""
    rows = spark.range(20_000).selectExpr("'2020' AS activity_year", "'1' AS action_taken", "'1' AS loan_type", "'1' AS loan_purpose",
                                          "'105000' AS loan_amount", "cast(2 + (id * 37 % 7919) / 1000D AS string) AS interest_rate")
    cells = [cubes.main_cube_direct(rows.repartition(n)).first() for n in (1, 3, 7, 16)]
    assert len({(c["c"], c["s"], c["rc"], round(c["r"], 2)) for c in cells}) == 1
    assert max(abs(c["r"] - cells[0]["r"]) for c in cells) <= 1e-12 * cells[0]["r"]


def test_malformed_county_rows_do_no_harm(spark):
    from loanscope.operators.lookups import county_names, state_by_fips_prefix, with_county_name, with_state_from_fips
    from loanscope.sources.reference import county_dimension
    dim = county_dimension(spark.createDataFrame([("06", "CA", "075", "San Francisco"), ("junk", "??", "x" * 50, ""), (None, None, None, None)],
                                                 "STATEFP string, STATE string, COUNTYFP string, COUNTYNAME string"))
    cube = spark.createDataFrame([("06075",), ("99999",), ("",)], "fips string")
    out = with_county_name(with_state_from_fips(cube, state_by_fips_prefix(dim)), county_names(dim))
    assert sorted(map(tuple, out.select("fips", "state", "name").collect())) == [("", "", "Unknown"), ("06075", "CA", "San Francisco"), ("99999", "", "Unknown")]
