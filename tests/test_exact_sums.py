"""Sums that do not depend on how rows are dealt."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from loanscope.functions.scalars import cell_round_rate, exact_sum
from loanscope.operators import cubes, reports
from loanscope.operators import rollup as R
from loanscope.plans import views as V
from loanscope.plans.warehouse import Sources, Warehouse
from loanscope.schema import MLAR_COLUMNS
from loanscope.sources import fixture
from tests.conftest import SF_SMALL

DEALT = (1, 3, 7, 16)


def bits(df):
    return sorted(tuple(x.hex() if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.fixture(scope="module")
def messy(spark):
    rng = random.Random(7)
    rates = ["3.1", "2.999999999", "0.1", "7.123456", "1e-7", "12.875%", "-0.3", "NA", "Exempt", ""]
    rows = []
    for i in range(4000):
        row = dict.fromkeys(MLAR_COLUMNS, "")
        row |= {"activity_year": str(2018 + i % 3), "lei": f"L{i % 7}", "action_taken": str(1 + i % 3), "loan_type": "1", "loan_purpose": str(1 + i % 2),
                "state_code": "CA", "county_code": "06001", "loan_amount": rng.choice([f"{rng.uniform(0, 1e6):.7f}", "123456.1", "0.07", f"{rng.uniform(0, 1e12):.3f}"]),
                "interest_rate": rng.choice(rates), "occupancy_type": "3", "business_or_commercial_purpose": "1", "purchaser_type": "0"}
        rows.append(tuple(row[c] for c in MLAR_COLUMNS))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in MLAR_COLUMNS)).cache()


BUILDS = {
    "quality": cubes.quality_cube, "main": lambda f: cubes.main_cube(cubes.quality_cube(f)), "geo": cubes.geo_base_cube, "lender": cubes.lender_base_cube,
    "investor": cubes.investor_base_cube, "lender rollup": lambda f: cubes.lender_cube(cubes.lender_base_cube(f)),
    "summary": lambda f: reports.summary(cubes.lender_base_cube(f)), "detail": lambda f: V.quality_detail(cubes.quality_cube(f)),
    "panels": lambda f: V.quality_panel_cells(cubes.quality_cube(f)), "by type": lambda f: reports.by_loan_type(cubes.main_cube(cubes.quality_cube(f))),
    "compact": lambda f: R.aggregate_compact(cubes.geo_base_cube(f), ["state"]), "investors": lambda f: V.investor_summary(cubes.investor_national_cube(cubes.investor_base_cube(f))),
}


@pytest.mark.parametrize("name", BUILDS)
def test_the_same_bits_however_rows_are_dealt(spark, messy, name):
    want = None
    for n in DEALT:
        got = bits(BUILDS[name](messy.repartition(n, F.rand(n))))
        want = want or got
        assert got == want, n


def test_plain_sums_would_differ(spark, messy):
    from loanscope.functions.scalars import lenient_double
    sums = {messy.repartition(n, F.rand(n)).agg(F.sum(lenient_double("loan_amount"))).first()[0] for n in DEALT}
    assert len(sums) > 1  # the input is messy enough


@pytest.mark.parametrize("values", [[], [None], [0.1] * 10, [1e15, 0.1, -1e15, 0.2], [-0.5, -1.25, 3.0], [1e300, 1.0], [2.0 ** 52 + 1, 0.5], [None, 5.0, -5.0],
                                    [1e-9, 2e-13], [123456789.987654321] * 7])
def test_exact_sum_against_fractions(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = df.agg(exact_sum("v").alias("s")).first()[0]
    some = [v for v in values if v is not None]
    if not some:
        assert got is None
    else:
        want = float(sum(map(Fraction, some)))
        assert math.isclose(got, want, rel_tol=1e-15, abs_tol=len(some) * 2 ** -40)


def test_a_cent_never_flips(spark):
    # 2.675 and the like: sums on the edge of a cent.
    rows = spark.createDataFrame([(i % 50, [0.005, 0.01, 0.335, 1.115][i % 4]) for i in range(3000)], "k int, r double")
    found = {tuple(sorted((r["k"], r["x"]) for r in rows.repartition(n, F.rand(n)).groupBy("k").agg(cell_round_rate(exact_sum("r")).alias("x")).collect())) for n in DEALT}
    assert len(found) == 1


def test_warehouse_tables_are_the_same_bits(spark, scratch):
    tables = []
    for n in (2, 5):
        wh = Warehouse(spark, f"{scratch}/w{n}", Sources(fact=lambda n=n: fixture.lar(spark, SF_SMALL).repartition(n, F.rand(n)),
                                                          county=lambda: fixture.county(spark, SF_SMALL), filers=lambda: fixture.filers(spark, SF_SMALL)))
        tables.append({t: bits(wh.table(t)) for t in ("main", "state", "inv_county", "lender", "rates")})
    assert tables[0] == tables[1]
