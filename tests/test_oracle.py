"""Every catalogued query against its DuckDB oracle (the driver's correctness gate), at sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.helpers import canon

ORACLES = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF_ORACLE).toPandas()
    want = duck.execute(ORACLES[key]).df()
    gc, gr = canon(got)
    wc, wr = canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_an_oracle():
    from loanscope.plans.catalog import QUERIES
    from loanscope.plans.oracle import ORACLES as OWN
    assert set(QUERIES) == set(OWN) <= set(ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["code", "count", "pct", "avg_loan", "label"]
