"""The queries that SQL can express against DuckDB, at sf0.01."""

import duckdb
import pytest

from loanscope.llm.catalog import ORACLES, QUERIES
from tests.helpers import canon

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert canon(QUERIES[name](spark, SF).toPandas()) == canon(con.execute(ORACLES[name]).df())
