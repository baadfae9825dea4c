"""Queries run in a session that does not carry the engine's defaults (as a driver's would)."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_plain_session_keeps_text_year(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    df = E.queries()["s7_year_summary"](other, SF_SMALL)
    assert dict(df.dtypes)["activity_year"] == "string"
    main = E.queries()["a1_main_cube"](other, SF_SMALL)
    assert dict(main.dtypes)["y"] == "string"
    assert main.count() > 0
