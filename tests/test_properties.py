"""Property tests: the lenient cast against an independent parser; views under random
filter combinations against the DuckDB oracle."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loanscope.functions.scalars import lenient_double
from loanscope.operators.filters import Filters
from loanscope.plans import oracle as O
from loanscope.plans import views as V
from loanscope.plans.warehouse import fixture_warehouse
from tests.conftest import SF_ORACLE
from tests.helpers import canon

JAVA_SPACE = " \t\n\x0b\f\r"


def prefix_value(s):
    """Longest numeric prefix by scanning characters (no regular expression)."""
    if s is None:
        return None
    i, n = 0, len(s)
    while i < n and s[i] in JAVA_SPACE:
        i += 1
    start = i
    if i < n and s[i] in "+-":
        i += 1
    d0 = i
    while i < n and "0" <= s[i] <= "9":
        i += 1
    int_digits = i - d0
    frac_digits = 0
    if i < n and s[i] == ".":
        j = i + 1
        while j < n and "0" <= s[j] <= "9":
            j += 1
        frac_digits = j - i - 1
        if int_digits or frac_digits:
            i = j
    if not (int_digits or frac_digits):
        return 0.0
    end = i
    if i < n and s[i] in "eE":
        j = i + 1
        if j < n and s[j] in "+-":
            j += 1
        k = j
        while k < n and "0" <= s[k] <= "9":
            k += 1
        if k > j:
            end = k
    return float(s[start:end])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789+-.eE x%,NAd\t", max_size=12)),
                min_size=20, max_size=120))
def test_lenient_cast_matches_prefix_parser(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(lenient_double("x")).collect()]
    for v, g in zip(values, got):
        want = prefix_value(v)
        if want is None or g is None:
            assert want is None and g is None, v
        else:
            assert g == want or (math.isinf(g) and math.isinf(want)), (v, g, want)


FILTERS = st.builds(
    Filters,
    year=st.sampled_from([None, "2018", "2021", "2025"]),
    action=st.sampled_from([None, "1", "3", "6", "-1"]),
    loan_type=st.sampled_from([None, "1", "2", "4"]),
    loan_purpose=st.sampled_from([None, "1", "31", "5"]),
)


def _same(spark, duck, got_df, sql):
    assert canon(got_df.toPandas()) == canon(duck.execute(sql).df())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(FILTERS)
def test_overview_views_under_any_filter(spark, duck, f):
    wh = fixture_warehouse(spark, SF_ORACLE)
    _same(spark, duck, V.national_summary(wh.table("main"), f), O._v1(f))
    _same(spark, duck, V.outcome_table(wh.table("main"), f), O._v3(f))
    _same(spark, duck, V.volume_trend(wh.table("main"), f), O._v8(f))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(FILTERS)
def test_compact_views_under_any_filter(spark, duck, f):
    wh = fixture_warehouse(spark, SF_ORACLE)
    _same(spark, duck, V.state_table(wh.table("state"), f), O._v14(f))
    _same(spark, duck, V.lender_table(wh.table("lender_base"), wh.table("lender_dim"), f), O._v10(f))
    _same(spark, duck, V.county_table(wh.table("county"), wh.table("county_names"), f), O._v16(f))
