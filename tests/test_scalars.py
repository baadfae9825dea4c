"""Edge tables for the scalar functions."""

import pytest
from pyspark.sql import functions as F

from loanscope.functions import scalars as X

LENIENT = [("NA", 0.0), ("", 0.0), (" 4.5x", 4.5), ("1e3", 1000.0), ("36%", 36.0), (".5", 0.5),
           ("-1", -1.0), (None, None), ("0x10", 0.0), ("1,000", 1.0), ("Infinity", 0.0), ("4.", 4.0),
           ("1e", 1.0), ("+3", 3.0), ("NaN", 0.0), ("1d", 1.0)]


def _eval(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_lenient_double(spark):
    got = _eval(spark, [v for v, _ in LENIENT], X.lenient_double)
    assert got == [e for _, e in LENIENT]


def test_rate_bands(spark):
    vals = ["3.999", "4", "5", "6", "7", "8", "9", "NA", "Exempt", ""]
    strict = _eval(spark, vals, X.rate_bucket_strict)
    assert strict[:7] == ["Under 4%", "4-5%", "5-6%", "6-7%", "7-8%", "8-9%", "9%+"]
    lenient = _eval(spark, vals, X.rate_bucket_lenient)
    assert lenient[7:] == ["Under 4%"] * 3          # missing codes cast to 0
    sep = _eval(spark, vals, lambda c: X.rate_bucket_lenient(c, "separate"))
    assert sep[7:] == ["Exempt/NA"] * 3
    assert _eval(spark, [None], X.rate_bucket_lenient) == ["Exempt/NA"]


def test_dti_bucket(spark):
    vals = ["<20%", "20%-<30%", "30%-<36%", "50%-60%", ">60%", "36", "49", "1111", "abc", "NA", "Exempt", ""]
    assert _eval(spark, vals, X.dti_bucket) == ["<20", "20-30", "30-36", "50-60", ">60", "36-50", "36-50",
                                                "36-50", "36-50", "NA", "NA", "NA"]


def test_cltv_bucket(spark):
    vals = ["59.99", "60", "79.99", "80", "90", "96.99", "97", "100", "100.01", "NA", "Exempt", ""]
    assert _eval(spark, vals, X.cltv_bucket) == ["<60", "60-80", "60-80", "80-90", "90-97", "90-97",
                                                 "97-100", "97-100", ">100", "NA", "NA", "NA"]


def test_spread_bucket(spark):
    vals = ["-0.25", "1.499", "1.5", "3", "4.999", "5", "NA", "Exempt", ""]
    assert _eval(spark, vals, X.spread_bucket) == ["<1.5", "<1.5", "1.5-3", "3-5", "3-5", ">5", "NA", "NA", "NA"]


def test_non_am_class(spark):
    rows = [("1", "2", "2", "2"), ("2", "1", "2", "2"), ("2", "2", "1", "2"), ("2", "2", "2", "1"),
            ("1111", "1", "2", "2"), ("1111", "2", "2", "2"), ("Exempt", "2", "2", "2"), ("2", "2", "2", "2")]
    df = spark.createDataFrame(rows, "b string, i string, n string, o string")
    got = [r[0] for r in df.select(X.non_am_class("b", "i", "n", "o")).collect()]
    assert got == ["exotic"] * 5 + ["exempt", "exempt", "vanilla"]


def test_labels_ratios_and_order(spark):
    df = spark.createDataFrame([("1", 3, 0), ("-1", 1, 4)], "code string, n int, d int")
    got = df.select(X.label_of("code", {"1": "one"}).alias("l"), X.ordinal_of("code", ["x", "1"]).alias("o"),
                    X.safe_pct("n", "d").alias("p"), X.share_or_zero("n", "d").alias("z"),
                    X.fips_state_prefix(F.lit("06075")).alias("s"), X.sql_round(F.lit(2.5), 0).alias("r")).collect()
    assert [tuple(r) for r in got] == [("one", 1, None, 0.0, "06", 3.0), ("-1", 999, 25.0, 25.0, "06", 3.0)]


@pytest.mark.parametrize("v,unit", [(5e11, "B"), (2e12, "T")])
def test_scale_volume(spark, v, unit):
    r = spark.range(1).select(X.scale_volume(F.lit(v)).alias("x")).first()[0]
    assert r["unit"] == unit
