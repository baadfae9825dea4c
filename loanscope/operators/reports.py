"""The national report (A12-A17), computed from the cubes where they carry enough.

* A12 reads the lender base cube (it has every row's lei, year and action);
* A13-A15 roll up the main cube; A17 rolls up the denial cube;
* A16 rolls up the rate base cube, which keeps originations with a missing rate
  apart (``rate_distribution`` computes it straight from the fact instead).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.functions.scalars import exact_sum, label_of, lenient_double, rate_bucket_lenient, sql_round
from loanscope.operators.bitmaps import count_lenders
from loanscope.operators.ranking import sort_small
from loanscope.schema import (ACTION_LABELS, DENIAL_REASON_LABELS, LOAN_PURPOSE_LABELS,
                              LOAN_TYPE_LABELS)


def _where_sum(cond, col):
    return F.sum(F.when(cond, F.col(col)).otherwise(F.lit(0)))


def summary(lender_base: DataFrame, approx_lenders: bool = False) -> DataFrame:
    """Totals, originated, denied, distinct lenders, averages and volume (rounded 0/1/3).

    The lender count is exact by default (a distinct over the lender cube, far
    smaller than the fact); ``approx_lenders`` uses HyperLogLog++ instead.
    """
    orig = F.col("a") == "1"
    c_o = F.sum(F.when(orig, F.col("c")))
    return lender_base.agg(
        F.sum("c").cast("bigint").alias("total_apps"),
        _where_sum(orig, "c").cast("bigint").alias("originated"),
        _where_sum(F.col("a") == "3", "c").cast("bigint").alias("denied"),
        (F.approx_count_distinct("lei", 0.02) if approx_lenders else F.count_distinct("lei"))
        .cast("bigint").alias("lender_count"),
        sql_round(F.try_divide(exact_sum(F.when(orig, F.col("s"))), c_o.cast("double")), 0).alias("avg_loan"),
        sql_round(exact_sum(F.when(orig, F.col("s")).otherwise(F.lit(0.0))) / F.lit(1e9), 1).alias("total_volume_b"),
        sql_round(F.try_divide(exact_sum(F.when(orig, F.col("r"))),
                             F.sum(F.when(orig, F.col("rc"))).cast("double")), 3).alias("avg_rate"),
    )


def summary_from_bitmaps(main: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """A12 without grouping by lender: the main cube's sums, the lenders by merged bitmaps (``operators.bitmaps``)."""
    sums = summary(main.withColumn("lei", F.lit(None).cast("string")))
    lenders = count_lenders(bitmaps).select(F.col("lenders").alias("lender_count"))
    both = sums.drop("lender_count").unionByName(lenders, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in sums.columns])


def breakdown(main: DataFrame, dim: str, labels: Mapping[str, str]) -> DataFrame:
    """Count, percent of all rows (1 decimal), average loan (0 decimals), label; count desc."""
    total = F.sum("count").over(Window.partitionBy())  # a handful of codes per report
    per = main.groupBy(F.col(dim).alias("code")).agg(F.sum("c").cast("bigint").alias("count"),
                                                      exact_sum("s").alias("_s"))
    return sort_small(per.select(
        "code", "count",
        sql_round(F.col("count") * F.lit(100.0) / total, 1).alias("pct"),
        sql_round(F.try_divide(F.col("_s"), F.col("count").cast("double")), 0).alias("avg_loan"),
        label_of("code", labels).alias("label")), F.desc("count"), F.asc("code"))


def by_action(main: DataFrame) -> DataFrame:
    """A13."""
    return breakdown(main, "a", ACTION_LABELS)


def by_loan_type(main: DataFrame) -> DataFrame:
    """A14."""
    return breakdown(main, "t", LOAN_TYPE_LABELS)


def by_loan_purpose(main: DataFrame) -> DataFrame:
    """A15."""
    return breakdown(main, "p", LOAN_PURPOSE_LABELS)


def rate_distribution(fact: DataFrame, missing: str = "as_zero") -> DataFrame:
    """Originations by lenient rate band, ordered by band text (binary order)."""
    src = fact.where(F.col("action_taken") == "1").withColumn("_rate_v", lenient_double("interest_rate"))
    return sort_small(src.groupBy(rate_bucket_lenient("interest_rate", missing, F.col("_rate_v")).alias("bucket"))
                      .agg(F.count(F.lit(1)).alias("count")), "bucket")


def rate_distribution_from_base(rate_base: DataFrame, missing: str = "as_zero") -> DataFrame:
    """A16 as a rollup of ``cubes.rate_base_cube`` (no second scan of the fact)."""
    if missing == "as_zero":
        bucket = F.col("bucket")
    elif missing == "separate":
        bucket = F.when(~F.col("valid"), F.lit("Exempt/NA")).otherwise(F.col("bucket"))
    else:
        raise ValueError(f"missing must be 'as_zero' or 'separate', not {missing!r}")
    return sort_small(rate_base.groupBy(bucket.alias("bucket")).agg(F.sum("c").cast("bigint").alias("count")),
                      "bucket")


def denial_reasons(denials: DataFrame) -> DataFrame:
    """Denials by first reason (the denial cube has exactly this filter), count desc."""
    return sort_small(denials.groupBy(F.col("reason").alias("code"))
                      .agg(F.sum("c").cast("bigint").alias("count"))
                      .withColumn("label", label_of("code", DENIAL_REASON_LABELS)), F.desc("count"), F.asc("code"))
