"""Rollups over cube tables (R1-R9): re-aggregation of additive measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscope.functions.scalars import exact_sum, label_of, ordinal_of, safe_pct, safe_ratio


def _sum_if(cond: Column | None, col: str) -> Column:
    v = F.col(col) if cond is None else F.when(cond, F.col(col))
    return F.coalesce(exact_sum(v) if col in ("s", "r") else F.sum(v), F.lit(0))


def aggregate(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sums of c, s, r, rc with avg_loan = s/c and avg_rate = r/rc."""
    return (df.groupBy(*keys).agg(_sum_if(None, "c").cast("bigint").alias("c"),
                                  _sum_if(None, "s").cast("double").alias("s"),
                                  _sum_if(None, "r").cast("double").alias("r"),
                                  _sum_if(None, "rc").cast("bigint").alias("rc"))
            .withColumn("avg_loan", safe_ratio("s", "c"))
            .withColumn("avg_rate", safe_ratio("r", "rc")))


def compact_measures(mask: Column | None = None) -> list[Column]:
    """R2 as aggregate expressions; ``mask`` restricts which cube rows count."""
    def m(extra: Column | None) -> Column | None:
        if mask is None:
            return extra
        return mask if extra is None else (mask & extra)

    orig, denied = F.col("a") == "1", F.col("a") == "3"
    return [
        _sum_if(m(None), "c").cast("bigint").alias("apps"),
        _sum_if(m(orig), "c").cast("bigint").alias("originated"),
        _sum_if(m(denied), "c").cast("bigint").alias("denied"),
        _sum_if(m(orig), "s").cast("double").alias("volume"),
        _sum_if(m(None), "s").cast("double").alias("_s_all"),
        _sum_if(m(orig), "r").cast("double").alias("_r_orig"),
        _sum_if(m(orig), "rc").cast("bigint").alias("_rc_orig"),
    ]


def finish_compact(df: DataFrame) -> DataFrame:
    """R2 ratios: average loan over all apps, average rate over originations, shares."""
    return (df.withColumn("avg_loan", safe_ratio("_s_all", "apps"))
            .withColumn("avg_rate", safe_ratio("_r_orig", "_rc_orig"))
            .withColumn("orig_pct", safe_pct("originated", "apps"))
            .withColumn("deny_pct", safe_pct("denied", "apps"))
            .drop("_s_all", "_r_orig", "_rc_orig"))


def aggregate_compact(df: DataFrame, keys: Sequence[str] = (), mask: Column | None = None) -> DataFrame:
    """R2: apps, originated, denied, originated volume, avg loan (all apps), avg rate (originated), shares."""
    return finish_compact(df.groupBy(*keys).agg(*compact_measures(mask)))


def year_series(df: DataFrame, code: str, value: str = "c", year: str = "y",
                labels: Mapping[str, str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """A dense category x year matrix in long form (code, label, y, c, pos).

    Missing cells are 0.  Years are those present.  ``pos`` orders the codes:
    by the given list (absent codes last) or by total descending; ties by code.
    The dense fill is a pivot on the (bounded) set of years and back.
    """
    # A null year counts as '' (a map key must not be null).
    per = df.groupBy(F.col(code).alias("code"), F.coalesce(F.col(year), F.lit("")).alias("y")).agg(F.sum(value).alias("v"))
    # One row per code with its cells as a map; every code gets the full year list.
    # Both are bounded by (codes x years), which a category series keeps small.
    per_code = per.groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("y", "v"))).alias("m"),
                                       F.sum("v").alias("_tot"))
    everything = Window.partitionBy()
    rank_order = ([ordinal_of("code", order), F.asc("code")] if order is not None
                  else [F.desc("_tot"), F.asc("code")])
    ranked = per_code.select(
        "code", "m",
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("m")).over(everything)))).alias("ys"),
        (F.row_number().over(Window.orderBy(*rank_order)) - 1).cast("int").alias("pos"))
    lab = label_of("code", labels) if labels is not None else F.col("code")
    return (ranked.select("code", "m", "pos", F.explode("ys").alias("y"))
            .select("code", lab.alias("label"), "y",
                    F.coalesce(F.col("m")[F.col("y")], F.lit(0)).cast("bigint").alias("c"), "pos"))


def by_year(df: DataFrame, measures: Sequence[Column]) -> DataFrame:
    """Several conditional measures per year in one pass."""
    return df.groupBy("y").agg(*measures)


def bucket_detail(df: DataFrame, dims: Mapping[str, str]) -> DataFrame:
    """Per (dimension, bucket) sums with the bucket's share of its dimension.

    ``dims`` maps a dimension name to its cube column; all are unpivoted in one
    pass (``stack``) so each cube row is read once.
    """
    stack_args = ", ".join(f"'{name}', `{col}`" for name, col in dims.items())
    long = df.selectExpr(f"stack({len(dims)}, {stack_args}) AS (dim, bucket)", "c", "s", "r", "rc")
    per = (long.groupBy("dim", "bucket").agg(F.sum("c").cast("bigint").alias("count"),
                                             exact_sum("s").alias("volume"), exact_sum("r").alias("_r"),
                                             F.sum("rc").alias("_rc"))
           .where(F.col("count") > 0))
    return finish_buckets(per)


def finish_buckets(per: DataFrame) -> DataFrame:
    """R7's share and rate of (dim, bucket, count, volume, _r, _rc)."""
    w = Window.partitionBy("dim")
    return (per.withColumn("pct", F.coalesce(safe_pct("count", F.sum("count").over(w)), F.lit(0.0)))
            .withColumn("avg_rate", safe_ratio("_r", "_rc")).drop("_r", "_rc"))


def distinct_years(df: DataFrame, year: str = "y") -> DataFrame:
    """R8."""
    return df.select(year).distinct().coalesce(1).sortWithinPartitions(year)  # one row per year


def totals(df: DataFrame, sums: Sequence[str], count_as: str = "groups") -> DataFrame:
    """Sums over group rows plus the number of groups."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(count_as),
                  *[F.coalesce(exact_sum(c) if df.schema[c].dataType.typeName() == "double" else F.sum(c), F.lit(0)).alias(c) for c in sums])
