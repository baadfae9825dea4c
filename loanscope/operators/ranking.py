"""Sorts, limits, top-k per group and arg-max.

Ties are always broken by the group key, so results do not depend on
partitioning or task order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per group by ``order`` (planned as a WindowGroupLimit)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def lender_top_states(state_counts: DataFrame, k: int = 5) -> DataFrame:
    """Each lender's top ``k`` states by originations, flat (lei, state, count, rank).

    Groups are bounded: one lender has at most one row per state.
    """
    return top_k_per_group(state_counts, "lei", [F.desc("count"), F.asc("state")], k)


def nest_top_states(flat: DataFrame) -> DataFrame:
    """(lei, states array<struct<state, count>>) in rank order."""
    return (flat.groupBy("lei")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "state", "count"))).alias("_s"))
            .select("lei", F.transform("_s", lambda s: F.struct(s["state"].alias("state"),
                                                                 s["count"].alias("count"))).alias("states")))


def sort_small(df: DataFrame, *order) -> DataFrame:
    """Order a result bounded by a code domain (years, states, categories, buckets).

    One partition sorted in place: no range-partition sampling job and no extra
    shuffle.  Use only after an aggregation (the scan and partial aggregation keep
    their parallelism) and only where the row count is bounded by construction.
    """
    return df.coalesce(1).sortWithinPartitions(*order)


def sort_by(df: DataFrame, column: str, tie: str | Sequence[str], ascending: bool = False) -> DataFrame:
    """By any column in either direction, NULLs last, ties by the key."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    key = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return df.orderBy(key, *[F.asc(t) for t in ties])


def top_n(df: DataFrame, column: str, n: int | None, tie: str | Sequence[str], ascending: bool = False) -> DataFrame:
    """The first ``n`` by ``column`` (all rows when ``n`` is None), the largest first unless ``ascending``."""
    out = sort_by(df, column, tie, ascending)
    return out if n is None else out.limit(n)


def peak(df: DataFrame, key: str, value: str) -> Column:
    """The key of the largest value, earliest key on ties; NULL when the max is not > 0.

    To be used inside ``agg``.
    """
    best = F.min_by(F.col(key), F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    return F.when(F.max(value) > 0, best)
