"""Dimension lookups (J1-J8) and size-checked broadcasting.

A side gets a broadcast hint only when its size is bounded by construction (a top-N
list).  Reference tables are landed and carry no hint: nothing keeps their
files to the size they should have, so the planner decides from the landed
files' statistics (``spark.sql.autoBroadcastJoinThreshold``; AQE re-checks at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.functions.scalars import fips_state_prefix

# Largest row count we hint for broadcast (a few MB of short strings).
BROADCAST_ROW_LIMIT = 1_000_000


def broadcast_bounded(df: DataFrame, bound: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` when its row count is provably at most ``bound`` <= ``limit``."""
    return F.broadcast(df) if bound <= limit else df


def state_by_fips_prefix(county_dim: DataFrame) -> DataFrame:
    """(prefix, state): the two-digit state code of a county key to its postal code.

    When a prefix appears more than once, the last row of the reference file wins.
    """
    return (county_dim.groupBy(F.col("STATEFP").alias("prefix"))
            .agg(F.max_by("STATE", "pos").alias("state")))


def county_names(county_dim: DataFrame) -> DataFrame:
    """(fips, county_name): five-digit key to name; the last row wins."""
    return (county_dim.groupBy(F.concat("STATEFP", "COUNTYFP").alias("fips"))
            .agg(F.max_by("COUNTYNAME", "pos").alias("county_name")))


def with_state_from_fips(df: DataFrame, state_prefix: DataFrame, fips_col: str = "fips",
                         out: str = "state") -> DataFrame:
    """State from the county prefix, '' when the prefix is unknown.

    ``state_prefix`` is ``state_by_fips_prefix(county_dim)`` (landed once).
    """
    states = state_prefix.select("prefix", "state")
    return (df.withColumn("_prefix", fips_state_prefix(fips_col))
            .join(states.withColumnRenamed("state", "_state"),
                  F.col("_prefix") == states["prefix"], "left")
            .withColumn(out, F.coalesce(F.col("_state"), F.lit("")))
            .drop("_prefix", "prefix", "_state"))


def with_county_name(df: DataFrame, names: DataFrame, fips_col: str = "fips",
                     out: str = "name") -> DataFrame:
    """County name, 'Unknown' when absent or empty.  ``names`` is ``county_names(county_dim)``."""
    return (df.join(names.select("fips", "county_name").withColumnRenamed("fips", "_fips").withColumnRenamed("county_name", "_cn"),
                    F.col(fips_col) == F.col("_fips"), "left")
            .withColumn(out, F.coalesce(F.nullif(F.col("_cn"), F.lit("")), F.lit("Unknown")))
            .drop("_fips", "_cn"))


def lender_dimension(names: DataFrame, lender_states: DataFrame) -> DataFrame:
    """(lei, name, top_states): one row per lender known to either input.

    ``names`` is (lei, name); ``lender_states`` the flat (lei, state, count, rank)
    top-state table.  Built once and landed, so views do a single lookup.
    """
    tops = (lender_states.groupBy("lei")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "state"))).alias("_st"))
            .select("lei", F.array_join(F.transform("_st", lambda s: s["state"]), ", ").alias("top_states")))
    return names.select("lei", "name").join(tops, "lei", "full")


def with_lender_dimension(df: DataFrame, dim: DataFrame, lei_col: str = "lei") -> DataFrame:
    """J4 + J5 in one lookup: name (fallback when absent or empty: the LEI) and top states
    text (fallback: '').

    The dimension grows with the number of lenders, so the planner decides the
    broadcast from its file statistics (``spark.sql.autoBroadcastJoinThreshold``).
    """
    side = dim.select(F.col("lei").alias("_lei"), F.col("name").alias("_name"),
                      F.col("top_states").alias("_tops"))
    return (df.join(side, F.col(lei_col) == F.col("_lei"), "left")
            .withColumn("name", F.coalesce(F.nullif(F.col("_name"), F.lit("")), F.col(lei_col)))
            .withColumn("top_states", F.coalesce(F.col("_tops"), F.lit("")))
            .drop("_lei", "_name", "_tops"))
