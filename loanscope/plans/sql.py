"""Parameterised SQL over landed tables.

``query`` is ``spark.sql`` with bound parameters (named ``:name`` or positional
``?``) and DataFrames substituted for ``{name}`` placeholders; it returns a lazy
DataFrame, so the caller decides what to collect.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

def query(spark: SparkSession, text: str, params: Mapping | Sequence | None = None,
          **frames: DataFrame) -> DataFrame:
    """Run ``text`` with bound parameters and DataFrame placeholders."""
    return spark.sql(text, args=params, **frames)


TOP_COUNTIES_SQL = """SELECT county_code, count(*) AS c FROM {fact}
WHERE county_code != '' AND county_code != 'NA'
GROUP BY county_code ORDER BY c DESC, county_code LIMIT :top_n"""
