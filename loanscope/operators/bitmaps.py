"""Distinct lenders under any filter (A12, V11) from exact bitmaps that are merged like sums.

Every lender has a number; a cube cell holds the set of its lenders as bitmaps of 32,768 numbers each (Spark's
``bitmap_*`` functions).  The lenders of a slice are the bits of its cells' bitmaps or-ed together, so counting them reads the
small cells and never groups by lender.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_KEYS = ("y", "a", "t", "p")


def lender_ordinals(lender_base: DataFrame) -> DataFrame:
    """(lei, ordinal): a number of its own for each lender, from 1, dense within each partition of the sorted lenders; to be landed.

    A null lender is none (``count(DISTINCT)`` leaves it out)."""
    lenders = lender_base.where(F.col("lei").isNotNull()).groupBy("lei").agg(F.lit(1).alias("_")).select("lei")
    return lenders.repartitionByRange("lei").sortWithinPartitions("lei").select("lei", (F.monotonically_increasing_id() + 1).alias("ordinal"))


def lender_bitmaps(lender_base: DataFrame, ordinals: DataFrame, keys: Sequence[str] = CELL_KEYS) -> DataFrame:
    """(keys, bucket, bits): the lenders of each cell."""
    numbered = lender_base.select("lei", *keys).join(ordinals, "lei")
    return numbered.groupBy(*keys, F.bitmap_bucket_number("ordinal").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ordinal")).alias("bits"))


def merged(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of coarser cells: (keys, bucket, bits)."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_lenders(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, lenders): distinct lenders of each group of cells."""
    return merged(bitmaps, keys).groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("lenders"))
