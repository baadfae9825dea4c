"""One-pass cross-filter (P9): every quality panel of one filter state from a single scan of the quality cube.

Each panel applies all active filters but its own dimension's (and the year's, in a series over years).  So a cell
counts for the summary and the detail if it fails no filter, and for a dimension's series if it fails at most
that dimension's and the year's.  A bitmask of the failed filters decides all of this at once; the cells that count anywhere are
added up by (dimension, code, year), which is as small as the codes and years are few.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.functions.scalars import exact_sum
from loanscope.operators.filters import MAIN_DIMS, QUALITY_DIMS, Filters, apply

BITS = {dim: 1 << i for i, dim in enumerate(QUALITY_DIMS)}
NEVER_IGNORED = {d: c for d, c in MAIN_DIMS.items() if d != "year"}


def failed_filters(f: Filters, dims: Mapping[str, str] = QUALITY_DIMS) -> Column:
    """Bitmask (``BITS``) of the active filters that a cell fails; a null code fails."""
    terms = [F.when(F.col(col).eqNullSafe(getattr(f, dim)), 0).otherwise(BITS[dim]) for dim, col in dims.items() if getattr(f, dim) is not None]
    return reduce(lambda a, b: a.bitwiseOR(b), terms, F.lit(0))


def panel_cells(quality: DataFrame, f: Filters, panels: Mapping[str, str]) -> DataFrame:
    """(dim, code, y, c, in_slice, fc, fs, fr, frc) for each dimension of ``panels`` (name to cube column).

    c: the records of the dimension's series; the others: records, volume, rate sum and rate count of the fully
    filtered slice, in_slice whether it has any cell there.  Outcome, type and purpose are ignored by no panel and are
    pushed into the scan.
    """
    rows = apply(quality, f, NEVER_IGNORED)
    open_dims = {d: c for d, c in QUALITY_DIMS.items() if d not in NEVER_IGNORED}
    counts = lambda dim: F.col("failed").bitwiseAND(F.lit(~(BITS["year"] | BITS[dim]))) == 0
    marked = rows.withColumn("failed", failed_filters(f, open_dims)).where(reduce(lambda a, b: a | b, [counts(d) for d in panels]))
    told = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(c).alias("code"), counts(d).alias("counts")) for d, c in panels.items()])
    each = marked.select("y", "c", "s", "r", "rc", (F.col("failed") == 0).alias("full"), F.inline(F.filter(told, lambda x: x["counts"])))
    full = lambda c, total=exact_sum: total(F.when(F.col("full"), F.col(c)))
    return each.groupBy("dim", "code", "y").agg(
        F.sum("c").cast("bigint").alias("c"), F.max("full").alias("in_slice"), full("c", F.sum).cast("bigint").alias("fc"), full("s").alias("fs"),
        full("r").alias("fr"), full("rc", F.sum).cast("bigint").alias("frc"))


def slice_of(cells: DataFrame) -> DataFrame:
    """(dim, bucket, y, c, s, r, rc) of the fully filtered slice."""
    return cells.where("in_slice").select("dim", F.col("code").alias("bucket"), "y", F.col("fc").alias("c"), F.col("fs").alias("s"),
                                          F.col("fr").alias("r"), F.col("frc").alias("rc"))
