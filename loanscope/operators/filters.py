"""Slice filters over cube tables.

A ``Filters`` value holds the active selection (``None`` = all).  Each cube
family exposes a subset of the dimensions, and each view may ignore some of
them; ``predicate`` folds the rest into one ``Column``, which Spark pushes
into the Parquet scan of the cube.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.functions.scalars import literal_map


@dataclass(frozen=True)
class Filters:
    year: str | None = None
    action: str | None = None
    loan_type: str | None = None
    loan_purpose: str | None = None
    dti: str | None = None
    ltv: str | None = None
    purchaser: str | None = None
    spread: str | None = None
    lien: str | None = None
    non_am: str | None = None

    def replace(self, **overrides) -> "Filters":
        """P5 ``overrides``: a copy with some dimensions replaced."""
        return dataclasses.replace(self, **overrides)


# Dimension -> cube column, per cube family.
MAIN_DIMS: dict[str, str] = {"year": "y", "action": "a", "loan_type": "t", "loan_purpose": "p"}
RATE_DIMS: dict[str, str] = {"year": "y", "loan_type": "t", "loan_purpose": "p"}      # P6, P7: no action
COMPACT_DIMS: dict[str, str] = MAIN_DIMS                                                # P8
QUALITY_DIMS: dict[str, str] = {**MAIN_DIMS, "dti": "d", "ltv": "l", "purchaser": "pu", "spread": "rs",
                                "lien": "li", "non_am": "nm"}                           # P9
INVESTOR_DIMS: dict[str, str] = {"year": "y", "loan_purpose": "p"}                      # P10


def predicate(f: Filters, dims: Mapping[str, str], ignore: Iterable[str] = ()) -> Column:
    """Conjunction of ``column == value`` for every active, non-ignored dimension."""
    skip = set(ignore)
    terms = [F.col(col) == F.lit(getattr(f, dim)) for dim, col in dims.items()
             if dim not in skip and getattr(f, dim) is not None]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def apply(df: DataFrame, f: Filters, dims: Mapping[str, str], ignore: Iterable[str] = ()) -> DataFrame:
    return df.where(predicate(f, dims, ignore))


def slice_main(main: DataFrame, f: Filters, ignore: Iterable[str] = ()) -> DataFrame:
    """P5."""
    return apply(main, f, MAIN_DIMS, ignore)


def slice_rates(cube: DataFrame, f: Filters, ignore: Iterable[str] = ()) -> DataFrame:
    """Year, type and purpose only."""
    return apply(cube, f, RATE_DIMS, ignore)


def slice_compact(cube: DataFrame, f: Filters, ignore: Iterable[str] = ()) -> DataFrame:
    """Lender, state and county cubes."""
    return apply(cube, f, COMPACT_DIMS, ignore)


def slice_quality(cube: DataFrame, f: Filters, ignore: Iterable[str] = ()) -> DataFrame:
    """All ten dimensions, any of which can be ignored."""
    return apply(cube, f, QUALITY_DIMS, ignore)


def slice_investor(cube: DataFrame, f: Filters, ignore: Iterable[str] = ()) -> DataFrame:
    """P10: year and purpose only (investor cubes are originations without loan type)."""
    return apply(cube, f, INVESTOR_DIMS, ignore)


def investor_lens(lens: str = "bp") -> Column:
    """P11: 'bp' = investment property for business purpose; 'all3' = any investment property."""
    if lens == "bp":
        return (F.col("occ") == "3") & (F.col("bp") == "1")
    if lens == "all3":
        return F.col("occ") == "3"
    raise ValueError(f"lens must be 'bp' or 'all3', not {lens!r}")


def contains_text(col, text: str) -> Column:
    """Case-insensitive substring test."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c).contains(text.lower())


def search_lenders(df: DataFrame, text: str | None, n: int = 100) -> DataFrame:
    """Name contains the text (all matches), or the first ``n`` rows without a search."""
    return df.where(contains_text("name", text)) if text else df.limit(n)


def search_states(df: DataFrame, text: str | None, code: str = "state", name: str = "state_name") -> DataFrame:
    """Code or full name contains the text."""
    return df.where(contains_text(code, text) | contains_text(name, text)) if text else df


def min_sample(df: DataFrame, column: str, n: int) -> DataFrame:
    """Keep groups with at least ``n`` (a HAVING over an aggregate)."""
    return df.where(F.col(column) >= n)


def keep_states(df: DataFrame, states: Sequence[str], column: str = "state", pos: str = "pos") -> DataFrame:
    """Keep the selected states and number them in selection order (unknown ones drop out)."""
    order = {s: i for i, s in enumerate(dict.fromkeys(states))}
    if not order:  # nothing selected
        return df.where(F.lit(False)).withColumn(pos, F.lit(None).cast("int"))
    return df.where(F.col(column).isin(list(order))).withColumn(pos, literal_map(order)[F.col(column)])
