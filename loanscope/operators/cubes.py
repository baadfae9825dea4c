"""Additive cubes over the application fact table.

Every cube is ``fact -> where -> groupBy(dimensions) -> agg(measures)``.  The
measures are additive (count ``c``, loan-amount sum ``s``, rate sum ``r``,
rate count ``rc``), so a coarser cube is a ``rollup`` of a finer one and every
average is a ratio of sums.  Spark plans each build as a partial (map-side)
aggregation, one shuffle on the dimension keys, and a final aggregation; hot
keys are absorbed map-side because all dimensions are low-cardinality codes.

The warehouse builds the scan-level cubes once and derives the others:

* quality cube (A8)   -> main cube (A1)
* geo base            -> state cube (A4), county cube (A5)
* lender base (with y) -> lender cube (A6), national summary (A12)
* investor base       -> investor national / state / county cubes (A9-A11)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.functions.scalars import (
    cltv_bucket, dti_bucket, is_known_code, is_valid_number, lenient_double, non_am_class,
    rate_bucket_lenient, rate_bucket_strict, spread_bucket, cell_round_amount, cell_round_rate, exact_sum,
)
from loanscope.operators.lookups import broadcast_bounded, with_state_from_fips

M4 = ("c", "s", "r", "rc")
CS = ("c", "s")
C = ("c",)


# Numeric values of text columns, computed once per row in a projection below the
# aggregation (branches of a CASE are not shared by subexpression elimination).
LOAN_V, RATE_V, CLTV_V, SPREAD_V = "_loan_v", "_rate_v", "_cltv_v", "_spread_v"
NUMBERS = {LOAN_V: "loan_amount", RATE_V: "interest_rate", CLTV_V: "combined_loan_to_value_ratio",
           SPREAD_V: "rate_spread"}


def with_numbers(fact: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add the lenient numeric value of each named text column (see ``NUMBERS``)."""
    return fact.withColumns({n: lenient_double(NUMBERS[n]) for n in names})


def measures(names: Sequence[str] = M4, loan: str = "loan_amount", rate: str = "interest_rate",
             loan_value: str | None = None, rate_value: str | None = None) -> list[Column]:
    """Fact-level measure expressions, by short name (``*_value``: precomputed numbers)."""
    valid = is_valid_number(rate)
    lv = F.col(loan_value) if loan_value else lenient_double(loan)
    rv = F.col(rate_value) if rate_value else lenient_double(rate)
    exprs = {
        "c": F.count(F.lit(1)).alias("c"),
        "s": exact_sum(lv).alias("s"),
        "r": exact_sum(F.when(valid, rv).otherwise(F.lit(0.0))).alias("r"),
        "rc": F.sum(F.when(valid, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("rc"),
    }
    return [exprs[n] for n in names]


def build_cube(fact: DataFrame, dims: Mapping[str, Column | str], where: Column | None = None,
               measure_names: Sequence[str] = M4, numbers: Sequence[str] = ()) -> DataFrame:
    """Generic cube: filter, group by named dimension expressions, aggregate measures.

    ``numbers`` lists precomputed numeric columns (``NUMBERS``) that dimension
    expressions use; the loan and rate values of the measures are always precomputed.
    """
    src = fact if where is None else fact.where(where)
    need = [n for n in (LOAN_V, RATE_V) if (n == LOAN_V and "s" in measure_names)
            or (n == RATE_V and "r" in measure_names)]
    src = with_numbers(src, list(dict.fromkeys([*numbers, *need])))
    keys = [(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in dims.items()]
    return src.groupBy(*keys).agg(*measures(measure_names, loan_value=LOAN_V if LOAN_V in need else None,
                                            rate_value=RATE_V if RATE_V in need else None))


def rollup(cube: DataFrame, keys: Sequence[str], where: Column | None = None,
           measure_names: Sequence[str] = M4) -> DataFrame:
    """Re-aggregate a cube to coarser keys (sums of additive measures)."""
    src = cube if where is None else cube.where(where)
    aggs = [(F.sum(m).cast("bigint") if m in ("c", "rc") else exact_sum(m)).alias(m) for m in measure_names]
    return src.groupBy(*keys).agg(*aggs)


def round_cells(cube: DataFrame) -> DataFrame:
    """Payload form of a cube: whole-dollar sums, rate sums to 2 decimals."""
    out = cube
    if "s" in cube.columns:
        out = out.withColumn("s", cell_round_amount("s"))
    if "r" in cube.columns:
        out = out.withColumn("r", cell_round_rate("r"))
    return out


def top_n_keys(cube: DataFrame, key: str, n: int, weight: str = "c") -> DataFrame:
    """The ``n`` known keys with the largest total weight (ties: smaller key first)."""
    return (cube.where(is_known_code(key)).groupBy(key).agg(F.sum(weight).alias("_w"))
            .orderBy(F.desc("_w"), F.asc(key)).limit(n).select(key))


def keep_top_n(cube: DataFrame, key: str, n: int, weight: str = "c") -> DataFrame:
    """Semi join of a cube with its top-N keys; the list is bounded by ``n``."""
    top = broadcast_bounded(top_n_keys(cube, key, n, weight), n)
    return cube.join(top, key, "left_semi")


# ---------------------------------------------------------------------------
# Dimension sets (short names, one scheme for all cubes)
# ---------------------------------------------------------------------------
YATP = {"y": "activity_year", "a": "action_taken", "t": "loan_type", "p": "loan_purpose"}


def quality_dims() -> dict[str, Column | str]:
    return {
        **YATP,
        "d": dti_bucket("debt_to_income_ratio"),
        "l": cltv_bucket("combined_loan_to_value_ratio", F.col(CLTV_V)),
        "pu": "purchaser_type",
        "rs": spread_bucket("rate_spread", F.col(SPREAD_V)),
        "li": "lien_status",
        "nm": non_am_class("balloon_payment", "interest_only_payment",
                           "negative_amortization", "other_non_amortizing_features"),
    }


# ---------------------------------------------------------------------------
# Scan-level cubes (one pass over the fact each)
# ---------------------------------------------------------------------------
def quality_cube(fact: DataFrame) -> DataFrame:
    """(y, a, t, p, d, l, pu, rs, li, nm) with M4, unrounded."""
    return build_cube(fact, quality_dims(), numbers=[CLTV_V, SPREAD_V])


def main_cube_direct(fact: DataFrame) -> DataFrame:
    """A1 straight from the fact: (y, a, t, p) with M4."""
    return build_cube(fact, YATP)


def rate_cube(fact: DataFrame) -> DataFrame:
    """A2: originated loans with a rate, (y, t, p, bucket) count."""
    where = (F.col("action_taken") == "1") & is_valid_number("interest_rate")
    dims = {"y": "activity_year", "t": "loan_type", "p": "loan_purpose",
            "bucket": rate_bucket_strict("interest_rate", F.col(RATE_V))}
    return build_cube(fact, dims, where, C, numbers=[RATE_V])


def rate_base_cube(fact: DataFrame) -> DataFrame:
    """Originations by (y, t, p, lenient rate band, valid-rate flag): the one scan behind
    the rate cube (A2) and the rate distribution (A16).  For a valid rate the lenient
    band is the strict band; missing codes sit in 'Under 4%' (cast to 0) with
    ``valid`` false, so both report modes can be rolled up from here."""
    dims = {"y": "activity_year", "t": "loan_type", "p": "loan_purpose",
            "bucket": rate_bucket_lenient("interest_rate", "as_zero", F.col(RATE_V)),
            "valid": F.coalesce(is_valid_number("interest_rate"), F.lit(False))}
    return build_cube(fact, dims, F.col("action_taken") == "1", C, numbers=[RATE_V])


def rate_cube_from_base(rate_base: DataFrame) -> DataFrame:
    """A2 as a rollup of the rate base (valid rates only)."""
    return rollup(rate_base, ["y", "t", "p", "bucket"], F.col("valid"), C)


def denial_cube(fact: DataFrame) -> DataFrame:
    """A3: denied with a reason other than '' and '10', (y, t, p, reason) count."""
    where = ((F.col("action_taken") == "3") & (F.col("denial_reason_1") != "")
             & (F.col("denial_reason_1") != "10"))
    dims = {"y": "activity_year", "t": "loan_type", "p": "loan_purpose", "reason": "denial_reason_1"}
    return build_cube(fact, dims, where, C)


def geo_base_cube(fact: DataFrame) -> DataFrame:
    """(y, state, fips, a, t, p) with M4: the one scan behind the state and county cubes."""
    dims = {"y": "activity_year", "state": "state_code", "fips": "county_code",
            "a": "action_taken", "t": "loan_type", "p": "loan_purpose"}
    return build_cube(fact, dims)


def lender_base_cube(fact: DataFrame) -> DataFrame:
    """(y, lei, a, t, p) with M4: the lender cube with year kept."""
    return build_cube(fact, {"y": "activity_year", "lei": "lei", "a": "action_taken",
                             "t": "loan_type", "p": "loan_purpose"})


def investor_base_cube(fact: DataFrame) -> DataFrame:
    """(y, state, fips, occ, bp, p) over originations with M4."""
    dims = {"y": "activity_year", "state": "state_code", "fips": "county_code",
            "occ": "occupancy_type", "bp": "business_or_commercial_purpose", "p": "loan_purpose"}
    return build_cube(fact, dims, F.col("action_taken") == "1")


def lender_state_counts(fact: DataFrame) -> DataFrame:
    """(lei, state, count) of originations with a known state."""
    where = (F.col("action_taken") == "1") & is_known_code("state_code")
    return (fact.where(where).groupBy("lei", F.col("state_code").alias("state"))
            .agg(F.count(F.lit(1)).alias("count")))


# ---------------------------------------------------------------------------
# Derived cubes (rollups of the scan-level ones)
# ---------------------------------------------------------------------------
def main_cube(quality: DataFrame) -> DataFrame:
    """A1: (y, a, t, p) with M4, as a rollup of the quality cube (which has no filter)."""
    return rollup(quality, ["y", "a", "t", "p"])


def state_cube(geo_base: DataFrame) -> DataFrame:
    """A4: (y, state, a, t, p) with M4 over rows with a known state."""
    return rollup(geo_base, ["y", "state", "a", "t", "p"], is_known_code("state"))


def county_cube(geo_base: DataFrame, state_prefix: DataFrame, top_n: int = 200) -> DataFrame:
    """A5: (y, fips, a, t, p) with M4 for the top-N counties by all records, plus state from the prefix."""
    top = keep_top_n(geo_base, "fips", top_n)  # measures are additive: the list comes from the base
    return with_state_from_fips(rollup(top, ["y", "fips", "a", "t", "p"]), state_prefix)


def lender_cube(lender_base: DataFrame) -> DataFrame:
    """A6 at the published grain (lei, a, t, p), no year."""
    return rollup(lender_base, ["lei", "a", "t", "p"])


def investor_national_cube(inv_base: DataFrame) -> DataFrame:
    """Originations by (y, occ, bp, p) with M4."""
    return rollup(inv_base, ["y", "occ", "bp", "p"])


def investor_state_cube(inv_base: DataFrame) -> DataFrame:
    """A10: originations by (y, state, occ, bp, p) with count and sum, known states."""
    return rollup(inv_base, ["y", "state", "occ", "bp", "p"], is_known_code("state"), CS)


def investor_county_cube(inv_base: DataFrame, state_prefix: DataFrame, top_n: int = 200) -> DataFrame:
    """Top-N counties by originations, (y, fips, occ, bp, p) with count and sum, plus state."""
    top = keep_top_n(inv_base, "fips", top_n)
    return with_state_from_fips(rollup(top, ["y", "fips", "occ", "bp", "p"], None, CS), state_prefix)
