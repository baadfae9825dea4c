"""Scalar expressions over register text columns.

All builders return JVM-side ``Column`` expressions, so they stay inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanscope.schema import MISSING_NUMBER_CODES, UNKNOWN_CODES

__all__ = [
    "NUMERIC_PREFIX", "lenient_double", "exact_sum", "is_valid_number", "is_known_code",
    "rate_bucket_strict", "rate_bucket_lenient", "dti_bucket", "cltv_bucket",
    "spread_bucket", "non_am_class", "fips_state_prefix",
    "sql_round", "cell_round_amount", "cell_round_rate", "safe_ratio", "safe_pct",
    "share_or_zero", "literal_map", "label_of", "ordinal_of", "order_map",
    "scale_billions", "scale_volume",
]

# Longest numeric prefix, the way an embedded SQL engine casts text to REAL:
# optional sign, digits with optional fraction (or a bare fraction), optional
# exponent.  No match means 0.0.
NUMERIC_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lenient_double(x) -> Column:
    """Text to double by longest numeric prefix; no number is 0.0; NULL stays NULL.

    Fast path: text made only of digits, signs, point and exponent letters that
    parses as a double is a number in full, so its prefix is itself; only the
    rest ('NA', '36%', ' 4.5x', ...) goes through the prefix expression.
    """
    c = _c(x)
    plain = F.when(F.translate(c, "0123456789.+-eE", "") == "", c.try_cast("double"))
    prefix = F.coalesce(F.regexp_extract(c, NUMERIC_PREFIX, 1).try_cast("double"), F.lit(0.0))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(plain, prefix))


# Parts of a number for ``exact_sum``: whole, multiples of 2**-20, multiples of 2**-40; from 2**53 on a double has no fraction.
PART = float(1 << 20)
LARGE = float(1 << 53)


def exact_sum(x) -> Column:
    """Aggregate: the sum of doubles, the same bits however rows are dealt over partitions.

    Each value is cut into a whole number and two fixed-point parts (its digits beyond 2**-40 are rounded, value by
    value), whose sums are integers and so depend on no order; they are put together once.  A sum of whole parts beyond 64 bits is an
    error.  Only values of 2**53 and more are added as doubles.  NULLs are skipped; no value at all gives NULL.
    """
    v = _c(x).cast("double")
    small = F.abs(v) < LARGE
    fraction = (v - F.floor(v)) * PART
    parts = [F.floor(v), F.floor(fraction), F.floor((fraction - F.floor(fraction)) * PART + 0.5)]
    whole, upper, lower = (F.sum(F.when(v.isNotNull(), F.when(small, p).otherwise(F.lit(0).cast("bigint")))).cast("double") for p in parts)
    large = F.sum(F.when(v.isNotNull(), F.when(small, 0.0).otherwise(v)))
    return whole + (upper / PART + lower / (PART * PART)) + large


def is_valid_number(x) -> Column:
    """The text is not one of the missing-number codes (NULL stays NULL)."""
    return ~_c(x).isin(*MISSING_NUMBER_CODES)


def is_known_code(x) -> Column:
    """The code is neither empty nor 'NA'."""
    return ~_c(x).isin(*UNKNOWN_CODES)


def _rate_bands(v: Column) -> Column:
    return (F.when(v < 4, "Under 4%").when(v < 5, "4-5%").when(v < 6, "5-6%")
            .when(v < 7, "6-7%").when(v < 8, "7-8%").when(v < 9, "8-9%")
            .when(v >= 9, "9%+"))


def rate_bucket_strict(x, value=None) -> Column:
    """Seven rate bands; callers filter missing rates out first.
    ``value``: the rate already cast by ``lenient_double`` (computed once upstream)."""
    return _rate_bands(_c(value) if value is not None else lenient_double(x))


def rate_bucket_lenient(x, missing: str = "as_zero", value=None) -> Column:
    """Seven rate bands with an 'Exempt/NA' fallback.

    ``missing='as_zero'`` keeps the published behaviour: missing codes cast to 0
    and land in 'Under 4%'.  ``missing='separate'`` routes them to 'Exempt/NA'.
    """
    c = _c(x)
    banded = _rate_bands(_c(value) if value is not None else lenient_double(c)).otherwise("Exempt/NA")
    if missing == "separate":
        return F.when(c.isin(*MISSING_NUMBER_CODES), "Exempt/NA").otherwise(banded)
    if missing != "as_zero":
        raise ValueError(f"missing must be 'as_zero' or 'separate', not {missing!r}")
    return banded


def dti_bucket(x) -> Column:
    """Debt-to-income bands on exact strings; any other text is '36-50'."""
    c = _c(x)
    return (F.when(c.isin(*MISSING_NUMBER_CODES), "NA")
            .when(c == "<20%", "<20").when(c == "20%-<30%", "20-30")
            .when(c == "30%-<36%", "30-36").when(c == "50%-60%", "50-60")
            .when(c == ">60%", ">60").otherwise("36-50"))


def cltv_bucket(x, value=None) -> Column:
    """Combined loan-to-value bands (the 97-100 band includes 100)."""
    c = _c(x)
    v = _c(value) if value is not None else lenient_double(c)
    return (F.when(c.isin(*MISSING_NUMBER_CODES), "NA")
            .when(v < 60, "<60").when(v < 80, "60-80").when(v < 90, "80-90")
            .when(v < 97, "90-97").when(v <= 100, "97-100").otherwise(">100"))


def spread_bucket(x, value=None) -> Column:
    """Rate-spread bands (exactly 5 is '>5'; negatives are '<1.5')."""
    c = _c(x)
    v = _c(value) if value is not None else lenient_double(c)
    return (F.when(c.isin(*MISSING_NUMBER_CODES), "NA")
            .when(v < 1.5, "<1.5").when(v < 3, "1.5-3").when(v < 5, "3-5").otherwise(">5"))


def non_am_class(balloon, interest_only, neg_am, other) -> Column:
    """X6: 'exotic' if any feature flag is 1, else 'exempt' for exempt balloon codes, else 'vanilla'."""
    b = _c(balloon)
    exotic = (b == "1") | (_c(interest_only) == "1") | (_c(neg_am) == "1") | (_c(other) == "1")
    return (F.when(exotic, "exotic").when(b.isin("1111", "Exempt"), "exempt")
            .otherwise("vanilla"))


def fips_state_prefix(x) -> Column:
    """The two-digit state part of a five-digit county code."""
    return F.substring(_c(x), 1, 2)


def sql_round(x, digits: int = 0) -> Column:
    """ROUND half away from zero."""
    return F.round(_c(x), digits)


def cell_round_amount(x) -> Column:
    """A cube cell's loan-amount sum as a whole number."""
    return F.round(_c(x), 0).cast("bigint")


def cell_round_rate(x) -> Column:
    """A cube cell's rate sum to two decimals."""
    return F.round(_c(x), 2)


def safe_ratio(n, d) -> Column:
    """X11: n / d, NULL when d is 0 or NULL."""
    return F.try_divide(_c(n).cast("double"), _c(d).cast("double"))


def safe_pct(n, d) -> Column:
    """X11: n / d * 100, NULL when d is 0 or NULL."""
    return safe_ratio(n, d) * F.lit(100.0)


def share_or_zero(n, d) -> Column:
    """N / d * 100, 0 when d is 0 or NULL."""
    return F.coalesce(safe_pct(n, d), F.lit(0.0))


def literal_map(mapping: Mapping) -> Column:
    """A small constant lookup table as a map expression (no join needed)."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def label_of(code, labels: Mapping[str, str]) -> Column:
    """Label of a code, falling back to the code itself."""
    c = _c(code)
    return F.coalesce(literal_map(labels)[c], c)


def order_map(order: Sequence[str]) -> dict[str, int]:
    return {code: i for i, code in enumerate(order)}


def ordinal_of(code, order: Sequence[str]) -> Column:
    """Position of a code in an ordered category list, 999 if absent."""
    return F.coalesce(literal_map(order_map(order))[_c(code)], F.lit(999))


def scale_billions(x) -> Column:
    """Dollars to billions."""
    return _c(x) / F.lit(1e9)


def scale_volume(x) -> Column:
    """Dollars to (value, unit): trillions from 1e12 up, else billions."""
    c = _c(x)
    return F.when(c >= F.lit(1e12), F.struct((c / F.lit(1e12)).alias("value"), F.lit("T").alias("unit"))) \
        .otherwise(F.struct((c / F.lit(1e9)).alias("value"), F.lit("B").alias("unit")))
