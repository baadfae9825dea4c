"""User-facing views over the cube tables.

Every view takes cube DataFrames (landed tables) and a ``Filters`` value and
returns a small DataFrame.  Views never touch the fact table: each is a
filter pushed into a cube scan, one aggregation, and at most a window or a
sort-limit over a handful of groups.  Which dimensions a view ignores is part
of its definition and is noted on each function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.functions.scalars import (exact_sum, label_of, literal_map, ordinal_of, safe_pct, safe_ratio,
                                         scale_billions, scale_volume, share_or_zero)
from loanscope.operators import filters as P
from loanscope.operators import rollup as R
from loanscope.operators.bitmaps import count_lenders
from loanscope.operators.crossfilter import panel_cells, slice_of
from loanscope.operators.filters import Filters
from loanscope.operators.lookups import with_county_name, with_lender_dimension
from loanscope.operators.ranking import nest_top_states, peak, sort_small, top_n
from loanscope.schema import (ACTION_LABELS, DENIAL_REASON_LABELS, DTI_ORDER, INVESTOR_PURPOSE_ORDER,
                              LIEN_LABELS, LOAN_PURPOSE_LABELS, LOAN_TYPE_LABELS, LTV_ORDER,
                              NON_AM_LABELS, NON_AM_ORDER, OCCUPANCY_LABELS, OCCUPANCY_ORDER,
                              PURCHASER_LABELS, RATE_BUCKET_ORDER, SPREAD_ORDER, STATE_NAMES,
                              STATE_PRESETS)

ALL = Filters()


def _match(dim_col: str, value: str | None):
    return F.lit(True) if value is None else (F.col(dim_col) == F.lit(value))


# ---------------------------------------------------------------------------
# Overview (V1-V9) over the main, rate and denial cubes
# ---------------------------------------------------------------------------
def national_summary(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V1: applications and average loan under all filters; originated, volume and
    average rate over action 1 ignoring the action filter (so the originated
    share can exceed 100% when another action is selected)."""
    in_f = _match("a", f.action)
    orig = F.col("a") == "1"
    agg = P.slice_main(main, f, ignore={"action"}).agg(
        F.coalesce(F.sum(F.when(in_f, F.col("c"))), F.lit(0)).cast("bigint").alias("apps"),
        F.coalesce(F.sum(F.when(orig, F.col("c"))), F.lit(0)).cast("bigint").alias("originated"),
        F.coalesce(exact_sum(F.when(orig, F.col("s"))), F.lit(0.0)).alias("_vol"),
        exact_sum(F.when(in_f, F.col("s"))).alias("_s"),
        exact_sum(F.when(orig, F.col("r"))).alias("_r"),
        F.sum(F.when(orig, F.col("rc"))).alias("_rc"))
    return agg.select("apps", "originated", safe_pct("originated", "apps").alias("orig_pct"),
                      scale_billions("_vol").alias("volume_b"),
                      safe_ratio("_s", "apps").alias("avg_loan"),
                      safe_ratio("_r", "_rc").alias("avg_rate"))


def outcome_series(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V2: action x year counts; ignores the year and action filters."""
    return R.year_series(P.slice_main(main, f, ignore={"year", "action"}), "a", labels=ACTION_LABELS)


def outcome_table(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V3: per action: count, share of the shown total, average loan; ignores the action filter."""
    per = P.slice_main(main, f, ignore={"action"}).groupBy(F.col("a").alias("code")).agg(
        F.sum("c").cast("bigint").alias("count"), exact_sum("s").alias("_s"))
    total = F.sum("count").over(Window.partitionBy())  # at most a dozen action codes
    return sort_small(per.select("code", label_of("code", ACTION_LABELS).alias("label"), "count",
                                 (F.col("count").cast("double") / total.cast("double") * F.lit(100.0)).alias("pct"),
                                 safe_ratio("_s", "count").alias("avg_loan")), F.desc("count"), F.asc("code"))


def loan_type_series(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V4: loan type x year; ignores the year and type filters."""
    return R.year_series(P.slice_main(main, f, ignore={"year", "loan_type"}), "t", labels=LOAN_TYPE_LABELS)


def loan_purpose_series(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V5: loan purpose x year; ignores the year and purpose filters."""
    return R.year_series(P.slice_main(main, f, ignore={"year", "loan_purpose"}), "p",
                         labels=LOAN_PURPOSE_LABELS)


def rate_histogram(rates: DataFrame, f: Filters = ALL) -> DataFrame:
    """V6: originations per rate band in band order; empty bands dropped (action filter not applied)."""
    return sort_small(P.slice_rates(rates, f).groupBy("bucket").agg(F.sum("c").cast("bigint").alias("c"))
                      .where((F.col("c") > 0) & F.col("bucket").isin(*RATE_BUCKET_ORDER))
                      .withColumn("pos", ordinal_of("bucket", RATE_BUCKET_ORDER)), "pos")


def top_denials(denials: DataFrame, f: Filters = ALL, n: int = 8) -> DataFrame:
    """V7: denial counts grouped by reason label, largest ``n``."""
    per = (P.slice_rates(denials, f).groupBy(label_of("reason", DENIAL_REASON_LABELS).alias("label"))
           .agg(F.sum("c").cast("bigint").alias("c")))
    return top_n(per, "c", n, "label")


def year_trend(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V8 + V9: per year apps, originated, denied and average rate over all
    actions passing the filter; ignores the year filter."""
    src = P.slice_main(main, f, ignore={"year"})
    return R.by_year(src, [
        F.sum("c").cast("bigint").alias("apps"),
        F.coalesce(F.sum(F.when(F.col("a") == "1", F.col("c"))), F.lit(0)).cast("bigint").alias("originated"),
        F.coalesce(F.sum(F.when(F.col("a") == "3", F.col("c"))), F.lit(0)).cast("bigint").alias("denied"),
        safe_ratio(exact_sum("r"), F.sum("rc")).alias("avg_rate"),
    ])  # one row per year; callers order it


def volume_trend(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V8."""
    return sort_small(year_trend(main, f).select("y", "apps", "originated", "denied"), "y")


def rate_trend(main: DataFrame, f: Filters = ALL) -> DataFrame:
    """V9."""
    return sort_small(year_trend(main, f).select("y", "avg_rate"), "y")


# ---------------------------------------------------------------------------
# Lenders (V10-V13) over the lender cube with year
# ---------------------------------------------------------------------------
def lender_stats(lender_base: DataFrame, f: Filters = ALL) -> DataFrame:
    """R2 per lender under the overview filters (lenders with no row vanish)."""
    return R.aggregate_compact(P.slice_compact(lender_base, f), ["lei"])


def lender_table(lender_base: DataFrame, lender_dim: DataFrame,
                 f: Filters = ALL, search: str | None = None, n: int = 100) -> DataFrame:
    """Per-lender stats with name and top states, by applications; a
    search returns every lender whose name contains the text.  ``lender_dim``
    is ``lookups.lender_dimension(names, lender_states)``."""
    stats = lender_stats(lender_base, f)
    if not search:  # only the n rows shown need their names
        return sort_small(with_lender_dimension(top_n(stats, "apps", n, "lei"), lender_dim), F.desc("apps"), F.asc("lei"))
    return P.search_lenders(with_lender_dimension(stats, lender_dim), search).orderBy(F.desc("apps"), F.asc("lei"))


def lender_summary(lender_base: DataFrame, f: Filters = ALL) -> DataFrame:
    """Active lenders, applications, originations, volume."""
    return R.totals(lender_stats(lender_base, f), ["apps", "originated", "volume"],
                    count_as="lenders").select(
        "lenders", F.col("apps").cast("bigint").alias("apps"),
        F.col("originated").cast("bigint").alias("originated"), F.col("volume").cast("double").alias("volume"))


def lender_summary_from_bitmaps(main: DataFrame, bitmaps: DataFrame, f: Filters = ALL) -> DataFrame:
    """V11 without grouping by lender: sums of the main cube, lenders by merged bitmaps."""
    sums = P.slice_compact(main, f).agg(*R.compact_measures()).select("apps", "originated", "volume")
    both = count_lenders(P.slice_compact(bitmaps, f)).unionByName(sums, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def top_lenders(lender_base: DataFrame, lender_dim: DataFrame, f: Filters = ALL, n: int = 15,
                rank_by: str = "apps") -> DataFrame:
    """Lenders with originations, first ``n`` by ``rank_by`` (the published chart ranks by apps)."""
    top = top_n(lender_stats(lender_base, f).where(F.col("originated") > 0), rank_by, n, "lei")
    return sort_small(with_lender_dimension(top, lender_dim), F.desc(rank_by), F.asc("lei")).select("lei", "name", "apps", "originated")


def highest_denial_lenders(lender_base: DataFrame, lender_dim: DataFrame, f: Filters = ALL, n: int = 15,
                           min_apps: int = 1000) -> DataFrame:
    """Highest denial shares among lenders with at least ``min_apps`` applications."""
    stats = P.min_sample(lender_stats(lender_base, f), "apps", min_apps).where(F.col("deny_pct").isNotNull())
    order = [F.desc("deny_pct"), F.desc("apps"), F.asc("lei")]
    top = stats.orderBy(*order).limit(n)
    return sort_small(with_lender_dimension(top, lender_dim), *order).select("lei", "name", "apps", "deny_pct")


# ---------------------------------------------------------------------------
# Geography
# ---------------------------------------------------------------------------
def state_stats(state: DataFrame, f: Filters = ALL) -> DataFrame:
    return (R.aggregate_compact(P.slice_compact(state, f), ["state"])
            .withColumn("state_name", F.coalesce(literal_map(STATE_NAMES)[F.col("state")], F.lit(""))))


def state_table(state: DataFrame, f: Filters = ALL, search: str | None = None) -> DataFrame:
    """Per-state stats with the state name, by applications; optional search on code or name."""
    return sort_small(P.search_states(state_stats(state, f), search), F.desc("apps"), F.asc("state"))


def state_picker(state: DataFrame, search: str | None = None) -> DataFrame:
    """Every state by name, those whose code or name contains the text; with its applications, 0 without any."""
    apps = state.groupBy("state").agg(F.sum("c").alias("apps"))
    named = state.sparkSession.createDataFrame(list(STATE_NAMES.items()), "state string, state_name string")
    listed = named.join(apps, "state", "left").select("state", "state_name", F.coalesce("apps", F.lit(0)).cast("bigint").alias("apps"))
    pos = F.row_number().over(Window.orderBy("state_name", "state")) - 1  # as many rows as states
    return sort_small(P.search_states(listed, search).withColumn("pos", pos.cast("int")), "pos")


def sorted_states(state: DataFrame, f: Filters = ALL, column: str = "apps", ascending: bool = False) -> DataFrame:
    """T13 on V14: the state table by any of its columns, either direction, with each row's place."""
    key = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    pos = F.row_number().over(Window.orderBy(key, F.asc("state"))) - 1
    return sort_small(state_stats(state, f).withColumn("pos", pos.cast("int")), "pos")


def sorted_lenders(lender_base: DataFrame, lender_dim: DataFrame, f: Filters = ALL, column: str = "apps", ascending: bool = False,
                   n: int = 100) -> DataFrame:
    """T13 on V10: the ``n`` lenders shown, by any column (of the measures), either direction."""
    shown = with_lender_dimension(top_n(lender_stats(lender_base, f), "apps", n, "lei"), lender_dim)
    key = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return sort_small(shown.withColumn("pos", (F.row_number().over(Window.orderBy(key, F.asc("lei"))) - 1).cast("int")), "pos")


RANK_METRICS = ("originated", "avg_loan", "deny_pct", "avg_rate")


def rank_states(state: DataFrame, f: Filters = ALL, metric: str = "originated", n: int = 10,
                min_apps: int = 1000) -> DataFrame:
    """Top ``n`` states by a metric; denial and rate rankings need ``min_apps``."""
    if metric not in RANK_METRICS:
        raise ValueError(f"metric must be one of {RANK_METRICS}")
    stats = state_stats(state, f)
    if metric != "originated":
        stats = stats.where(F.col(metric).isNotNull())
    if metric in ("deny_pct", "avg_rate"):
        stats = P.min_sample(stats, "apps", min_apps)
    return (stats.orderBy(F.desc(metric), F.desc("apps"), F.asc("state")).limit(n)
            .select("state", F.col(metric).cast("double").alias("value")))


def county_table(county: DataFrame, county_names: DataFrame, f: Filters = ALL, n: int = 100) -> DataFrame:
    """Per-county stats under all overview filters, plus the FHA share of
    originations, which ignores the type and action filters (year and purpose apply)."""
    src = P.slice_compact(county, f, ignore={"action", "loan_type"})
    mask = _match("a", f.action) & _match("t", f.loan_type)
    orig = F.col("a") == "1"
    per = src.groupBy("fips").agg(
        *R.compact_measures(mask), F.max("state").alias("state"),
        F.coalesce(F.sum(F.when(orig & (F.col("t") == "2"), F.col("c"))), F.lit(0)).alias("_fha"),
        F.coalesce(F.sum(F.when(orig, F.col("c"))), F.lit(0)).alias("_orig_all"))
    stats = (R.finish_compact(per.where(F.col("apps") > 0))
             .withColumn("fha_pct", safe_pct("_fha", "_orig_all")).drop("_fha", "_orig_all"))
    return sort_small(with_county_name(top_n(stats, "apps", n, "fips"), county_names), F.desc("apps"), F.asc("fips"))


# ---------------------------------------------------------------------------
# Loan quality
# ---------------------------------------------------------------------------
QUALITY_VIEW_DIMS = [
    # (filter name, cube column, display label, order, labels)
    ("dti", "d", "DTI", DTI_ORDER, None),
    ("ltv", "l", "CLTV", LTV_ORDER, None),
    ("purchaser", "pu", "Purchaser", None, PURCHASER_LABELS),
    ("spread", "rs", "Rate Spread", SPREAD_ORDER, None),
    ("lien", "li", "Lien", None, LIEN_LABELS),
    ("non_am", "nm", "Non-Am", NON_AM_ORDER, NON_AM_LABELS),
]


def quality_summary(quality: DataFrame, f: Filters = ALL) -> DataFrame:
    """Records, volume, average loan and rate in the fully filtered slice."""
    agg = R.aggregate(P.slice_quality(quality, f))
    return agg.select(F.col("c").alias("count"), F.col("s").alias("volume"), "avg_loan", "avg_rate")


def quality_series(quality: DataFrame, f: Filters = ALL, dim: str = "dti") -> DataFrame:
    """One quality dimension x year; ignores the year filter and the dimension's own filter."""
    spec = {d[0]: d for d in QUALITY_VIEW_DIMS}[dim]
    _, col, _, order, labels = spec
    return R.year_series(P.slice_quality(quality, f, ignore={"year", dim}), col, labels=labels, order=order)


def quality_detail(quality: DataFrame, f: Filters = ALL) -> DataFrame:
    """Per dimension and bucket: count, share of the dimension, volume, average rate."""
    return _in_panel_order(R.bucket_detail(P.slice_quality(quality, f), {d[2]: d[1] for d in QUALITY_VIEW_DIMS}))


def _in_panel_order(detail: DataFrame) -> DataFrame:
    """V19's labels and order."""
    label, order_pos = None, None
    for _, _, name, order, labels in QUALITY_VIEW_DIMS:
        lab = label_of("bucket", labels) if labels else F.col("bucket")
        label = (F.when(F.col("dim") == name, lab) if label is None
                 else label.when(F.col("dim") == name, lab))
        if order is not None:
            o = ordinal_of("bucket", order)
            order_pos = (F.when(F.col("dim") == name, o) if order_pos is None
                         else order_pos.when(F.col("dim") == name, o))
    dim_pos = literal_map({d[2]: i for i, d in enumerate(QUALITY_VIEW_DIMS)})[F.col("dim")]
    # buckets of a dimension without a fixed order go by count, descending
    w = Window.partitionBy("dim").orderBy(order_pos.otherwise(F.lit(0)), F.desc("count"), F.asc("bucket"))
    return sort_small(detail.withColumn("pos", F.row_number().over(w) - 1)
                      .select("dim", F.col("bucket").alias("code"), label.alias("bucket"), "count", "pct", "volume",
                              "avg_rate", dim_pos.alias("dim_pos"), F.col("pos").cast("int").alias("pos")),
                      "dim_pos", "pos")


def quality_panel_cells(quality: DataFrame, f: Filters = ALL) -> DataFrame:
    """The cells behind V17, V18 (every dimension) and V19 in one pass; to be landed, as each panel reads them."""
    return panel_cells(quality, f, {d[0]: d[1] for d in QUALITY_VIEW_DIMS})


def panel_summary(cells: DataFrame) -> DataFrame:
    """V17 from ``quality_panel_cells``: every record of the slice is in one bucket of each dimension."""
    agg = R.aggregate(slice_of(cells).where(F.col("dim") == QUALITY_VIEW_DIMS[0][0]))
    return agg.select(F.col("c").alias("count"), F.col("s").alias("volume"), "avg_loan", "avg_rate")


def panel_series(cells: DataFrame, dim: str = "dti") -> DataFrame:
    """V18 from ``quality_panel_cells``."""
    _, _, _, order, labels = {d[0]: d for d in QUALITY_VIEW_DIMS}[dim]
    return R.year_series(cells.where(F.col("dim") == dim), "code", labels=labels, order=order)


def panel_detail(cells: DataFrame) -> DataFrame:
    """V19 from ``quality_panel_cells``."""
    names = literal_map({d[0]: d[2] for d in QUALITY_VIEW_DIMS})
    per = slice_of(cells).withColumn("dim", names[F.col("dim")]).groupBy("dim", "bucket").agg(
        F.sum("c").cast("bigint").alias("count"), exact_sum("s").alias("volume"), exact_sum("r").alias("_r"), F.sum("rc").alias("_rc"))
    return _in_panel_order(R.finish_buckets(per.where(F.col("count") > 0)))


# ---------------------------------------------------------------------------
# Investors
# ---------------------------------------------------------------------------
def investor_by_year(inv_national: DataFrame, f: Filters = ALL, lens: str = "bp") -> DataFrame:
    """Per year investor and all-origination measures under the year/purpose filters."""
    inv = P.investor_lens(lens)
    src = P.slice_investor(inv_national, f)
    return R.by_year(src, [
        F.coalesce(F.sum(F.when(inv, F.col("c"))), F.lit(0)).cast("bigint").alias("inv_c"),
        F.coalesce(exact_sum(F.when(inv, F.col("s"))), F.lit(0.0)).alias("inv_s"),
        F.coalesce(exact_sum(F.when(inv, F.col("r"))), F.lit(0.0)).alias("inv_r"),
        F.coalesce(F.sum(F.when(inv, F.col("rc"))), F.lit(0)).cast("bigint").alias("inv_rc"),
        F.sum("c").cast("bigint").alias("all_c"),
        exact_sum("s").alias("all_s"),
    ])


def investor_summary(inv_national: DataFrame, f: Filters = ALL, lens: str = "bp") -> DataFrame:
    """Investor originations, share of all, volume, averages, and the peak year."""
    yr = investor_by_year(inv_national, f, lens)
    agg = yr.agg(F.coalesce(F.sum("inv_c"), F.lit(0)).cast("bigint").alias("inv_c"),
                 F.coalesce(F.sum("all_c"), F.lit(0)).cast("bigint").alias("all_c"),
                 F.coalesce(exact_sum("inv_s"), F.lit(0.0)).alias("volume"),
                 exact_sum("inv_r").alias("_r"), F.sum("inv_rc").alias("_rc"),
                 peak(yr, "y", "inv_c").alias("peak_year"),
                 F.max("inv_c").alias("_max"))
    return agg.select("inv_c", "all_c", share_or_zero("inv_c", "all_c").alias("share"), "volume",
                      scale_volume("volume")["unit"].alias("volume_unit"),
                      safe_ratio("volume", "inv_c").alias("avg_loan"), safe_ratio("_r", "_rc").alias("avg_rate"),
                      "peak_year",
                      F.when(F.col("peak_year").isNotNull(), F.col("_max")).cast("bigint").alias("peak_count"))


def investor_trend(inv_national: DataFrame, f: Filters = ALL, lens: str = "bp") -> DataFrame:
    """Investor count and volume in $B per year."""
    return sort_small(investor_by_year(inv_national, f, lens).select(
        "y", "inv_c", scale_billions("inv_s").alias("inv_volume_b")), "y")


def investor_share_trend(inv_national: DataFrame, f: Filters = ALL, lens: str = "bp") -> DataFrame:
    """Investor share of all originations per year."""
    return sort_small(investor_by_year(inv_national, f, lens).select(
        "y", safe_pct("inv_c", "all_c").alias("share")), "y")


def investor_purpose_series(inv_national: DataFrame, f: Filters = ALL, lens: str = "bp") -> DataFrame:
    """Investor originations, purpose x year, in the fixed purpose order."""
    src = P.slice_investor(inv_national, f).where(P.investor_lens(lens))
    return R.year_series(src, "p", labels=LOAN_PURPOSE_LABELS, order=INVESTOR_PURPOSE_ORDER)


def occupancy_series(inv_national: DataFrame, f: Filters = ALL) -> DataFrame:
    """All originations, occupancy x year (no lens)."""
    return R.year_series(P.slice_investor(inv_national, f), "occ", labels=OCCUPANCY_LABELS,
                         order=OCCUPANCY_ORDER)


def _investor_group(cube: DataFrame, key: str, f: Filters, lens: str) -> DataFrame:
    inv = P.investor_lens(lens)
    extra = [F.max("state").alias("state")] if key != "state" else []  # one state per county
    return P.slice_investor(cube, f).groupBy(key).agg(
        F.coalesce(F.sum(F.when(inv, F.col("c"))), F.lit(0)).cast("bigint").alias("inv_c"),
        F.coalesce(exact_sum(F.when(inv, F.col("s"))), F.lit(0.0)).alias("inv_s"),
        F.sum("c").cast("bigint").alias("all_c"), *extra)


def investor_states(inv_state: DataFrame, f: Filters = ALL, lens: str = "bp", n: int = 50) -> DataFrame:
    """Per state investor and all originations, share, volume, average loan; by investor count."""
    per = _investor_group(inv_state, "state", f, lens).where(F.col("all_c") > 0)
    out = per.select("state", F.coalesce(literal_map(STATE_NAMES)[F.col("state")], F.lit("")).alias("state_name"),
                     "inv_c", "all_c", share_or_zero("inv_c", "all_c").alias("share"),
                     F.col("inv_s").alias("volume"), safe_ratio("inv_s", "inv_c").alias("avg_loan"))
    return top_n(out, "inv_c", n, "state")


def investor_counties(inv_county: DataFrame, county_names: DataFrame, f: Filters = ALL, lens: str = "bp",
                      n: int = 60, min_orig: int = 1000) -> DataFrame:
    """Counties with at least ``min_orig`` originations, by investor share."""
    per = P.min_sample(_investor_group(inv_county, "fips", f, lens), "all_c", min_orig)
    out = per.select("fips", "state", "inv_c", "all_c", share_or_zero("inv_c", "all_c").alias("share"),
                     F.col("inv_s").alias("volume"))
    return sort_small(with_county_name(top_n(out, "share", n, "fips"), county_names), F.desc("share"), F.asc("fips"))


# ---------------------------------------------------------------------------
# State comparison
# ---------------------------------------------------------------------------
COMPARE_COLUMNS = {"originations": "originated", "applications": "apps", "volume": "volume",
                   "avgLoan": "avg_loan", "avgRate": "avg_rate", "origPct": "orig_pct", "denyPct": "deny_pct"}


def compare_states(state: DataFrame, states: Sequence[str], metric: str = "originations",
                   loan_type: str | None = None, loan_purpose: str | None = None) -> DataFrame:
    """One metric per selected state and year under the comparison's own type/purpose
    choice (overview year and action do not apply).  Long form (state, pos, y, value)."""
    if metric not in COMPARE_COLUMNS:
        raise ValueError(f"metric must be one of {list(COMPARE_COLUMNS)}")
    src = P.keep_states(state, states).where(_match("t", loan_type) & _match("p", loan_purpose))
    per = R.aggregate_compact(src, ["state", "pos", "y"])
    return per.select("state", "pos", "y", F.col(COMPARE_COLUMNS[metric]).cast("double").alias("value"))


def compare_table(state: DataFrame, states: Sequence[str], metric: str = "originations",
                  loan_type: str | None = None, loan_purpose: str | None = None) -> DataFrame:
    """V27 pivoted, one row per year and one column per selected state present in the
    cube (selection order); a year without data for a state is NULL."""
    wanted = list(dict.fromkeys(states))
    present = {r[0] for r in state.where(F.col("state").isin(wanted)).select("state").distinct().collect()}
    cols = [s for s in wanted if s in present]  # bounded by the selection
    long = compare_states(state, cols, metric, loan_type, loan_purpose)
    if not cols:
        return long.select("y").limit(0)
    return sort_small(long.groupBy("y").pivot("state", cols).agg(F.first("value")), "y")


def compare_preset(state: DataFrame, preset: str, metric: str = "originations",
                   loan_type: str | None = None, loan_purpose: str | None = None) -> DataFrame:
    """The comparison for one of the preset state groups."""
    return compare_states(state, STATE_PRESETS[preset], metric, loan_type, loan_purpose)


# ---------------------------------------------------------------------------
# Lender profile payload
# ---------------------------------------------------------------------------
def lender_profile_cube(lender: DataFrame) -> DataFrame:
    """The lender cube in payload form: short keys, whole-dollar and 2-decimal sums."""
    from loanscope.operators.cubes import round_cells
    return round_cells(lender).select(F.col("lei").alias("l"), "a", "t", "p", "c", "s", "r", "rc")


def lender_profiles(names: DataFrame, lender_states: DataFrame) -> DataFrame:
    """Per lender its name and its top states, nested; a lender known to one side alone has the other NULL."""
    return names.select("lei", "name").join(nest_top_states(lender_states), "lei", "full")


# ---------------------------------------------------------------------------
# Every view for one filter state (what a filter change refreshes)
# ---------------------------------------------------------------------------
def dashboard(wh, f: Filters = ALL, lens: str = "bp", search: str | None = None,
              min_apps: int = 1000, min_orig: int = 1000) -> dict[str, DataFrame]:
    """All views of the dashboard under ``f``; ``wh`` is a ``Warehouse``.  Each reads only its landed cube and runs
    when it is collected; the quality panels share one scan of theirs (P9), landed here."""
    main, rates, denials = wh.table("main"), wh.table("rates"), wh.table("denials")
    lb, ld, st = wh.table("lender_base"), wh.table("lender_dim"), wh.table("state")
    county, cdim, q = wh.table("county"), wh.table("county_names"), wh.table("quality")
    panels = wh.scratch("quality-panels", quality_panel_cells(q, f))
    inv_n, inv_s, inv_c = wh.table("inv_national"), wh.table("inv_state"), wh.table("inv_county")
    out = {
        "national_summary": national_summary(main, f), "outcome_series": outcome_series(main, f),
        "outcome_table": outcome_table(main, f), "loan_type_series": loan_type_series(main, f),
        "loan_purpose_series": loan_purpose_series(main, f), "rate_histogram": rate_histogram(rates, f),
        "top_denials": top_denials(denials, f), "year_trend": year_trend(main, f),
        "lender_table": lender_table(lb, ld, f, search), "lender_summary": lender_summary(lb, f),
        "top_lenders": top_lenders(lb, ld, f), "highest_denial_lenders": highest_denial_lenders(lb, ld, f,
                                                                                                min_apps=min_apps),
        "state_table": state_table(st, f), "county_table": county_table(county, cdim, f),
        "quality_summary": panel_summary(panels), "quality_detail": panel_detail(panels),
        "investor_summary": investor_summary(inv_n, f, lens), "investor_trend": investor_trend(inv_n, f, lens),
        "investor_share_trend": investor_share_trend(inv_n, f, lens),
        "investor_purpose_series": investor_purpose_series(inv_n, f, lens),
        "occupancy_series": occupancy_series(inv_n, f), "investor_states": investor_states(inv_s, f, lens),
        "investor_counties": investor_counties(inv_c, cdim, f, lens, min_orig=min_orig),
    }
    for metric in RANK_METRICS:
        out[f"rank_states_{metric}"] = rank_states(st, f, metric, min_apps=min_apps)
    for spec in QUALITY_VIEW_DIMS:
        out[f"quality_series_{spec[0]}"] = panel_series(panels, spec[0])
    return out
