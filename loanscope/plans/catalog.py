"""The catalogue of runnable queries: one entry per operator of the survey.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the fixture
registers of ``sf_dir``.  Cube-level entries read the landed cubes of the
session's warehouse, so the fact table is scanned once per cube family, not
once per query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as _F

from loanscope.functions.scalars import lenient_double as _lenient
from loanscope.operators import bitmaps as _bitmaps
from loanscope.operators import lookups as _lookups
from loanscope.operators import ranking as _rank
from loanscope.operators import reports
from loanscope.operators import rollup as _R
from loanscope.operators.cubes import round_cells as _round_cells
from loanscope.operators.filters import QUALITY_DIMS as _QUALITY_DIMS
from loanscope.operators.filters import Filters
from loanscope.plans import cuboids as _cuboids
from loanscope.plans import jobs as _jobs
from loanscope.plans import sql as _sql
from loanscope.plans import views as V
from loanscope.plans.warehouse import Warehouse, fixture_warehouse
from loanscope.schema import LAR_TO_MLAR_RENAMES, QUERIED_COLUMNS
from loanscope.sources import documents as _docs
from loanscope.sources import fixture as _fx
from loanscope.sources import reference as _ref
from loanscope.sources import registers as _reg
from loanscope.sources import sinks as _sinks
from loanscope.sources.tables import read_table as _read_table

Query = Callable[[SparkSession, str], DataFrame]


def _t(name: str) -> Query:
    return lambda spark, sf_dir: fixture_warehouse(spark, sf_dir).table(name)


def _w(fn: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(fixture_warehouse(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # cubes
    "a1_main_cube": _t("main"),
    "a2_rate_cube": _t("rates"),
    "a3_denial_cube": _t("denials"),
    "a4_state_cube": _t("state"),
    "a4_state_cube_payload": _w(lambda w: _round_cells(w.table("state"))),
    "a5_county_cube": _t("county"),
    "a6_lender_cube": _t("lender"),
    "a6_lender_cube_by_year": _t("lender_base"),
    "a7_lender_states": _t("lender_states"),
    "a8_quality_cube": _t("quality"),
    "a9_inv_national": _t("inv_national"),
    "a10_inv_state": _t("inv_state"),
    "a11_inv_county": _t("inv_county"),
    # national report
    "a12_summary": _w(lambda w: reports.summary(w.table("lender_base"))),
    "a13_by_action": _w(lambda w: reports.by_action(w.table("main"))),
    "a14_by_type": _w(lambda w: reports.by_loan_type(w.table("main"))),
    "a15_by_purpose": _w(lambda w: reports.by_loan_purpose(w.table("main"))),
    "a16_rate_distribution": _t("rate_distribution"),
    "a16_rate_distribution_separate": _w(lambda w: reports.rate_distribution_from_base(w.table("rate_base"),
                                                                                        "separate")),
    "a17_denial_reasons": _w(lambda w: reports.denial_reasons(w.table("denials"))),
}

# ---------------------------------------------------------------------------
# Views (V1-V30).  Fixed parameter sets: one unfiltered and one filtered variant
# where the survey asks for both; thresholds scaled to the fixture (lenders hold
# about 600 applications, counties 5-632 originations at sf0.01).
# ---------------------------------------------------------------------------

F_YT = Filters(year="2020", loan_type="1")
F_AP = Filters(action="3", loan_purpose="31")
F_COUNTY = Filters(year="2019", action="1", loan_type="2")
F_QUAL = Filters(year="2022", dti="36-50", lien="1")
F_QUAL_SERIES = Filters(year="2022", action="1", ltv="80-90", non_am="vanilla")
F_INV = Filters(year="2021", loan_purpose="1")
LENDER_MIN_APPS = 500
STATE_MIN_APPS = 500
COUNTY_MIN_ORIG = 100
LENDER_SEARCH = "0000001"
STATE_SEARCH = "w"
COMPARE = ["CA", "TX", "ZZ", "NY", "PR"]


def _v(fn) -> Query:
    return lambda spark, sf_dir: fn(fixture_warehouse(spark, sf_dir))


QUERIES.update({
    "v1_national_summary": _v(lambda w: V.national_summary(w.table("main"))),
    "v1_national_summary_f": _v(lambda w: V.national_summary(w.table("main"), F_YT)),
    "v1_national_summary_action": _v(lambda w: V.national_summary(w.table("main"), F_AP)),
    "v2_outcome_series": _v(lambda w: V.outcome_series(w.table("main"))),
    "v2_outcome_series_f": _v(lambda w: V.outcome_series(w.table("main"), F_YT)),
    "v3_outcome_table": _v(lambda w: V.outcome_table(w.table("main"))),
    "v3_outcome_table_f": _v(lambda w: V.outcome_table(w.table("main"), F_YT)),
    "v4_loan_type_series": _v(lambda w: V.loan_type_series(w.table("main"), F_AP)),
    "v5_loan_purpose_series": _v(lambda w: V.loan_purpose_series(w.table("main"), F_YT)),
    "v6_rate_histogram": _v(lambda w: V.rate_histogram(w.table("rates"))),
    "v6_rate_histogram_f": _v(lambda w: V.rate_histogram(w.table("rates"), F_YT.replace(action="3"))),
    "v7_top_denials": _v(lambda w: V.top_denials(w.table("denials"))),
    "v7_top_denials_f": _v(lambda w: V.top_denials(w.table("denials"), F_YT)),
    "v8_volume_trend": _v(lambda w: V.volume_trend(w.table("main"))),
    "v8_volume_trend_f": _v(lambda w: V.volume_trend(w.table("main"), F_AP)),
    "v9_rate_trend": _v(lambda w: V.rate_trend(w.table("main"), F_YT)),
    "v10_lender_table": _v(lambda w: V.lender_table(w.table("lender_base"), w.table("lender_dim"))),
    "v10_lender_table_f": _v(lambda w: V.lender_table(w.table("lender_base"), w.table("lender_dim"), F_YT)),
    "v10_lender_table_search": _v(lambda w: V.lender_table(w.table("lender_base"), w.table("lender_dim"), F_AP,
                                                           search=LENDER_SEARCH)),
    "v11_lender_summary": _v(lambda w: V.lender_summary(w.table("lender_base"))),
    "v11_lender_summary_f": _v(lambda w: V.lender_summary(w.table("lender_base"), F_YT)),
    "v12_top_lenders": _v(lambda w: V.top_lenders(w.table("lender_base"), w.table("lender_dim"), F_YT)),
    "v13_highest_denial_lenders": _v(lambda w: V.highest_denial_lenders(
        w.table("lender_base"), w.table("lender_dim"), min_apps=LENDER_MIN_APPS)),
    "v14_state_table": _v(lambda w: V.state_table(w.table("state"))),
    "v14_state_table_f": _v(lambda w: V.state_table(w.table("state"), F_YT)),
    "v14_state_table_search": _v(lambda w: V.state_table(w.table("state"), F_AP, search=STATE_SEARCH)),
    "v15_rank_states_originated": _v(lambda w: V.rank_states(w.table("state"), F_YT, "originated")),
    "v15_rank_states_avg_loan": _v(lambda w: V.rank_states(w.table("state"), F_YT, "avg_loan")),
    "v15_rank_states_deny_pct": _v(lambda w: V.rank_states(w.table("state"), Filters(year="2020"), "deny_pct",
                                                           min_apps=STATE_MIN_APPS)),
    "v15_rank_states_avg_rate": _v(lambda w: V.rank_states(w.table("state"), Filters(year="2020"),
                                                           "avg_rate", min_apps=STATE_MIN_APPS)),
    "v16_county_table": _v(lambda w: V.county_table(w.table("county"), w.table("county_names"))),
    "v16_county_table_f": _v(lambda w: V.county_table(w.table("county"), w.table("county_names"), F_COUNTY)),
    "v17_quality_summary": _v(lambda w: V.quality_summary(w.table("quality"))),
    "v17_quality_summary_f": _v(lambda w: V.quality_summary(w.table("quality"), F_QUAL)),
    "v19_quality_detail": _v(lambda w: V.quality_detail(w.table("quality"))),
    "v19_quality_detail_f": _v(lambda w: V.quality_detail(w.table("quality"), F_QUAL)),
    "v20_investor_summary": _v(lambda w: V.investor_summary(w.table("inv_national"))),
    "v20_investor_summary_f": _v(lambda w: V.investor_summary(w.table("inv_national"), F_INV, "all3")),
    "v21_investor_trend": _v(lambda w: V.investor_trend(w.table("inv_national"), Filters(loan_purpose="31"))),
    "v22_investor_share_trend": _v(lambda w: V.investor_share_trend(w.table("inv_national"), lens="all3")),
    "v23_investor_purpose_series": _v(lambda w: V.investor_purpose_series(w.table("inv_national"))),
    "v24_occupancy_series": _v(lambda w: V.occupancy_series(w.table("inv_national"), Filters(year="2024"))),
    "v25_investor_states": _v(lambda w: V.investor_states(w.table("inv_state"))),
    "v25_investor_states_f": _v(lambda w: V.investor_states(w.table("inv_state"), F_INV, "all3", n=5)),
    "v26_investor_counties": _v(lambda w: V.investor_counties(w.table("inv_county"), w.table("county_names"),
                                                              min_orig=COUNTY_MIN_ORIG)),
    "v27_compare_states": _v(lambda w: V.compare_states(w.table("state"), COMPARE)),
    "v27_compare_states_f": _v(lambda w: V.compare_states(w.table("state"), COMPARE, "avgRate", "1", "31")),
    "v28_compare_table": _v(lambda w: V.compare_table(w.table("state"), COMPARE, "denyPct", loan_type="2")),
    "v29_compare_preset": _v(lambda w: V.compare_preset(w.table("state"), "High Cost", "volume")),
    "v30_lender_profile_cube": _v(lambda w: V.lender_profile_cube(w.table("lender"))),
})
for _dim in ("dti", "ltv", "purchaser", "spread", "lien", "non_am"):
    QUERIES[f"v18_quality_series_{_dim}"] = (
        lambda d: _v(lambda w: V.quality_series(w.table("quality"), F_QUAL_SERIES, d)))(_dim)

# One pass for all quality panels (P9), lenders by bitmaps (A12, V11), views over chosen cuboids.
CUBOID_BUDGET = 20_000  # cells
CUBOID_VIEWS = _cuboids.quality_view_needs(Filters(), [d[0] for d in V.QUALITY_VIEW_DIMS]) + _cuboids.quality_view_needs(
    F_QUAL_SERIES, [d[0] for d in V.QUALITY_VIEW_DIMS])


def _panels(w, f):
    """The panel cells of a filter state, landed once for all panels' queries."""
    tag = "-".join(str(getattr(f, d) or "") for d in _QUALITY_DIMS).replace("%", "").replace(">", "gt").replace("<", "lt")
    return w.derived(f"panels{tag}", lambda: V.quality_panel_cells(w.table("quality"), f))


def _cuboid_view(w, dims, view):
    return view(_cuboids.build(w, CUBOID_VIEWS, CUBOID_BUDGET).covering(dims))


QUERIES.update({
    "p9_panel_summary": _v(lambda w: V.panel_summary(_panels(w, F_QUAL))),
    "p9_panel_detail": _v(lambda w: V.panel_detail(_panels(w, F_QUAL))),
    "p9_panel_detail_all": _v(lambda w: V.panel_detail(_panels(w, Filters()))),
    "a12_summary_bitmaps": _w(lambda w: reports.summary_from_bitmaps(w.table("main"), w.table("lender_bitmaps"))),
    "v11_lender_summary_bitmaps": _v(lambda w: V.lender_summary_from_bitmaps(w.table("main"), w.table("lender_bitmaps"))),
    "v11_lender_summary_bitmaps_f": _v(lambda w: V.lender_summary_from_bitmaps(w.table("main"), w.table("lender_bitmaps"), F_YT)),
    "a12_lenders_by_year_and_outcome": _w(lambda w: _bitmaps.count_lenders(w.table("lender_bitmaps"), ["y", "a"])),
    "a8_cuboid_summary": _v(lambda w: _cuboid_view(w, _cuboids.needs(Filters()), V.quality_summary)),
    "a8_cuboid_detail": _v(lambda w: _cuboid_view(w, _cuboids.needs(Filters(), [d[0] for d in V.QUALITY_VIEW_DIMS]), V.quality_detail)),
})
for _dim in ("dti", "ltv", "purchaser", "spread", "lien", "non_am"):
    QUERIES[f"p9_panel_series_{_dim}"] = (lambda d: _v(lambda w: V.panel_series(_panels(w, F_QUAL_SERIES), d)))(_dim)
    QUERIES[f"a8_cuboid_series_{_dim}"] = (lambda d: _v(lambda w: _cuboid_view(
        w, _cuboids.needs(F_QUAL_SERIES, ("year", d), ("year", d)), lambda cube: V.quality_series(cube, F_QUAL_SERIES, d))))(_dim)

# ---------------------------------------------------------------------------
# Sources (S3-S10): the fixture rows presented in both register layouts.
# ---------------------------------------------------------------------------

_MLAR_TO_LAR = {v: k for k, v in LAR_TO_MLAR_RENAMES.items()}
LAR_EXTRA = {"derived_msa_md": "", "tract_population": "0"}


def as_lar_layout(rows: DataFrame) -> DataFrame:
    """The rows as a public register presents them: older names, another column
    order, extra columns; most of the 85 columns absent."""
    cols = [_F.col(c).alias(_MLAR_TO_LAR.get(c, c)) for c in reversed(rows.columns)]
    return rows.select(*cols, *[_F.lit(v).alias(k) for k, v in LAR_EXTRA.items()])


def as_mlar_layout(rows: DataFrame) -> DataFrame:
    """The rows as the 85-column modified register (absent columns empty)."""
    have = set(rows.columns)
    return rows.select(*[(_F.col(c) if c in have else _F.lit("")).alias(c) for c in _reg.MLAR_COLUMNS])


def union_of_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years before 2022 in the public layout, later years in the modified
    layout, each harmonised, then appended by name."""
    lar = _fx.lar(spark, sf_dir)
    old = _reg.harmonise(as_lar_layout(lar.where(_F.col("activity_year") < "2022")))
    new = as_mlar_layout(lar.where(_F.col("activity_year") >= "2022"))
    old = old.withColumn("source_file", _F.concat("activity_year", _F.lit("_lar.txt")))
    new = new.withColumn("source_file", _F.concat("activity_year", _F.lit("_combined_mlar_header.txt")))
    return old.unionByName(new)


QUERIES.update({
    "s3_harmonise": lambda s, d: _reg.harmonise(as_lar_layout(_fx.lar(s, d))),
    "s4_union": lambda s, d: union_of_layouts(s, d).select(*QUERIED_COLUMNS, "source_file"),
    "s6_audit": lambda s, d: _reg.ingest_audit(union_of_layouts(s, d)),
    "s7_year_summary": _w(lambda w: _reg.year_summary(w.fact())),
    "s8_total": _w(lambda w: _reg.total_rows(w.fact())),
    "s9_county_dim": _w(lambda w: w.table("county_dim").drop("pos")),
    "s10_lender_names": _t("lender_names"),
})

# ---------------------------------------------------------------------------
# Parameterised SQL (S11) and distinct years
# ---------------------------------------------------------------------------

QUERIES.update({
    "s11_parameterised_query": _w(lambda w: _sql.query(w.spark, _sql.TOP_COUNTIES_SQL, {"top_n": 200},
                                                       fact=w.fact())),
    "r8_distinct_years": _w(lambda w: _R.distinct_years(w.table("main"))),
})

# ---------------------------------------------------------------------------
# Sink and reader round trips (S2, S12, S16): Spark writes data derived from the
# tables with the sink, the engine's reader reads it back.
# ---------------------------------------------------------------------------


def _mlar_text(w):
    def write(path):
        _fx.write_text(as_mlar_layout(_fx.lar(w.spark, w.sf_dir)), path)
    return _reg.read_mlar_text(w.spark, w.landed_files("mlar_text", write)).select(*QUERIED_COLUMNS)


def _mlar_zips(w):
    """The pipe-text round trip's files, zipped as one register, read by the zip data source."""
    _mlar_text(w)
    zips = w.landed_files("mlar_zips", lambda p: _fx.zip_folder(w.spark, w.path("mlar_text"), p))
    return _reg.read_zip(w.spark, zips, schema=_reg.MLAR_SCHEMA).select(*QUERIED_COLUMNS)


REGISTER_YEARS = range(2018, 2027)  # the last one is never filed: skipped as absent
REGISTER_ZIP = "register.zip"


def _register_files(w) -> list[_reg.RegisterFile]:
    """The rows as yearly zips of one name in a folder for each year: the public layout before 2022, else the modified."""
    lar = _fx.lar(w.spark, w.sf_dir).withColumn("yr", _F.col("activity_year"))
    keep_year = lambda layout, df: layout(df.drop("yr")).withColumn("yr", _F.col("activity_year"))
    frames = {"lar": keep_year(as_lar_layout, lar.where(_F.col("yr") < "2022")), "mlar": keep_year(as_mlar_layout, lar.where(_F.col("yr") >= "2022"))}

    def write(path):
        for layout, df in frames.items():
            _fx.write_text(df, f"{path}/text/{layout}", "yr")
            _fx.zip_folder(w.spark, f"{path}/text/{layout}", f"{path}/zip", REGISTER_ZIP)

    root = w.landed_files("register_zips", write)
    return [_reg.RegisterFile(f"{root}/zip/yr={y}/{REGISTER_ZIP}", "lar" if y < 2022 else "mlar") for y in REGISTER_YEARS]


def _load_registers(w, extract: bool):
    """Those files through the loader; ``source_file`` is cut to its folder and name."""
    texts = f"{w.path('register_texts')}" if extract else None
    rows, _ = _reg.load_registers(w.spark, _register_files(w), extract_dir=texts)
    return rows.select(*QUERIED_COLUMNS, _F.regexp_extract("source_file", "([^/]+/[^/]+)$", 1).alias("source_file"))


def _absent_columns(w):
    """Names of the columns that the public-layout register zips lack."""
    files = _reg.present_files(w.spark, _register_files(w))[0]
    told = _reg.absent_column_table(w.spark, files)
    return told.select(_F.regexp_extract("source_file", "([^/]+/[^/]+)$", 1).alias("source_file"), "column")


def _refreshed_fact(w):
    """The fact table of the rows before 2022, then refreshed with all rows: what readers of the last version see."""
    rows = _fx.lar(w.spark, w.sf_dir)

    def write(path):
        for df in (rows.where(_F.col("activity_year") < "2022"), rows):
            _sinks.write_fact(df, path)

    return _sinks.read_fact(w.spark, w.landed_files("refreshed", write), rows.schema).select(*QUERIED_COLUMNS)


def _county_file_repeated(w):
    """A county file that lists every county twice, first under other names, as one file: the last row's name of each county."""
    def write(path):
        rows = w.table("county_dim").drop("pos")
        renamed = rows.withColumn("COUNTYNAME", _F.concat(_F.lit("Old "), "COUNTYNAME"))
        both = renamed.withColumn("o", _F.lit(0)).unionByName(rows.withColumn("o", _F.lit(1)))
        (both.coalesce(1).sortWithinPartitions("o", "STATEFP", "COUNTYFP").drop("o").write.mode("overwrite").option("sep", "|").option("header", True)
         .option("quote", '"').option("escape", '"').csv(path))
    return _lookups.county_names(_ref.read_county_file(w.spark, w.landed_files("county_file_repeated", write)))


def _county_file(w):
    """The county file written as pipe text and read by the engine."""
    def write(path):
        (w.table("county_dim").drop("pos").write.mode("overwrite").option("sep", "|").option("header", True)
         .option("quote", '"').option("escape", '"').csv(path))
    return _ref.read_county_file(w.spark, w.landed_files("county_file", write)).drop("pos")


def _filer_files(w):
    """Yearly filer lists as JSON documents of at most 10,000 institutions, one year's list missing."""
    def write(path):
        lists = _fx.filers(w.spark, w.sf_dir).groupBy("year", _F.floor(_F.substring("lei", 4, 17).cast("bigint") / 10_000).alias("part")).agg(
            _F.to_json(_F.struct(_F.collect_list(_F.struct("lei", "name")).alias("institutions"))).alias("value"))
        lists.select("year", "value").write.mode("overwrite").partitionBy("year").option("maxRecordsPerFile", 1).text(path)
    root = w.landed_files("filer_files", write)
    return _ref.lender_names(_ref.read_filer_files(w.spark, {y: f"{root}/year={y}" for y in REGISTER_YEARS}))


def _payload_json(w):
    cube = _round_cells(w.table("state"))
    path = w.landed_files("payload_state_json", lambda p: _sinks.write_payload({"state_cube": cube}, p, "json"))
    return w.spark.read.schema(cube.schema).json(f"{path}/state_cube")


def _payload_rows(w):
    """Every payload table written and loaded again: rows by payload and member."""
    tables = _jobs.payloads(w)
    root = w.landed_files("payloads", lambda p: _jobs.run_all(w, p))
    loaded = _jobs.load_payload(w.spark, {p: {n: f"{root}/{p}/{n}" for n in members} for p, members in tables.items()})
    counts = [df.agg(_F.count("*").alias("rows")).select(_F.lit(p).alias("payload"), _F.lit(n).alias("member"), "rows")
              for p, members in loaded.items() for n, df in members.items()]
    return reduce(DataFrame.unionByName, counts)


def _nested_states(w):
    """The nested top states written as JSON lines, read back and flattened."""
    nested = _rank.nest_top_states(w.table("lender_states"))
    path = w.landed_files("payload_states_json", lambda p: _sinks.write_payload({"states": nested}, p, "json"))
    back = w.spark.read.schema(nested.schema).json(f"{path}/states")
    return back.select("lei", _F.posexplode("states").alias("i", "s")).select(
        "lei", _F.col("s.state").alias("state"), _F.col("s.count").alias("count"), (_F.col("i") + 1).alias("rank"))


def _quality_document(w):
    """The quality payload's JSON document, its cube read back from it."""
    members = _jobs.documents(w)["quality"]
    path = w.landed_files("quality_document", lambda p: _sinks.write_document(members, p))
    return _docs.member_table(_docs.read_document(w.spark, path), "cube", _jobs.DOCUMENT_MEMBERS["quality"]["cube"])


# For each member of a document its key columns and which columns are its measures c, s, r and rc.
_M4 = {"c": "c", "s": "s", "r": "r", "rc": "rc"}
_REPORT = (["code", "label"], {"c": "count", "s": "avg_loan", "r": "pct"})
DOCUMENT_ROWS: dict[tuple[str, str], tuple[list[str], dict[str, str]]] = {
    ("national", "summary"): ([], {"c": "total_apps", "s": "avg_loan", "r": "avg_rate", "rc": "lender_count"}),
    ("national", "by_action"): _REPORT, ("national", "by_loan_type"): _REPORT, ("national", "by_loan_purpose"): _REPORT,
    ("national", "rate_distribution"): (["bucket"], {"c": "count"}), ("national", "denial_reasons"): (["code", "label"], {"c": "count"}),
    ("geographic", "county_names"): (["fips", "county_name"], {}), ("geographic", "state_cube"): (["y", "state", "a", "t", "p"], _M4),
    ("geographic", "county_cube"): (["y", "fips", "a", "t", "p", "state"], _M4),
    ("cube", "main"): (["y", "a", "t", "p"], _M4), ("cube", "rates"): (["y", "t", "p", "bucket"], {"c": "c"}),
    ("cube", "denials"): (["y", "t", "p", "reason"], {"c": "c"}),
    ("lenders", "names"): (["lei", "name"], {}), ("lenders", "cube"): (["l", "a", "t", "p"], _M4), ("lenders", "states"): (["lei", "rank", "state"], {"c": "count"}),
    ("quality", "cube"): (["y", "a", "t", "p", "d", "l", "pu", "rs", "li", "nm"], _M4),
    ("quality", "orders"): (["dim", "code", "label"], {"c": "pos"}), ("quality", "labels"): (["dim", "code", "label"], {"c": "pos"}),
    ("investor", "national_cube"): (["y", "occ", "bp", "p"], _M4), ("investor", "state_cube"): (["y", "state", "occ", "bp", "p"], {"c": "c", "s": "s"}),
    ("investor", "county_cube"): (["y", "fips", "occ", "bp", "p", "state"], {"c": "c", "s": "s"}),
    ("investor", "labels"): (["dim", "code", "label"], {"c": "pos"}),
}
_MEASURES = {"c": "bigint", "s": "double", "r": "double", "rc": "bigint"}


def _loaded_documents(w):
    """All six payload documents written and loaded again, every member's rows in one form: payload, member, keys, measures."""
    root = w.landed_files("documents", lambda p: _jobs.write_documents(w, p))
    loaded = _jobs.load_documents(w.spark, {p: f"{root}/{p}" for p in _jobs.DOCUMENT_MEMBERS}, chunk_bytes=1 << 16)
    out = []
    for (payload, member), (keys, measures) in DOCUMENT_ROWS.items():
        df = loaded[payload][member]
        if member == "states":
            df = df.select("lei", _F.posexplode("states").alias("i", "e")).select("lei", (_F.col("i") + 1).alias("rank"), "e.state", "e.count")
        key = _F.concat_ws("|", *keys) if keys else _F.lit("")
        cells = [(_F.col(measures[m]) if m in measures else _F.lit(None)).cast(kind).alias(m) for m, kind in _MEASURES.items()]
        out.append(df.select(_F.lit(payload).alias("payload"), _F.lit(member).alias("member"), key.alias("key"), *cells))
    return reduce(DataFrame.unionByName, out)


def _static_members(w):
    """The payload tables that hold orders and labels, written and loaded again."""
    tables = {p: {m: t for m, t in ms.items() if m in ("orders", "labels")} for p, ms in _jobs.payloads(w).items()}
    root = w.landed_files("payloads", lambda p: _jobs.run_all(w, p))
    loaded = _jobs.load_payload(w.spark, {p: {n: f"{root}/{p}/{n}" for n in ms} for p, ms in tables.items() if ms})
    return reduce(DataFrame.unionByName, [df.select(_F.lit(p).alias("payload"), _F.lit(n).alias("member"), "dim", "pos", "code", "label")
                                          for p, ms in loaded.items() for n, df in ms.items()])


def _lender_profiles(w):
    """Names and nested top states, as text."""
    p = V.lender_profiles(w.table("lender_names"), w.table("lender_states"))
    told = _F.transform("states", lambda s: _F.concat(s["state"], _F.lit(":"), s["count"].cast("string")))
    return p.select("lei", "name", _F.array_join(told, " ").alias("states"))


def _text(w, name, write):
    """The lines of a text file that a sink wrote."""
    return w.spark.read.text(w.landed_files(name, write)).withColumnRenamed("value", "line")


def _compare_csv(w, metric):
    """The comparison table as CSV text."""
    table = V.compare_table(w.table("state"), COMPARE, metric, loan_type="2")
    return _text(w, f"compare_csv_{metric}", lambda p: _sinks.write_compare_csv(table, COMPARE, p))


def _chart_csv(w):
    """A chart of several series as CSV text."""
    lines = _sinks.chart_csv_lines(V.outcome_series(w.table("main"), F_YT))
    return _text(w, "chart_csv", lambda p: _sinks.write_csv_lines(lines, p))


def _histogram_csv(w):
    """A chart of one unlabelled series as CSV text."""
    lines = _sinks.single_chart_csv_lines(V.rate_histogram(w.table("rates")), "bucket", "c", "Rates, originated", ["pos"])
    return _text(w, "histogram_csv", lambda p: _sinks.write_csv_lines(lines, p))


# Numbers as people type them, derived from the line items.
MESSY_SQL = """SELECT CASE (l_orderkey + l_linenumber) % 12 WHEN 0 THEN concat(' ', q, '.5x') WHEN 1 THEN concat(q, 'abc')
 WHEN 2 THEN concat(q, 'e2') WHEN 3 THEN '.' WHEN 4 THEN concat('.', q) WHEN 5 THEN concat('-', q, ' days') WHEN 6 THEN concat('+', q, '.')
 WHEN 7 THEN 'NA' WHEN 8 THEN '' WHEN 9 THEN concat(q, '%') WHEN 10 THEN concat('1,', q) ELSE concat(q, '.', cast(l_linenumber as string)) END AS text
FROM (SELECT l_orderkey, l_linenumber, cast(l_partkey % 1000 as string) AS q FROM {lineitem}) x"""


def _messy_numbers(spark, sf_dir):
    """X1 over messy text: the value of each text and the sum over its rows."""
    rows = spark.sql(MESSY_SQL, lineitem=_read_table(spark, sf_dir, "lineitem"))
    return rows.groupBy("text", _lenient("text").alias("value")).agg(_F.count("*").alias("n"))


QUERIES.update({
    "s1_zip_roundtrip": _w(_mlar_zips),
    "s2_mlar_text_roundtrip": _w(_mlar_text),
    "s4_load_registers": _w(lambda w: _load_registers(w, False)),
    "s4_load_registers_extracted": _w(lambda w: _load_registers(w, True)),
    "s5_refreshed_fact": _w(_refreshed_fact),
    "s6_absent_columns": _w(_absent_columns),
    "s9_county_file": _w(_county_file),
    "s9_county_file_repeated": _w(_county_file_repeated),
    "s10_filer_files": _w(_filer_files),
    "s12_payload_json_roundtrip": _w(_payload_json),
    "s12_quality_document": _w(_quality_document),
    "s13_payload_rows": _w(_payload_rows),
    "s13_static_members": _w(_static_members),
    "s14_load_documents": _w(_loaded_documents),
    "s14_nested_states": _w(_nested_states),
    "s15_compare_csv_text": _w(lambda w: _compare_csv(w, "volume")),
    "s15_compare_csv_text_rates": _w(lambda w: _compare_csv(w, "avgRate")),
    "s16_chart_csv_text": _w(_chart_csv),
    "s16_histogram_csv_text": _w(_histogram_csv),
    "v30_lender_profiles": _w(_lender_profiles),
    "p13_state_picker": _w(lambda w: V.state_picker(w.table("state"))),
    "p13_state_picker_search": _w(lambda w: V.state_picker(w.table("state"), STATE_SEARCH)),
    "t13_sorted_states": _w(lambda w: V.sorted_states(w.table("state"), F_YT, "avg_rate", True)),
    "t13_sorted_lenders": _w(lambda w: V.sorted_lenders(w.table("lender_base"), w.table("lender_dim"), column="deny_pct")),
    "x1_messy_numbers": _messy_numbers,
})
