"""Oracle SQL (DuckDB dialect) for every catalogued query.

Each text re-states the query from its definition over the fixture views
(``lar``, ``filers``, ``county``), straight from the fact rows: no cubes, no
reuse.  Agreement with the Spark result therefore checks the cube lineage too.
Numbers are cast the way the Spark side types them (BIGINT counts, DOUBLE
sums and ratios).  Text-to-number casts use ``NUM``: the fixture only holds
clean decimals and missing codes, where DuckDB's ``TRY_CAST`` with a 0
fallback and the lenient cast agree.
"""

from __future__ import annotations

from collections.abc import Mapping

from loanscope.plans import catalog as _cat
from loanscope.schema import (
    ACTION_LABELS, BIZ_PURPOSE_LABELS, DENIAL_REASON_LABELS, DTI_ORDER, INVESTOR_PURPOSE_ORDER, LIEN_LABELS, LOAN_PURPOSE_LABELS,
    LOAN_TYPE_LABELS, LTV_ORDER, MLAR_COLUMNS, NON_AM_LABELS, NON_AM_ORDER, OCCUPANCY_LABELS, OCCUPANCY_ORDER,
    PURCHASER_LABELS, QUERIED_COLUMNS, RATE_BUCKET_ORDER, SPREAD_ORDER, STATE_NAMES, STATE_PRESETS,
)
from loanscope.sources.fixture import with_oracle_views


def NUM(x: str) -> str:
    return f"coalesce(try_cast({x} AS DOUBLE), CAST(0 AS DOUBLE))"


VALID_RATE = "interest_rate NOT IN ('Exempt', 'NA', '')"
M4_SQL = (f"CAST(count(*) AS BIGINT) AS c, sum({NUM('loan_amount')}) AS s, "
          f"sum(CASE WHEN {VALID_RATE} THEN {NUM('interest_rate')} ELSE CAST(0 AS DOUBLE) END) AS r, "
          f"CAST(sum(CASE WHEN {VALID_RATE} THEN 1 ELSE 0 END) AS BIGINT) AS rc")


def label_case(col: str, labels: Mapping[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"coalesce(CASE {col} {whens} END, {col})"


def q(select_sql: str, *views: str, extra: str = "") -> str:
    """Prefix the fixture views (and optional extra CTEs) to a SELECT."""
    sql = with_oracle_views(select_sql if not extra else "\x00", *views)
    if extra:
        sql = sql.replace("\n\x00", ",\n" + extra + "\n" + select_sql)
    return sql


ORACLES: dict[str, str] = {}


# ---------------------------------------------------------------------------
# Cubes (A1-A11)
# ---------------------------------------------------------------------------

ORACLES["a1_main_cube"] = q(f"""SELECT activity_year AS y, action_taken AS a, loan_type AS t, loan_purpose AS p,
 {M4_SQL}
FROM lar GROUP BY activity_year, action_taken, loan_type, loan_purpose""")


def _breakdown_sql(col: str, labels: Mapping[str, str]) -> str:
    return q(f"""SELECT {col} AS code, CAST(count(*) AS BIGINT) AS count,
 round(count(*) * 100e0 / (SELECT count(*) FROM lar), 1) AS pct,
 round(avg({NUM('loan_amount')}), 0) AS avg_loan,
 {label_case(col, labels)} AS label
FROM lar GROUP BY {col}""")


ORACLES["a13_by_action"] = _breakdown_sql("action_taken", ACTION_LABELS)


RATE_BANDS_SQL = """CASE
 WHEN {v} < 4 THEN 'Under 4%' WHEN {v} < 5 THEN '4-5%' WHEN {v} < 6 THEN '5-6%'
 WHEN {v} < 7 THEN '6-7%' WHEN {v} < 8 THEN '7-8%' WHEN {v} < 9 THEN '8-9%'
 WHEN {v} >= 9 THEN '9%+' {tail} END"""

QUALITY_DIMS_SQL = f"""activity_year AS y, action_taken AS a, loan_type AS t, loan_purpose AS p,
 CASE WHEN debt_to_income_ratio IN ('NA', 'Exempt', '') THEN 'NA'
  WHEN debt_to_income_ratio = '<20%' THEN '<20' WHEN debt_to_income_ratio = '20%-<30%' THEN '20-30'
  WHEN debt_to_income_ratio = '30%-<36%' THEN '30-36' WHEN debt_to_income_ratio = '50%-60%' THEN '50-60'
  WHEN debt_to_income_ratio = '>60%' THEN '>60' ELSE '36-50' END AS d,
 CASE WHEN combined_loan_to_value_ratio IN ('NA', 'Exempt', '') THEN 'NA'
  WHEN {NUM('combined_loan_to_value_ratio')} < 60 THEN '<60'
  WHEN {NUM('combined_loan_to_value_ratio')} < 80 THEN '60-80'
  WHEN {NUM('combined_loan_to_value_ratio')} < 90 THEN '80-90'
  WHEN {NUM('combined_loan_to_value_ratio')} < 97 THEN '90-97'
  WHEN {NUM('combined_loan_to_value_ratio')} <= 100 THEN '97-100' ELSE '>100' END AS l,
 purchaser_type AS pu,
 CASE WHEN rate_spread IN ('NA', 'Exempt', '') THEN 'NA'
  WHEN {NUM('rate_spread')} < 1.5 THEN '<1.5' WHEN {NUM('rate_spread')} < 3 THEN '1.5-3'
  WHEN {NUM('rate_spread')} < 5 THEN '3-5' ELSE '>5' END AS rs,
 lien_status AS li,
 CASE WHEN balloon_payment = '1' OR interest_only_payment = '1' OR negative_amortization = '1'
   OR other_non_amortizing_features = '1' THEN 'exotic'
  WHEN balloon_payment IN ('1111', 'Exempt') THEN 'exempt' ELSE 'vanilla' END AS nm"""

KNOWN_STATE = "state_code != '' AND state_code != 'NA'"
KNOWN_COUNTY = "county_code != '' AND county_code != 'NA'"
STATE_OF_PREFIX = "(SELECT STATEFP, max(STATE) AS STATE FROM county GROUP BY STATEFP)"

ORACLES["a2_rate_cube"] = q(f"""SELECT activity_year AS y, loan_type AS t, loan_purpose AS p,
 {RATE_BANDS_SQL.format(v=NUM('interest_rate'), tail='')} AS bucket, CAST(count(*) AS BIGINT) AS c
FROM lar WHERE action_taken = '1' AND {VALID_RATE}
GROUP BY 1, 2, 3, 4""")

ORACLES["a3_denial_cube"] = q("""SELECT activity_year AS y, loan_type AS t, loan_purpose AS p,
 denial_reason_1 AS reason, CAST(count(*) AS BIGINT) AS c
FROM lar WHERE action_taken = '3' AND denial_reason_1 != '' AND denial_reason_1 != '10'
GROUP BY 1, 2, 3, 4""")

ORACLES["a4_state_cube"] = q(f"""SELECT activity_year AS y, state_code AS state, action_taken AS a,
 loan_type AS t, loan_purpose AS p, {M4_SQL}
FROM lar WHERE {KNOWN_STATE} GROUP BY 1, 2, 3, 4, 5""")

ORACLES["a4_state_cube_payload"] = q(f"""SELECT y, state, a, t, p, c, CAST(round(s, 0) AS BIGINT) AS s,
 round(r, 2) AS r, rc FROM (SELECT activity_year AS y, state_code AS state, action_taken AS a,
 loan_type AS t, loan_purpose AS p, {M4_SQL}
FROM lar WHERE {KNOWN_STATE} GROUP BY 1, 2, 3, 4, 5) x""")

ORACLES["a5_county_cube"] = q(f"""SELECT activity_year AS y, county_code AS fips, action_taken AS a,
 loan_type AS t, loan_purpose AS p, {M4_SQL}, coalesce(any_value(st.STATE), '') AS state
FROM lar LEFT JOIN {STATE_OF_PREFIX} st ON substr(county_code, 1, 2) = st.STATEFP
WHERE county_code IN (SELECT county_code FROM lar WHERE {KNOWN_COUNTY}
  GROUP BY county_code ORDER BY count(*) DESC, county_code LIMIT 200)
GROUP BY 1, 2, 3, 4, 5""", "lar", "county")

ORACLES["a6_lender_cube"] = q(f"""SELECT lei, action_taken AS a, loan_type AS t, loan_purpose AS p, {M4_SQL}
FROM lar GROUP BY 1, 2, 3, 4""")

ORACLES["a6_lender_cube_by_year"] = q(f"""SELECT activity_year AS y, lei, action_taken AS a, loan_type AS t,
 loan_purpose AS p, {M4_SQL}
FROM lar GROUP BY 1, 2, 3, 4, 5""")

ORACLES["a7_lender_states"] = q(f"""SELECT lei, state, count, rank FROM (
 SELECT lei, state_code AS state, CAST(count(*) AS BIGINT) AS count,
  CAST(row_number() OVER (PARTITION BY lei ORDER BY count(*) DESC, state_code) AS INTEGER) AS rank
 FROM lar WHERE action_taken = '1' AND {KNOWN_STATE} GROUP BY lei, state_code) x
WHERE rank <= 5""")

ORACLES["a8_quality_cube"] = q(f"""SELECT {QUALITY_DIMS_SQL}, {M4_SQL}
FROM lar GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""")

ORACLES["a9_inv_national"] = q(f"""SELECT activity_year AS y, occupancy_type AS occ,
 business_or_commercial_purpose AS bp, loan_purpose AS p, {M4_SQL}
FROM lar WHERE action_taken = '1' GROUP BY 1, 2, 3, 4""")

ORACLES["a10_inv_state"] = q(f"""SELECT activity_year AS y, state_code AS state, occupancy_type AS occ,
 business_or_commercial_purpose AS bp, loan_purpose AS p, CAST(count(*) AS BIGINT) AS c,
 sum({NUM('loan_amount')}) AS s
FROM lar WHERE action_taken = '1' AND {KNOWN_STATE} GROUP BY 1, 2, 3, 4, 5""")

ORACLES["a11_inv_county"] = q(f"""SELECT activity_year AS y, county_code AS fips, occupancy_type AS occ,
 business_or_commercial_purpose AS bp, loan_purpose AS p, CAST(count(*) AS BIGINT) AS c,
 sum({NUM('loan_amount')}) AS s, coalesce(any_value(st.STATE), '') AS state
FROM lar LEFT JOIN {STATE_OF_PREFIX} st ON substr(county_code, 1, 2) = st.STATEFP
WHERE action_taken = '1' AND county_code IN (SELECT county_code FROM lar
  WHERE action_taken = '1' AND {KNOWN_COUNTY}
  GROUP BY county_code ORDER BY count(*) DESC, county_code LIMIT 200)
GROUP BY 1, 2, 3, 4, 5""", "lar", "county")

# ---------------------------------------------------------------------------
# National report
# ---------------------------------------------------------------------------
ORACLES["a12_summary"] = q(f"""SELECT CAST(count(*) AS BIGINT) AS total_apps,
 CAST(sum(CASE WHEN action_taken = '1' THEN 1 ELSE 0 END) AS BIGINT) AS originated,
 CAST(sum(CASE WHEN action_taken = '3' THEN 1 ELSE 0 END) AS BIGINT) AS denied,
 CAST(count(DISTINCT lei) AS BIGINT) AS lender_count,
 round(avg(CASE WHEN action_taken = '1' THEN {NUM('loan_amount')} END), 0) AS avg_loan,
 round(sum(CASE WHEN action_taken = '1' THEN {NUM('loan_amount')} ELSE 0 END) / 1e9, 1) AS total_volume_b,
 round(avg(CASE WHEN action_taken = '1' AND {VALID_RATE} THEN {NUM('interest_rate')} END), 3) AS avg_rate
FROM lar""")

ORACLES["a14_by_type"] = _breakdown_sql("loan_type", LOAN_TYPE_LABELS)
ORACLES["a15_by_purpose"] = _breakdown_sql("loan_purpose", LOAN_PURPOSE_LABELS)

ORACLES["a16_rate_distribution"] = q(f"""SELECT {RATE_BANDS_SQL.format(v=NUM('interest_rate'), tail="ELSE 'Exempt/NA'")} AS bucket,
 CAST(count(*) AS BIGINT) AS count
FROM lar WHERE action_taken = '1' GROUP BY 1""")

ORACLES["a16_rate_distribution_separate"] = q(f"""SELECT CASE WHEN interest_rate IN ('Exempt', 'NA', '') THEN 'Exempt/NA' ELSE
 {RATE_BANDS_SQL.format(v=NUM('interest_rate'), tail="ELSE 'Exempt/NA'")} END AS bucket,
 CAST(count(*) AS BIGINT) AS count
FROM lar WHERE action_taken = '1' GROUP BY 1""")

ORACLES["a17_denial_reasons"] = q(f"""SELECT denial_reason_1 AS code, CAST(count(*) AS BIGINT) AS count,
 {label_case('denial_reason_1', DENIAL_REASON_LABELS)} AS label
FROM lar WHERE action_taken = '3' AND denial_reason_1 != '' AND denial_reason_1 != '10'
GROUP BY denial_reason_1""")

# ---------------------------------------------------------------------------
# Views (V1-V30), stated over the fact rows
# ---------------------------------------------------------------------------

LAR_DIMS = {"year": "activity_year", "action": "action_taken", "loan_type": "loan_type",
            "loan_purpose": "loan_purpose"}
Q_DIMS = {"year": "y", "action": "a", "loan_type": "t", "loan_purpose": "p", "dti": "d", "ltv": "l",
          "purchaser": "pu", "spread": "rs", "lien": "li", "non_am": "nm"}
INV_DIMS = {"year": "activity_year", "loan_purpose": "loan_purpose"}
RATE_DIMS = {"year": "activity_year", "loan_type": "loan_type", "loan_purpose": "loan_purpose"}
QLAR = f"qlar AS (SELECT {QUALITY_DIMS_SQL}, loan_amount, interest_rate FROM lar)"
NAMES = "names AS (SELECT lei, arg_max(name, year) AS name FROM filers GROUP BY lei)"
COUNTY_NAMES = ("cnames AS (SELECT STATEFP || COUNTYFP AS fips, max(COUNTYNAME) AS county_name "
                "FROM county GROUP BY 1)")


def where_sql(f, dims, ignore=()) -> str:
    terms = [f"{col} = '{getattr(f, d)}'" for d, col in dims.items()
             if d not in ignore and getattr(f, d) is not None]
    return " AND ".join(terms) or "TRUE"


def ordinal_case(col: str, order) -> str:
    whens = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(order))
    return f"coalesce(CASE {col} {whens} END, 999)"


def ratio(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0)"


def cnt(cond: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def compact_sql(mask: str = "TRUE", a: str = "action_taken") -> str:
    """R2 over fact rows, restricted to rows matching ``mask``."""
    apps, orig, den = (f"sum(CASE WHEN {mask} THEN 1 ELSE 0 END)",
                       f"sum(CASE WHEN {mask} AND {a} = '1' THEN 1 ELSE 0 END)",
                       f"sum(CASE WHEN {mask} AND {a} = '3' THEN 1 ELSE 0 END)")
    vr = f"{mask} AND {a} = '1' AND {VALID_RATE}"
    return f"""CAST(coalesce({apps}, 0) AS BIGINT) AS apps, CAST(coalesce({orig}, 0) AS BIGINT) AS originated,
 CAST(coalesce({den}, 0) AS BIGINT) AS denied,
 coalesce(sum(CASE WHEN {mask} AND {a} = '1' THEN {NUM('loan_amount')} END), CAST(0 AS DOUBLE)) AS volume,
 {ratio(f"sum(CASE WHEN {mask} THEN {NUM('loan_amount')} END)", apps)} AS avg_loan,
 {ratio(f"sum(CASE WHEN {vr} THEN {NUM('interest_rate')} END)", f"sum(CASE WHEN {vr} THEN 1 ELSE 0 END)")} AS avg_rate,
 {ratio(orig, apps)} * 100e0 AS orig_pct, {ratio(den, apps)} * 100e0 AS deny_pct"""


def series_sql(src_select: str, views=("lar",), labels=None, order=None, ctes: str = "") -> str:
    """R4 over fact rows: ``src_select`` yields (code, y) per row."""
    ord_expr = ordinal_case("code", order) if order is not None else "tot DESC"
    lab = label_case("r.code", labels) if labels else "r.code"
    extra = (ctes + ",\n" if ctes else "") + f"""src AS ({src_select}),
per AS (SELECT code, y, count(*) AS v FROM src GROUP BY code, y),
ys AS (SELECT DISTINCT y FROM per),
cs AS (SELECT code, sum(v) AS tot FROM per GROUP BY code),
ranked AS (SELECT code, CAST(row_number() OVER (ORDER BY {ord_expr}, code) - 1 AS INTEGER) AS pos FROM cs)"""
    return q(f"""SELECT r.code, {lab} AS label, ys.y, CAST(coalesce(per.v, 0) AS BIGINT) AS c, r.pos
FROM ranked r CROSS JOIN ys LEFT JOIN per ON per.code = r.code AND per.y = ys.y""", *views, extra=extra)


def state_name_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_NAMES.items())
    return f"coalesce(CASE {col} {whens} END, '')"


# V1 ------------------------------------------------------------------------
def _v1(f) -> str:
    in_f = where_sql(f, {"action": "action_taken"})
    apps = f"sum(CASE WHEN {in_f} THEN 1 ELSE 0 END)"
    vr = f"action_taken = '1' AND {VALID_RATE}"
    return q(f"""SELECT CAST(coalesce({apps}, 0) AS BIGINT) AS apps, {cnt("action_taken = '1'")} AS originated,
 {ratio(f"coalesce(sum(CASE WHEN action_taken = '1' THEN 1 ELSE 0 END), 0)", f"coalesce({apps}, 0)")} * 100e0 AS orig_pct,
 coalesce(sum(CASE WHEN action_taken = '1' THEN {NUM('loan_amount')} END), CAST(0 AS DOUBLE)) / 1e9 AS volume_b,
 {ratio(f"sum(CASE WHEN {in_f} THEN {NUM('loan_amount')} END)", f"coalesce({apps}, 0)")} AS avg_loan,
 {ratio(f"sum(CASE WHEN {vr} THEN {NUM('interest_rate')} END)", f"sum(CASE WHEN {vr} THEN 1 ELSE 0 END)")} AS avg_rate
FROM lar WHERE {where_sql(f, LAR_DIMS, {"action"})}""")


ORACLES["v1_national_summary"] = _v1(_cat.Filters())
ORACLES["v1_national_summary_f"] = _v1(_cat.F_YT)
ORACLES["v1_national_summary_action"] = _v1(_cat.F_AP)


# V2, V4, V5 ----------------------------------------------------------------
def _main_series(f, col, ignore, labels) -> str:
    return series_sql(f"SELECT {col} AS code, activity_year AS y FROM lar WHERE {where_sql(f, LAR_DIMS, ignore)}",
                      labels=labels)


ORACLES["v2_outcome_series"] = _main_series(_cat.Filters(), "action_taken", {"year", "action"}, ACTION_LABELS)
ORACLES["v2_outcome_series_f"] = _main_series(_cat.F_YT, "action_taken", {"year", "action"}, ACTION_LABELS)
ORACLES["v4_loan_type_series"] = _main_series(_cat.F_AP, "loan_type", {"year", "loan_type"}, LOAN_TYPE_LABELS)
ORACLES["v5_loan_purpose_series"] = _main_series(_cat.F_YT, "loan_purpose", {"year", "loan_purpose"},
                                                 LOAN_PURPOSE_LABELS)


# V3 ------------------------------------------------------------------------
def _v3(f) -> str:
    return q(f"""SELECT action_taken AS code, {label_case('action_taken', ACTION_LABELS)} AS label,
 CAST(count(*) AS BIGINT) AS count,
 CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100e0 AS pct,
 {ratio(f"sum({NUM('loan_amount')})", "count(*)")} AS avg_loan
FROM lar WHERE {where_sql(f, LAR_DIMS, {"action"})} GROUP BY action_taken""")


ORACLES["v3_outcome_table"] = _v3(_cat.Filters())
ORACLES["v3_outcome_table_f"] = _v3(_cat.F_YT)


# V6, V7 --------------------------------------------------------------------
def _v6(f) -> str:
    band = RATE_BANDS_SQL.format(v=NUM("interest_rate"), tail="")
    return q(f"""SELECT bucket, CAST(count(*) AS BIGINT) AS c, {ordinal_case('bucket', RATE_BUCKET_ORDER)} AS pos
FROM (SELECT {band} AS bucket FROM lar WHERE action_taken = '1' AND {VALID_RATE}
 AND {where_sql(f, RATE_DIMS)}) x GROUP BY bucket""")


def _v7(f, n=8) -> str:
    return q(f"""SELECT label, CAST(count(*) AS BIGINT) AS c FROM (
 SELECT {label_case('denial_reason_1', DENIAL_REASON_LABELS)} AS label FROM lar
 WHERE action_taken = '3' AND denial_reason_1 != '' AND denial_reason_1 != '10' AND {where_sql(f, RATE_DIMS)}) x
GROUP BY label ORDER BY c DESC, label LIMIT {n}""")


ORACLES["v6_rate_histogram"] = _v6(_cat.Filters())
ORACLES["v6_rate_histogram_f"] = _v6(_cat.F_YT.replace(action="3"))
ORACLES["v7_top_denials"] = _v7(_cat.Filters())
ORACLES["v7_top_denials_f"] = _v7(_cat.F_YT)


# V8, V9 --------------------------------------------------------------------
def _v8(f) -> str:
    return q(f"""SELECT activity_year AS y, CAST(count(*) AS BIGINT) AS apps, {cnt("action_taken = '1'")} AS originated,
 {cnt("action_taken = '3'")} AS denied
FROM lar WHERE {where_sql(f, LAR_DIMS, {"year"})} GROUP BY activity_year""")


def _v9(f) -> str:
    return q(f"""SELECT activity_year AS y,
 {ratio(f"sum(CASE WHEN {VALID_RATE} THEN {NUM('interest_rate')} ELSE 0 END)", f"sum(CASE WHEN {VALID_RATE} THEN 1 ELSE 0 END)")} AS avg_rate
FROM lar WHERE {where_sql(f, LAR_DIMS, {"year"})} GROUP BY activity_year""")


ORACLES["v8_volume_trend"] = _v8(_cat.Filters())
ORACLES["v8_volume_trend_f"] = _v8(_cat.F_AP)
ORACLES["v9_rate_trend"] = _v9(_cat.F_YT)


# V10-V13 -------------------------------------------------------------------
TOPS = f"""tops AS (SELECT lei, string_agg(state, ', ' ORDER BY rank) AS top_states FROM (
 SELECT lei, state_code AS state,
  row_number() OVER (PARTITION BY lei ORDER BY count(*) DESC, state_code) AS rank
 FROM lar WHERE action_taken = '1' AND {KNOWN_STATE} GROUP BY lei, state_code) t WHERE rank <= 5 GROUP BY lei)"""


def _lender_stats(f) -> str:
    return f"stats AS (SELECT lei, {compact_sql()} FROM lar WHERE {where_sql(f, LAR_DIMS)} GROUP BY lei)"


def _v10(f, search=None, n=100) -> str:
    tail = (f"WHERE contains(lower(coalesce(nullif(names.name, ''), stats.lei)), '{search.lower()}')" if search
            else f"ORDER BY apps DESC, lei LIMIT {n}")
    return q(f"""SELECT stats.*, coalesce(nullif(names.name, ''), stats.lei) AS name, coalesce(tops.top_states, '') AS top_states
FROM stats LEFT JOIN names USING (lei) LEFT JOIN tops USING (lei) {tail}""", "lar", "filers",
             extra=",\n".join([NAMES, TOPS, _lender_stats(f)]))


ORACLES["v10_lender_table"] = _v10(_cat.Filters())
ORACLES["v10_lender_table_f"] = _v10(_cat.F_YT)
ORACLES["v10_lender_table_search"] = _v10(_cat.F_AP, search=_cat.LENDER_SEARCH)


def _v11(f) -> str:
    return q("""SELECT CAST(count(*) AS BIGINT) AS lenders, CAST(coalesce(sum(apps), 0) AS BIGINT) AS apps,
 CAST(coalesce(sum(originated), 0) AS BIGINT) AS originated, CAST(coalesce(sum(volume), 0) AS DOUBLE) AS volume
FROM stats""", extra=_lender_stats(f))


ORACLES["v11_lender_summary"] = _v11(_cat.Filters())
ORACLES["v11_lender_summary_f"] = _v11(_cat.F_YT)

ORACLES["v12_top_lenders"] = q("""SELECT stats.lei, coalesce(nullif(names.name, ''), stats.lei) AS name, apps, originated
FROM stats LEFT JOIN names USING (lei) WHERE originated > 0 ORDER BY apps DESC, lei LIMIT 15""",
                               "lar", "filers", extra=",\n".join([NAMES, _lender_stats(_cat.F_YT)]))

ORACLES["v13_highest_denial_lenders"] = q(f"""SELECT stats.lei, coalesce(nullif(names.name, ''), stats.lei) AS name, apps, deny_pct
FROM stats LEFT JOIN names USING (lei) WHERE apps >= {_cat.LENDER_MIN_APPS} AND deny_pct IS NOT NULL
ORDER BY deny_pct DESC, apps DESC, lei LIMIT 15""", "lar", "filers",
                                          extra=",\n".join([NAMES, _lender_stats(_cat.Filters())]))


# V14-V16 -------------------------------------------------------------------
def _state_stats(f) -> str:
    return (f"sstats AS (SELECT state_code AS state, {compact_sql()}, {state_name_sql('state_code')} AS state_name "
            f"FROM lar WHERE {KNOWN_STATE} AND {where_sql(f, LAR_DIMS)} GROUP BY state_code)")


def _v14(f, search=None) -> str:
    cond = (f"WHERE contains(lower(state), '{search.lower()}') OR contains(lower(state_name), '{search.lower()}')"
            if search else "")
    return q(f"SELECT * FROM sstats {cond}", extra=_state_stats(f))


ORACLES["v14_state_table"] = _v14(_cat.Filters())
ORACLES["v14_state_table_f"] = _v14(_cat.F_YT)
ORACLES["v14_state_table_search"] = _v14(_cat.F_AP, _cat.STATE_SEARCH)


def _v15(f, metric, min_apps=None, n=10) -> str:
    conds = ["TRUE"]
    if metric != "originated":
        conds.append(f"{metric} IS NOT NULL")
    if metric in ("deny_pct", "avg_rate"):
        conds.append(f"apps >= {min_apps}")
    return q(f"""SELECT state, CAST({metric} AS DOUBLE) AS value FROM sstats WHERE {' AND '.join(conds)}
ORDER BY {metric} DESC, apps DESC, state LIMIT {n}""", extra=_state_stats(f))


ORACLES["v15_rank_states_originated"] = _v15(_cat.F_YT, "originated")
ORACLES["v15_rank_states_avg_loan"] = _v15(_cat.F_YT, "avg_loan")
ORACLES["v15_rank_states_deny_pct"] = _v15(_cat.Filters(year="2020"), "deny_pct", _cat.STATE_MIN_APPS)
ORACLES["v15_rank_states_avg_rate"] = _v15(_cat.Filters(year="2020"), "avg_rate", _cat.STATE_MIN_APPS)


def _v16(f, n=100, top_n=200) -> str:
    mask = where_sql(f, {"action": "action_taken", "loan_type": "loan_type"})
    orig_all = "sum(CASE WHEN action_taken = '1' THEN 1 ELSE 0 END)"
    fha = "sum(CASE WHEN action_taken = '1' AND loan_type = '2' THEN 1 ELSE 0 END)"
    extra = ",\n".join([
        COUNTY_NAMES,
        f"""cstats AS (SELECT county_code AS fips, {compact_sql(mask)}, {ratio(fha, orig_all)} * 100e0 AS fha_pct
 FROM lar WHERE county_code IN (SELECT county_code FROM lar WHERE {KNOWN_COUNTY}
   GROUP BY county_code ORDER BY count(*) DESC, county_code LIMIT {top_n})
  AND {where_sql(f, LAR_DIMS, {"action", "loan_type"})} GROUP BY county_code)"""])
    return q(f"""SELECT cstats.*, coalesce(st.STATE, '') AS state, coalesce(nullif(cnames.county_name, ''), 'Unknown') AS name
FROM cstats LEFT JOIN {STATE_OF_PREFIX} st ON substr(fips, 1, 2) = st.STATEFP LEFT JOIN cnames USING (fips)
WHERE apps > 0 ORDER BY apps DESC, fips LIMIT {n}""", "lar", "county", extra=extra)


ORACLES["v16_county_table"] = _v16(_cat.Filters())
ORACLES["v16_county_table_f"] = _v16(_cat.F_COUNTY)


# V17-V19 -------------------------------------------------------------------
def _v17(f) -> str:
    vr = VALID_RATE
    return q(f"""SELECT CAST(count(*) AS BIGINT) AS count,
 coalesce(sum({NUM('loan_amount')}), CAST(0 AS DOUBLE)) AS volume,
 {ratio(f"coalesce(sum({NUM('loan_amount')}), 0)", "count(*)")} AS avg_loan,
 {ratio(f"sum(CASE WHEN {vr} THEN {NUM('interest_rate')} ELSE 0 END)", f"sum(CASE WHEN {vr} THEN 1 ELSE 0 END)")} AS avg_rate
FROM qlar WHERE {where_sql(f, Q_DIMS)}""", extra=QLAR)


ORACLES["v17_quality_summary"] = _v17(_cat.Filters())
ORACLES["v17_quality_summary_f"] = _v17(_cat.F_QUAL)

_Q_SERIES = {"dti": ("d", DTI_ORDER, None), "ltv": ("l", LTV_ORDER, None),
             "purchaser": ("pu", None, PURCHASER_LABELS), "spread": ("rs", SPREAD_ORDER, None),
             "lien": ("li", None, LIEN_LABELS), "non_am": ("nm", NON_AM_ORDER, NON_AM_LABELS)}
for _dim, (_col, _order, _labels) in _Q_SERIES.items():
    ORACLES[f"v18_quality_series_{_dim}"] = series_sql(
        f"SELECT {_col} AS code, y FROM qlar WHERE {where_sql(_cat.F_QUAL_SERIES, Q_DIMS, {'year', _dim})}",
        labels=_labels, order=_order, ctes=QLAR)

_DETAIL_DIMS = [("DTI", "d", DTI_ORDER, None), ("CLTV", "l", LTV_ORDER, None),
                ("Purchaser", "pu", None, PURCHASER_LABELS), ("Rate Spread", "rs", SPREAD_ORDER, None),
                ("Lien", "li", None, LIEN_LABELS), ("Non-Am", "nm", NON_AM_ORDER, NON_AM_LABELS)]


def _v19(f) -> str:
    parts, label_whens, ord_whens = [], [], []
    for i, (name, col, order, labels) in enumerate(_DETAIL_DIMS):
        parts.append(f"""SELECT '{name}' AS dim, {i} AS dim_pos, {col} AS code, CAST(count(*) AS BIGINT) AS count,
 sum({NUM('loan_amount')}) AS volume,
 sum(CASE WHEN {VALID_RATE} THEN {NUM('interest_rate')} ELSE 0 END) AS r,
 sum(CASE WHEN {VALID_RATE} THEN 1 ELSE 0 END) AS rc
FROM qlar WHERE {where_sql(f, Q_DIMS)} GROUP BY {col}""")
        label_whens.append(f"WHEN '{name}' THEN {label_case('code', labels) if labels else 'code'}")
        ord_whens.append(f"WHEN '{name}' THEN {ordinal_case('code', order) if order else '0'}")
    per = "per AS (" + "\nUNION ALL\n".join(parts) + ")"
    return q(f"""SELECT dim, code, CASE dim {' '.join(label_whens)} END AS bucket, count,
 coalesce({ratio('count', 'sum(count) OVER (PARTITION BY dim)')} * 100e0, 0) AS pct, volume,
 {ratio('r', 'rc')} AS avg_rate, dim_pos,
 CAST(row_number() OVER (PARTITION BY dim ORDER BY CASE dim {' '.join(ord_whens)} END, count DESC, code) - 1 AS INTEGER) AS pos
FROM per WHERE count > 0""", extra=",\n".join([QLAR, per]))


ORACLES["v19_quality_detail"] = _v19(_cat.Filters())
ORACLES["v19_quality_detail_f"] = _v19(_cat.F_QUAL)

# The same views by other ways; A12, V11 by bitmaps.
ORACLES["p9_panel_summary"], ORACLES["p9_panel_detail"] = ORACLES["v17_quality_summary_f"], ORACLES["v19_quality_detail_f"]
ORACLES["p9_panel_detail_all"] = ORACLES["a8_cuboid_detail"] = ORACLES["v19_quality_detail"]
ORACLES["a8_cuboid_summary"] = ORACLES["v17_quality_summary"]
for _dim in ("dti", "ltv", "purchaser", "spread", "lien", "non_am"):
    ORACLES[f"p9_panel_series_{_dim}"] = ORACLES[f"a8_cuboid_series_{_dim}"] = ORACLES[f"v18_quality_series_{_dim}"]
ORACLES["a12_summary_bitmaps"] = ORACLES["a12_summary"]
ORACLES["v11_lender_summary_bitmaps"], ORACLES["v11_lender_summary_bitmaps_f"] = ORACLES["v11_lender_summary"], ORACLES["v11_lender_summary_f"]
ORACLES["a12_lenders_by_year_and_outcome"] = q("""SELECT activity_year AS y, action_taken AS a, CAST(count(DISTINCT lei) AS BIGINT) AS lenders
FROM lar GROUP BY 1, 2""")


# V20-V26 -------------------------------------------------------------------
def lens_sql(lens: str) -> str:
    return ("occupancy_type = '3' AND business_or_commercial_purpose = '1'" if lens == "bp"
            else "occupancy_type = '3'")


def _inv_year(f, lens) -> str:
    L = lens_sql(lens)
    return f"""yr AS (SELECT activity_year AS y, sum(CASE WHEN {L} THEN 1 ELSE 0 END) AS inv_c,
 coalesce(sum(CASE WHEN {L} THEN {NUM('loan_amount')} END), 0) AS inv_s,
 sum(CASE WHEN {L} AND {VALID_RATE} THEN {NUM('interest_rate')} ELSE 0 END) AS inv_r,
 sum(CASE WHEN {L} AND {VALID_RATE} THEN 1 ELSE 0 END) AS inv_rc, count(*) AS all_c
 FROM lar WHERE action_taken = '1' AND {where_sql(f, INV_DIMS)} GROUP BY activity_year)"""


def _v20(f, lens) -> str:
    return q(f"""SELECT CAST(coalesce(sum(inv_c), 0) AS BIGINT) AS inv_c, CAST(coalesce(sum(all_c), 0) AS BIGINT) AS all_c,
 coalesce({ratio('sum(inv_c)', 'sum(all_c)')} * 100e0, 0) AS share,
 CAST(coalesce(sum(inv_s), 0) AS DOUBLE) AS volume,
 CASE WHEN coalesce(sum(inv_s), 0) >= 1e12 THEN 'T' ELSE 'B' END AS volume_unit,
 {ratio('coalesce(sum(inv_s), 0)', 'sum(inv_c)')} AS avg_loan, {ratio('sum(inv_r)', 'sum(inv_rc)')} AS avg_rate,
 (SELECT y FROM yr WHERE inv_c > 0 ORDER BY inv_c DESC, y LIMIT 1) AS peak_year,
 CAST(CASE WHEN max(inv_c) > 0 THEN max(inv_c) END AS BIGINT) AS peak_count
FROM yr""", extra=_inv_year(f, lens))


ORACLES["v20_investor_summary"] = _v20(_cat.Filters(), "bp")
ORACLES["v20_investor_summary_f"] = _v20(_cat.F_INV, "all3")
ORACLES["v21_investor_trend"] = q("SELECT y, CAST(inv_c AS BIGINT) AS inv_c, inv_s / 1e9 AS inv_volume_b FROM yr",
                                  extra=_inv_year(_cat.Filters(loan_purpose="31"), "bp"))
ORACLES["v22_investor_share_trend"] = q(f"SELECT y, {ratio('inv_c', 'all_c')} * 100e0 AS share FROM yr",
                                        extra=_inv_year(_cat.Filters(), "all3"))
ORACLES["v23_investor_purpose_series"] = series_sql(
    f"SELECT loan_purpose AS code, activity_year AS y FROM lar WHERE action_taken = '1' AND {lens_sql('bp')}",
    labels=LOAN_PURPOSE_LABELS, order=INVESTOR_PURPOSE_ORDER)
ORACLES["v24_occupancy_series"] = series_sql(
    "SELECT occupancy_type AS code, activity_year AS y FROM lar WHERE action_taken = '1' AND activity_year = '2024'",
    labels=OCCUPANCY_LABELS, order=OCCUPANCY_ORDER)


def _v25(f, lens, n) -> str:
    L = lens_sql(lens)
    return q(f"""SELECT state_code AS state, {state_name_sql('state_code')} AS state_name,
 {cnt(L)} AS inv_c, CAST(count(*) AS BIGINT) AS all_c,
 coalesce({ratio(f"sum(CASE WHEN {L} THEN 1 ELSE 0 END)", "count(*)")} * 100e0, 0) AS share,
 coalesce(sum(CASE WHEN {L} THEN {NUM('loan_amount')} END), CAST(0 AS DOUBLE)) AS volume,
 {ratio(f"coalesce(sum(CASE WHEN {L} THEN {NUM('loan_amount')} END), 0)", f"sum(CASE WHEN {L} THEN 1 ELSE 0 END)")} AS avg_loan
FROM lar WHERE action_taken = '1' AND {KNOWN_STATE} AND {where_sql(f, INV_DIMS)}
GROUP BY state_code ORDER BY inv_c DESC, state LIMIT {n}""")


ORACLES["v25_investor_states"] = _v25(_cat.Filters(), "bp", 50)
ORACLES["v25_investor_states_f"] = _v25(_cat.F_INV, "all3", 5)


def _v26(f, lens, n=60, min_orig=1000, top_n=200) -> str:
    L = lens_sql(lens)
    return q(f"""SELECT fips, coalesce(st.STATE, '') AS state, inv_c, all_c, share, volume,
 coalesce(nullif(cnames.county_name, ''), 'Unknown') AS name FROM (
 SELECT county_code AS fips, {cnt(L)} AS inv_c, CAST(count(*) AS BIGINT) AS all_c,
  coalesce({ratio(f"sum(CASE WHEN {L} THEN 1 ELSE 0 END)", "count(*)")} * 100e0, 0) AS share,
  coalesce(sum(CASE WHEN {L} THEN {NUM('loan_amount')} END), CAST(0 AS DOUBLE)) AS volume
 FROM lar WHERE action_taken = '1' AND county_code IN (SELECT county_code FROM lar
   WHERE action_taken = '1' AND {KNOWN_COUNTY} GROUP BY county_code ORDER BY count(*) DESC, county_code LIMIT {top_n})
  AND {where_sql(f, INV_DIMS)} GROUP BY county_code) x
LEFT JOIN {STATE_OF_PREFIX} st ON substr(fips, 1, 2) = st.STATEFP LEFT JOIN cnames USING (fips)
WHERE all_c >= {min_orig} ORDER BY share DESC, fips LIMIT {n}""", "lar", "county", extra=COUNTY_NAMES)


ORACLES["v26_investor_counties"] = _v26(_cat.Filters(), "bp", min_orig=_cat.COUNTY_MIN_ORIG)


# V27-V30 -------------------------------------------------------------------
_METRIC_SQL = {"originations": "originated", "applications": "apps", "volume": "volume", "avgLoan": "avg_loan",
               "avgRate": "avg_rate", "origPct": "orig_pct", "denyPct": "deny_pct"}


def _compare_long(states, metric, loan_type=None, loan_purpose=None) -> str:
    order = {s: i for i, s in enumerate(dict.fromkeys(states))}
    pos = "CASE state_code " + " ".join(f"WHEN '{s}' THEN {i}" for s, i in order.items()) + " END"
    sel = ", ".join(f"'{s}'" for s in order)
    conds = [f"state_code IN ({sel})", KNOWN_STATE]
    if loan_type:
        conds.append(f"loan_type = '{loan_type}'")
    if loan_purpose:
        conds.append(f"loan_purpose = '{loan_purpose}'")
    return f"""cmp AS (SELECT state, pos, y, CAST({_METRIC_SQL[metric]} AS DOUBLE) AS value FROM (
 SELECT state_code AS state, {pos} AS pos, activity_year AS y, {compact_sql()}
 FROM lar WHERE {' AND '.join(conds)} GROUP BY state_code, activity_year) x)"""


ORACLES["v27_compare_states"] = q("SELECT * FROM cmp", extra=_compare_long(_cat.COMPARE, "originations"))
ORACLES["v27_compare_states_f"] = q("SELECT * FROM cmp", extra=_compare_long(_cat.COMPARE, "avgRate", "1", "31"))
ORACLES["v28_compare_table"] = q(
    "SELECT y, " + ", ".join(f"max(CASE WHEN state = '{s}' THEN value END) AS {s}" for s in ["CA", "TX", "NY", "PR"])
    + " FROM cmp GROUP BY y", extra=_compare_long(_cat.COMPARE, "denyPct", loan_type="2"))
ORACLES["v29_compare_preset"] = q("SELECT * FROM cmp", extra=_compare_long(STATE_PRESETS["High Cost"], "volume"))
ORACLES["v30_lender_profile_cube"] = q(f"""SELECT lei AS l, action_taken AS a, loan_type AS t, loan_purpose AS p,
 CAST(count(*) AS BIGINT) AS c, CAST(round(sum({NUM('loan_amount')}), 0) AS BIGINT) AS s,
 round(sum(CASE WHEN {VALID_RATE} THEN {NUM('interest_rate')} ELSE 0 END), 2) AS r,
 CAST(sum(CASE WHEN {VALID_RATE} THEN 1 ELSE 0 END) AS BIGINT) AS rc
FROM lar GROUP BY 1, 2, 3, 4""")

# ---------------------------------------------------------------------------
# Sources (S3-S10)
# ---------------------------------------------------------------------------

ORACLES["s3_harmonise"] = q("SELECT " + ", ".join(
    (c if c in QUERIED_COLUMNS else f"'' AS {c}") for c in MLAR_COLUMNS) + " FROM lar")
_SOURCE_FILE = ("CASE WHEN activity_year < '2022' THEN activity_year || '_lar.txt' "
                "ELSE activity_year || '_combined_mlar_header.txt' END")
ORACLES["s4_union"] = q("SELECT " + ", ".join(QUERIED_COLUMNS) + f", {_SOURCE_FILE} AS source_file FROM lar")
ORACLES["s6_audit"] = q(f"SELECT {_SOURCE_FILE} AS source_file, CAST(count(*) AS BIGINT) AS rows FROM lar GROUP BY 1")
ORACLES["s7_year_summary"] = q(f"""SELECT activity_year, CAST(count(*) AS BIGINT) AS apps,
 {cnt("action_taken = '1'")} AS originated FROM lar GROUP BY activity_year""")
ORACLES["s8_total"] = q("SELECT CAST(count(*) AS BIGINT) AS total FROM lar")
ORACLES["s9_county_dim"] = q("SELECT STATEFP, STATE, COUNTYFP, COUNTYNAME FROM county", "county")
ORACLES["s10_lender_names"] = q("SELECT lei, arg_max(name, year) AS name FROM filers GROUP BY lei", "filers")

ORACLES["s11_parameterised_query"] = q("""SELECT county_code, count(*) AS c FROM lar
WHERE county_code != '' AND county_code != 'NA'
GROUP BY county_code ORDER BY c DESC, county_code LIMIT 200""")
ORACLES["r8_distinct_years"] = q("SELECT DISTINCT activity_year AS y FROM lar")

ORACLES["s2_mlar_text_roundtrip"] = q("SELECT " + ", ".join(QUERIED_COLUMNS) + " FROM lar")
ORACLES["s12_payload_json_roundtrip"] = ORACLES["a4_state_cube_payload"]
ORACLES["s1_zip_roundtrip"] = ORACLES["s2_mlar_text_roundtrip"]
for _key in ("s4_load_registers", "s4_load_registers_extracted"):
    ORACLES[_key] = q("SELECT " + ", ".join(QUERIED_COLUMNS)
                      + f", 'yr=' || activity_year || '/{_cat.REGISTER_ZIP}' AS source_file FROM lar")
ORACLES["s9_county_file"] = ORACLES["s9_county_dim"]
ORACLES["s5_refreshed_fact"] = ORACLES["s2_mlar_text_roundtrip"]
_ABSENT = ", ".join(f"('{c}')" for c in MLAR_COLUMNS if c not in QUERIED_COLUMNS)
ORACLES["s6_absent_columns"] = q(f"""SELECT 'yr=' || y || '/{_cat.REGISTER_ZIP}' AS source_file, c AS "column"
FROM (SELECT DISTINCT activity_year AS y FROM lar WHERE activity_year < '2022') d, (VALUES {_ABSENT}) v(c)""")
ORACLES["s9_county_file_repeated"] = q("SELECT STATEFP || COUNTYFP AS fips, any_value(COUNTYNAME) AS county_name FROM county GROUP BY 1", "county")
ORACLES["s10_filer_files"] = ORACLES["s10_lender_names"]
ORACLES["s12_quality_document"] = q(f"""SELECT y, a, t, p, d, l, pu, rs, li, nm, c, CAST(round(s, 0) AS BIGINT) AS s, round(r, 2) AS r, rc
FROM (SELECT {QUALITY_DIMS_SQL}, {M4_SQL} FROM lar GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10) x""")
ORACLES["s14_nested_states"] = ORACLES["a7_lender_states"]

# Rows of each payload member, from the member's own definition.
_COUNTY_NAMES_OF_FIPS = q("SELECT DISTINCT STATEFP || COUNTYFP AS fips FROM county", "county")
_PAYLOADS = {
    "national": {"summary": "a12_summary", "by_action": "a13_by_action", "by_loan_type": "a14_by_type", "by_loan_purpose": "a15_by_purpose",
                 "rate_distribution": "a16_rate_distribution", "denial_reasons": "a17_denial_reasons"},
    "geographic": {"county_names": _COUNTY_NAMES_OF_FIPS, "state_cube": "a4_state_cube", "county_cube": "a5_county_cube"},
    "cube": {"main": "a1_main_cube", "rates": "a2_rate_cube", "denials": "a3_denial_cube"},
    "lenders": {"names": "s10_lender_names", "cube": "a6_lender_cube",
                "states": q(f"SELECT DISTINCT lei FROM lar WHERE action_taken = '1' AND {KNOWN_STATE}")},
    "quality": {"cube": "a8_quality_cube", "orders": len(DTI_ORDER) + len(LTV_ORDER) + len(SPREAD_ORDER) + len(NON_AM_ORDER),
                "labels": len(PURCHASER_LABELS) + len(LIEN_LABELS) + len(NON_AM_LABELS)},
    "investor": {"national_cube": "a9_inv_national", "state_cube": "a10_inv_state", "county_cube": "a11_inv_county",
                 "labels": len(OCCUPANCY_LABELS) + len(BIZ_PURPOSE_LABELS) + len(LOAN_PURPOSE_LABELS)},
}


def _rows_of(what) -> str:
    return str(what) if isinstance(what, int) else f"(SELECT count(*) FROM ({ORACLES.get(what, what)}) m)"


ORACLES["s13_payload_rows"] = "\nUNION ALL\n".join(
    f"SELECT '{payload}' AS payload, '{member}' AS member, CAST({_rows_of(what)} AS BIGINT) AS rows"
    for payload, members in _PAYLOADS.items() for member, what in members.items())


# The contents of orders and labels, and every member of every document.
_STATIC = {("quality", "orders"): {"dti": DTI_ORDER, "ltv": LTV_ORDER, "spread": SPREAD_ORDER, "non_am": NON_AM_ORDER},
           ("quality", "labels"): {"purchaser": PURCHASER_LABELS, "lien": LIEN_LABELS, "non_am": NON_AM_LABELS},
           ("investor", "labels"): {"occupancy": OCCUPANCY_LABELS, "biz_purpose": BIZ_PURPOSE_LABELS, "loan_purpose": LOAN_PURPOSE_LABELS}}


def _static_sql(payload: str, member: str) -> str:
    rows = [(dim, i, code, label) for dim, values in _STATIC[payload, member].items()
            for i, (code, label) in enumerate(values.items() if isinstance(values, Mapping) else ((v, v) for v in values))]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{d}', {i}, '{c}', '{x}')" for d, i, c, x in rows) + ") v(dim, pos, code, label)"


ORACLES["s13_static_members"] = "\nUNION ALL\n".join(
    f"SELECT '{p}' AS payload, '{m}' AS member, dim, CAST(pos AS INTEGER) AS pos, code, label FROM ({_static_sql(p, m)}) s" for p, m in _STATIC)

_DOCUMENT_SOURCES = {(p, m): ORACLES.get(what, what) for p, members in _PAYLOADS.items() for m, what in members.items()} | {
    ("geographic", "county_names"): q("SELECT STATEFP || COUNTYFP AS fips, any_value(COUNTYNAME) AS county_name FROM county GROUP BY 1", "county"),
    ("lenders", "cube"): ORACLES["v30_lender_profile_cube"], ("lenders", "states"): ORACLES["a7_lender_states"],
} | {k: _static_sql(*k) for k in _STATIC}


def _document_member_sql(payload: str, member: str) -> str:
    keys, measures = _cat.DOCUMENT_ROWS[payload, member]
    digits = {} if payload in ("cube", "national") else {"s": 0, "r": 2}
    cells = [f"CAST({f'round({measures[m]}, {digits[m]})' if m in digits and m in measures else measures.get(m, 'NULL')} AS {kind}) AS {m}"
             for m, kind in (("c", "BIGINT"), ("s", "DOUBLE"), ("r", "DOUBLE"), ("rc", "BIGINT"))]
    key = "concat_ws('|', " + ", ".join(keys) + ")" if keys else "''"
    return f"SELECT '{payload}' AS payload, '{member}' AS member, {key} AS key, {', '.join(cells)} FROM ({_DOCUMENT_SOURCES[payload, member]}) m"


ORACLES["s14_load_documents"] = "\nUNION ALL\n".join(_document_member_sql(p, m) for p, m in _cat.DOCUMENT_ROWS)


# CSV text (S15, S16): numbers without exponent and without a fraction of zero.
def _plain(x: str) -> str:
    return f"coalesce(regexp_replace(CAST({x} AS VARCHAR), '\\.0$', ''), '')"


def _compare_lines(metric) -> str:
    shown = ["CA", "TX", "NY", "PR"]
    cells = ", ".join(_plain(f"CASE WHEN abs(v{i}) >= 1e4 AND v{i} = floor(v{i}) THEN CAST(CAST(v{i} AS BIGINT) AS VARCHAR) ELSE CAST(v{i} AS VARCHAR) END")
                      for i in range(len(shown)))
    values = ", ".join(f"max(CASE WHEN state = '{s}' THEN value END) AS v{i}" for i, s in enumerate(shown))
    head = ",".join(["Year", *[f"{s} - {STATE_NAMES[s]}" for s in shown]])
    return q(f"""SELECT '{head}' AS line UNION ALL
SELECT concat_ws(',', y, {cells}) AS line FROM (SELECT y, {values} FROM cmp GROUP BY y) w""",
             extra=_compare_long(_cat.COMPARE, metric, loan_type="2"))


ORACLES["s15_compare_csv_text"] = _compare_lines("volume")
ORACLES["s15_compare_csv_text_rates"] = _compare_lines("avgRate")


def _csv(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '[",\\n]') THEN '"' || replace({x}, '"', '""') || '"' ELSE {x} END"""


ORACLES["s16_chart_csv_text"] = f"""WITH long AS ({ORACLES["v2_outcome_series_f"]})
SELECT 'Category,' || string_agg({_csv('label')}, ',' ORDER BY pos) AS line FROM (SELECT DISTINCT label, pos FROM long) h
UNION ALL SELECT y || ',' || string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos) FROM long GROUP BY y"""
ORACLES["s16_histogram_csv_text"] = f"""SELECT 'Category,"Rates, originated"' AS line
UNION ALL SELECT {_csv('bucket')} || ',' || CAST(c AS VARCHAR) FROM ({_v6(_cat.Filters())}) h"""

ORACLES["v30_lender_profiles"] = q(f"""SELECT coalesce(names.lei, s.lei) AS lei, names.name, s.states FROM names FULL JOIN (
 SELECT lei, string_agg(state || ':' || CAST(count AS VARCHAR), ' ' ORDER BY rank) AS states FROM (
  SELECT lei, state_code AS state, count(*) AS count, row_number() OVER (PARTITION BY lei ORDER BY count(*) DESC, state_code) AS rank
  FROM lar WHERE action_taken = '1' AND {KNOWN_STATE} GROUP BY lei, state_code) t WHERE rank <= 5 GROUP BY lei) s ON names.lei = s.lei""",
                                   "lar", "filers", extra=NAMES)


def _picker(search=None) -> str:
    values = ", ".join(f"('{k}', '{v}')" for k, v in STATE_NAMES.items())
    cond = f"WHERE contains(lower(state), '{search}') OR contains(lower(state_name), '{search}')" if search else ""
    return q(f"""SELECT state, state_name, apps, CAST(row_number() OVER (ORDER BY state_name, state) - 1 AS INTEGER) AS pos FROM (
 SELECT n.state, n.state_name, (SELECT count(*) FROM lar WHERE state_code = n.state) AS apps FROM (VALUES {values}) n(state, state_name)) x {cond}""")


ORACLES["p13_state_picker"] = _picker()
ORACLES["p13_state_picker_search"] = _picker(_cat.STATE_SEARCH)
ORACLES["t13_sorted_states"] = q("""SELECT *, CAST(row_number() OVER (ORDER BY avg_rate ASC NULLS LAST, state) - 1 AS INTEGER) AS pos
FROM sstats""", extra=_state_stats(_cat.F_YT))
ORACLES["t13_sorted_lenders"] = f"""SELECT *, CAST(row_number() OVER (ORDER BY deny_pct DESC NULLS LAST, lei) - 1 AS INTEGER) AS pos
FROM ({ORACLES["v10_lender_table"]}) shown"""

_NUMERIC_PREFIX_SQL = r"^[ \t\n\x0B\f\r]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
ORACLES["x1_messy_numbers"] = f"""SELECT text, coalesce(try_cast(regexp_extract(text, '{_NUMERIC_PREFIX_SQL}', 1) AS DOUBLE), 0e0) AS value,
 count(*) AS n FROM ({_cat.MESSY_SQL.format(lineitem='lineitem')}) x GROUP BY text"""
