"""Fixed values of the register format and of the published reports.

Everything in this module is data that must equal the original register layout
and report vocabulary for results to line up: column names, renames, code labels
and category orders.  They are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: the 85 columns of the modified register layout, in file order.
# ---------------------------------------------------------------------------
MLAR_COLUMNS: list[str] = [
    "activity_year", "lei", "loan_type", "loan_purpose", "preapproval",
    "construction_method", "occupancy_type", "loan_amount", "action_taken",
    "state_code", "county_code", "census_tract",
    "applicant_ethnicity_1", "applicant_ethnicity_2", "applicant_ethnicity_3",
    "applicant_ethnicity_4", "applicant_ethnicity_5",
    "co_applicant_ethnicity_1", "co_applicant_ethnicity_2", "co_applicant_ethnicity_3",
    "co_applicant_ethnicity_4", "co_applicant_ethnicity_5",
    "applicant_ethnicity_observed", "co_applicant_ethnicity_observed",
    "applicant_race_1", "applicant_race_2", "applicant_race_3",
    "applicant_race_4", "applicant_race_5",
    "co_applicant_race_1", "co_applicant_race_2", "co_applicant_race_3",
    "co_applicant_race_4", "co_applicant_race_5",
    "applicant_race_observed", "co_applicant_race_observed",
    "applicant_sex", "co_applicant_sex",
    "applicant_sex_observed", "co_applicant_sex_observed",
    "applicant_age", "applicant_age_above_62",
    "co_applicant_age", "co_applicant_age_above_62",
    "income", "purchaser_type", "rate_spread", "hoepa_status", "lien_status",
    "applicant_credit_scoring_model", "co_applicant_credit_scoring_model",
    "denial_reason_1", "denial_reason_2", "denial_reason_3", "denial_reason_4",
    "total_loan_costs", "total_points_and_fees", "origination_charges",
    "discount_points", "lender_credits", "interest_rate",
    "prepayment_penalty_term", "debt_to_income_ratio",
    "combined_loan_to_value_ratio", "loan_term", "intro_rate_period",
    "balloon_payment", "interest_only_payment", "negative_amortization",
    "other_non_amortizing_features", "property_value",
    "manufactured_home_secured_property_type",
    "manufactured_home_land_property_interest",
    "total_units", "multifamily_affordable_units",
    "submission_of_application", "initially_payable_to_institution",
    "aus_1", "aus_2", "aus_3", "aus_4", "aus_5",
    "reverse_mortgage", "open_end_line_of_credit",
    "business_or_commercial_purpose",
]

# FIXED VALUES: public-register header name -> modified-register name.
LAR_TO_MLAR_RENAMES: dict[str, str] = {
    "applicant_credit_score_type": "applicant_credit_scoring_model",
    "co_applicant_credit_score_type": "co_applicant_credit_scoring_model",
    "other_nonamortizing_features": "other_non_amortizing_features",
}

# The columns any analysis reads (21 of 85); everything else is carried, never queried.
QUERIED_COLUMNS: list[str] = [
    "activity_year", "lei", "loan_type", "loan_purpose", "action_taken",
    "loan_amount", "interest_rate", "state_code", "county_code", "denial_reason_1",
    "debt_to_income_ratio", "combined_loan_to_value_ratio", "purchaser_type",
    "rate_spread", "lien_status", "balloon_payment", "interest_only_payment",
    "negative_amortization", "other_non_amortizing_features", "occupancy_type",
    "business_or_commercial_purpose",
]

MLAR_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in MLAR_COLUMNS])

# Codes that mean "no number here" in numeric text columns.
MISSING_NUMBER_CODES: tuple[str, ...] = ("Exempt", "NA", "")
# Codes that mean "no code here" in state / county columns.
UNKNOWN_CODES: tuple[str, ...] = ("", "NA")

# ---------------------------------------------------------------------------
# FIXED VALUES: code labels.
# ---------------------------------------------------------------------------
ACTION_LABELS: dict[str, str] = {
    "1": "Loan originated",
    "2": "Approved, not accepted",
    "3": "Denied",
    "4": "Withdrawn",
    "5": "File closed for incompleteness",
    "6": "Purchased by institution",
    "7": "Preapproval denied",
    "8": "Preapproval approved, not accepted",
}

LOAN_TYPE_LABELS: dict[str, str] = {"1": "Conventional", "2": "FHA", "3": "VA", "4": "USDA/RHS"}

LOAN_PURPOSE_LABELS: dict[str, str] = {
    "1": "Purchase",
    "2": "Home Improvement",
    "31": "Refinance",
    "32": "Cash-out Refinance",
    "4": "Other",
    "5": "Not Applicable",
}

DENIAL_REASON_LABELS: dict[str, str] = {
    "1": "Debt-to-income ratio",
    "2": "Employment history",
    "3": "Credit history",
    "4": "Collateral",
    "5": "Insufficient cash",
    "6": "Unverifiable information",
    "7": "Credit application incomplete",
    "8": "Mortgage insurance denied",
    "9": "Other",
    "10": "Not applicable",
}

PURCHASER_LABELS: dict[str, str] = {
    "0": "Not sold",
    "1": "Fannie Mae",
    "2": "Ginnie Mae",
    "3": "Freddie Mac",
    "4": "Farmer Mac",
    "5": "Private securitizer",
    "6": "Commercial bank/thrift",
    "71": "Credit union/mtg co/finance",
    "72": "Life insurer",
    "8": "Affiliate institution",
    "9": "Other",
}

LIEN_LABELS: dict[str, str] = {"1": "First lien", "2": "Subordinate", "1111": "Exempt"}

NON_AM_LABELS: dict[str, str] = {
    "vanilla": "Vanilla",
    "exotic": "Has exotic feature",
    "exempt": "Exempt",
}

OCCUPANCY_LABELS: dict[str, str] = {
    "1": "Principal residence",
    "2": "Second residence",
    "3": "Investment property",
}

BIZ_PURPOSE_LABELS: dict[str, str] = {
    "1": "Business/commercial",
    "2": "Consumer",
    "1111": "Exempt",
}

STATE_NAMES: dict[str, str] = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois",
    "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana",
    "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan",
    "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana",
    "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota",
    "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "PR": "Puerto Rico", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin",
    "WY": "Wyoming",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: category orders used for axes and series.
# ---------------------------------------------------------------------------
RATE_BUCKET_ORDER: list[str] = ["Under 4%", "4-5%", "5-6%", "6-7%", "7-8%", "8-9%", "9%+"]
DTI_ORDER: list[str] = ["<20", "20-30", "30-36", "36-50", "50-60", ">60", "NA"]
LTV_ORDER: list[str] = ["<60", "60-80", "80-90", "90-97", "97-100", ">100", "NA"]
SPREAD_ORDER: list[str] = ["<1.5", "1.5-3", "3-5", ">5", "NA"]
NON_AM_ORDER: list[str] = ["vanilla", "exotic", "exempt"]
INVESTOR_PURPOSE_ORDER: list[str] = ["1", "31", "32", "2", "4", "5"]
OCCUPANCY_ORDER: list[str] = ["1", "2", "3"]

# FIXED VALUES: preset state groups of the state comparison.
STATE_PRESETS: dict[str, list[str]] = {
    "Top 5 by Pop": ["CA", "TX", "FL", "NY", "IL"],
    "High Cost": ["CA", "HI", "WA", "NY", "MA"],
    "Southeast": ["MS", "WV", "AR", "AL", "LA"],
    "Sun Belt": ["AZ", "NV", "ID", "UT", "TX"],
}
