"""Small fixed lookup tables, kept as plain Python values and turned into
DataFrames on demand.  Every table here has a size fixed by definition (51
states, 5 categories, 3 scenarios), so broadcasting it is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from econ_lake.session import small_frame

# ---------------------------------------------------------------------------
# Fixed values (must equal the published definitions for identical results).
# ---------------------------------------------------------------------------

# State FIPS code -> USPS abbreviation: the 50 states plus DC.
STATE_FIPS_TO_ABBR = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO",
    "09": "CT", "10": "DE", "11": "DC", "12": "FL", "13": "GA", "15": "HI",
    "16": "ID", "17": "IL", "18": "IN", "19": "IA", "20": "KS", "21": "KY",
    "22": "LA", "23": "ME", "24": "MD", "25": "MA", "26": "MI", "27": "MN",
    "28": "MS", "29": "MO", "30": "MT", "31": "NE", "32": "NV", "33": "NH",
    "34": "NJ", "35": "NM", "36": "NY", "37": "NC", "38": "ND", "39": "OH",
    "40": "OK", "41": "OR", "42": "PA", "44": "RI", "45": "SC", "46": "SD",
    "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA",
    "54": "WV", "55": "WI", "56": "WY",
}

# Price-parity line code -> (category key, category label).
RPP_LINE_CATEGORIES = [
    ("1", "all_items", "All items"),
    ("2", "goods", "Goods"),
    ("3", "housing_rents", "Housing rents"),
    ("4", "utilities", "Utilities"),
    ("5", "other_services", "Other services"),
]

# Spending crosswalk: (table, line) -> category, mapping method.  The
# derived "other services" category is line 13 minus line 15 of SAPCE1.
SPENDING_CROSSWALK = [
    ("SAPCE1", "1", "all_items", "All items", "direct"),
    ("SAPCE1", "2", "goods", "Goods", "direct"),
    ("SAPCE4", "19", "housing_rents", "Housing rents", "approximation_housing_proxy_for_rents"),
    ("SAPCE4", "24", "utilities", "Utilities", "direct"),
]
DERIVED_OTHER_SERVICES = {
    "table": "SAPCE1",
    "minuend_line": "13",
    "subtrahend_line": "15",
    "category_key": "other_services",
    "category": "Other services",
    "mapping_method": "derived_services_less_housing_and_utilities",
    "series_code": "SAPCE1-13_MINUS_15",
    "function_name": "Services less housing and utilities",
}

# Study constants: target states, display orders and exclusion scenarios.
TARGET_STATES = ("CA", "NY", "NJ", "IL", "CT")
CATEGORY_ORDER = ("All items", "Housing rents", "Goods", "Utilities", "Other services")
SCENARIO_ORDER = ("National", "Without CA", "Without CA, NY, NJ, IL, CT")
SCENARIO_EXCLUSIONS = {
    "National": (),
    "Without CA": ("CA",),
    "Without CA, NY, NJ, IL, CT": ("CA", "NY", "NJ", "IL", "CT"),
}

# Dataset ids the ratio views select on.
GDP_TABLE, GDP_LINE = "SAGDP1", "3"
FEDERAL_TO_STATEGOV_DATASET = "census_state_gov_finance_federal_intergovernmental_revenue"
FEDERAL_TO_PERSONS_DATASET, FEDERAL_TO_PERSONS_LINE = "state_personal_transfer_receipts_sainc35", "2000"
POPULATION_DATASET = "census_state_population"

# Tolerances of the study gates.
SHARE_SUM_TOLERANCE = 1e-8
SCENARIO_MATH_TOLERANCE = 1e-4

# ---------------------------------------------------------------------------


def fips_frame(spark: SparkSession) -> DataFrame:
    return small_frame(spark, sorted(STATE_FIPS_TO_ABBR.items()), "state_fips string, state_abbrev string")


def rpp_category_frame(spark: SparkSession) -> DataFrame:
    schema = "line_code string, category_key string, category string"
    return small_frame(spark, RPP_LINE_CATEGORIES, schema)


def crosswalk_frame(spark: SparkSession) -> DataFrame:
    schema = ("pce_source_table string, line_code string, category_key string, "
              "category string, mapping_method string")
    return small_frame(spark, SPENDING_CROSSWALK, schema)
