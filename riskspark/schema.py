"""Column lists, sentinels and explicit schemas of the credit application data.

Every reader in the package uses these schemas, so no inference pass over
the input is ever needed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference application for equal results.
# ---------------------------------------------------------------------------

# DAYS_EMPLOYED value meaning "not employed".
EMPLOYMENT_SENTINEL = 365243
# Days per year used by every age / seniority conversion.
DAYS_PER_YEAR = 365.25

# Feature columns cast to double before scoring.
NUMERIC_COLS = [
    "CNT_CHILDREN", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
    "AMT_GOODS_PRICE", "REGION_POPULATION_RELATIVE", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH",
    "OWN_CAR_AGE", "CNT_FAM_MEMBERS", "EXT_SOURCE_1",
    "EXT_SOURCE_2", "EXT_SOURCE_3", "OBS_30_CNT_SOCIAL_CIRCLE",
    "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE",
    "DEF_60_CNT_SOCIAL_CIRCLE", "DAYS_LAST_PHONE_CHANGE",
]

# Feature columns cast to string, null replaced by "Unknown", before scoring.
CATEGORICAL_COLS = [
    "NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_TYPE_SUITE",
    "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE", "OCCUPATION_TYPE", "WEEKDAY_APPR_PROCESS_START",
    "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE",
]

# Y/N flags encoded to 1/0 before scoring.
FLAG_COLS = ["FLAG_OWN_CAR", "FLAG_OWN_REALTY"]

# The six credit bureau enquiry counters summed into TOTAL_ENQUIRIES.
ENQUIRY_COLS = [
    "AMT_REQ_CREDIT_BUREAU_HOUR", "AMT_REQ_CREDIT_BUREAU_DAY",
    "AMT_REQ_CREDIT_BUREAU_WEEK", "AMT_REQ_CREDIT_BUREAU_MON",
    "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR",
]

# Columns kept for the client profile of a scored application.
PROFILE_COLS = [
    "SK_ID_CURR", "CODE_GENDER", "CNT_CHILDREN", "AMT_INCOME_TOTAL",
    "AMT_CREDIT", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "risk_score", "prediction",
]

# Weekdays in week order (rank 0 = MONDAY).
WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]

# ---------------------------------------------------------------------------
# Explicit schemas
# ---------------------------------------------------------------------------

_STRING_COLS = [
    "NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY", "FLAG_OWN_CAR", "CODE_GENDER",
    "NAME_INCOME_TYPE", "NAME_FAMILY_STATUS", "NAME_EDUCATION_TYPE",
    "NAME_HOUSING_TYPE", "NAME_TYPE_SUITE", "OCCUPATION_TYPE",
    "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE",
]
_DOUBLE_COLS = ENQUIRY_COLS + [
    "AMT_ANNUITY", "AMT_GOODS_PRICE", "REGION_POPULATION_RELATIVE",
    "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "OWN_CAR_AGE", "CNT_FAM_MEMBERS",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
    "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
    "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE",
    "DAYS_LAST_PHONE_CHANGE",
]

# Column order of the derived application table (see sources.fixtures).
APPLICATION_COLUMNS = [
    "SK_ID_CURR", "CUST_ID", "TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL",
    "NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY", "FLAG_OWN_CAR", "CODE_GENDER",
    "NAME_INCOME_TYPE", "NAME_FAMILY_STATUS", "NAME_EDUCATION_TYPE",
    "NAME_HOUSING_TYPE", "NAME_TYPE_SUITE", "OCCUPATION_TYPE",
    "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE", "CNT_CHILDREN",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "WEEKDAY_APPR_PROCESS_START",
    *ENQUIRY_COLS,
    "AMT_ANNUITY", "AMT_GOODS_PRICE", "REGION_POPULATION_RELATIVE",
    "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "OWN_CAR_AGE", "CNT_FAM_MEMBERS",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
    "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
    "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE",
    "DAYS_LAST_PHONE_CHANGE",
]


def _type_of(name: str) -> T.DataType:
    if name in ("SK_ID_CURR", "CUST_ID"):
        return T.LongType()
    if name in ("TARGET", "CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED"):
        return T.IntegerType()
    if name in ("AMT_CREDIT", "AMT_INCOME_TOTAL") or name in _DOUBLE_COLS:
        return T.DoubleType()
    return T.StringType()


def application_schema(with_target: bool = True) -> T.StructType:
    """Schema of the portfolio table (``with_target``) or of the scoring table."""
    return T.StructType([
        T.StructField(c, _type_of(c), nullable=(c != "SK_ID_CURR"))
        for c in APPLICATION_COLUMNS
        if with_target or c != "TARGET"
    ])


APPLICATION = application_schema(True)
SCORING = application_schema(False)

FEEDBACK = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("custom_dimensions", T.MapType(T.StringType(), T.StringType())),
    T.StructField("is_positive", T.BooleanType()),
])
