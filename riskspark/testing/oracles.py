"""DuckDB oracle SQL for every query registered in ``__spark_entry__``.

Each statement starts from the same derived ``application`` (and, where
needed, ``users_data`` / ``feedback``) as ``riskspark.sources.fixtures``,
written independently in DuckDB SQL, then computes the query. Column names
and types are aligned with the Spark side.
"""

from __future__ import annotations

from riskspark.functions import client as C
from riskspark.plans.parameters import published
from riskspark.plans.sql_export import features_sql, scores_sql
from riskspark.schema import CATEGORICAL_COLS, FLAG_COLS, NUMERIC_COLS, PROFILE_COLS, WEEKDAYS, application_schema

APPLICATION_SQL = """
SELECT o.o_orderkey AS SK_ID_CURR, o.o_custkey AS CUST_ID,
 CAST(CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS TARGET,
 o.o_totalprice AS AMT_CREDIT,
 CASE WHEN c.c_acctbal > 0 THEN c.c_acctbal * 12 WHEN o.o_custkey % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE NULL END AS AMT_INCOME_TOTAL,
 CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Revolving loans' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
 CASE WHEN o.o_custkey % 50 = 7 THEN 'X' WHEN o.o_custkey % 3 = 0 THEN 'N' ELSE 'Y' END AS FLAG_OWN_REALTY,
 CASE WHEN o.o_custkey % 11 = 0 THEN NULL WHEN o.o_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
 CASE WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
 CASE WHEN o.o_orderkey % 500 = 0 THEN 'Student' WHEN c.c_mktsegment = 'BUILDING' THEN 'Working'
      WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Commercial associate' WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Pensioner'
      WHEN c.c_mktsegment = 'MACHINERY' THEN 'State servant' ELSE 'Entrepreneur' END AS NAME_INCOME_TYPE,
 CASE c.c_nationkey % 6 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single / not married' WHEN 2 THEN 'Civil marriage'
      WHEN 3 THEN 'Separated' WHEN 4 THEN 'Widow' ELSE NULL END AS NAME_FAMILY_STATUS,
 CASE o.o_custkey % 5 WHEN 0 THEN 'Higher education' WHEN 1 THEN 'Secondary / secondary special' WHEN 2 THEN 'Incomplete higher'
      WHEN 3 THEN 'Lower secondary' ELSE 'Academic degree' END AS NAME_EDUCATION_TYPE,
 CASE o.o_custkey % 7 WHEN 0 THEN 'House / apartment' WHEN 1 THEN 'Rented apartment' WHEN 2 THEN 'With parents' WHEN 3 THEN 'Municipal apartment'
      WHEN 4 THEN 'Office apartment' WHEN 5 THEN 'Co-op apartment' ELSE 'Other' END AS NAME_HOUSING_TYPE,
 CASE WHEN o.o_orderkey % 9 = 0 THEN NULL WHEN o.o_orderkey % 2 = 0 THEN 'Family' ELSE 'Unaccompanied' END AS NAME_TYPE_SUITE,
 CASE WHEN o.o_custkey % 3 = 0 THEN NULL WHEN o.o_custkey % 3 = 1 THEN 'Laborers' ELSE 'Managers' END AS OCCUPATION_TYPE,
 CASE WHEN o.o_custkey % 4 < 2 THEN 'Business Entity' ELSE 'Government' END AS ORGANIZATION_TYPE,
 CASE WHEN o.o_custkey % 3 = 0 THEN NULL ELSE 'reg oper account' END AS FONDKAPREMONT_MODE,
 CASE WHEN o.o_custkey % 2 = 0 THEN NULL ELSE 'block of flats' END AS HOUSETYPE_MODE,
 CASE WHEN o.o_custkey % 5 = 0 THEN NULL WHEN o.o_custkey % 2 = 0 THEN 'Panel' ELSE 'Stone, brick' END AS WALLSMATERIAL_MODE,
 CASE WHEN o.o_custkey % 13 = 0 THEN 'Yes' ELSE 'No' END AS EMERGENCYSTATE_MODE,
 CAST(CASE WHEN o.o_orderkey % 200 = 1 THEN 5 WHEN o.o_orderkey % 10 < 6 THEN 0 WHEN o.o_orderkey % 10 < 8 THEN 1
      WHEN o.o_orderkey % 10 = 8 THEN 2 ELSE 3 END AS INT) AS CNT_CHILDREN,
 CAST(CASE WHEN o.o_custkey % 101 = 0 THEN NULL ELSE -(7305 + (o.o_custkey * 37) % 18000) END AS INT) AS DAYS_BIRTH,
 CAST(CASE WHEN o.o_custkey % 6 = 0 THEN 365243 WHEN o.o_custkey % 103 = 0 THEN NULL ELSE -((o.o_orderkey * 13) % 7000) END AS INT) AS DAYS_EMPLOYED,
 upper(dayname(o.o_orderdate)) AS WEEKDAY_APPR_PROCESS_START,
 l.rh AS AMT_REQ_CREDIT_BUREAU_HOUR, l.rd AS AMT_REQ_CREDIT_BUREAU_DAY, l.rw AS AMT_REQ_CREDIT_BUREAU_WEEK,
 l.rm AS AMT_REQ_CREDIT_BUREAU_MON, l.rq AS AMT_REQ_CREDIT_BUREAU_QRT, l.ry AS AMT_REQ_CREDIT_BUREAU_YEAR,
 o.o_totalprice / 20 AS AMT_ANNUITY,
 CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE o.o_totalprice * 0.75 END AS AMT_GOODS_PRICE,
 CAST((c.c_nationkey * 7) % 64 AS DOUBLE) / 1024 AS REGION_POPULATION_RELATIVE,
 CAST(-((o.o_custkey * 17) % 9000) AS DOUBLE) AS DAYS_REGISTRATION, CAST(-((o.o_custkey * 19) % 6000) AS DOUBLE) AS DAYS_ID_PUBLISH,
 CAST(CASE WHEN o.o_custkey % 4 = 0 THEN o.o_custkey % 30 ELSE NULL END AS DOUBLE) AS OWN_CAR_AGE,
 CAST(1 + o.o_custkey % 5 AS DOUBLE) AS CNT_FAM_MEMBERS,
 CAST(CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE (o.o_orderkey * 31) % 1024 END AS DOUBLE) / 1024 AS EXT_SOURCE_1,
 CAST((o.o_orderkey * 37) % 1024 AS DOUBLE) / 1024 AS EXT_SOURCE_2,
 CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE (o.o_orderkey * 41) % 1024 END AS DOUBLE) / 1024 AS EXT_SOURCE_3,
 CAST(o.o_custkey % 6 AS DOUBLE) AS OBS_30_CNT_SOCIAL_CIRCLE, CAST(o.o_custkey % 3 AS DOUBLE) AS DEF_30_CNT_SOCIAL_CIRCLE,
 CAST(o.o_custkey % 7 AS DOUBLE) AS OBS_60_CNT_SOCIAL_CIRCLE, CAST(o.o_custkey % 2 AS DOUBLE) AS DEF_60_CNT_SOCIAL_CIRCLE,
 CAST(-(o.o_orderkey % 4000) AS DOUBLE) AS DAYS_LAST_PHONE_CHANGE
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey,
  CAST(sum(CASE WHEN l_returnflag='A' AND l_linestatus='F' THEN 1 END) AS DOUBLE) rh,
  CAST(sum(CASE WHEN l_returnflag='A' AND l_linestatus='O' THEN 1 END) AS DOUBLE) rd,
  CAST(sum(CASE WHEN l_returnflag='N' AND l_linestatus='F' THEN 1 END) AS DOUBLE) rw,
  CAST(sum(CASE WHEN l_returnflag='N' AND l_linestatus='O' THEN 1 END) AS DOUBLE) rm,
  CAST(sum(CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN 1 END) AS DOUBLE) rq,
  CAST(sum(CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN 1 END) AS DOUBLE) ry
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

USERS_SQL = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS SK_CURR_ID_INT,
       CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey AS VARCHAR) END AS SK_CURR_ID_STR,
       split_part(c_name, '#', 1) AS FirstName,
       split_part(c_name, '#', 2) || d.suffix AS LastName,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'photos/' || CAST(c_custkey AS VARCHAR) || '.jpg' END AS PhotoURL
FROM customer, (VALUES (''), ('-dup')) d(suffix)
WHERE c_custkey % 10 <> 9 AND (d.suffix = '' OR c_custkey % 25 = 0)
"""

# Bucket labels / expressions shared by several oracle statements.
AGE_GROUP = """CASE WHEN -DAYS_BIRTH / 365.25::DOUBLE < 25 THEN '< 25 ans'
  WHEN -DAYS_BIRTH / 365.25::DOUBLE < 35 THEN '25-35 ans' WHEN -DAYS_BIRTH / 365.25::DOUBLE < 45 THEN '35-45 ans'
  WHEN -DAYS_BIRTH / 365.25::DOUBLE < 55 THEN '45-55 ans' ELSE '> 55 ans' END"""
YEARS_EMPLOYED = "CASE WHEN DAYS_EMPLOYED = 365243 THEN 0.0::DOUBLE ELSE -DAYS_EMPLOYED / 365.25::DOUBLE END"
EMPLOYMENT_LENGTH = f"""CASE WHEN ({YEARS_EMPLOYED}) < 1 THEN '< 1 an' WHEN ({YEARS_EMPLOYED}) < 3 THEN '1-3 ans'
  WHEN ({YEARS_EMPLOYED}) < 5 THEN '3-5 ans' WHEN ({YEARS_EMPLOYED}) < 10 THEN '5-10 ans' ELSE '> 10 ans' END"""
TOTAL_ENQUIRIES = ("(coalesce(AMT_REQ_CREDIT_BUREAU_HOUR, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_DAY, 0) "
                   "+ coalesce(AMT_REQ_CREDIT_BUREAU_WEEK, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_MON, 0) "
                   "+ coalesce(AMT_REQ_CREDIT_BUREAU_QRT, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_YEAR, 0))")
ENQUIRY_GROUP = f"""CASE WHEN {TOTAL_ENQUIRIES} = 0 THEN 'Aucune demande' WHEN {TOTAL_ENQUIRIES} <= 2 THEN '1-2 demandes'
  WHEN {TOTAL_ENQUIRIES} <= 5 THEN '3-5 demandes' ELSE '> 5 demandes' END"""
DEFAULT_FLAG = "CASE WHEN TARGET = 1 THEN 1 ELSE 0 END"
DEFAULT_RATE = f"round(avg({DEFAULT_FLAG}) * 100, 2)"
RATIO = "round(AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0), 2)"
WEEKDAY_ORDER = f"""CAST(CASE WHEN WEEKDAY_APPR_PROCESS_START IS NULL THEN 0
  ELSE list_position([{", ".join(f"'{d}'" for d in WEEKDAYS)}],
                     upper(WEEKDAY_APPR_PROCESS_START)) - 1 END AS INT)"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def with_app(body: str, extra: str = "") -> str:
    """``WITH application AS (...) <body>``; ``extra`` adds further CTEs."""
    more = f",\n{extra}" if extra else ""
    return f"WITH application AS ({APPLICATION_SQL}){more}\n{body}"


ORACLE_SQL: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


# --- G: the eight analyses -------------------------------------------------
oracle("g1_age", with_app(f"""
SELECT {AGE_GROUP} AS AGE_GROUP, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application GROUP BY 1"""))

oracle("g2_credit_income", with_app(f"""
SELECT RATIO_CATEGORY, count(*) AS COUNT, round(avg(r), 2) AS AVG_RATIO, {DEFAULT_RATE} AS DEFAULT_RATE
FROM (SELECT *, {RATIO} AS r,
        CAST(ntile(5) OVER (ORDER BY {RATIO} NULLS FIRST, SK_ID_CURR) AS INT) AS RATIO_CATEGORY
      FROM application) t
GROUP BY RATIO_CATEGORY"""))

oracle("g3_income_type", with_app(f"""
SELECT NAME_INCOME_TYPE, count(*) AS CLIENT_COUNT, round(avg(AMT_INCOME_TOTAL), 0) AS AVG_INCOME,
       {DEFAULT_RATE} AS DEFAULT_RATE
FROM application GROUP BY NAME_INCOME_TYPE HAVING count(*) > 100"""))

oracle("g4_employment", with_app(f"""
SELECT {EMPLOYMENT_LENGTH} AS EMPLOYMENT_LENGTH, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application GROUP BY 1 ORDER BY 1"""))

oracle("g5_enquiries", with_app(f"""
SELECT {ENQUIRY_GROUP} AS ENQUIRY_GROUP, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application GROUP BY 1"""))

oracle("g6_contract_realty", with_app(f"""
SELECT NAME_CONTRACT_TYPE,
       CASE FLAG_OWN_REALTY WHEN 'Y' THEN 'Propriétaire' WHEN 'N' THEN 'Non propriétaire' ELSE FLAG_OWN_REALTY END
         AS FLAG_OWN_REALTY,
       count(*) AS CLIENT_COUNT, round(avg(AMT_CREDIT), 0) AS AVG_CREDIT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application GROUP BY NAME_CONTRACT_TYPE, application.FLAG_OWN_REALTY"""))

oracle("g7_family_children", with_app(f"""
SELECT NAME_FAMILY_STATUS, CNT_CHILDREN, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application GROUP BY NAME_FAMILY_STATUS, CNT_CHILDREN HAVING count(*) > 50"""))

oracle("g8_weekday", with_app(f"""
SELECT WEEKDAY_APPR_PROCESS_START, count(*) AS APPLICATION_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE,
       round(avg(AMT_CREDIT), 0) AS AVG_CREDIT, {WEEKDAY_ORDER} AS WEEKDAY_ORDER
FROM application GROUP BY WEEKDAY_APPR_PROCESS_START ORDER BY WEEKDAY_ORDER NULLS LAST"""))

oracle("w1_ntile", with_app(f"""
SELECT SK_ID_CURR, {RATIO} AS CREDIT_INCOME_RATIO,
       CAST(ntile(5) OVER (ORDER BY {RATIO} NULLS FIRST, SK_ID_CURR) AS INT) AS RATIO_CATEGORY
FROM application"""))


# --- G9-G12 -----------------------------------------------------------------
_OWNERSHIP = ("CASE FLAG_OWN_REALTY WHEN 'Y' THEN 'Propriétaire' WHEN 'N' THEN 'Non propriétaire' "
              "ELSE FLAG_OWN_REALTY END")

oracle("g9_portfolio_report", with_app(f"""
SELECT 1 AS ANALYSIS, {AGE_GROUP} AS KEY1, NULL::VARCHAR AS KEY2, count(*) AS CLIENT_COUNT,
       {DEFAULT_RATE} AS DEFAULT_RATE, NULL::DOUBLE AS AVG_VALUE FROM application GROUP BY 2
UNION ALL
SELECT 2, CAST(RATIO_CATEGORY AS VARCHAR), NULL, count(*), {DEFAULT_RATE}, round(avg(r), 2)
FROM (SELECT *, {RATIO} AS r, ntile(5) OVER (ORDER BY {RATIO} NULLS FIRST, SK_ID_CURR) AS RATIO_CATEGORY
      FROM application) t GROUP BY RATIO_CATEGORY
UNION ALL
SELECT 3, NAME_INCOME_TYPE, NULL, count(*), {DEFAULT_RATE}, round(avg(AMT_INCOME_TOTAL), 0)
FROM application GROUP BY NAME_INCOME_TYPE HAVING count(*) > 100
UNION ALL
SELECT 4, {EMPLOYMENT_LENGTH}, NULL, count(*), {DEFAULT_RATE}, NULL FROM application GROUP BY 2
UNION ALL
SELECT 5, {ENQUIRY_GROUP}, NULL, count(*), {DEFAULT_RATE}, NULL FROM application GROUP BY 2
UNION ALL
SELECT 6, NAME_CONTRACT_TYPE, {_OWNERSHIP}, count(*), {DEFAULT_RATE}, round(avg(AMT_CREDIT), 0)
FROM application GROUP BY NAME_CONTRACT_TYPE, FLAG_OWN_REALTY
UNION ALL
SELECT 7, NAME_FAMILY_STATUS, CAST(CNT_CHILDREN AS VARCHAR), count(*), {DEFAULT_RATE}, NULL
FROM application GROUP BY NAME_FAMILY_STATUS, CNT_CHILDREN HAVING count(*) > 50
UNION ALL
SELECT 8, WEEKDAY_APPR_PROCESS_START, NULL, count(*), {DEFAULT_RATE}, round(avg(AMT_CREDIT), 0)
FROM application GROUP BY WEEKDAY_APPR_PROCESS_START"""))

oracle("g10_filter_options", with_app("""
SELECT list_sort(list_distinct(list(NAME_FAMILY_STATUS) FILTER (WHERE NAME_FAMILY_STATUS IS NOT NULL)))
         AS family_status_options,
       list_sort(list_distinct(list(NAME_INCOME_TYPE) FILTER (WHERE NAME_INCOME_TYPE IS NOT NULL)))
         AS income_type_options
FROM application"""))

_STATUSES = ["Civil marriage", "Married", "Separated", "Single / not married", "Unknown", "Widow"]
oracle("g11_heatmap", with_app(
    "SELECT CNT_CHILDREN, " + ", ".join(
        f"max(CASE WHEN st = '{s}' THEN DEFAULT_RATE END) AS \"{s}\"" for s in _STATUSES) + f"""
FROM (SELECT CNT_CHILDREN, coalesce(NAME_FAMILY_STATUS, 'Unknown') AS st, {DEFAULT_RATE} AS DEFAULT_RATE
      FROM application GROUP BY CNT_CHILDREN, NAME_FAMILY_STATUS HAVING count(*) > 50) g
GROUP BY CNT_CHILDREN"""))

oracle("g12_kpis", with_app(f"""
SELECT count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE, round(avg(AMT_CREDIT), 0) AS AVG_CREDIT,
       round(avg(AMT_INCOME_TOTAL), 0) AS AVG_INCOME, round(sum(AMT_CREDIT), 0) AS TOTAL_CREDIT
FROM application"""))

# --- A ------------------------------------------------------------------------
oracle("a1_count", with_app("SELECT NAME_HOUSING_TYPE, count(*) AS CLIENT_COUNT FROM application GROUP BY 1"))
oracle("a2_default_rate", with_app(f"SELECT CODE_GENDER, {DEFAULT_RATE} AS DEFAULT_RATE FROM application GROUP BY 1"))
oracle("a3_rounded_mean", with_app("""
SELECT NAME_EDUCATION_TYPE, round(avg(AMT_ANNUITY), 0) AS AVG_ANNUITY, round(avg(EXT_SOURCE_2), 2) AS AVG_EXT_SOURCE_2
FROM application GROUP BY 1"""))

# --- F ------------------------------------------------------------------------
def _g1_where(cond: str) -> str:
    return with_app(f"""
SELECT {AGE_GROUP} AS AGE_GROUP, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application WHERE {cond} GROUP BY 1""")


oracle("f1_min_credit", _g1_where("AMT_CREDIT >= 100000.0"))
oracle("f2_max_credit", _g1_where("AMT_CREDIT <= 250000.0"))
oracle("f3_min_income", _g1_where("AMT_INCOME_TOTAL >= 30000.0"))
oracle("f4_family_status", _g1_where("NAME_FAMILY_STATUS IN ('Married', 'Widow')"))
oracle("f5_income_type", _g1_where("NAME_INCOME_TYPE IN ('Working', 'Pensioner', 'Student')"))
oracle("f6_realty_yes", _g1_where("FLAG_OWN_REALTY = 'Y'"))
oracle("f6_realty_no", _g1_where("FLAG_OWN_REALTY = 'N'"))
oracle("f7_all_filters", with_app(f"""
SELECT {ENQUIRY_GROUP} AS ENQUIRY_GROUP, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application
WHERE AMT_CREDIT >= 50000.0 AND AMT_CREDIT <= 400000.0 AND AMT_INCOME_TOTAL >= 10000.0
  AND NAME_FAMILY_STATUS IN ('Married', 'Single / not married', 'Civil marriage')
  AND NAME_INCOME_TYPE IN ('Working', 'Commercial associate', 'Pensioner') AND FLAG_OWN_REALTY = 'Y'
GROUP BY 1"""))
oracle("f8_having_income_type", with_app(f"""
SELECT NAME_INCOME_TYPE, count(*) AS CLIENT_COUNT, round(avg(AMT_INCOME_TOTAL), 0) AS AVG_INCOME,
       {DEFAULT_RATE} AS DEFAULT_RATE
FROM application WHERE AMT_INCOME_TOTAL >= 30000.0 GROUP BY NAME_INCOME_TYPE HAVING count(*) > 100"""))
oracle("f9_having_family_children", with_app(f"""
SELECT NAME_FAMILY_STATUS, CNT_CHILDREN, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application WHERE AMT_CREDIT <= 250000.0 GROUP BY NAME_FAMILY_STATUS, CNT_CHILDREN HAVING count(*) > 50"""))
REQUESTED = "SELECT DISTINCT l_partkey * 10 AS SK_ID_CURR FROM lineitem"
oracle("f10_lookup", with_app(f"""
SELECT SK_ID_CURR, AMT_CREDIT, NAME_INCOME_TYPE FROM application
WHERE SK_ID_CURR IN ({REQUESTED})"""))
oracle("f11_non_null_options", with_app(
    "SELECT DISTINCT NAME_FAMILY_STATUS FROM application WHERE NAME_FAMILY_STATUS IS NOT NULL"))
oracle("f12_missing_client", with_app(f"""
SELECT r.SK_ID_CURR, 'Client ID ' || CAST(r.SK_ID_CURR AS VARCHAR) || ' non trouvé dans les données' AS error
FROM ({REQUESTED}) r WHERE r.SK_ID_CURR NOT IN (SELECT SK_ID_CURR FROM application)"""))

# --- P ------------------------------------------------------------------------
def _p(col_sql: str, name: str) -> str:
    return with_app(f"SELECT SK_ID_CURR, {col_sql} AS {name} FROM application")


oracle("p1_age", _p("-DAYS_BIRTH / 365.25::DOUBLE", "AGE"))
oracle("p2_age_group", _p(AGE_GROUP, "AGE_GROUP"))
oracle("p3_ratio", _p(RATIO, "CREDIT_INCOME_RATIO"))
oracle("p4_years_employed", _p(YEARS_EMPLOYED, "YEARS_EMPLOYED"))
oracle("p5_employment_length", _p(EMPLOYMENT_LENGTH, "EMPLOYMENT_LENGTH"))
oracle("p6_total_enquiries", _p(TOTAL_ENQUIRIES, "TOTAL_ENQUIRIES"))
oracle("p7_enquiry_group", _p(ENQUIRY_GROUP, "ENQUIRY_GROUP"))
oracle("p8_ownership_label", _p(_OWNERSHIP, "OWNERSHIP_LABEL"))
oracle("p9_weekday_order", _p(WEEKDAY_ORDER, "WEEKDAY_ORDER"))
oracle("p10_default_flag", _p(DEFAULT_FLAG, "DEFAULT_FLAG"))
oracle("p11_rounding", with_app(
    "SELECT SK_ID_CURR, round(AMT_ANNUITY, 0) AS ROUND0, round(EXT_SOURCE_2 * 100, 2) AS ROUND2 FROM application"))


# --- P12-P28 ------------------------------------------------------------------
oracle("p12_numeric_repair", with_app(
    "SELECT SK_ID_CURR, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_COLS) + " FROM application"))
oracle("p13_categorical_repair", with_app(
    "SELECT SK_ID_CURR, " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in CATEGORICAL_COLS)
    + " FROM application"))
oracle("p14_flag_encoding", with_app(
    "SELECT SK_ID_CURR, " + ", ".join(
        f"CASE WHEN {c} IN ('Y', '1') THEN 1 ELSE 0 END AS {c}" for c in FLAG_COLS)
    + " FROM application"))

CLIENT_AGE = "-CAST(trunc(DAYS_BIRTH / 365.25::DOUBLE) AS INT)"
CLIENT_YEARS = ("CASE WHEN DAYS_EMPLOYED IS NULL OR DAYS_EMPLOYED = 365243 THEN 0.0::DOUBLE "
                "ELSE -DAYS_EMPLOYED / 365.25::DOUBLE END")
CLIENT_INFO = f"""SELECT SK_ID_CURR AS client_id, coalesce(CODE_GENDER, 'Unknown') AS gender,
  {CLIENT_AGE} AS age, CAST(CNT_CHILDREN AS INT) AS children_count,
  CAST(AMT_INCOME_TOTAL AS DOUBLE) AS income, CAST(AMT_CREDIT AS DOUBLE) AS credit_amount,
  coalesce(NAME_INCOME_TYPE, 'Unknown') AS income_type, coalesce(NAME_EDUCATION_TYPE, 'Unknown') AS education_type,
  coalesce(NAME_FAMILY_STATUS, 'Unknown') AS family_status, coalesce(NAME_HOUSING_TYPE, 'Unknown') AS housing_type,
  {CLIENT_YEARS} AS years_employed
FROM application"""


def _tr(field: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in C.TRANSLATIONS[field].items())
    return f"CASE {field} {whens} ELSE {field} END"


oracle("p16_client_age", with_app(f"SELECT SK_ID_CURR, {CLIENT_AGE} AS CLIENT_AGE FROM application"))
oracle("p17_client_years_employed", with_app(f"SELECT SK_ID_CURR, {CLIENT_YEARS} AS YEARS_EMPLOYED FROM application"))
oracle("p18_nested_response", with_app(CLIENT_INFO.replace("\nFROM application", """,
  EXT_SOURCE_2 AS risk_score, CASE WHEN EXT_SOURCE_2 > 0.5 THEN 1 ELSE 0 END AS predicted_default
FROM application""")))
# Python's round(): printf rounds the exact binary value half-even, as Python does.
def py_round(x: str, places: int) -> str:
    return f"CAST(printf('%.{places}f', {x}) AS DOUBLE)"


oracle("p19_years_display", with_app(f"""
SELECT client_id,
       {py_round("CASE WHEN years_employed > 100 THEN fmod(years_employed, 100) ELSE years_employed END", 1)}
  AS years_employed FROM ({CLIENT_INFO}) i"""))
oracle("p20_amounts", with_app(f"""
SELECT client_id, age, CAST({py_round("income", 0)} AS BIGINT) AS income,
       CAST({py_round("credit_amount", 0)} AS BIGINT) AS credit_amount FROM ({CLIENT_INFO}) i"""))
oracle("p21_labels", with_app(f"""
SELECT client_id, {", ".join(f"{_tr(f)} AS {f}" for f in C.TRANSLATIONS)} FROM ({CLIENT_INFO}) i"""))


def _rec_field(name: str, score: str) -> str:
    def val(band):
        v = C.RECOMMENDATIONS[band][name]
        return "[" + ", ".join(_q(x) for x in v) + "]" if isinstance(v, list) else _q(v)
    return (f"CASE WHEN {score} IS NULL THEN NULL WHEN {score} >= {C.REFUSE_FROM} THEN {val('refuse')} "
            f"WHEN {score} >= {C.CONDITIONAL_FROM} THEN {val('conditional')} ELSE {val('accept')} END")


_REC_FIELDS = ["decision", "explanation", "alternative", "risk_level", "action_plan"]

oracle("p22_recommendation", with_app(
    "SELECT SK_ID_CURR, " + ", ".join(
        f"{_rec_field(name, 'EXT_SOURCE_2')} AS {name}" for name in _REC_FIELDS)
    + " FROM application"))

FEEDBACK_SQL = """
SELECT event_id,
       coalesce(CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END, 'Message vide') AS message,
       coalesce(CASE WHEN event_type = 'error' THEN false WHEN event_type = 'view' THEN NULL ELSE true END, true)
         AS is_positive,
       CASE WHEN coalesce(CASE WHEN event_type = 'error' THEN false WHEN event_type = 'view' THEN NULL
                          ELSE true END, true) THEN 'INFO' ELSE 'ERROR' END AS level,
       json_extract_string(props, '$.k') AS dim_k,
       CAST(coalesce(json_array_length(json_keys(props)), 0) AS INT) AS n_dims
FROM events"""
oracle("p23_feedback_defaults", FEEDBACK_SQL)
oracle("p24_risk_level", with_app("""
SELECT SK_ID_CURR, CASE WHEN EXT_SOURCE_2 IS NULL THEN NULL WHEN EXT_SOURCE_2 < 0.4 THEN 'Risque Faible'
  WHEN EXT_SOURCE_2 < 0.7 THEN 'Risque Moyen' ELSE 'Risque Élevé' END AS RISK_TAG FROM application"""))
oracle("p25_score_percent", with_app(
    "SELECT SK_ID_CURR, printf('%.1f%%', EXT_SOURCE_2 * 100) AS SCORE_TEXT FROM application"))
# Python's round(x, 2): printf rounds the exact binary value half-even, as Python does.
oracle("p26_display_ratio", with_app(f"""
SELECT client_id, CAST(printf('%.2f', CAST({py_round("credit_amount", 0)} AS BIGINT)
                        / nullif(CAST({py_round("income", 0)} AS BIGINT), 0)) AS DOUBLE) AS RATIO
FROM ({CLIENT_INFO}) i"""))
oracle("p27_stamps", """
SELECT o_orderkey AS SK_ID_CURR, strftime(o_orderdate, '%d/%m/%Y') AS analysis_date,
       strftime(o_orderdate, '%H:%M') AS analysis_time, '1.2.3' AS version,
       'Régression logistique' AS model_type, 'Historique clients 2020-2024' AS data_source
FROM orders""")
oracle("p28_amount_label", with_app(
    f"SELECT SK_ID_CURR, CAST(CAST({py_round('AMT_CREDIT', 0)} AS BIGINT) AS VARCHAR) || ' €' AS AMOUNT_LABEL "
    "FROM application"))

# --- O ------------------------------------------------------------------------
oracle("o1_label_order", with_app(f"""
SELECT {EMPLOYMENT_LENGTH} AS EMPLOYMENT_LENGTH, count(*) AS CLIENT_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE
FROM application WHERE FLAG_OWN_REALTY = 'Y' GROUP BY 1 ORDER BY 1"""))
oracle("o2_weekday_order", with_app(f"""
SELECT WEEKDAY_APPR_PROCESS_START, count(*) AS APPLICATION_COUNT, {DEFAULT_RATE} AS DEFAULT_RATE,
       round(avg(AMT_CREDIT), 0) AS AVG_CREDIT, {WEEKDAY_ORDER} AS WEEKDAY_ORDER
FROM application WHERE AMT_CREDIT >= 100000.0 GROUP BY WEEKDAY_APPR_PROCESS_START ORDER BY WEEKDAY_ORDER"""))
oracle("o3_sorted_options", with_app("""
SELECT list_sort(list_distinct(list(NAME_FAMILY_STATUS) FILTER (WHERE NAME_FAMILY_STATUS IS NOT NULL)))
         AS family_status_options,
       list_sort(list_distinct(list(NAME_INCOME_TYPE) FILTER (WHERE NAME_INCOME_TYPE IS NOT NULL)))
         AS income_type_options
FROM application WHERE AMT_CREDIT <= 250000.0"""))
oracle("o4_first_row", with_app("""
SELECT CUST_ID, SK_ID_CURR, AMT_CREDIT, NAME_CONTRACT_TYPE FROM (
  SELECT *, row_number() OVER (PARTITION BY CUST_ID ORDER BY SK_ID_CURR) AS rn FROM application) t
WHERE rn = 1"""))

# --- S ------------------------------------------------------------------------
oracle("s1_read_portfolio", with_app("SELECT " + ", ".join(f.name for f in application_schema(True).fields) + " FROM application"))
oracle("s2_read_scoring", with_app("SELECT " + ", ".join(f.name for f in application_schema(False).fields) + " FROM application"))
oracle("s3_keep_hot", ORACLE_SQL["g4_employment"])
PROFILES_SQL = f"""
SELECT PROFILE_KEY, SK_CURR_ID, LastName, FirstName, PhotoURL FROM (
  SELECT *, row_number() OVER (PARTITION BY PROFILE_KEY
                               ORDER BY prio, LastName, FirstName, PhotoURL NULLS FIRST, SK_CURR_ID) AS rn
  FROM (SELECT SK_CURR_ID_INT AS PROFILE_KEY, 0 AS prio, CAST(SK_CURR_ID_INT AS VARCHAR) AS SK_CURR_ID,
               LastName, FirstName, PhotoURL FROM users WHERE SK_CURR_ID_INT IS NOT NULL
        UNION ALL
        SELECT TRY_CAST(SK_CURR_ID_STR AS BIGINT), 1, SK_CURR_ID_STR, LastName, FirstName, PhotoURL
        FROM users WHERE CAST(TRY_CAST(SK_CURR_ID_STR AS BIGINT) AS VARCHAR) = SK_CURR_ID_STR) u) r
WHERE rn = 1"""
oracle("s6_profiles", f"WITH users AS ({USERS_SQL}) {PROFILES_SQL}")
oracle("s7_feedback_stream", FEEDBACK_SQL)
oracle("s8_export", ORACLE_SQL["g6_contract_realty"])

# --- J ------------------------------------------------------------------------
oracle("j1_client_card", with_app(f"""
SELECT a.SK_ID_CURR, a.CUST_ID, p.SK_CURR_ID, p.LastName, p.FirstName, p.PhotoURL
FROM application a JOIN ({PROFILES_SQL}) p ON a.CUST_ID = p.PROFILE_KEY""", f"users AS ({USERS_SQL})"))
oracle("j2_missing_card", with_app(f"""
SELECT SK_ID_CURR, 'Impossible de récupérer les informations complètes pour le client ID : '
       || CAST(SK_ID_CURR AS VARCHAR) || '. Veuillez vérifier l''identifiant et que l''API est bien lancée.' AS error
FROM application a WHERE NOT EXISTS (SELECT 1 FROM ({PROFILES_SQL}) p WHERE p.PROFILE_KEY = a.CUST_ID)""",
    f"users AS ({USERS_SQL})"))

oracle("w1_ntile_distributed", ORACLE_SQL["w1_ntile"])
oracle("g2_credit_income_distributed", ORACLE_SQL["g2_credit_income"])
oracle("s7_feedback_json_stream", FEEDBACK_SQL)
oracle("j1_client_card_salted", ORACLE_SQL["j1_client_card"])
oracle("j1_client_card_plain", ORACLE_SQL["j1_client_card"])

oracle("p23_feedback_bodies", """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'Message vide' WHEN 3 THEN 'Message vide' WHEN 5 THEN 'm' || event_id WHEN 6 THEN 'Message vide' END AS message,
  CASE WHEN event_id % 8 IN (0, 5) THEN true WHEN event_id % 8 IN (3, 4, 6) THEN false END AS is_positive,
  CASE WHEN event_id % 8 IN (0, 5) THEN 'INFO' WHEN event_id % 8 IN (3, 4, 6) THEN 'ERROR' END AS level,
  CASE WHEN event_id % 8 = 6 THEN CAST(event_id AS VARCHAR) END AS dim_k, event_id % 8 IN (1, 2, 7) AS rejected
FROM events""")

oracle("s7_feedback_outcomes", """
SELECT message, is_positive, level, dim_k, body, count(*) AS bodies FROM (
  SELECT CASE event_id % 8 WHEN 0 THEN 'Message vide' WHEN 3 THEN 'Message vide' WHEN 5 THEN 'm' || event_id WHEN 6 THEN 'Message vide' END AS message,
    CASE WHEN event_id % 8 IN (0, 5) THEN true WHEN event_id % 8 IN (3, 4, 6) THEN false END AS is_positive,
    CASE WHEN event_id % 8 IN (0, 5) THEN 'INFO' WHEN event_id % 8 IN (3, 4, 6) THEN 'ERROR' END AS level,
    CASE WHEN event_id % 8 = 6 THEN CAST(event_id AS VARCHAR) END AS dim_k, CASE event_id % 8 WHEN 1 THEN 'not json' WHEN 2 THEN '' WHEN 7 THEN '[1]' END AS body
  FROM events) b GROUP BY ALL""")

_PREPROCESSED = ("SELECT SK_ID_CURR, " + ", ".join(
    [f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_COLS] + [f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in CATEGORICAL_COLS]
    + [f"CASE WHEN {c} IN ('Y', '1') THEN 1 ELSE 0 END AS {c}" for c in FLAG_COLS])
    + ", CASE WHEN EXT_SOURCE_2 > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, TARGET FROM application")
oracle("m4_fallback_score", with_app(f"""
SELECT SK_ID_CURR, prediction, CASE WHEN prediction > 0 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS risk_score FROM ({_PREPROCESSED}) p"""))
oracle("p15_profile_projection", with_app(f"""
SELECT {", ".join(PROFILE_COLS)} FROM (SELECT *, EXT_SOURCE_2 AS risk_score FROM ({_PREPROCESSED}) p) q"""))
oracle("p12_numeric_repair_text", with_app("""
SELECT SK_ID_CURR, CASE SK_ID_CURR % 5 WHEN 0 THEN CAST(trunc(AMT_CREDIT) AS DOUBLE) WHEN 3 THEN -150.0::DOUBLE END AS AMT_CREDIT FROM application"""))
_STATISTICS = (
    [f"SELECT 'mean' AS kind, '{c}' AS \"column\", CAST(NULL AS VARCHAR) AS label, round(avg({c}), 6) AS value FROM p" for c in NUMERIC_COLS]
    + [f"SELECT 'rank', '{c}', {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) FROM p GROUP BY {c}" for c in CATEGORICAL_COLS]
    + [f"SELECT 'spread', '{c}', NULL, round(coalesce(stddev_samp(coalesce({c}, (SELECT avg({c}) FROM p))), 0), 4) FROM p" for c in NUMERIC_COLS])
_TRAINING = f"p AS (SELECT * FROM ({_PREPROCESSED}) x WHERE TARGET IS NOT NULL)"
oracle("m6_fitted_statistics", with_app(" UNION ALL ".join(_STATISTICS), _TRAINING))
# The optimum's first-order condition: no slot has a slope.
oracle("m6_fit_gradient", with_app(" UNION ALL ".join(
    ["SELECT CAST(NULL AS VARCHAR) AS \"column\", CAST(NULL AS VARCHAR) AS label, CAST(0 AS DOUBLE) AS gradient"] + [f"SELECT '{c}', NULL, 0" for c in (*NUMERIC_COLS, *FLAG_COLS)]
    + [f"SELECT DISTINCT '{c}', {c}, 0 FROM p" for c in CATEGORICAL_COLS]), _TRAINING))

# --- the published model --------------------------------------------------------
_READY = f"ready AS (SELECT *, CAST(CNT_CHILDREN AS INT) AS children FROM ({_PREPROCESSED}) x)"
_SCORES = scores_sql(published(), "ready")
oracle("m1_prepare", with_app(features_sql(published(), "ready"), _READY))
oracle("s4_load_preprocessor", ORACLE_SQL["m1_prepare"])
oracle("m2_classify", with_app(
    f"SELECT SK_ID_CURR, prediction, round(1 - risk_score, 9) AS probability_0, round(risk_score, 9) AS probability_1 FROM ({_SCORES}) s", _READY))
oracle("m3_risk_score", with_app(f"SELECT SK_ID_CURR, round(risk_score, 9) AS risk_score, prediction FROM ({_SCORES}) s", _READY))
oracle("s5_load_classifier", with_app(f"SELECT SK_ID_CURR, round(risk_score, 9) AS risk_score FROM ({_SCORES}) s", _READY))
oracle("m4_fallback_model", with_app(
    f"SELECT SK_ID_CURR, prediction, CASE WHEN prediction > 0 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS risk_score FROM ({_SCORES}) s", _READY))
_RESPONSE = f"""SELECT i.client_id, {", ".join(f"{_tr(f)} AS {f}" for f in C.TRANSLATIONS)}, age, children_count,
  CAST({py_round("income", 0)} AS BIGINT) AS income, CAST({py_round("credit_amount", 0)} AS BIGINT) AS credit_amount,
  {py_round("CASE WHEN years_employed > 100 THEN fmod(years_employed, 100) ELSE years_employed END", 1)} AS years_employed,
  round(risk_score, 9) AS risk_score, CAST(s.prediction AS INT) AS predicted_default, {", ".join(f"{_rec_field(name, 'risk_score')} AS {name}" for name in _REC_FIELDS)},
  CASE WHEN risk_score < {C.RISK_TAGS[0][0]} THEN '{C.RISK_TAGS[0][1]}' WHEN risk_score < {C.RISK_TAGS[1][0]} THEN '{C.RISK_TAGS[1][1]}' ELSE '{C.RISK_TAG_LAST}' END AS risk_tag,
  printf('%.1f%%', risk_score * 100) AS score_text, '15/01/2024' AS analysis_date, '10:30' AS analysis_time, '{C.STAMP_VERSION}' AS version,
  '{C.STAMP_MODEL_TYPE}' AS model_type, '{C.STAMP_DATA_SOURCE}' AS data_source{{more}}
FROM ({CLIENT_INFO}) i JOIN ({_SCORES}) s ON s.SK_ID_CURR = i.client_id"""
oracle("m5_batch_score", with_app(_RESPONSE.format(more=""), _READY))
oracle("m5_client_card", with_app(f"""
SELECT r.*, p.SK_CURR_ID, p.LastName, p.FirstName, p.PhotoURL FROM ({_RESPONSE.format(more=", a.CUST_ID")} JOIN application a ON a.SK_ID_CURR = i.client_id) r
JOIN ({PROFILES_SQL}) p ON r.CUST_ID = p.PROFILE_KEY""", f"users AS ({USERS_SQL}), {_READY}"))
