"""Boundary units of the column functions (P1-P28) and filters."""

import pytest
from pyspark.sql import functions as F

from paths import app_rows
from riskspark.functions import client as C
from riskspark.functions import portfolio as P
from riskspark.operators.filters import PortfolioFilters


def _one(df, col):
    return [r[0] for r in df.select(col).orderBy("SK_ID_CURR").collect()]


def test_age_group_boundaries(spark):
    # -DAYS_BIRTH / 365.25 exactly at 25, 35, 45, 55 years, plus a null birth date.
    days = [-int(25 * 365.25), -int(25 * 365.25) - 1, int(-35 * 365.25), int(-45 * 365.25), int(-55 * 365.25), None]
    df = app_rows(spark, [{"SK_ID_CURR": i, "DAYS_BIRTH": d} for i, d in enumerate(days)])
    got = _one(df, P.age_group())
    assert got[0] == "< 25 ans"            # 9131 / 365.25 = 24.99...
    assert got[1] == "25-35 ans"           # 9132 / 365.25 = 25.002
    assert got[2] == "25-35 ans"           # 12783.75 -> 12783 days -> 34.99
    assert got[-1] == "> 55 ans"           # null falls to the last group
    with_null = _one(df, P.age_group(null_label="Inconnu"))
    assert with_null[-1] == "Inconnu"


def test_employment_length_sentinel_and_null(spark):
    days = [365243, None, -365, -366, int(-3 * 365.25) - 1, int(-10 * 365.25) - 1]
    df = app_rows(spark, [{"SK_ID_CURR": i, "DAYS_EMPLOYED": d} for i, d in enumerate(days)])
    assert _one(df, P.employment_length()) == ["< 1 an", "> 10 ans", "< 1 an", "1-3 ans", "3-5 ans", "> 10 ans"]
    assert _one(df, C.client_years_employed())[:2] == [0.0, 0.0]


def test_enquiry_groups(spark):
    rows = [{"SK_ID_CURR": 0}, {"SK_ID_CURR": 1, "AMT_REQ_CREDIT_BUREAU_DAY": 2.0},
            {"SK_ID_CURR": 2, "AMT_REQ_CREDIT_BUREAU_DAY": 2.0, "AMT_REQ_CREDIT_BUREAU_YEAR": 3.0},
            {"SK_ID_CURR": 3, "AMT_REQ_CREDIT_BUREAU_YEAR": 6.0}]
    df = app_rows(spark, rows)
    assert _one(df, P.enquiry_group()) == ["Aucune demande", "1-2 demandes", "3-5 demandes", "> 5 demandes"]


def test_ratio_zero_and_null_income(spark):
    rows = [{"SK_ID_CURR": 0, "AMT_CREDIT": 100.0, "AMT_INCOME_TOTAL": 0.0},
            {"SK_ID_CURR": 1, "AMT_CREDIT": 100.0},
            {"SK_ID_CURR": 2, "AMT_CREDIT": 100.0, "AMT_INCOME_TOTAL": 3.0}]
    assert _one(app_rows(spark, rows), P.credit_income_ratio()) == [None, None, 33.33]


def test_weekday_order(spark):
    rows = [{"SK_ID_CURR": i, "WEEKDAY_APPR_PROCESS_START": d}
            for i, d in enumerate(["monday", "SUNDAY", None, "HOLIDAY"])]
    assert _one(app_rows(spark, rows), P.weekday_order()) == [0, 6, 0, None]


def test_ownership_and_default_flag(spark):
    rows = [{"SK_ID_CURR": 0, "FLAG_OWN_REALTY": "Y", "TARGET": 1},
            {"SK_ID_CURR": 1, "FLAG_OWN_REALTY": "N", "TARGET": 0},
            {"SK_ID_CURR": 2, "FLAG_OWN_REALTY": "X"}]
    df = app_rows(spark, rows)
    assert _one(df, P.ownership_label()) == ["Propriétaire", "Non propriétaire", "X"]
    assert _one(df, P.default_flag()) == [1, 0, 0]


@pytest.mark.parametrize("score,decision,tag", [
    (0.0, "Acceptation recommandée", "Risque Faible"),
    (0.3999, "Acceptation recommandée", "Risque Faible"),
    (0.40, "Acceptation conditionnelle", "Risque Moyen"),
    (0.6999, "Acceptation conditionnelle", "Risque Moyen"),
    (0.70, "Refus recommandé", "Risque Élevé"),
    (None, None, None),
])
def test_score_bands(spark, score, decision, tag):
    df = spark.createDataFrame([(score,)], "s double")
    row = df.select(C.recommendation("s").alias("r"), C.risk_tag("s").alias("t")).first()
    assert (row.r.decision if row.r else None) == decision
    assert row.t == tag
    if score is not None:
        assert len(row.r.action_plan) == 4


def test_display_helpers(spark):
    df = spark.createDataFrame([(0.4256, 123456.5, 2.5, 150.25, 12.34)],
                               "s double, credit double, half double, years double, small double")
    r = df.select(C.score_percent_text("s").alias("pct"), C.whole_amount("credit").alias("w"),
                  C.whole_amount("half").alias("h"), C.years_employed_display("years").alias("y"),
                  C.amount_label(C.whole_amount("credit")).alias("lab")).first()
    assert r.pct == "42.6%"
    tie = spark.createDataFrame([(0.0625,)], "s double").select(C.score_percent_text("s")).first()[0]
    assert tie == f"{0.0625 * 100:.1f}%" == "6.2%"          # half-even on the exact value, as Python
    assert r.w == 123456 and r.h == 2           # half-even, as Python round()
    assert r.y == round(150.25 % 100, 1) == 50.2   # > 100 wraps modulo 100; Python rounding
    assert r.lab == "123456 €"


def test_translations_keep_unmapped(spark):
    df = spark.createDataFrame([("M",), ("Unknown",)], "g string")
    assert [x[0] for x in df.select(C.translate("gender", "g")).collect()] == ["Homme", "Unknown"]


def test_stamps_fixed_time(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-05 07:08:09' AS t")
    r = df.select(C.result_stamps(F.col("t")).alias("m")).first().m
    assert (r.analysis_date, r.analysis_time, r.version) == ("05/03/2024", "07:08", "1.2.3")


def test_filters(spark):
    rows = [{"SK_ID_CURR": 0, "AMT_CREDIT": 100.0, "AMT_INCOME_TOTAL": 10.0, "FLAG_OWN_REALTY": "Y",
             "NAME_FAMILY_STATUS": "Married", "NAME_INCOME_TYPE": "Working"},
            {"SK_ID_CURR": 1, "AMT_CREDIT": 200.0, "AMT_INCOME_TOTAL": 20.0, "FLAG_OWN_REALTY": "N",
             "NAME_FAMILY_STATUS": "Widow", "NAME_INCOME_TYPE": "Pensioner"},
            {"SK_ID_CURR": 2, "FLAG_OWN_REALTY": "X"}]
    df = app_rows(spark, rows)

    def ids(f):
        return sorted(r[0] for r in f.apply(df).select("SK_ID_CURR").collect())

    assert ids(PortfolioFilters()) == [0, 1, 2]
    assert ids(PortfolioFilters(min_credit=150)) == [1]          # null credit dropped
    assert ids(PortfolioFilters(max_credit=100)) == [0]
    assert ids(PortfolioFilters(min_income=15)) == [1]
    assert ids(PortfolioFilters(family_statuses=[])) == [0, 1, 2]   # empty list = off
    assert ids(PortfolioFilters(family_statuses=["Widow"])) == [1]
    assert ids(PortfolioFilters(income_types=["Working"])) == [0]
    assert ids(PortfolioFilters(realty_status="Tous")) == [0, 1, 2]
    assert ids(PortfolioFilters(realty_status="Oui")) == [0]
    assert ids(PortfolioFilters(realty_status="Non")) == [1]
    assert ids(PortfolioFilters(realty_status="anything")) == [1]
    many = ["Widow"] + [f"s{i}" for i in range(2000)]
    f = PortfolioFilters(family_statuses=many)
    assert ids(f) == [1] and f.predicate() is not None
    assert f.apply(df).columns == df.columns and [r.SK_ID_CURR for r in df.filter(f.predicate()).collect()] == [1]
    assert PortfolioFilters.from_params({"min_credit": "many", "max_credit": "5"}) == PortfolioFilters(max_credit=5.0)


def test_filters_from_request_params(spark):
    f = PortfolioFilters.from_params({"min_credit": "100.5", "max_credit": "", "family_statuses": '["Widow"]',
                                      "income_types": None, "realty_status": "Oui"})
    assert f == PortfolioFilters(min_credit=100.5, family_statuses=["Widow"], realty_status="Oui")
    from riskspark.plans.analyses import analysis_from_params
    rows = [{"SK_ID_CURR": 0, "AMT_CREDIT": 200.0, "NAME_INCOME_TYPE": "Working", "TARGET": 1},
            {"SK_ID_CURR": 1, "AMT_CREDIT": 50.0, "NAME_INCOME_TYPE": "Working", "TARGET": 0}]
    out = analysis_from_params(app_rows(spark, rows), {"analysis_type": "3", "min_credit": "100"})
    # one client left, below the HAVING limit of G3
    assert out.count() == 0


def test_lookup_forms(spark):
    from riskspark.operators.filters import lookup_ids, missing_ids
    df = spark.range(5000).withColumnRenamed("id", "SK_ID_CURR")
    assert lookup_ids(df, 7).count() == 1
    assert lookup_ids(df, [1, 2, 99999]).count() == 2
    assert lookup_ids(df, list(range(0, 10000, 2))).count() == 2500       # broadcast path
    ids = spark.createDataFrame([(1,), (1,), (6000,)], "x long")
    assert lookup_ids(df, ids).count() == 1                                 # no duplicates
    assert [r.SK_ID_CURR for r in missing_ids(ids, df).collect()] == [6000]


def test_python_round_matches_python(spark):
    pairs = [(224593, 200), (9, 8), (247673, 40), (571089, 111432), (77079, 200), (1, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(C.displayed_ratio("a", "b")).collect()]
    assert got == [round(a / b, 2) for a, b in pairs]
    assert spark.createDataFrame([(1, 0)], "a long, b long").select(C.displayed_ratio("a", "b")).first()[0] is None
