"""Properties of the analyses on the driver's data."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from riskspark.operators.filters import PortfolioFilters
from riskspark.plans import analyses as G
from riskspark.plans.report import portfolio_report
from riskspark.sources.fixtures import application


def test_group_counts_sum_to_filtered_total(spark):
    app = application(spark, SF_SMALL)
    f = PortfolioFilters(min_credit=50000.0, realty_status="Oui")
    total = f.apply(app).count()
    for fn, col in [(G.by_age, "CLIENT_COUNT"), (G.by_credit_income_quintile, "COUNT"),
                    (G.by_employment_length, "CLIENT_COUNT"), (G.by_enquiries, "CLIENT_COUNT"),
                    (G.by_contract_and_realty, "CLIENT_COUNT"), (G.by_weekday, "APPLICATION_COUNT")]:
        res = fn(app, f)
        assert res.agg(F.sum(col)).first()[0] == total, fn.__name__
        assert res.filter((F.col("DEFAULT_RATE") < 0) | (F.col("DEFAULT_RATE") > 100)).count() == 0


def test_filters_commute(spark):
    app = application(spark, SF_SMALL)
    a = PortfolioFilters(min_credit=50000.0).apply(PortfolioFilters(income_types=["Working"]).apply(app))
    b = PortfolioFilters(min_credit=50000.0, income_types=["Working"]).apply(app)
    assert sorted(a.select("SK_ID_CURR").collect()) == sorted(b.select("SK_ID_CURR").collect())


def test_report_equals_individual_analyses(spark):
    app = application(spark, SF_SMALL)
    rep = portfolio_report(app)
    g1 = {(r.AGE_GROUP, r.CLIENT_COUNT, r.DEFAULT_RATE) for r in G.by_age(app).collect()}
    r1 = {(r.KEY1, r.CLIENT_COUNT, r.DEFAULT_RATE) for r in rep.filter("ANALYSIS = 1").collect()}
    assert g1 == r1
    g7 = {(r.NAME_FAMILY_STATUS, str(r.CNT_CHILDREN), r.CLIENT_COUNT)
          for r in G.by_family_and_children(app).collect()}
    r7 = {(r.KEY1, r.KEY2, r.CLIENT_COUNT) for r in rep.filter("ANALYSIS = 7").collect()}
    assert g7 == r7
    assert {r.ANALYSIS for r in rep.select("ANALYSIS").distinct().collect()} <= set(range(1, 9))


def test_unknown_analysis_number_is_an_error(spark):
    import pytest
    with pytest.raises(ValueError):
        G.analysis(application(spark, SF_SMALL), 9)


def test_null_label_gives_nulls_their_own_group(spark):
    app = application(spark, SF_SMALL)
    default = {r.AGE_GROUP: r.CLIENT_COUNT for r in G.by_age(app).collect()}
    split = {r.AGE_GROUP: r.CLIENT_COUNT for r in G.by_age(app, null_label="Inconnu").collect()}
    nulls = app.filter(F.col("DAYS_BIRTH").isNull()).count()
    assert nulls > 0 and split["Inconnu"] == nulls
    assert default.get("> 55 ans", 0) == split.get("> 55 ans", 0) + nulls
    emp = {r.EMPLOYMENT_LENGTH: r.CLIENT_COUNT for r in G.by_employment_length(app, null_label="Inconnu").collect()}
    assert emp.get("Inconnu", 0) == app.filter(F.col("DAYS_EMPLOYED").isNull()).count()


def test_orders_of_labels_and_weekdays(spark):
    """O1, O2: the rows come in the order of the labels and of the week."""
    app = application(spark, SF_SMALL)
    labels = [r.EMPLOYMENT_LENGTH for r in G.by_employment_length(app).collect()]
    assert labels == sorted(labels) and len(labels) == 5
    days = [r.WEEKDAY_APPR_PROCESS_START for r in G.by_weekday(app).collect()]
    assert days == ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]


def test_heat_map_keeps_every_rate(spark):
    """A real status ``Unknown`` and a null one have columns of their own."""
    g7 = spark.createDataFrame([(0, "Unknown", 1.5), (0, None, 2.5), (0, "Widow", 3.5), (1, None, 4.5)],
                               "CNT_CHILDREN int, NAME_FAMILY_STATUS string, DEFAULT_RATE double")
    got = {r.CNT_CHILDREN: r.asDict() for r in G.family_children_matrix(g7, ["Unknown", "Widow"]).collect()}
    assert (got[0]["Unknown"], got[0]["Unknown (null)"], got[0]["Widow"], got[1]["Unknown (null)"]) == (1.5, 2.5, 3.5, 4.5)
    assert G.family_children_matrix(g7).columns == ["CNT_CHILDREN", "Unknown", "Unknown (null)", "Widow"]
