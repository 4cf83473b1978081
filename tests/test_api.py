"""The service facade mirrors the reference's entry points."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from riskspark.api import CreditRiskService, filters_metadata
from riskspark.operators.filters import PortfolioFilters
from riskspark.sources.fixtures import application, users_data


def test_service_end_to_end(spark):
    app = application(spark, SF_SMALL)
    svc = CreditRiskService(portfolio=app, users=users_data(spark, SF_SMALL), profile_key="CUST_ID")
    data, meta = svc.dataviz_from_params({"analysis_type": "4", "realty_status": "Oui",
                                          "family_statuses": '["Married"]'})
    assert meta == {"analysis_type": 4, "filters": {"family_statuses": ["Married"], "realty_status": "Y"}}
    assert set(data.columns) == {"EMPLOYMENT_LENGTH", "CLIENT_COUNT", "DEFAULT_RATE"}
    opts = svc.filter_options().first()
    assert "Married" in opts.family_status_options and None not in opts.family_status_options
    ids = [r[0] for r in app.select("SK_ID_CURR").orderBy("SK_ID_CURR").limit(5).collect()]
    pred = svc.predict(ids)
    assert pred.count() == 5
    assert pred.filter(F.col("prediction.risk_score").between(0, 1)).count() == 5
    both = svc.predict([ids[0], 10**12]).collect()
    answers = {r.client_id: (r.prediction is not None, r.error) for r in both}
    assert answers == {ids[0]: (True, None), 10**12: (False, f"Client ID {10**12} non trouvé dans les données")}
    assert svc.dataviz_from_params({"analysis_type": "first", "min_credit": "much"})[1] == {"analysis_type": 1, "filters": {}}
    cards = svc.cards(ids)
    assert cards.count() <= 5 and "LastName" in cards.columns
    missing = svc.unknown_clients(spark.createDataFrame([(ids[0],), (10**12,)], "id long"))
    assert [r.SK_ID_CURR for r in missing.collect()] == [10**12]
    assert svc.cards_missing().count() + svc.cards().count() == app.count()


def test_filters_metadata_like_reference():
    assert filters_metadata(PortfolioFilters(realty_status="Tous", family_statuses=[])) == {}
    assert filters_metadata(PortfolioFilters(min_income=1.0, realty_status="Non")) == \
        {"min_income": 1.0, "realty_status": "N"}


def test_feedback_entry_point(spark, tmp_path):
    from riskspark.session import scratch_path
    base = scratch_path(spark, "api-feedback")
    spark.createDataFrame([('{"message": "x", "is_positive": false}',), ("{}",)], "value string") \
        .write.text(f"{base}/bodies")
    q = CreditRiskService.feedback(spark, f"{base}/bodies", f"{base}/sink", f"{base}/ckpt")
    q.awaitTermination()
    levels = sorted(r.level for r in spark.read.parquet(f"{base}/sink").collect())
    assert levels == ["ERROR", "INFO"]
