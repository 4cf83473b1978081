"""Fit, save / load, batch scoring."""

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from riskspark.plans.scoring import RiskModel, fit_pipeline, score, score_clients
from riskspark.session import scratch_path
from riskspark.sources.fixtures import application


@pytest.fixture(scope="module")
def model(spark):
    return fit_pipeline(application(spark, SF_SMALL), max_iter=20)


def test_scores_are_probabilities(spark, model):
    s = score(application(spark, SF_SMALL).drop("TARGET"), model)
    lo, hi, n = s.agg(F.min("risk_score"), F.max("risk_score"), F.count("risk_score")).first()
    assert 0.0 <= lo <= hi <= 1.0
    assert n == application(spark, SF_SMALL).count()


def test_save_load_gives_equal_scores(spark, model):
    path = scratch_path(spark, "model-test")
    model.save(path)
    again = RiskModel.load(path)
    apps = application(spark, SF_SMALL).drop("TARGET")
    a = {r.SK_ID_CURR: r.risk_score for r in score(apps, model).select("SK_ID_CURR", "risk_score").collect()}
    b = {r.SK_ID_CURR: r.risk_score for r in score(apps, again).select("SK_ID_CURR", "risk_score").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_unseen_category_and_nulls(spark, model):
    apps = application(spark, SF_SMALL).drop("TARGET").limit(3)
    odd = apps.withColumn("CODE_GENDER", F.lit("Z")).withColumn("EXT_SOURCE_1", F.lit(None).cast("double")) \
        .withColumn("NAME_INCOME_TYPE", F.lit(None).cast("string"))
    assert score(odd, model).filter(F.col("risk_score").isNull()).count() == 0


def test_batch_equals_single_id(spark, model):
    apps = application(spark, SF_SMALL).drop("TARGET")
    one_id = apps.select("SK_ID_CURR").orderBy("SK_ID_CURR").first()[0]
    batch = score_clients(apps, model).filter(F.col("client_id") == one_id).first()
    single = score_clients(apps, model, ids=one_id).first()
    assert batch.prediction.risk_score == pytest.approx(single.prediction.risk_score)
    assert batch.recommendation.decision == single.recommendation.decision


def test_fallback_without_probability(spark, model):
    from riskspark.plans.scoring import classify, prepare, risk_score
    no_prob = classify(prepare(application(spark, SF_SMALL).drop("TARGET"), model), model).drop("probability")
    vals = {r[0] for r in no_prob.select(risk_score(no_prob)).distinct().collect()}
    assert vals <= {0.25, 0.75}


def test_dedupe_keeps_one_row_per_id(spark, model):
    apps = application(spark, SF_SMALL).drop("TARGET")
    doubled = apps.unionByName(apps.withColumn("AMT_CREDIT", F.col("AMT_CREDIT") + 1))
    out = score_clients(doubled, model, dedupe=True)
    assert out.count() == apps.count()
    assert out.select("client_id").distinct().count() == apps.count()
    # ties on the id are broken by the rest of the row: the lower credit wins, every time
    from riskspark.plans.scoring import first_per_key
    firsts = first_per_key(doubled.select("SK_ID_CURR", "AMT_CREDIT"), "SK_ID_CURR", "SK_ID_CURR")
    base = {r.SK_ID_CURR: r.AMT_CREDIT for r in apps.select("SK_ID_CURR", "AMT_CREDIT").collect()}
    assert all(base[r.SK_ID_CURR] == r.AMT_CREDIT for r in firsts.collect())


def test_compiled_scores_equal_pipeline(spark, model):
    apps = application(spark, SF_SMALL).drop("TARGET")
    odd = apps.limit(40).withColumn("CODE_GENDER", F.lit("Z")) \
        .withColumn("NAME_INCOME_TYPE", F.lit(None).cast("string")) \
        .withColumn("EXT_SOURCE_1", F.lit(float("nan")))
    for df in (apps, odd):
        a = score(df, model, compiled=False).select("SK_ID_CURR", F.col("risk_score").alias("a"),
                                                   F.col("prediction").alias("pa"))
        b = score(df, model, compiled=True).select("SK_ID_CURR", F.col("risk_score").alias("b"),
                                                  F.col("prediction").alias("pb"))
        j = a.join(b, "SK_ID_CURR")
        assert j.count() == df.count()
        assert j.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-12
        assert j.filter(F.col("pa") != F.col("pb")).count() == 0


def test_compiled_plan_is_one_codegen_projection(spark, model):
    from riskspark.sources.cache import materialize
    apps = materialize(application(spark, SF_SMALL).drop("TARGET"), "compiled-plan")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")   # print whole expressions
    try:
        plan = score(apps, model)._jdf.queryExecution().executedPlan().toString()
        pipeline = score(apps, model, compiled=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "UDF(" not in plan and "Exchange" not in plan       # no ML transformer, no shuffle
    assert "UDF(" in pipeline                                 # the stage-by-stage path, for contrast


def _fitted(df, change):
    """The default pipeline with its stages changed, fitted on ``df``, and a classifier over it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    from riskspark.operators.preprocess import preprocess
    from riskspark.plans.scoring import preprocessor_pipeline
    train = preprocess(df).filter(F.col("TARGET").isNotNull()).withColumn("label", F.col("TARGET").cast("double"))
    stages = change(preprocessor_pipeline(train).getStages())
    pre = Pipeline(stages=stages).fit(train)
    clf = LogisticRegression(featuresCol=stages[-1].getOutputCol(), maxIter=5, regParam=0.1).fit(pre.transform(train))
    return RiskModel(pre, clf)


def _extra_stage(stages):
    from pyspark.ml.feature import MinMaxScaler
    return [*stages, MinMaxScaler(inputCol="features", outputCol="ranged")]


def _other_missing(stages):
    return [stages[0].setMissingValue(0.0), *stages[1:]]


def _skip(stages):
    return [stages[0], stages[1].setHandleInvalid("skip"), stages[2].setHandleInvalid("keep"), *stages[3:]]


@pytest.mark.parametrize("change", [_extra_stage, _other_missing, _skip])
def test_foreign_pipelines_are_applied_stage_by_stage(spark, change):
    from riskspark.plans.compiled import NotCompilable, score_columns
    apps = application(spark, SF_SMALL)
    other = _fitted(apps, change)
    with pytest.raises(NotCompilable):
        score_columns(other)
    a = {r.SK_ID_CURR: r.risk_score for r in score(apps, other).select("SK_ID_CURR", "risk_score").collect()}
    b = {r.SK_ID_CURR: r.risk_score for r in score(apps, other, compiled=False).select("SK_ID_CURR", "risk_score").collect()}
    assert a == b and a
