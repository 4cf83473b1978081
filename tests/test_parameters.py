"""The model as plain numbers: Newton fit, portable file, SQL export, sparse features."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL, app_rows
from riskspark.operators.preprocess import preprocess
from riskspark.plans import newton
from riskspark.plans.parameters import Category, DamagedModel, Flag, Number, RiskParameters, feature_rows, published
from riskspark.plans.scoring import classify, fit, fit_pipeline, prepare, risk_score, score, score_clients
from riskspark.session import scratch_path
from riskspark.sources.cache import materialize
from riskspark.sources.fixtures import application


@pytest.fixture(scope="module")
def apps(spark):
    return materialize(application(spark, SF_SMALL), "parameter-tests")


@pytest.fixture(scope="module")
def model(apps):
    return fit(apps)


def test_fit_equals_the_pipeline_at_its_optimum(apps, model):
    other = RiskParameters.from_model(fit_pipeline(apps, max_iter=2000, tol=1e-14))
    mine, theirs = model.slots(), other.slots()
    assert [x[:3] for x in mine] == [x[:3] for x in theirs]  # the same slots in the same order
    assert max(abs(a[3] - b[3]) for a, b in zip(mine, theirs)) < 1e-9
    assert max(abs(a[4] - b[4]) for a, b in zip(mine, theirs)) < 1e-6
    assert abs(model.intercept - other.intercept) < 5e-6  # the pipeline's search gives up there; the slopes below are ours


def test_no_slot_has_a_slope_at_the_fit(apps, model):
    slopes = [r.gradient for r in newton.gradient(apps, model).collect()]
    assert len(slopes) > 60 and max(map(abs, slopes)) < 1e-9
    moved = model.with_weights([w + 0.01 for *_, w in model.slots()], model.intercept)
    assert max(abs(r.gradient) for r in newton.gradient(apps, moved).collect()) > 1e-5


def test_statistics_equal_numpy(apps):
    train = newton.training_rows(apps)
    table = train.toPandas()
    got = {(r.feature, r.label): r for r in newton.statistics(train).collect()}
    for c in ("AMT_CREDIT", "EXT_SOURCE_1", "FLAG_OWN_CAR", "label"):
        x = table[c].astype(float).dropna().to_numpy()
        r = got[c, None]
        assert r.n == len(x) and r.mean == pytest.approx(x.mean(), rel=1e-12) and r.moment == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-9)
    assert {k[1]: r.n for k, r in got.items() if k[0] == "CODE_GENDER"} == table.CODE_GENDER.value_counts().to_dict()


def test_fit_of_few_odd_rows(spark):
    rows = [{"SK_ID_CURR": i, "TARGET": t, "AMT_CREDIT": float(i * i), "EXT_SOURCE_1": float("nan") if i % 2 else None, "CODE_GENDER": "F" if i % 3 else None}
            for i, t in enumerate([1, 0, 0, 1, None, 0, 1, 1])]
    found = fit(app_rows(spark, rows))
    numbers = {n.column: n for n in found.numbers}
    assert numbers["EXT_SOURCE_1"] == Number("EXT_SOURCE_1", 0.0, 0.0, 0.0)  # nothing known: the slot stays empty
    assert numbers["AMT_CREDIT"].fill == pytest.approx(np.mean([i * i for i in (0, 1, 2, 3, 5, 6, 7)]))
    gender = next(c for c in found.categories if c.column == "CODE_GENDER")
    assert gender.labels == ("F", "Unknown")  # 4 and 3 of 7
    assert all(math.isfinite(w) for *_, w in found.slots())
    for targets in ([1, 1, 1], [None, None], []):
        with pytest.raises(ValueError):
            fit(app_rows(spark, [{"SK_ID_CURR": i, "TARGET": t, "CODE_GENDER": "F"} for i, t in enumerate(targets)]))


def test_file_round_trip_and_damage(spark, model):
    path = scratch_path(spark, "parameters")
    model.save(path, spark)
    assert RiskParameters.load(path, spark) == model
    text = model.to_text()
    file = json.loads(text)
    file["model"]["intercept"] += 1e-9
    for bad in (json.dumps(file), text[:-40], "", "[]", "{}", text.replace('"version": 1', '"version": 2'), json.dumps({**json.loads(text), "format": "other"})):
        with pytest.raises(DamagedModel):
            RiskParameters.from_text(bad)
    spark.createDataFrame([(json.dumps(file),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    with pytest.raises(DamagedModel):
        RiskParameters.load(path, spark)


def test_published_model_is_whole():
    assert published() == RiskParameters.from_text(published().to_text())
    assert len(published().slots()) < 100 and published().rounded(6) == published()


def test_all_paths_give_one_score(spark, apps, model):
    odd = apps.limit(60).withColumns({"CODE_GENDER": F.lit("Z"), "NAME_INCOME_TYPE": F.lit(None).cast("string"), "EXT_SOURCE_1": F.lit(float("nan")),
                                      "AMT_CREDIT": F.lit(None).cast("double"), "FLAG_OWN_CAR": F.lit(None).cast("string")})
    for frame in (apps, odd):
        direct = {r.SK_ID_CURR: (r.risk_score, r.prediction) for r in score(frame, model).collect()}
        staged = classify(prepare(frame, model), model)
        dense = {r.SK_ID_CURR: (r.s, r.prediction) for r in staged.select("SK_ID_CURR", "prediction", risk_score(staged).alias("s")).collect()}
        weights = {slot: w for slot, _, _, _, w in model.slots()}
        margins = dict.fromkeys(direct, model.intercept)
        for r in feature_rows(preprocess(frame), model).collect():
            margins[r.SK_ID_CURR] += r.value * weights[r.slot]
        for k, (s, p) in direct.items():
            assert dense[k] == (pytest.approx(s, abs=1e-12), p)
            assert 1 / (1 + math.exp(-margins[k])) == pytest.approx(s, abs=1e-12)


def test_labels_that_are_not_listed_fill_no_slot(spark):
    small = RiskParameters((Number("AMT_CREDIT", 2.0, 0.5, 1.0),), (Category("CODE_GENDER", ("F", "it's"), (1.0, 2.0), (0.25, -1.0)),), (Flag("FLAG_OWN_CAR", 4.0, 0.5),), -1.0)
    rows = [(1, None, "F", "Y"), (2, 4.0, "it's", "N"), (3, 0.0, None, None)]
    frame = spark.createDataFrame(rows, "SK_ID_CURR long, AMT_CREDIT double, CODE_GENDER string, FLAG_OWN_CAR string")
    sparse = {}
    for r in feature_rows(preprocess(frame), small).collect():
        sparse.setdefault(r.SK_ID_CURR, {})[r.slot] = r.value
    assert sparse == {1: {0: 1.0, 1: 1.0, 3: 4.0}, 2: {0: 2.0, 2: 2.0}}
    want = {1: -1 + 1 + 0.25 + 2, 2: -1 + 2 - 2, 3: -1}
    assert {r.SK_ID_CURR: r.risk_score for r in score(frame, small).collect()} == {k: pytest.approx(1 / (1 + math.exp(-m))) for k, m in want.items()}


def test_sql_export_of_quoted_labels(spark):
    import duckdb

    from riskspark.plans.sql_export import features_sql, scores_sql
    small = RiskParameters((Number("a", 2.0, 0.5, 1.0),), (Category("c", ("x", "it's"), (1.0, 2.0), (0.25, -1.0)),), (Flag("f", 4.0, 0.5),), -1.0, threshold=0.6)
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (1, NULL::DOUBLE, 'x', 1), (2, 4.0, 'it''s', 0), (3, 'nan'::DOUBLE, 'new', 1)) v(k, a, c, f)")
    got = {k: (m, s, p) for k, m, s, p in con.sql(scores_sql(small, "t", "k")).fetchall()}
    assert {k: m for k, (m, _, _) in got.items()} == {1: 2.25, 2: -1.0, 3: 2.0}
    assert [got[k][2] for k in (1, 2, 3)] == [1.0, 0.0, 1.0] and got[1][1] == pytest.approx(1 / (1 + math.exp(-2.25)))
    assert sorted(con.sql(features_sql(small, "t", "k")).fetchall()) == [(1, 0, 1.0), (1, 1, 1.0), (1, 3, 4.0), (2, 0, 2.0), (2, 2, 2.0), (3, 0, 1.0), (3, 3, 4.0)]


def test_scoring_stays_within_a_compiled_method(spark, apps):
    """The JVM compiles no method above 8,000 bytes of code; the whole response is below without any setting."""
    frame = score_clients(apps.drop("TARGET"), published(), at=F.lit("2024-01-15 10:30:00").cast("timestamp_ntz"))
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000, sizes


def _method_sizes(frame):
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


@pytest.fixture
def written(spark, monkeypatch):
    """The largest generated method of each table that the fit or its check writes, by name."""
    sizes = {}

    def recorded(df, name, **more):
        sizes[name] = max(_method_sizes(df))
        return materialize(df, name, **more)
    monkeypatch.setattr(newton, "materialize", recorded)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # whose plans show no code before they have run
    yield sizes
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_no_pass_of_the_fit_is_too_long_to_compile(spark, written):
    newton.fit(application(spark, SF_SMALL))
    assert written and max(written.values()) < 8000, written


def test_no_pass_of_the_gradient_is_too_long_to_compile(spark, model, written):
    apps = application(spark, SF_SMALL)
    newton.gradient(apps, model)
    assert written and max(written.values()) < 8000, written
    assert max(_method_sizes(feature_rows(preprocess(apps.drop("TARGET")), published()))) < 8000
