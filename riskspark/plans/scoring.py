"""Default model: fit (M6), save / load (S4, S5) and batch scoring (M1-M5).

The reference scores one client per request with a loaded ``PipelineModel``
and ``LogisticRegressionModel`` and a Python UDF for the probability. Here a
model is either such a pair (``RiskModel``) or the same linear model as plain
numbers (``RiskParameters``: what ``fit`` gives, and the published set), and
scores a whole table in one lazy plan; the probability of class 1 is read
with ``vector_to_array`` (JVM side, no UDF).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import client as C
from riskspark.operators.filters import lookup_ids
from riskspark.operators.preprocess import preprocess
from riskspark.plans.newton import fit
from riskspark.plans.parameters import RiskParameters, scores_of
from riskspark.schema import CATEGORICAL_COLS, FLAG_COLS, NUMERIC_COLS
from riskspark.sources.cache import materialize, release

__all__ = ["RiskModel", "RiskParameters", "classify", "first_per_key", "fit", "fit_pipeline", "flatten_response", "load_classifier",
           "load_preprocessor", "nested_response", "prepare", "risk_score", "score", "score_clients"]

# Fallback scores when the model exposes no probability (M4).
FALLBACK_POSITIVE = 0.75
FALLBACK_NEGATIVE = 0.25


@dataclass(frozen=True)
class RiskModel:
    """The fitted preprocessor (features) and classifier (probability, prediction)."""

    preprocessor: PipelineModel
    classifier: LogisticRegressionModel

    def save(self, path: str) -> None:
        """S4 / S5 counterpart: write both models under ``path``."""
        self.preprocessor.write().overwrite().save(f"{path}/preprocessor")
        self.classifier.write().overwrite().save(f"{path}/classifier")

    @staticmethod
    def load(path: str) -> "RiskModel":
        return RiskModel(load_preprocessor(f"{path}/preprocessor"), load_classifier(f"{path}/classifier"))


def load_preprocessor(path: str) -> PipelineModel:
    """Load the fitted preprocessor."""
    return PipelineModel.load(path)


def load_classifier(path: str) -> LogisticRegressionModel:
    """Load the fitted logistic classifier."""
    return LogisticRegressionModel.load(path)


def _feature_columns(df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    cols = set(df.columns)
    return ([c for c in NUMERIC_COLS if c in cols], [c for c in CATEGORICAL_COLS if c in cols],
            [c for c in FLAG_COLS if c in cols])


def preprocessor_pipeline(df: DataFrame) -> Pipeline:
    """Stages of the preprocessor: impute, index, one-hot, assemble, scale."""
    numeric, categorical, flags = _feature_columns(df)
    imputed = [f"{c}__imp" for c in numeric]
    indexed = [f"{c}__idx" for c in categorical]
    encoded = [f"{c}__ohe" for c in categorical]
    return Pipeline(stages=[
        Imputer(inputCols=numeric, outputCols=imputed, strategy="mean"),
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=imputed + encoded + flags, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True),
    ])


def fit_pipeline(portfolio: DataFrame, *, max_iter: int = 50, reg_param: float = 0.01, tol: float = 1e-6) -> RiskModel:
    """M6 with Spark ML's stages: preprocessor and classifier of the rows with a known target.

    ``newton.fit`` gives the same model as plain numbers in a few passes. Here every stage fits with distributed aggregates (means, category counts,
    column statistics, gradient sums); logistic regression persists its own
    training instances while it iterates.
    """
    numeric, categorical, flags = _feature_columns(portfolio)
    train = preprocess(portfolio).filter(F.col("TARGET").isNotNull()) \
        .select(*numeric, *categorical, *flags, F.col("TARGET").cast("double").alias("label"))
    # Each stage fit is a pass over the input: the pruned training rows are written once to
    # the shared folder, so no pass repeats the joins that built them.
    train = materialize(train, "training")
    try:
        pre = preprocessor_pipeline(train).fit(train)
        lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, tol=tol,
                                regParam=reg_param, elasticNetParam=0.0)
        return RiskModel(pre, lr.fit(pre.transform(train)))
    finally:
        release(train)


def prepare(applications: DataFrame, model: RiskModel | RiskParameters) -> DataFrame:
    """M1: P12-P14 then the fitted preprocessor: ``features`` is a vector, or an array for ``RiskParameters``."""
    if isinstance(model, RiskParameters):
        return preprocess(applications).withColumn("features", model.features())
    return model.preprocessor.transform(preprocess(applications))


def classify(prepared: DataFrame, model: RiskModel | RiskParameters) -> DataFrame:
    """M2: the logistic classifier adds ``rawPrediction``, ``probability`` (vectors, or arrays), ``prediction``."""
    if isinstance(model, RiskParameters):
        margin = model.margin_of(F.col("features"))
        probability, prediction = scores_of(F.col("rawPrediction")[1], model.threshold)
        return prepared.withColumn("rawPrediction", F.array(-margin, margin)).withColumns(
            {"probability": F.array(1 - probability, probability), "prediction": prediction})
    return model.classifier.transform(prepared)


def risk_score(predicted: DataFrame) -> Column:
    """M3 / M4: probability of class 1, or the fixed fallback when there is no probability."""
    if "probability" in predicted.columns:
        p = F.col("probability")
        return (p if predicted.schema["probability"].dataType.typeName() == "array" else vector_to_array(p)).getItem(1)
    return F.when(F.col("prediction") > 0, F.lit(FALLBACK_POSITIVE)).otherwise(F.lit(FALLBACK_NEGATIVE))


def score(applications: DataFrame, model: RiskModel | RiskParameters, *, compiled: bool = True) -> DataFrame:
    """M1-M3: applications with ``risk_score`` and ``prediction``.

    ``compiled`` (default) evaluates the fitted linear pipeline as one built-in
    expression (``plans.compiled``): the same probabilities (to ~1e-16), in a
    single codegen stage instead of six vector-building transformers. A model of any
    other shape, and any model with ``compiled=False``, is applied stage by stage; without
    a probability column its score is the fixed fallback (M4).
    """
    if compiled:
        from riskspark.plans.compiled import NotCompilable, score_columns
        try:
            probability, prediction = score_columns(model)
        except NotCompilable:
            pass
        else:
            return preprocess(applications).withColumn("prediction", prediction) \
                .withColumn("risk_score", probability)
    predicted = classify(prepare(applications, model), model)
    return predicted.withColumn("risk_score", risk_score(predicted))


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per ``key``, the one with the smallest ``order`` (then the smallest row).

    An aggregate (partial on the map side), not a window: a key holding a
    third of the table is reduced before the shuffle instead of being sorted
    in one task.
    """
    others = [c for c in df.columns if c != key]
    # Ties on ``order`` are broken by the rest of the row, so the pick is defined.
    row = F.struct(F.col(order).alias("_order"), *[F.col(c) for c in others])
    picked = df.groupBy(key).agg(F.min(row).alias("_row"))
    return picked.select(key, *[F.col("_row")[c].alias(c) for c in others])


def score_clients(applications: DataFrame, model: RiskModel | RiskParameters, ids=None, *,
                  at: Column | None = None, dedupe: bool = False,
                  carry: list[str] | None = None, compiled: bool = True) -> DataFrame:
    """M5: batch client response.

    ``ids`` (int, list or DataFrame) restricts the table (F10); ``dedupe``
    keeps the first row per id (O4) when the source may repeat ids. Output:
    ``client_id``, ``client_info`` (P16-P21 formatted), ``prediction``
    (risk score, predicted default), ``recommendation`` (P22), ``risk_tag``
    (P24), ``score_text`` (P25), ``metadata`` (P27), plus the ``carry``
    columns of the input (e.g. a profile key), so no join back is needed.
    """
    apps = applications if ids is None else lookup_ids(applications, ids)
    if dedupe:
        apps = first_per_key(apps, "SK_ID_CURR", "SK_ID_CURR")
    extra = list(carry or [])
    return nested_response(score(apps, model, compiled=compiled), extra).select(
        *extra,
        "client_id",
        C.formatted_client_info("client_info").alias("client_info"),
        "prediction",
        C.recommendation(F.col("prediction.risk_score")).alias("recommendation"),
        C.risk_tag(F.col("prediction.risk_score")).alias("risk_tag"),
        C.score_percent_text(F.col("prediction.risk_score")).alias("score_text"),
        C.result_stamps(at).alias("metadata"),
    )


def nested_response(scored: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``client_id``, ``client_info`` and ``prediction`` of a scored, preprocessed table."""
    return scored.select(
        *(carry or []),
        F.col("SK_ID_CURR").alias("client_id"),
        C.client_info().alias("client_info"),
        F.struct(F.col("risk_score").cast("double").alias("risk_score"),
                 F.col("prediction").cast("int").alias("predicted_default")).alias("prediction"),
    )


def flatten_response(resp: DataFrame) -> DataFrame:
    """The client response with one column per leaf."""
    nested = {"client_id", "client_info", "prediction", "recommendation", "risk_tag", "score_text", "metadata"}
    extra = [c for c in resp.columns if c not in nested]
    return resp.select(
        *extra, "client_id", "client_info.*", "prediction.*",
        "recommendation.*", "risk_tag", "score_text", "metadata.*",
    )
