"""The fitted pipeline of Spark ML stages as plain numbers (``RiskParameters``).

Applying the ``PipelineModel`` and ``LogisticRegressionModel`` runs each
stage (imputer, indexer, one-hot encoder, assembler, scaler, classifier) as
a separate row-level transformer that builds vectors. For a linear model the
same probability is a plain expression over the raw columns:

    margin = intercept + sum_k w_k * impute(x_k) + sum_c weight_c[value_c] + sum_f w_f * flag_f
    probability = 1 / (1 + exp(-margin))

Parameters are read from the fitted stages (a few hundred numbers); no data
passes through the driver.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import (ImputerModel, OneHotEncoderModel, StandardScalerModel, StringIndexerModel,
                                VectorAssembler)
from pyspark.sql import Column

from riskspark.plans.parameters import Category, Flag, Number, RiskParameters


class NotCompilable(ValueError):
    """The model is not of the one shape whose expression is known; apply its fitted stages."""


def _stages(model):
    """The stages by class, if the pipeline is exactly the supported one: its stages, their order, wiring and parameters."""
    stages, clf = list(model.preprocessor.stages), model.classifier
    shape = [ImputerModel, StringIndexerModel, OneHotEncoderModel, VectorAssembler, StandardScalerModel]
    if [type(s) for s in stages] not in (shape, shape[:4]):
        raise NotCompilable(f"stages {[type(s).__name__ for s in stages]}")
    imputer, indexer, encoder, assembler = stages[:4]
    features, scaler = assembler.getOutputCol(), stages[4] if len(stages) == 5 else None
    last = scaler.getOutputCol() if scaler is not None else features
    checks = {
        "classifier": type(clf) is LogisticRegressionModel and clf.numClasses == 2 and clf.getFeaturesCol() == last,
        "imputer": math.isnan(imputer.getMissingValue()) and bool(imputer.getInputCols()),
        "indexer": indexer.getHandleInvalid() == "keep" and bool(indexer.getInputCols()),
        "encoder": encoder.getHandleInvalid() == "keep" and list(encoder.getInputCols()) == list(indexer.getOutputCols()),
        "scaler": scaler is None or (not scaler.getWithMean() and scaler.getInputCol() == features),
        "names": not {*imputer.getOutputCols(), *indexer.getOutputCols(), *encoder.getOutputCols()} & {*imputer.getInputCols(), *indexer.getInputCols()},
    }
    wrong = [k for k, ok in checks.items() if not ok]
    if wrong:
        raise NotCompilable(f"unsupported: {wrong}")
    return dict(zip(shape, stages))


def parameters_of(model) -> RiskParameters:
    """The numbers of the fitted pipeline and classifier."""
    st = _stages(model)
    imputer, indexer, encoder = st[ImputerModel], st[StringIndexerModel], st[OneHotEncoderModel]
    assembler, scaler = st[VectorAssembler], st.get(StandardScalerModel)
    clf = model.classifier

    surrogate_row = imputer.surrogateDF.first()
    imputed_to_input = dict(zip(imputer.getOutputCols(), imputer.getInputCols()))
    indexed_to_input = dict(zip(indexer.getOutputCols(), indexer.getInputCols()))
    labels = dict(zip(indexer.getOutputCols(), indexer.labelsArray))
    encoded_to_indexed = dict(zip(encoder.getOutputCols(), encoder.getInputCols()))
    sizes = dict(zip(encoder.getInputCols(), encoder.categorySizes))
    keep, drop_last = encoder.getHandleInvalid() == "keep", encoder.getDropLast()

    coef = clf.coefficients.toArray()
    std = scaler.std.toArray() if scaler is not None and scaler.getWithStd() else None

    def scale(pos: int) -> float:
        if std is None:
            return 1.0
        return 0.0 if std[pos] == 0 else 1 / float(std[pos])

    numbers, categories, flags = [], [], []
    pos = 0
    for col in assembler.getInputCols():
        if col in imputed_to_input:
            src = imputed_to_input[col]
            numbers.append(Number(src, float(surrogate_row[src]), scale(pos), float(coef[pos])))
            pos += 1
        elif col in encoded_to_indexed:
            idx_col = encoded_to_indexed[col]
            names = labels[idx_col]
            width = sizes[idx_col] + (1 if keep else 0) - (1 if drop_last else 0)
            if len(names) < width and scale(pos + len(names)) * coef[pos + len(names)] != 0:
                raise NotCompilable(f"{col} gives labels that it has not seen a weight")
            listed = range(min(len(names), width))
            categories.append(Category(indexed_to_input[idx_col], tuple(names[i] for i in listed), tuple(scale(pos + i) for i in listed), tuple(float(coef[pos + i]) for i in listed)))
            pos += width
        else:
            flags.append(Flag(col, scale(pos), float(coef[pos])))
            pos += 1
    if pos != len(coef):
        raise NotCompilable(f"feature layout mismatch: {pos} slots for {len(coef)} coefficients")
    return RiskParameters(tuple(numbers), tuple(categories), tuple(flags), float(clf.intercept), clf.getThreshold())


def score_columns(model) -> tuple[Column, Column]:
    """``(probability of class 1, prediction)`` as expressions over the preprocessed columns."""
    return (model if isinstance(model, RiskParameters) else parameters_of(model)).score_columns()
