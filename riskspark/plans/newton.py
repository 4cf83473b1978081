"""M6: the risk model from one pass of sufficient statistics and a few Newton steps.

1. **Statistics.** The training rows are written once, so that no later pass repeats the joins behind
   them. One aggregate of all numbers and flags gives the count, mean and central moment of each,
   one of the rows unrolled to (feature, label) the count of each label. Fills, label ranks and
   scales of all slots follow from these few hundred rows.
2. **Encoding.** The rows become a narrow table in the shared folder: numbers, one small code a
   category, the flags and the target. It is the only thing that the steps read.
3. **Newton steps.** A step is one pass: each task adds up the gradient, the Hessian (a few thousand
   numbers) and the loss of its rows with numpy, Spark sums them cell by cell, and the driver
   solves one small system. The ridge term makes it definite, so one-hot slots may be complete.
   A step that does not lower the loss is halved.

The objective is that of ``LogisticRegression`` over standardized slots: mean log loss plus
``reg_param / 2`` times the sum of squared weights, the intercept free. The result is its optimum,
where the quasi-Newton fit of the pipeline stops early.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.preprocess import preprocess
from riskspark.plans.parameters import Category, Flag, Number, RiskParameters, code_of, feature_rows
from riskspark.schema import CATEGORICAL_COLS, FLAG_COLS, NUMERIC_COLS
from riskspark.session import ship_package
from riskspark.sources.cache import materialize, release

ROW_GROUP_BYTES = 4 << 20  # of a written table, so that a few files still make a task a core
BLOCK_ROWS = 2048  # of one matrix, so that it stays in the processor's cache


def training_rows(portfolio: DataFrame) -> DataFrame:
    """The preprocessed feature columns that are present, and ``label``, of the rows with a target."""
    have = [c for c in (*NUMERIC_COLS, *CATEGORICAL_COLS, *FLAG_COLS) if c in portfolio.columns]
    return preprocess(portfolio).where(F.col("TARGET").isNotNull()).select(*have, F.col("TARGET").cast("double").alias("label"))


def statistics(train: DataFrame) -> DataFrame:
    """``feature, label, n, mean, moment`` (the sum of squared differences from the mean): of numbers and flags with a null
    label, of each label of a category with its count only; of ``label`` itself as a number."""
    def known(c: str):
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    numbers = [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("string").alias("label"), F.count(known(c)).alias("n"), F.avg(known(c)).alias("mean"),
                        (F.var_pop(known(c)) * F.count(known(c))).alias("moment")) for c in train.columns if c not in CATEGORICAL_COLS]
    out = train.agg(F.array(*numbers).alias("e")).select(F.explode("e").alias("e")).select("e.*")
    labels = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("label")) for c in train.columns if c in CATEGORICAL_COLS]
    if not labels:
        return out
    rows = train.select(F.explode(F.array(*labels)).alias("e")).select("e.*")
    return out.unionByName(rows.groupBy("feature", "label").agg(F.count(F.lit(1)).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("moment")))


def _scale(moment: float, n: int) -> float:
    """One over the standard deviation; 0 for a slot that does not vary."""
    return 1 / math.sqrt(moment / (n - 1)) if n > 1 and moment > 0 else 0.0


def slots_from(stats: list, columns: list[str]) -> tuple[RiskParameters, int, float]:
    """The model without weights, the number of rows and the mean of the target, from the rows of ``statistics``."""
    numbers = {r.feature: r for r in stats if r.label is None}
    if "label" not in numbers or not numbers["label"].n:
        raise ValueError("no row has a target")
    n, target = numbers["label"].n, numbers["label"].mean
    if not 0 < target < 1:
        raise ValueError("the target has one value only")
    labels: dict[str, list[tuple[int, str]]] = {}
    for r in stats:
        if r.label is not None:
            labels.setdefault(r.feature, []).append((-r.n, r.label))
    ranked = {c: [(label, -k) for k, label in sorted(found)] for c, found in labels.items()}
    model = RiskParameters(
        tuple(Number(c, r.mean, _scale(r.moment, n), 0.0) if (r := numbers[c]).n else Number(c, 0.0, 0.0, 0.0) for c in NUMERIC_COLS if c in columns),
        tuple(Category(c, tuple(x for x, _ in ranked[c]), tuple(_scale(k * (n - k) / n, n) for _, k in ranked[c]), (0.0,) * len(ranked[c])) for c in CATEGORICAL_COLS if c in columns),
        tuple(Flag(c, _scale(numbers[c].moment, n), 0.0) for c in FLAG_COLS if c in columns), math.log(target / (1 - target)))
    return model, n, target


def encoded(train: DataFrame, model: RiskParameters) -> DataFrame:
    """``label``, the numbers and the flags as doubles, the categories as codes (0: not listed). Missing numbers are filled where
    they are read: with the fills, the JVM's code for a row gets too long to run fast."""
    return train.select("label", *(F.col(x.column).cast("double").alias(x.column) for x in (*model.numbers, *model.flags)),
                        *(code_of(x).cast("short").alias(x.column) for x in model.categories))


class _Design:
    """The matrix of the slots that vary, with a last row of ones and a column a row, from encoded batches."""

    def __init__(self, model: RiskParameters):
        self.plain, self.coded, used = [], [], []
        slot = 0
        for x in model.numbers:
            self.plain.append((x.column, len(used), x.scale, x.fill))
            used += [slot] if x.scale else []
            slot += 1
        for x in model.categories:
            at = np.full(len(x.labels) + 1, -1)
            for k, s in enumerate(x.scales):
                if s:
                    at[k + 1] = len(used)
                    used.append(slot + k)
            self.coded.append((x.column, at, np.array([0.0, *x.scales])))
            slot += len(x.labels)
        for x in model.flags:
            self.plain.append((x.column, len(used), x.scale, 0.0))
            used += [slot] if x.scale else []
            slot += 1
        self.used, self.slots = used, slot

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((len(self.used) + 1, batch.num_rows))
        for c, at, scale, fill in self.plain:
            if scale:
                x = batch.column(c).to_numpy(zero_copy_only=False)  # null: NaN
                np.multiply(np.where(np.isnan(x), fill, x), scale, out=out[at])
        for c, at, scales in self.coded:
            code = batch.column(c).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(at[code] >= 0)
            out[at[code[rows]], rows] = scales[code[rows]]
        out[-1] = 1.0
        return out


def _sums(design: _Design, beta: np.ndarray):
    """Loss, gradient and upper triangle of the Hessian of a task's rows, as (cell, value)."""
    upper = np.triu_indices(len(beta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, hessian = 0.0, np.zeros(len(beta)), np.zeros((len(beta), len(beta)))
        for batch in (b.slice(at, BLOCK_ROWS) for b in batches for at in range(0, b.num_rows, BLOCK_ROWS)):
            x, y = design.matrix(batch), batch.column("label").to_numpy(zero_copy_only=False)
            margin = beta @ x
            p = 0.5 * (1 + np.tanh(0.5 * margin))
            loss += float((np.logaddexp(0, margin) - y * margin).sum())
            gradient += x @ (p - y)
            hessian += (x * (p * (1 - p))) @ x.T
        values = np.concatenate(([loss], gradient, hessian[upper]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["cell", "value"])
    return run


def _objective(rows: DataFrame, design: _Design, beta: np.ndarray, n: int, ridge: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The objective, its gradient and its Hessian at ``beta``: one pass over ``rows``."""
    d = len(beta)
    got = rows.mapInArrow(_sums(design, beta), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    values = np.zeros(1 + d + d * (d + 1) // 2)
    values[got.column("cell").to_numpy()] = got.column("value").to_numpy()
    values /= n
    hessian = np.zeros((d, d))
    hessian[np.triu_indices(d)] = values[1 + d:]
    hessian += np.triu(hessian, 1).T + np.diag(ridge)
    return float(values[0] + 0.5 * (ridge * beta * beta).sum()), values[1:1 + d] + ridge * beta, hessian


def fit(portfolio: DataFrame, *, max_iter: int = 50, reg_param: float = 0.01, tol: float = 1e-9) -> RiskParameters:
    """M6: the model of the rows with a known target, to a last step below ``tol`` (or after ``max_iter`` passes).

    Jobs run when it is called: the statistics, the encoding and a pass a step. The driver holds the slots' numbers and
    one matrix of slots by slots."""
    ship_package(portfolio.sparkSession)
    train = materialize(training_rows(portfolio), "training", row_group_bytes=ROW_GROUP_BYTES)
    try:
        model, n, _ = slots_from(statistics(train).collect(), train.columns)
        rows = materialize(encoded(train, model), "encoded", row_group_bytes=ROW_GROUP_BYTES)
    finally:
        release(train)
    try:
        design = _Design(model)
        beta = np.zeros(len(design.used) + 1)
        beta[-1] = model.intercept
        ridge = np.append(np.full(len(design.used), reg_param), 0.0)
        loss, gradient, hessian = _objective(rows, design, beta, n, ridge)
        for _ in range(max_iter):
            step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
            if np.abs(step).max() < tol:
                beta = beta - step
                break
            for _ in range(20):
                after = _objective(rows, design, beta - step, n, ridge)
                if after[0] <= loss + 1e-9 * abs(loss):  # the objective is convex: rounding aside, a whole step only overshoots far from the optimum
                    break
                step = step / 2
            beta, (loss, gradient, hessian) = beta - step, after
    finally:
        release(rows)
    weights = np.zeros(design.slots)
    weights[design.used] = beta[:-1]
    return model.with_weights(weights.tolist(), float(beta[-1]))


def gradient(portfolio: DataFrame, model: RiskParameters, reg_param: float = 0.01) -> DataFrame:
    """``slot, gradient``: the slope of the objective in every slot that occurs (-1: the intercept), by one aggregate over the
    sparse features; 0 at the optimum. Jobs run when it is called: the training rows and their residuals are written, so that
    the joins behind them run once and each pass is one that the JVM compiles."""
    train = materialize(training_rows(portfolio), "training", row_group_bytes=ROW_GROUP_BYTES)
    probability, _ = model.score_columns()
    wrong = materialize(train.withColumn("residual", probability - F.col("label")), "residuals", row_group_bytes=ROW_GROUP_BYTES)
    release(train)
    n = wrong.agg(F.count("residual")).first()[0]
    rows = feature_rows(wrong, model, "residual").select("slot", (F.col("value") * F.col("residual")).alias("x"))
    sums = rows.unionByName(wrong.select(F.lit(-1).alias("slot"), F.col("residual").alias("x"))).groupBy("slot").agg((F.sum("x") / n).alias("g"))
    weights = F.create_map(*(F.lit(x) for slot, _, _, _, w in model.slots() for x in (slot, float(w))), F.lit(-1), F.lit(0.0))
    slopes = materialize(sums.select("slot", (F.col("g") + reg_param * F.try_element_at(weights, F.col("slot"))).alias("gradient")), "slopes")
    release(wrong)
    return slopes
