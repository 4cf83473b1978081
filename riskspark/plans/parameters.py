"""The linear risk model as plain numbers: one portable file, Spark expressions, sparse features and SQL.

A model is a list of slots. A number fills its slot with ``value * scale`` (its mean where it is
missing), a label of a category and a flag fill theirs with ``scale``; every other slot is 0. The
margin is the intercept plus the sum of slot times weight, the score its logistic function.

``save`` writes one text file with a format version and a checksum of all it holds, through Spark,
so that any store will do; ``load`` refuses a file whose version it does not know or whose checksum
does not match. ``published()`` is the parameter set that comes with the library.

Scoring is dictionary-encoded: a label becomes its place in a literal array and the place picks the
weight from another, so that the generated code does not grow with the labels and a whole scoring
projection stays one compiled method.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass, replace
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMAT, VERSION = "riskspark-linear", 1


class DamagedModel(ValueError):
    """The file is no model of a known version, or not the one that was written."""


@dataclass(frozen=True)
class Number:
    """A number's slot. A scale of 0 leaves the slot empty."""

    column: str
    fill: float
    scale: float
    weight: float


@dataclass(frozen=True)
class Category:
    """The slots of a category, one for each label; a label that is not listed fills none."""

    column: str
    labels: tuple[str, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]


@dataclass(frozen=True)
class Flag:
    """The slot of a 0/1 flag."""

    column: str
    scale: float
    weight: float


@dataclass(frozen=True)
class RiskParameters:
    """A fitted model; slots are numbered through ``numbers``, the labels of ``categories``, then ``flags``."""

    numbers: tuple[Number, ...]
    categories: tuple[Category, ...]
    flags: tuple[Flag, ...]
    intercept: float
    threshold: float = 0.5

    # --- slots ---------------------------------------------------------------
    def slots(self) -> list[tuple[int, str, str | None, float, float]]:
        """(slot, column, label, scale, weight) of every slot, in order."""
        out = [(n.column, None, n.scale, n.weight) for n in self.numbers]
        out += [(c.column, *x) for c in self.categories for x in zip(c.labels, c.scales, c.weights)]
        out += [(f.column, None, f.scale, f.weight) for f in self.flags]
        return [(i, *x) for i, x in enumerate(out)]

    def slot_table(self, spark: SparkSession) -> DataFrame:
        """The slot dictionary: ``slot, column, label, scale, weight``; slot -1 is the intercept."""
        rows = [(-1, None, None, 1.0, float(self.intercept)), *self.slots()]
        return spark.createDataFrame(rows, "slot int, column string, label string, scale double, weight double")

    def with_weights(self, weights: list[float], intercept: float) -> "RiskParameters":
        """The same slots with other weights."""
        if len(weights) != len(self.slots()):
            raise ValueError(f"{len(weights)} weights for {len(self.slots())} slots")
        left = iter(map(float, weights))
        return replace(self, numbers=tuple(replace(n, weight=next(left)) for n in self.numbers),
                       categories=tuple(replace(c, weights=tuple(next(left) for _ in c.labels)) for c in self.categories),
                       flags=tuple(replace(f, weight=next(left)) for f in self.flags), intercept=float(intercept))

    def rounded(self, digits: int = 6) -> "RiskParameters":
        """The same model with all numbers at ``digits`` significant digits."""
        short = lambda x: float(f"{x:.{digits}g}")
        return RiskParameters(tuple(Number(n.column, short(n.fill), short(n.scale), short(n.weight)) for n in self.numbers),
                              tuple(Category(c.column, c.labels, tuple(map(short, c.scales)), tuple(map(short, c.weights))) for c in self.categories),
                              tuple(Flag(f.column, short(f.scale), short(f.weight)) for f in self.flags), short(self.intercept), self.threshold)

    # --- expressions over the preprocessed columns ------------------------------
    def _filled(self, n: Number) -> Column:
        x = F.col(n.column).cast("double")
        return F.when(x.isNull() | F.isnan(x), F.lit(float(n.fill))).otherwise(x)

    def margin(self) -> Column:
        """The linear margin of a preprocessed row."""
        total = F.lit(float(self.intercept))
        for n in self.numbers:
            total = total + self._filled(n) * F.lit(n.scale * n.weight)
        for c in self.categories:
            total = total + _by_label(c, [s * w for s, w in zip(c.scales, c.weights)], 0.0)
        for f in self.flags:
            total = total + F.col(f.column).cast("double") * F.lit(f.scale * f.weight)
        return total

    def score_columns(self) -> tuple[Column, Column]:
        """``(probability of class 1, prediction)`` of a preprocessed row."""
        return scores_of(self.margin(), self.threshold)

    def features(self) -> Column:
        """All slots of a preprocessed row, as an array."""
        slots = [self._filled(n) * F.lit(float(n.scale)) for n in self.numbers]
        slots += [F.when(F.col(c.column) == label, F.lit(float(s))).otherwise(F.lit(0.0)) for c in self.categories for label, s in zip(c.labels, c.scales)]
        slots += [F.col(f.column).cast("double") * F.lit(float(f.scale)) for f in self.flags]
        return F.array(*slots).cast("array<double>")

    def margin_of(self, features: Column) -> Column:
        """The margin of an array of slots."""
        weights = F.lit([w for *_, w in self.slots()] or [0.0])
        return F.aggregate(F.zip_with(features, weights, lambda x, w: x * w), F.lit(float(self.intercept)), lambda a, x: a + x)

    # --- the file ----------------------------------------------------------------
    def to_text(self) -> str:
        """The model as JSON with its version and checksum."""
        body = asdict(self)
        return json.dumps({"format": FORMAT, "version": VERSION, "sha256": _checksum(body), "model": body}, ensure_ascii=False, indent=1)

    @staticmethod
    def from_text(text: str) -> "RiskParameters":
        """The model of ``to_text``; ``DamagedModel`` if it is not one, or was changed."""
        try:
            file = json.loads(text)
            if file["format"] != FORMAT or file["version"] != VERSION:
                raise DamagedModel(f"not {FORMAT} version {VERSION}")
            body = file["model"]
            if _checksum(body) != file["sha256"]:
                raise DamagedModel("the checksum does not match")
            return RiskParameters(tuple(Number(**n) for n in body["numbers"]),
                                  tuple(Category(c["column"], tuple(c["labels"]), tuple(c["scales"]), tuple(c["weights"])) for c in body["categories"]),
                                  tuple(Flag(**f) for f in body["flags"]), body["intercept"], body["threshold"])
        except (json.JSONDecodeError, KeyError, TypeError, AttributeError) as e:
            raise DamagedModel(f"no model file: {e}") from e

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """Write the model as one text file under ``path`` (S4 / S5 counterpart)."""
        spark = spark or SparkSession.getActiveSession()
        spark.createDataFrame([(self.to_text(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(path: str, spark: SparkSession | None = None) -> "RiskParameters":
        """Read a model back; ``DamagedModel`` if the file is damaged."""
        spark = spark or SparkSession.getActiveSession()
        files = spark.read.text(path, wholetext=True).limit(2).collect()
        if len(files) != 1:
            raise DamagedModel(f"one file expected under {path}")
        return RiskParameters.from_text(files[0].value)

    @staticmethod
    def from_model(model) -> "RiskParameters":
        """The numbers of a fitted ``RiskModel`` of the supported shape (else ``NotCompilable``)."""
        from riskspark.plans.compiled import parameters_of
        return parameters_of(model)


def _checksum(body: dict) -> str:
    return hashlib.sha256(json.dumps(body, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def _by_label(c: Category, values: list, other) -> Column:
    """The value of a row's label; ``other`` for a label that is not listed, and for none."""
    first = dict(zip(reversed(c.labels), reversed(values)))
    if not first:
        return F.lit(other)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in first.items() for x in pair)), F.col(c.column).cast("string")), F.lit(other))


def code_of(c: Category) -> Column:
    """The place of a row's label, from 1; 0 for a label that is not listed."""
    return _by_label(c, list(range(1, len(c.labels) + 1)), 0).cast("int")


def scores_of(margin: Column, threshold: float) -> tuple[Column, Column]:
    """``(probability, prediction)`` of a margin."""
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    cut = math.log(threshold / (1 - threshold)) if 0 < threshold < 1 else (math.inf if threshold >= 1 else -math.inf)
    return probability, F.when(margin > F.lit(cut), F.lit(1.0)).otherwise(F.lit(0.0))


def feature_rows(preprocessed: DataFrame, model: RiskParameters, *keys: str) -> DataFrame:
    """M1 as a sparse table: ``keys`` (``SK_ID_CURR``), ``slot`` and ``value`` of every slot that is not 0. No shuffle; a row
    makes at most as many rows as the model has columns.

    The columns are unrolled first and one expression, with the column's place, makes the slot and the value of all: an
    expression a column would be more code than the JVM compiles."""
    entry = lambda x, label: F.struct(F.lit(x).cast("double").alias("x"), F.lit(label).cast("string").alias("label"))
    entries, first, fills, scales, labels = [], [], [], [], []

    def add(e: Column, fill: float | None, of: list[float], names: tuple[str, ...] = ()) -> None:
        first.append(first[-1] + len(scales[-1]) if first else 0)
        entries.append(e)
        fills.append(fill)
        scales.append([float(s) for s in of])
        labels.append(list(names))

    for n in model.numbers:
        add(entry(F.col(n.column), None), float(n.fill), [n.scale])
    for c in model.categories:
        add(entry(None, F.col(c.column)), None, c.scales, c.labels)
    for f in model.flags:
        add(entry(F.col(f.column), None), None, [f.scale])
    keys = keys or ("SK_ID_CURR",)
    rows = preprocessed.select(*keys, F.posexplode(F.array(*entries)).alias("__place", "__entry"))
    at = lambda values, kind: F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("__place"))
    x, label = F.col("__entry.x"), F.col("__entry.label")
    filled = F.when(x.isNull() | F.isnan(x), F.coalesce(at(fills, "double"), x)).otherwise(x)
    code = F.coalesce(F.array_position(at([F.array(*map(F.lit, v)).cast("array<string>") for v in labels], "array<string>"), label).cast("int") - 1, F.lit(0))
    scale = F.get(at([F.array(*map(F.lit, v)).cast("array<double>") for v in scales], "array<double>"), code)
    value = F.when(label.isNull(), filled * scale).otherwise(scale)
    return rows.select(*keys, F.coalesce(at(first, "int") + code, F.lit(0)).alias("slot"), value.alias("value")).where("value <> 0")


@lru_cache(1)
def published() -> RiskParameters:
    """The parameter set that comes with the library."""
    return RiskParameters.from_text(Path(__file__).with_name("published_model.json").read_text(encoding="utf-8"))
