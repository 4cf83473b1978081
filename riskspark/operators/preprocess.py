"""Scoring preprocessing in one projection.

The reference loops ``withColumn`` 50 times; here one ``select`` casts the
numeric features (bad text -> null via ``try_cast``), fills categorical
features with ``Unknown`` and encodes the Y/N flags. Missing columns are
skipped, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.schema import CATEGORICAL_COLS, FLAG_COLS, NUMERIC_COLS, PROFILE_COLS

# Placeholder for missing categories and the flag codes meaning "yes".
UNKNOWN = "Unknown"
FLAG_TRUE = ["Y", "1"]


def numeric_repair(c: str) -> Column:
    """To double; text that is not a number becomes null."""
    return F.col(c).try_cast("double")


def categorical_repair(c: str) -> Column:
    """To string, null -> ``Unknown``."""
    return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))


def flag_encoding(c: str) -> Column:
    """``Y`` / ``1`` -> 1, anything else and null -> 0."""
    return F.when(F.col(c).cast("string").isin(FLAG_TRUE), F.lit(1)).otherwise(F.lit(0))


def preprocess(df: DataFrame) -> DataFrame:
    """P12-P14 over every present feature column; other columns pass through."""
    out = []
    for c in df.columns:
        if c in NUMERIC_COLS:
            out.append(numeric_repair(c).alias(c))
        elif c in CATEGORICAL_COLS:
            out.append(categorical_repair(c).alias(c))
        elif c in FLAG_COLS:
            out.append(flag_encoding(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def profile_projection(scored: DataFrame) -> DataFrame:
    """The 13 columns of the client profile of a scored table."""
    return scored.select(*PROFILE_COLS)
