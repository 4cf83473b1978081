"""Intermediate tables of the operators: written to the shared folder and read back.

A staged table cuts the lineage (a lost executor re-runs one job, not the whole
operator) and lets Spark drop the shuffle files of the job that wrote it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import remove_path, scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) under ``spark.checkpoint.dir`` and return the table that reads it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # this job's shuffle files go when it has ended
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for t in tables:
        remove_path(t.sparkSession, t.staged_path)


def carried(docs: DataFrame, new: tuple[str, ...], but: tuple[str, ...] = ()) -> tuple[list[str], Column]:
    """The columns that an operator returns as they are (all but those with the name of a new one, and ``but``),
    and one column that holds them, so that no name of theirs meets a name of the operator's own."""
    taken = {n.lower() for n in new}
    names = [c for c in docs.columns if c.lower() not in taken and c not in but]
    return names, F.struct(*(F.col(f"`{c}`") for c in names) if names else (F.lit(0).alias("_"),)).alias("others")


def power_of_two(n: float) -> int:
    """The smallest power of two that is at least ``n``."""
    return 1 << max(0, int(-(-n // 1)) - 1).bit_length()
