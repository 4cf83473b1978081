"""Readers: the driver's parquet tables and application files with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.schema import application_schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, e.g. ``orders``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_application(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "csv",
    with_target: bool = True,
) -> DataFrame:
    """Read an application table without a schema inference pass.

    ``with_target=True`` reads the portfolio table, ``False`` the scoring table
    (same columns without ``TARGET``). CSV files are read with a header and the
    explicit schema, so filters and column pruning reach the scan.
    """
    reader = spark.read.schema(application_schema(with_target))
    if fmt == "csv":
        return reader.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return reader.format(fmt).load(path)


def write_application(df: DataFrame, path: str, *, fmt: str = "csv") -> None:
    """Write an application table in the layout ``read_application`` expects."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
