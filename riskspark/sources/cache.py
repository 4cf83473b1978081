"""Reuse of a table across analyses (S3) and export of results.

``materialize`` writes the pruned, filtered table to the shared checkpoint
folder and reads it back: later analyses scan parquet (filters and column
pruning reach the scan) and the lineage is cut, so a lost executor does not
re-run the joins that built it. ``keep_hot`` is the in-memory variant for an
interactive session.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import remove_path, scratch_path


def materialize(df: DataFrame, name: str, columns: list[str] | None = None,
                partitions: int | None = None, partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, row_group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` (optionally only ``columns``) as parquet under ``spark.checkpoint.dir``.

    ``partitions`` spreads the rows evenly over that many files (one shuffle,
    paid once) when the source arrives in too few, large files.
    ``partition_by`` writes one folder per value of low-cardinality columns,
    so an equality filter on them reads only its folders (partition pruning). The rows are
    then dealt by ranges of those columns and of ``sort_within``, or of a hash of the row, so
    that a value with many rows has many files.
    ``sort_within`` sorts each file, so parquet min/max statistics let range
    filters (e.g. on ``AMT_CREDIT``) skip whole row groups.
    ``row_group_bytes`` makes smaller row groups, so that readers can split a file between more tasks.
    """
    spark = df.sparkSession
    out = df.select(*columns) if columns else df
    if partitions:
        if partition_by:
            hashed = [F.col(f"`{f.name}`") for f in out.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
            out = out.repartitionByRange(partitions, *partition_by, *(sort_within or []), F.xxhash64(*hashed))
        else:
            out = out.repartition(partitions)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    path = scratch_path(spark, name)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    out = spark.read.parquet(path)
    out.staged_path = path
    return out


def release(table: DataFrame) -> None:
    """Remove a table that ``materialize`` returned and nothing reads any more."""
    remove_path(table.sparkSession, table.staged_path)


def keep_hot(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Persist only the used columns (memory, spilling to disk); no forced count."""
    out = df.select(*columns) if columns else df
    return out.persist(StorageLevel.MEMORY_AND_DISK)


def export(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Write an analysis result for consumers outside Spark; returns the path."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path
