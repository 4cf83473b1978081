"""The training-data pipeline: stages over ``documents``, each on all that the stage before kept.

Every stage but the last returns the columns of ``documents``; the last returns the packed pieces.
The tables between the stages are Parquet in the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.decontaminate import find_benchmark
from riskspark.llm.minhash_dedup import one_of_each
from riskspark.llm.packing import pack
from riskspark.llm.quality_rules import judge
from riskspark.llm.stage import staged
from riskspark.llm.substring_dedup import remove_repeats
from riskspark.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, and the host's frequent lines; the source is the host. ``n_chars`` follows the text."""
    lost = F.col("n_removed_words") > 0
    text, size = F.when(lost, F.col("kept_text")).otherwise(F.col("text")), F.when(lost, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return judge(docs, line_words=None, cleaned=True).where("kept").withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the smallest id."""
    return one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go. A text that loses words is its other words, joined by one space; ``n_chars`` follows."""
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return remove_repeats(docs).withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated by the benchmark go."""
    return find_benchmark(docs, read_table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of at most 1024 tokens."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("minhash_dedup", near_duplicates), ("substring_dedup", substrings),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL does not express the signatures and the packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
