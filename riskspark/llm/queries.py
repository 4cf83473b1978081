"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.centroids import cluster_vectors, with_inertia
from riskspark.llm.decontaminate import find_benchmark
from riskspark.llm.license_scan import scan
from riskspark.llm.maxent_lm import language_scores
from riskspark.llm.merkle import lower_case, manifest
from riskspark.llm.minhash_dedup import near_duplicates
from riskspark.llm.oracles import CENTROIDS, MERKLE, QUALITY_RULES, SUBSTRING_DEDUP, SUFFIX_DEDUP
from riskspark.llm.packing import pack
from riskspark.llm.quality_classifier import fit, score
from riskspark.llm.quality_rules import judge
from riskspark.llm.substring_dedup import remove_repeats
from riskspark.llm.suffix_dedup import remove_repeated_bytes
from riskspark.llm.token_files import read_ids, token_files
from riskspark.llm.url_filter import filter_urls
from riskspark.sources.tables import read_table


#: The rules of the URL filter's query.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).drop("url")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every document names."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of each document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "copies", "keep")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in 20-word windows that start earlier elsewhere go."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against all 13-word windows of the benchmark."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = F.col("items")
    return find_benchmark(docs, read_table(spark, sf_dir, "benchmark"), slop=2).select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        "contaminated", F.size("near_items").cast("long").alias("n_near_items"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document, learned from six sevenths of the ids."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return language_scores(docs, ~F.coalesce("held_out", F.lit(False)), keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over every document and all its lines; the source is the host."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs, line_words=None).drop("source", "text")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in 400-byte strings that start anywhere else go."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from four fifths of the labels' ids."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return score(docs.select("doc_id", "text", held_out.alias("held_out")), model, keep=["doc_id", "held_out"])


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after three rounds with 16 centroids."""
    return with_inertia(*cluster_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof of inclusion; a third of the texts is lower-cased after the manifest was made."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampers = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(docs, tampered={"text": lower_case(F.col("text"))}, tampers=tampers).drop("segment")


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents, from the files that hold them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_ids(spark, token_files(docs), checksums=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_ids": op13_token_ids,
}

ORACLE_SQL: dict[str, str] = {"op4_substring_dedup": SUBSTRING_DEDUP, "op8_quality_rules": QUALITY_RULES, "op9_suffix_dedup": SUFFIX_DEDUP,
                              "op11_centroid_clusters": CENTROIDS, "op12_merkle_manifest": MERKLE}
