"""Queries over the driver's tables, one for each operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmap.llm import fingerprints, jaccard_join, mixing, packing, pii, secrets, substring_dedup, token_counts, topk, toxicity
from quillmap.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents")).drop("kept", "removed")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_surrogates(docs, count_col="n_entities")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_substring_dedup, op3_fingerprints, op4_best_fit_packing, op5_source_mixing, op6_toxicity, op7_exact_topk, op8_token_counts, op9_pii_surrogates, op10_jaccard_join)}

SQL: dict[str, str] = {"op2_substring_dedup": substring_dedup.SQL, "op5_source_mixing": mixing.SQL, "op7_exact_topk": topk.SQL}
