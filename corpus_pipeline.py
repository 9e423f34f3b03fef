"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
all but the last return the columns of documents; between stages the rows are written
and read again. Nulls, empty tables and repeated rows are as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmap.llm import jaccard_join, mixing, packing, pii, toxicity
from quillmap.llm.common import table, written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.ToxicityModel.fit(docs, table(spark, sf_dir, "labels")).filter(docs)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least id."""
    return jaccard_join.keep_one(docs)


def pii_replaced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars follows the new text."""
    out = pii.with_surrogates(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("pii", pii_replaced),
    ("mixing", sources_mixed),
    ("packing", packed),
]

#: SQL cannot express the classifier, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
