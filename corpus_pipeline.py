"""The corpus pipeline: documents through the training-data operators, a written table between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import empirical_bayes, harmonic_packing, lsh_forest, prefix_free, weak_supervision
from siltworks.llm.shared import documents, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that text and site together don't show to be low or toxic."""
    return empirical_bayes.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules pass and the voting rules find good."""
    return weak_supervision.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; five-word shingles, similarity 0.8."""
    return lsh_forest.keep_one(docs, percent=80, words=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes and more that occur again."""
    cut = prefix_free.dedup_texts(docs)
    if "n_chars" not in cut.columns:
        return cut
    n_chars = F.when(F.col("text").isNotNull(), F.length("text")).cast(cut.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", n_chars)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids."""
    return harmonic_packing.pack_documents(spark, docs)


#: name and function of each stage: (spark, docs, sf_dir) to the next stage's docs.
STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: The stages fit models and compare texts by hashing; SQL can't express them, so the pipeline
#: is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
