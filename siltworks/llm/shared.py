"""Written tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Frees the shuffle files of a write when it is done, instead of when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/siltworks-llm/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str) -> None:
    """Write a table once. A frame that shares its shuffles with others must not be given here."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a table of their own: lineage ends here and nothing is computed twice."""
    path = shared_path(df.sparkSession, label)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that no name of theirs can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
