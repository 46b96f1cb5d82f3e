"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the jobs are written for. Partition counts are left to AQE and to the
# cluster's own spark.sql.shuffle.partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Scan and write are one task here, so the split decides the size of written files.
    # Inputs smaller than this per core are still spread over all cores.
    "spark.sql.files.maxPartitionBytes": "512m",
    # A contract of a dozen typed columns compiles to one method beyond the size the
    # JVM still optimises. Above this limit Spark uses its split-up projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A wide contract outgrows the 64 KB of a JVM method; Spark would compile it in vain and then
    # fall back to the same split-up projections.
    "spark.sql.codegen.maxFields": "60",
    # Timestamps as INT96 carry no min/max, so files could not be skipped on them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
    # Two open files per task (valid and quarantined) spare a sort of every row.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Frees the shuffle files of a frame when its write ends. Not for frames that run more than once.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Apply the same settings to a session that already runs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder the session names, which every executor can read.

    Without that setting it is the warehouse, the one other folder a session always names.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/siltworks/{label}-{uuid.uuid4().hex}"
