"""Which landed files have been loaded: one entry per file, kept beside the audit log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from siltworks.sinks.lake import LEDGER_TABLE, Lake
from siltworks.sinks.logs import AppendLog

LEDGER_COLUMNS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("job_run_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)


def _ledger(lake: Lake) -> AppendLog:
    return AppendLog(lake, lake.bronze, LEDGER_TABLE, LEDGER_COLUMNS)


def record_files(files: DataFrame, lake: Lake, target_table: str, job_run_id: str, loaded_at: datetime) -> None:
    """Enter the files of a finished load, as they were listed for it."""
    entries = files.select(
        "path", "length", "modificationTime", F.lit(target_table).alias("target_table"),
        F.lit(job_run_id).alias("job_run_id"), F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
    )
    _ledger(lake).append(entries, loaded_at.date())


def file_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """All entries; empty before the first load."""
    return _ledger(lake).read(spark).select(*LEDGER_COLUMNS.names)


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of a listing without an entry of the same path, size and modification time.

    A file that was replaced counts as new, and a folder says nothing about its files.
    """
    key = ["length", "modificationTime"]
    known = ledger.select(_plain("path").alias("_path"), *key).distinct()
    listed = files.withColumn("_path", _plain("path"))
    return listed.join(known, ["_path", *key], "left_anti").select(*files.columns)


def _plain(column: str):
    """A path without scheme or trailing slash, so listings and log entries compare equal."""
    return F.regexp_replace(F.regexp_replace(column, r"^[a-zA-Z0-9]+:/*", "/"), r"/+$", "")
