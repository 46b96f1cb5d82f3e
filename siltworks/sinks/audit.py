"""The append-only audit log: one row per table load."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import astuple, dataclass, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltworks.sinks.lake import AUDIT_TABLE, Lake
from siltworks.sinks.logs import AppendLog

# The log's columns.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("job_run_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("task_run_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("success", T.IntegerType()),
        T.StructField("failure_reason", T.StringType()),
        T.StructField("record_count", T.LongType()),
    ]
)


@dataclass(frozen=True)
class AuditRow:
    job_id: str
    job_run_id: str
    task_id: str
    task_run_id: str
    start_time: datetime | None = None
    end_time: datetime | None = None
    source_file_path: str | None = None
    source_table: str | None = None
    target_table: str | None = None
    success: int | None = 0
    failure_reason: str | None = None
    record_count: int | None = 0


@dataclass(frozen=True)
class Run:
    """Identifiers every audit row of one job run carries."""

    job_id: str = ""
    job_run_id: str = ""
    task_id: str = ""
    task_run_id: str = ""

    def row(self, **values) -> AuditRow:
        return replace(
            AuditRow(self.job_id, self.job_run_id, self.task_id, self.task_run_id), **values
        )


def log_of(lake: Lake, schema: str) -> AppendLog:
    return AppendLog(lake, schema, AUDIT_TABLE, AUDIT_SCHEMA)


def ensure_audit_log(spark: SparkSession, lake: Lake, schema: str) -> str:
    return log_of(lake, schema).ensure(spark)


def _day(row: AuditRow) -> date:
    moment = row.start_time or row.end_time or datetime.now(timezone.utc)
    return (moment.astimezone(timezone.utc) if moment.tzinfo else moment).date()


def append_audit(spark: SparkSession, lake: Lake, schema: str, rows: Iterable[AuditRow]) -> None:
    """Add rows to the log, each to the day it started."""
    by_day: dict[date, list[AuditRow]] = {}
    for row in rows:
        by_day.setdefault(_day(row), []).append(row)
    for day, members in by_day.items():
        frame = spark.createDataFrame([astuple(r) for r in members], AUDIT_SCHEMA)
        log_of(lake, schema).append(frame, day)


@contextmanager
def audited(spark: SparkSession, lake: Lake, schema: str, run: Run, **known) -> Iterator[dict]:
    """One audit row for what happens inside, also if it fails; the block fills in its values.

    If both the block and the log fail, the block's error is raised and the log's is logged.
    """
    values = {"start_time": datetime.now(timezone.utc), "success": 0, "record_count": 0, **known}
    failed = None
    try:
        yield values
        values["success"] = 1
    except Exception as error:
        failed = error
        values |= {"failure_reason": str(error), "record_count": 0}
        raise
    finally:
        values["end_time"] = datetime.now(timezone.utc)
        try:
            append_audit(spark, lake, schema, [run.row(**values)])
        except Exception:
            if failed is None:
                raise
            logging.getLogger(__name__).exception("the audit row of a failed load was not written")


def audit_log(spark: SparkSession, lake: Lake, schema: str) -> DataFrame:
    """All rows, with the day they are filed under (``run_date``)."""
    return log_of(lake, schema).read(spark)


def compact_audit(spark: SparkSession, lake: Lake, schema: str, before: date) -> list[str]:
    """Rewrite the closed days before ``before`` as one file each."""
    return log_of(lake, schema).compact(spark, before)
