"""Reports over audit-shaped logs made from events (Bronze) and orders (Silver)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.plans import runs
from siltworks.queries.inputs import BRONZE_LOG, SILVER_LOG, dirty, plain

RUN_ID = "2024-01-15"


def _logs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [dirty(spark, sf_dir, BRONZE_LOG), dirty(spark, sf_dir, SILVER_LOG)]


def run_task_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The report reads a log table by name; the view is resolved when the query is made.
    view = f"run_log_{uuid.uuid4().hex}"
    bronze, silver = _logs(spark, sf_dir)
    bronze.unionByName(silver).createOrReplaceTempView(view)
    report = runs.run_task_status(spark, view, RUN_ID)
    spark.catalog.dropTempView(view)
    return report


def audit_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.audit_union(*_logs(spark, sf_dir))


def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = _logs(spark, sf_dir)
    return runs.run_rollup(bronze.unionByName(silver))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = _logs(spark, sf_dir)
    log = bronze.unionByName(silver)
    return runs.run_summary(log, RUN_ID).unionByName(runs.run_summary(log, "never ran"))


def run_task_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one run, sorted last."""
    lines = runs.run_task_report(runs.run_rows(_logs(spark, sf_dir), RUN_ID))
    return lines.orderBy(F.col("start_time").asc_nulls_first(), "job_run_id", "task_id", "task_run_id")


_UNION = f"({plain(BRONZE_LOG)} union all {plain(SILVER_LOG)})"


def _rollup(where: str, group: bool) -> str:
    run = "job_run_id" if group else f"{where.split('=')[1].strip()} as job_run_id"
    sql = (
        f"select {run}, count(*) as total_tasks, "
        "cast(count(*) filter (where success = 1) as bigint) as passed_tasks, "
        "cast(count(*) - count(*) filter (where success = 1) as bigint) as failed_tasks, "
        "min(start_time) as run_start, max(end_time) as run_end, "
        "case when count(*) = 0 then 'UNKNOWN' when count(*) filter (where success = 0) > 0 "
        f"then 'FAILED' else 'SUCCESS' end as overall_status from {_UNION}"
    )
    return f"{sql} group by job_run_id" if group else f"{sql} where {where}"


QUERIES = {
    "run_task_status": (
        run_task_status,
        f"select {', '.join(runs.STATUS_COLUMNS)} from {_UNION} where job_run_id = '{RUN_ID}' "
        "order by start_time asc nulls first",
    ),
    "audit_union": (
        audit_union,
        f"select * from {_UNION} order by start_time asc nulls first, job_run_id, task_id, task_run_id",
    ),
    "run_rollup": (run_rollup, _rollup("", True)),
    "run_summary": (
        run_summary,
        _rollup(f"job_run_id = '{RUN_ID}'", False)
        + " union all "
        + _rollup("job_run_id = 'never ran'", False),
    ),
    "run_task_report": (
        run_task_report,
        "select job_run_id, task_id, task_run_id, target_table, "
        "case when success = 1 then 'SUCCESS' else 'FAILED' end as status, start_time, end_time, "
        "coalesce(record_count, 0) as record_count, coalesce(failure_reason, '') as failure_reason "
        f"from {_UNION} where job_run_id = '{RUN_ID}'",
    ),
}
