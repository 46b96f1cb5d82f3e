"""Bronze to Silver: cast, measure, gate, publish, log."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import Contract, Registry
from siltworks.operators.constraints import fill_defaults
from siltworks.operators.projection import (
    RAW_PREFIX,
    ROW_FAILED,
    absent_columns,
    check_contract,
    failed_columns,
    raw_names,
    typed_columns,
)
from siltworks.operators.quality import DqReport, Gate, metric_columns
from siltworks.plans.bronze import LOG, Outcome, delta_waiting, merged_delta, run_tables
from siltworks.sinks.audit import Run, audited
from siltworks.sinks.lake import (
    CLUSTER_FILE_BYTES,
    CLUSTER_TASK_BYTES,
    Lake,
    cluster_files,
    clustered,
    ddl,
    sorted_bytes,
)
from siltworks.sinks.layout import clustered_on_all
from siltworks.sinks.versions import Part, Version, publish, settle
from siltworks.sources.tables import tables_to_process

SPLIT_COLUMN = "dq_failed"
LANDED = "landed"


def write_checked(checked: DataFrame, contract: Contract, location: str) -> DqReport:
    """Write the typed rows and measure them in the same pass.

    The metrics are observed in the stage that writes. Spark counts a result task's
    metrics once however often it is retried, so they are exact, and the source is
    scanned and cast once instead of once for metrics and once for rows.
    """
    measured = Observation()
    typed_columns(checked.observe(measured, *metric_columns(checked)), contract).write.parquet(
        location
    )
    return DqReport.of(measured.get)


def write_quarantined(
    checked: DataFrame, contract: Contract, location: str
) -> tuple[str, str, DqReport]:
    """Write valid and failing rows apart in one pass; returns their two folders.

    Failing rows (``check_contract(keep_raw=True)``) keep their text as it landed in ``landed``, because
    the next load overwrites Bronze. Valid rows have it empty, which costs next to nothing. Both folders are there
    afterwards, also where no row belongs in one.
    """
    measured = Observation()
    landed = F.struct(*[F.col(RAW_PREFIX + c).alias(c) for c in raw_names(checked)])
    checked.observe(measured, *metric_columns(checked)).select(
        *contract.schema.names,
        F.when(F.col(ROW_FAILED), landed).alias(LANDED),
        failed_columns(checked).alias("failed_columns"),
        F.col(ROW_FAILED).alias(SPLIT_COLUMN),
    ).write.partitionBy(SPLIT_COLUMN).parquet(location)
    report, spark = DqReport.of(measured.get), checked.sparkSession
    valid, failing = f"{location}/{SPLIT_COLUMN}=false", f"{location}/{SPLIT_COLUMN}=true"
    columns = quarantine_columns(contract, raw_names(checked))
    for folder, n_rows in ((valid, report.total_rows - report.cast_error_rows), (failing, report.cast_error_rows)):
        if not n_rows:
            spark.createDataFrame([], _nullable(columns)).write.parquet(folder)
    return valid, failing, report


def _nullable(columns: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in columns])


def write_clustered(
    spark: SparkSession, contract: Contract, staged: str, location: str, file_bytes: int = CLUSTER_FILE_BYTES
) -> None:
    """Order staged rows by the contract's clustering keys, in as many files as their bytes ask for, packed or as a task sorts them.

    Several keys are ordered along a Hilbert curve, so that files can be skipped on each of them (``sinks/layout``).
    Works from the staged typed files, not from the text: finding the key ranges is a
    pass over the input of its own, and tasks lost during the shuffle start again from
    here. A refused load never gets this far.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(staged)
    staged_bytes = listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    rows = spark.read.schema(contract.schema).parquet(staged)
    order = clustered_on_all if len(contract.cluster_by) > 1 else clustered
    files = max(cluster_files(staged_bytes, file_bytes), cluster_files(sorted_bytes(rows), CLUSTER_TASK_BYTES))
    order(rows, contract.cluster_by, files).write.parquet(location)


def promote_silver(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    run: Run = Run(),
    gate: Gate = Gate(),
    *,
    defaults: bool = False,
    cluster: bool = False,
    quarantine: bool = False,
    complete: bool = False,
) -> DqReport:
    """Refresh one Silver table from its Bronze table.

    Rows are staged and measured together; the gate then decides whether the staged
    rows are published. A refused load raises and leaves the table unchanged. The audit
    row is written in every case. Table and quarantine are one version (``sinks/versions``): both
    change, or neither does, and of two loads at once the second to end raises ``LoadConflict``.

    ``defaults`` fills declared defaults, ``cluster`` orders rows by the contract's
    clustering keys, ``quarantine`` keeps failing rows out of the table and puts them
    in ``<table>_dq_quarantine``. All three are off in a plain load. ``complete`` says that a
    Bronze table loaded with ``only_new`` holds all there is; without it such a table is refused, as Silver would
    lose the rows of earlier files (``merge_silver`` adds to them instead).
    """
    source = lake.table(lake.bronze, contract.name)
    target = lake.table(lake.silver, contract.name)
    with audited(spark, lake, lake.silver, run, source_table=source, target_table=target) as entry:
        if not complete and delta_waiting(spark, source):
            raise ValueError(f"{source} holds only what was new; merge it, or say that it is complete")
        before = settle(spark, lake, contract.name)
        if before.buckets:
            raise ValueError(f"{contract.name} is merged by key; a plain load would replace what was merged")
        landed = spark.table(source)
        checked = check_contract(landed, contract, keep_raw=quarantine)
        if defaults:
            absent = absent_columns(landed, contract)
            checked = fill_defaults(checked, contract, entry["start_time"], absent)
        location = lake.new_location(lake.silver, contract.name)
        if quarantine:
            location, failing, report = write_quarantined(checked, contract, location)
        else:
            failing, report = None, write_checked(checked, contract, location)
        report.enforce(gate, contract.name)
        if report.cast_error_rows:
            LOG.warning(report.message(contract.name))
        if cluster and contract.cluster_by:
            staged, location = location, lake.new_location(lake.silver, contract.name)
            write_clustered(spark, contract, staged, location)
        new = Version(parts=(Part(location),), columns=ddl(contract.schema), job_run_id=run.job_run_id)
        if failing:
            new = replace(new, quarantine=(failing,), quarantine_columns=ddl(quarantine_columns(contract, raw_names(checked))))
        publish(spark, lake, contract, new, before.number)
        if complete and delta_waiting(spark, source):
            merged_delta(spark, source)
        entry["record_count"] = report.total_rows
        return report


def quarantine_columns(contract: Contract, raw: list[str]) -> T.StructType:
    """Columns of the rows put aside: as typed, as landed, and which did not cast."""
    landed = T.StructType([T.StructField(c, T.StringType()) for c in raw])
    reasons = T.StructField("failed_columns", T.ArrayType(T.StringType()))
    return T.StructType([*contract.schema.fields, T.StructField(LANDED, landed), reasons])


def promote_all(
    spark: SparkSession,
    lake: Lake,
    registry: Registry,
    run: Run = Run(),
    gate: Gate = Gate(),
    *,
    requested: str = "",
    parallel: int = 1,
    **options,
) -> DataFrame:
    """Promote every table that has a Bronze source, stopping at the first error.

    Each outcome tells how many rows failed a cast, which share that is, and the columns with most failures.
    """

    def promote(name: str) -> Outcome:
        r = promote_silver(spark, lake, registry.lookup(name), run, gate, **options)
        return Outcome(
            name,
            True,
            r.total_rows,
            cast_error_rows=r.cast_error_rows,
            cast_error_pct=r.cast_error_pct,
            top_columns=r.top_columns(),
        )

    return run_tables(spark, tables_to_process(spark, lake, requested), promote, parallel=parallel)


def declare_silver(
    spark: SparkSession, lake: Lake, registry: Registry, *, replace: bool = False
) -> list[str]:
    """Create every contract's Silver table, empty; ``replace`` also empties existing ones."""
    lake.create_schemas(spark)
    for contract in registry:
        table = lake.table(lake.silver, contract.name)
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            contract.create_table_sql(table, lake.new_location(lake.silver, contract.name))
        )
    return registry.names()
