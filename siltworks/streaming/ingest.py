"""Incremental file ingest: each landed file is loaded once, told by the checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltworks.contracts import Contract
from siltworks.operators.projection import (
    RAW_PREFIX,
    ROW_FAILED,
    check_contract,
    failed_columns,
    raw_names,
)
from siltworks.operators.quality import DqReport, Gate, metric_columns
from siltworks.plans.bronze import LOG
from siltworks.plans.keyed import key_of, merge_delivery
from siltworks.plans.silver import LANDED, SPLIT_COLUMN
from siltworks.sinks.audit import Run, audited
from siltworks.sinks.lake import Lake
from siltworks.sources.delimited import INGEST_TS, _local_path, add_provenance, delimited_reader

#: A file is never too old to be loaded: late deliveries and restored backlogs carry old dates.
NO_AGE_LIMIT = "36500d"
#: How long a stream by key remembers the rows it has seen.
EXPIRY = "7 days"
#: Bytes a batch takes, so that a first backlog is not a single one.
BATCH_BYTES = 64 << 30


def read_new_files(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    *,
    archive_to: str | None = None,
    max_bytes_per_trigger: int = BATCH_BYTES,
    ingest_time: datetime | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A stream of the lines of files arriving in ``folder``, with provenance.

    ``archive_to`` moves a file away after a later batch has committed. It only keeps
    the folder short: what has been loaded is known from the checkpoint.
    """
    reader = delimited_reader(spark.readStream, contract.source_schema, keep_corrupt=keep_corrupt)
    reader = reader.option("maxFileAge", NO_AGE_LIMIT).option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    return add_provenance(reader.csv(_local_path(folder)), ingest_time)


def _batches(
    lines: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], int], lake: Lake | None, schema: str, target: str, run: Run
) -> StreamingQuery:
    """Write each batch with ``write`` and, with a lake, one audit row per batch."""

    def batch(rows: DataFrame, number: int) -> None:
        if lake is None:
            write(rows, number)
            return
        with audited(rows.sparkSession, lake, schema, run, target_table=target, source_table=f"batch {number}") as entry:
            entry["record_count"] = write(rows, number)

    return (
        lines.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_bronze(
    lines: DataFrame, target: str, checkpoint: str, *, lake: Lake | None = None, run: Run = Run()
) -> StreamingQuery:
    """Append whatever is new to Bronze files and stop.

    A batch owns the folder ``batch=N`` and overwrites it when it is run again after a failure.
    """

    def write(rows: DataFrame, number: int) -> int:
        counted = Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{target}/batch={number}")
        return counted.get["n"]

    return _batches(lines, checkpoint, write, lake, lake.bronze if lake else "", target, run)


def stream_silver(
    lines: DataFrame,
    contract: Contract,
    target: str,
    checkpoint: str,
    *,
    lake: Lake | None = None,
    run: Run = Run(),
) -> StreamingQuery:
    """Append new lines typed, valid and failing rows in separate partitions of each batch.

    The casts are the batch ones, and a failing row keeps its landed text and the names of
    the columns that failed. No state is kept, so a batch costs only its own files.
    """

    def write(rows: DataFrame, number: int) -> int:
        checked, measured = check_contract(rows, contract, keep_raw=True), Observation()
        landed = F.struct(*[F.col(RAW_PREFIX + c).alias(c) for c in raw_names(checked)])
        checked.observe(measured, *metric_columns(checked)).select(
            *contract.schema.names,
            F.when(F.col(ROW_FAILED), landed).alias(LANDED),
            failed_columns(checked).alias("failed_columns"),
            F.col(ROW_FAILED).alias(SPLIT_COLUMN),
        ).write.mode("overwrite").partitionBy(SPLIT_COLUMN).parquet(f"{target}/batch={number}")
        report = DqReport.of(measured.get)
        if report.cast_error_rows:
            LOG.warning(report.message(f"{contract.name}, batch {number}"))
        return report.total_rows

    return _batches(lines, checkpoint, write, lake, lake.silver if lake else "", target, run)


def unseen(lines: DataFrame, contract: Contract, key: Sequence[str], expiry: str = EXPIRY) -> DataFrame:
    """Lines that the stream has not met before, by key and content; it remembers them for ``expiry``.

    The state store holds the key and a 128-bit digest of the line's fields, and lets them go when the watermark on the
    time of arrival has passed. Arrival, not the row's own time, so nothing comes too late. A repeated line that
    the store has let go of costs a merge that changes nothing.
    """
    fields = F.to_json(F.struct(*[F.col(c) for c in contract.source_schema.names]), {"ignoreNullFields": "false"})
    names = [contract.source_name(c) for c in key]
    known = lines.withColumn("__content", F.md5(fields)).withWatermark(INGEST_TS, expiry)
    return known.dropDuplicatesWithinWatermark([*names, "__content"]).drop("__content")


def stream_keyed(
    lines: DataFrame,
    contract: Contract,
    checkpoint: str,
    *,
    lake: Lake,
    run: Run = Run(),
    gate: Gate = Gate(),
    key: Sequence[str] = (),
    latest_by: Sequence[str] = (),
    expiry: str = EXPIRY,
    **options,
) -> StreamingQuery:
    """Merge new lines into a published Silver table by key, a version for each batch.

    The state store drops lines met before, so repeated files rewrite nothing. What is left of a batch is gated,
    failing rows are put aside, and the rest is merged like a delivery (``plans/keyed``). A batch the gate
    refuses stops the stream with the table as it was; started again, the stream takes up that batch. A version
    says which batch it holds, so one that is run again after a crash is not merged twice.
    """
    columns, target = key_of(contract, key), lake.table(lake.silver, contract.name)

    def write(rows: DataFrame, number: int) -> int:
        entry = {"start_time": datetime.now(timezone.utc)}
        report = merge_delivery(
            rows.sparkSession, lake, contract, rows, entry, gate, key=columns, latest_by=latest_by, run=run, stream=checkpoint, batch=number, **options
        )
        if report is None:  # merged before a crash; the state store still has to take the batch in
            rows.write.format("noop").mode("overwrite").save()
            return 0
        return report.delivery.total_rows

    return _batches(unseen(lines, contract, columns, expiry), checkpoint, write, lake, lake.silver, target, run)
