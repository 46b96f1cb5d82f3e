"""Deliveries merged into Silver by key: the latest row of each key stays, and only buckets a delivery touches are rewritten.

A table merged by key is kept in buckets, by a hash of the key. A merge types and measures the delivery as any
load does, puts failing rows aside, and rewrites the buckets that its keys fall into: the rows there
and the delivery's, one for each key. All other buckets stay as they are, as folders of earlier
loads, and a version (``sinks/versions``) names them all, so readers see all of a delivery or nothing.

Which row of a key is the latest is decided by ``latest_by`` columns (a missing value is the oldest) and, among
equals, by the row's other values. Nothing but the rows decides, so deliveries may come late, again, or in any
order: the table is what one load of all of them would give. Without ``latest_by`` it is the row delivered last,
and then the row's values.

Rows without a whole key can't be told apart by it; they are put aside, with the key's missing columns as reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import Contract
from siltworks.operators.constraints import fill_defaults
from siltworks.operators.projection import RAW_PREFIX, ROW_FAILED, absent_columns, check_contract, failed_columns, raw_names
from siltworks.operators.quality import DqReport, Gate, metric_columns
from siltworks.plans.bronze import LOG, delta_waiting, merged_delta
from siltworks.plans.silver import LANDED, SPLIT_COLUMN, quarantine_columns
from siltworks.sinks.audit import Run, audited
from siltworks.sinks.lake import Lake, ddl
from siltworks.sinks.versions import BUCKET, Part, Version, publish, settle

DELIVERED = "__delivered"
#: Bytes of files a bucket is meant to have. Buckets are doubled when they have twice as many on average.
BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class MergeReport:
    """What a delivery held and what merging it rewrote."""

    delivery: DqReport
    version: int
    buckets: int
    touched: int
    bytes_rewritten: int
    bytes_total: int
    rows_total: int


def key_of(contract: Contract, key: Sequence[str] = ()) -> list[str]:
    """The columns rows are told apart by: those given, or the contract's first unique key."""
    chosen = list(key) or list(contract.unique_keys[0] if contract.unique_keys else ())
    if not chosen:
        raise ValueError(f"{contract.name} declares no unique key to merge by")
    return chosen


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def latest(rows: DataFrame, key: Sequence[str], latest_by: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """One row of each key, the latest. Tasks reduce their own rows before any is sent."""
    others = [c for c in rows.columns if c not in (*latest_by, DELIVERED)]
    order = F.struct(*latest_by, *others, DELIVERED) if latest_by else F.struct(DELIVERED, *others)
    rest = [c for c in rows.columns if c not in (*key, *group)]
    one = F.max_by(F.struct(*rest), order).alias("one")
    return rows.groupBy(*group, *key).agg(one).select(*key, *group, *[F.col(f"one.{c}").alias(c) for c in rest]).select(*rows.columns)


def stage_delivery(checked: DataFrame, contract: Contract, key: Sequence[str], delivered: datetime, location: str) -> DqReport:
    """Write a checked delivery, good and failing rows apart, and measure it in the same pass."""
    measured = Observation()
    no_key = [F.col(c).isNull() for c in key]
    failing = reduce(or_, no_key, F.col(ROW_FAILED))
    landed = F.struct(*[F.col(RAW_PREFIX + c).alias(c) for c in raw_names(checked)])
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in key]))
    checked.observe(measured, *metric_columns(checked)).select(
        *contract.schema.names,
        F.lit(delivered).cast("timestamp").alias(DELIVERED),
        F.when(failing, landed).alias(LANDED),
        F.array_union(failed_columns(checked), missing).alias("failed_columns"),
        failing.alias(SPLIT_COLUMN),
    ).write.partitionBy(SPLIT_COLUMN).parquet(location)
    return DqReport.of(measured.get)


def _doubled(bytes_held: int, buckets: int, target: int) -> int:
    while bytes_held > 2 * target * buckets:
        buckets *= 2
    return buckets


def _bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder and those in it, with their sizes."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
    return listing.select("path", "length")


def merge_rows(
    spark: SparkSession, lake: Lake, contract: Contract, staged: str, before: Version, key: Sequence[str], latest_by: Sequence[str], bucket_bytes: int
) -> tuple[tuple[Part, ...], int, int]:
    """Rewrite the buckets that a staged delivery's keys fall into; returns all parts, the number of buckets and of those rewritten."""
    held = T.StructType([*[T.StructField(f.name, f.dataType) for f in contract.schema], T.StructField(DELIVERED, T.TimestampType())])
    valid = f"{staged}/{SPLIT_COLUMN}=false"
    arriving = _bytes(spark, staged).where(F.contains("path", F.lit(f"/{SPLIT_COLUMN}=false/"))).agg(F.sum("length")).first()[0]
    if not arriving:  # nothing was written there
        return before.parts, before.buckets or 1, 0
    delivery = spark.read.schema(held).parquet(valid)
    buckets = _doubled(sum(p.n_bytes for p in before.parts) + arriving, before.buckets or 1, bucket_bytes)
    parts = {p.bucket: p for p in before.parts}
    placed = delivery.withColumn(BUCKET, bucket_of(key, buckets))
    if buckets == before.buckets:
        touched = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())  # numbers of buckets
        read, kept = [parts[b].folder for b in touched if b in parts], [p for b, p in parts.items() if b not in touched]
    else:
        read, kept = [p.folder for p in before.parts], []
    rows = latest(placed, key, latest_by, [BUCKET])
    if read:
        old = spark.read.schema(held).parquet(*read).withColumn(BUCKET, bucket_of(key, buckets))
        # One shuffle by bucket serves both the choice by key and the files of each bucket.
        rows = latest(rows.unionByName(old).repartition(BUCKET), key, latest_by, [BUCKET])
    else:
        rows = rows.repartition(BUCKET)
    location = lake.new_location(lake.silver, contract.name)
    rows.write.partitionBy(BUCKET).parquet(location)
    number = F.regexp_extract("path", rf"/{BUCKET}=(\d+)/", 1).cast("int").alias(BUCKET)
    sizes = _bytes(spark, location).groupBy(number).agg(F.sum("length").alias("n_bytes"))
    counts = spark.read.schema(T.StructType([*held.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(location).groupBy(BUCKET).agg(F.count("*").alias("n_rows"))
    new = [Part(f"{location}/{BUCKET}={r[BUCKET]}", r[BUCKET], r["n_rows"], r["n_bytes"]) for r in sizes.join(counts, BUCKET).collect()]
    return tuple(sorted([*kept, *new], key=lambda p: p.bucket)), buckets, len(new)


def merge_delivery(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    landed: DataFrame,
    entry: dict,
    gate: Gate = Gate(),
    *,
    key: Sequence[str] = (),
    latest_by: Sequence[str] = (),
    defaults: bool = False,
    run: Run = Run(),
    delivered: datetime | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    stream: str = "",
    batch: int = -1,
) -> MergeReport | None:
    """Merge landed text into a table; None where this batch of this stream is in it already."""
    columns, before = key_of(contract, key), settle(spark, lake, contract.name)
    if stream and before.stream == stream and batch <= before.batch:
        return None
    if before.number and not before.buckets:
        raise ValueError(f"{contract.name} was published as a whole; empty it before deliveries are merged into it")
    if before.number and before.columns != ddl(_held(contract)):
        raise ValueError(f"the contract of {contract.name} has changed since its rows were merged")
    checked = check_contract(landed, contract, keep_raw=True)
    if defaults:
        checked = fill_defaults(checked, contract, entry["start_time"], absent_columns(landed, contract))
    staged = lake.new_location(lake.silver, contract.name)
    report = stage_delivery(checked, contract, columns, delivered or entry["start_time"], staged)
    report.enforce(gate, contract.name)
    if report.cast_error_rows:
        LOG.warning(report.message(contract.name))
    if stream and not report.total_rows:  # a batch that only moves the watermark on
        entry["record_count"] = 0
        return _reported(report, before.number, before.parts, before.buckets, 0, ())
    parts, buckets, touched = merge_rows(spark, lake, contract, staged, before, columns, latest_by, bucket_bytes)
    aside = f"{staged}/{SPLIT_COLUMN}=true"
    put_aside = not _bytes(spark, staged).where(F.contains("path", F.lit(f"/{SPLIT_COLUMN}=true/"))).isEmpty()
    new = replace(
        before, parts=parts, columns=ddl(_held(contract)), buckets=buckets, job_run_id=run.job_run_id, stream=stream or before.stream,
        batch=batch if stream else before.batch, quarantine=(*before.quarantine, aside) if put_aside else before.quarantine,
        quarantine_columns=ddl(quarantine_columns(contract, raw_names(checked))),
    )
    entered = publish(spark, lake, contract, new, before.number)
    entry["record_count"] = report.total_rows
    return _reported(report, entered.number, parts, buckets, touched, before.parts)


def _reported(report: DqReport, version: int, parts: Sequence[Part], buckets: int, touched: int, before: Sequence[Part]) -> MergeReport:
    rewritten = sum(p.n_bytes for p in parts if p not in before) if touched else 0
    return MergeReport(report, version, buckets, touched, rewritten, sum(p.n_bytes for p in parts), sum(p.n_rows for p in parts))


def _held(contract: Contract) -> T.StructType:
    return T.StructType([*contract.schema.fields, T.StructField(DELIVERED, T.TimestampType())])


def merge_silver(spark: SparkSession, lake: Lake, contract: Contract, run: Run = Run(), gate: Gate = Gate(), **options) -> MergeReport:
    """Merge what Bronze holds of a table into Silver; ``options`` are those of ``merge_delivery``.

    After a load with ``only_new`` Bronze holds the files that were new, and nothing is loaded over them until they are merged.
    """
    source, target = lake.table(lake.bronze, contract.name), lake.table(lake.silver, contract.name)
    with audited(spark, lake, lake.silver, run, source_table=source, target_table=target) as entry:
        report = merge_delivery(spark, lake, contract, spark.table(source), entry, gate, run=run, **options)
        if delta_waiting(spark, source):
            merged_delta(spark, source)
        return report
