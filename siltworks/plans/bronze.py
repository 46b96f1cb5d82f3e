"""Landing to Bronze: one table, or every table of a registry."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import Contract, Registry
from siltworks.sinks.audit import Run, audited
from siltworks.sinks.lake import Lake, publish_frame, remove
from siltworks.sources.delimited import CORRUPT, add_provenance, landed_paths, scan_delimited, source_files
from siltworks.sources.ledger import file_ledger, new_files, record_files


LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class BronzeReport:
    """What a Bronze load wrote, and how many of its lines had too few or too many fields."""

    total_rows: int
    malformed_rows: int = 0

    def message(self, table: str) -> str:
        return f"{table}: {self.malformed_rows} of {self.total_rows} lines have too few or too many fields"


def write_bronze(spark: SparkSession, lake: Lake, name: str, df: DataFrame | Iterable[DataFrame]) -> BronzeReport:
    """Overwrite a Bronze table; returns the rows written and, of a ``keep_corrupt`` scan, the malformed ones.

    Scan and write are one stage without a shuffle, so there are as many tasks as input
    splits. The counts are observed in that stage, where each task reports exactly once,
    instead of being read back. Several frames are written one after the other, each asked for when the one before
    is written, and published together.
    """
    location, total, malformed = lake.new_location(lake.bronze, name), 0, 0
    for part in [df] if isinstance(df, DataFrame) else df:
        written = Observation()
        corrupt = F.count_if(F.col(CORRUPT).isNotNull()) if CORRUPT in part.columns else F.count_if(F.lit(False))
        rows = part.observe(written, F.count(F.lit(1)).alias("n"), corrupt.alias("malformed")).drop(CORRUPT)
        rows.write.mode("append").parquet(location)
        total, malformed = total + written.get["n"], malformed + written.get["malformed"]
    publish_frame(spark, lake, lake.bronze, name, rows.schema, location)
    return BronzeReport(total, malformed)


_DELTA = "siltworks.delta"


def delta_waiting(spark: SparkSession, table: str) -> bool:
    """Whether a Bronze table holds only what was new, and that is not in Silver yet."""
    if not spark.catalog.tableExists(table):
        return False
    return any(r["key"] == _DELTA and r["value"] == "waiting" for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect())


def _mark_delta(spark: SparkSession, table: str) -> None:
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_DELTA}' = 'waiting')")


def merged_delta(spark: SparkSession, table: str) -> None:
    """A table's delta is in Silver: other rows may be loaded over it."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_DELTA}' = 'merged')")


def load_bronze(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    landing: str,
    run: Run = Run(),
    *,
    single_file: bool = True,
    only_new: bool = False,
    discard: bool = False,
    parts: Iterator | None = None,
) -> BronzeReport:
    """Load one table's extract; an audit row is written whatever happens.

    The folder is listed once. The files of that listing are read, and entered in the ledger when
    the table is published; one that arrives meanwhile waits for the next load. ``single_file``
    insists on exactly one, ``only_new`` leaves out those in the ledger. Without a file to
    read the load is refused and the table stays as it was. ``discard`` deletes the files that were
    read once Bronze and the ledger have them, so that a large landing is not kept twice.

    ``parts`` fetches an extract that is too large for the landing: each step puts the files of a part into the folder. They are
    read into the load's own folder and deleted before the next step, and the table is published when there is
    no further part. A load that fails before that leaves the table as it was and has to fetch all parts again.

    After an earlier load, ``only_new`` leaves a delta in Bronze: the table holds the new files' rows
    alone. It is marked as such. Merging it into Silver (``plans/keyed``) takes the mark away; until then
    nothing is loaded over it, and a promotion, which would replace Silver by it, is refused.
    """
    target, delta = lake.table(lake.bronze, contract.name), False
    with audited(spark, lake, lake.bronze, run, target_table=target) as entry:
        folder = f"{landing.rstrip('/')}/{contract.folder}"
        if parts is not None and (single_file or not discard):
            raise ValueError("parts are files of their own and are discarded: single_file=False, discard=True")
        rows, paths = [], []

        def scans() -> Iterator[DataFrame]:
            nonlocal delta, paths
            for _ in [None] if parts is None else parts:
                listing = source_files(spark, folder)
                if only_new:
                    known = file_ledger(spark, lake).where(F.col("target_table") == target)
                    listing, delta = new_files(listing, known), not known.isEmpty()
                found = listing.collect()  # names, sizes and times of files
                paths = landed_paths(spark.createDataFrame(found, listing.schema), folder, single=single_file)
                if not rows:
                    entry["source_file_path"] = paths[0] if single_file else folder
                    if delta_waiting(spark, target):
                        raise ValueError(f"{target} holds a delta that is not merged yet; loading over it would lose its rows")
                    if delta:  # before its rows are there: a crash in between leaves a mark too many, not one too few
                        _mark_delta(spark, target)
                rows.extend(found)
                scan = scan_delimited(spark, paths, contract.source_schema, keep_corrupt=True)
                yield add_provenance(scan, entry["start_time"])
                if parts is not None:  # written: the next one takes its place
                    remove(spark, paths)
                    paths = []
            if not rows:
                raise FileNotFoundError(f"no .txt file to load in {folder}")

        report = write_bronze(spark, lake, contract.name, scans())
        if delta:
            _mark_delta(spark, target)
        files = spark.createDataFrame(rows, "path string, length bigint, modificationTime timestamp")
        record_files(files, lake, target, run.job_run_id, entry["start_time"])
        if discard:
            remove(spark, paths)
        entry["record_count"] = report.total_rows
        if report.malformed_rows:
            LOG.warning(report.message(contract.name))
        return report


OUTCOMES = (
    "table_name string, success boolean, record_count bigint, error string, malformed_rows bigint, "
    "cast_error_rows bigint, cast_error_pct double, top_columns array<struct<column_name: string, cast_failures: bigint>>"
)


@dataclass(frozen=True)
class Outcome:
    """One table's result. What a layer does not measure is missing."""

    table_name: str
    success: bool
    record_count: int
    error: str | None = None
    malformed_rows: int | None = None
    cast_error_rows: int | None = None
    cast_error_pct: float | None = None
    top_columns: list[tuple[str, int]] | None = None


def run_tables(
    spark: SparkSession,
    names: Iterable[str],
    load: Callable[[str], Outcome],
    *,
    fail_fast: bool = True,
    parallel: int = 1,
) -> DataFrame:
    """Run ``load`` for each table and return one outcome row per table.

    ``fail_fast`` re-raises the first error and starts no further table; otherwise
    errors are collected. Tables do not depend on each other, so with ``parallel`` > 1
    several submit their jobs at once and small tables fill the gaps large ones leave.
    """

    stop = Event()

    def attempt(name: str) -> Outcome | None:
        if stop.is_set():
            return None
        try:
            return load(name)
        except Exception as error:
            if fail_fast:
                stop.set()
                raise
            return Outcome(name, False, 0, str(error))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        started = [
            pool.submit(inheritable_thread_target(spark)(attempt), name) for name in sorted(names)
        ]
    outcomes = [future.result() for future in started]
    return spark.createDataFrame([astuple(o) for o in outcomes], OUTCOMES)


def load_all(
    spark: SparkSession,
    lake: Lake,
    registry: Registry,
    landing: str,
    run: Run = Run(),
    *,
    fail_fast: bool = True,
    parallel: int = 1,
    before: Callable[[str], object] | None = None,
    **options,
) -> DataFrame:
    """Load every table of a registry; ``options`` are those of ``load_bronze``.

    ``before`` is called with a table's name when its turn comes, to fetch its extract. With ``discard`` the
    landing then holds the extracts of ``parallel`` tables at a time. An iterator it returns fetches the extract by
    parts (``load_bronze``), and the landing holds a part of each.
    """

    def load(name: str) -> Outcome:
        fetched = before(name) if before else None
        parts = fetched if isinstance(fetched, Iterator) else None
        report = load_table(spark, lake, registry, name, landing, run, **options, parts=parts)
        return Outcome(name, True, report.total_rows, malformed_rows=report.malformed_rows)

    return run_tables(spark, registry.names(), load, fail_fast=fail_fast, parallel=parallel)


def load_table(
    spark: SparkSession,
    lake: Lake,
    registry: Registry,
    name: str,
    landing: str,
    run: Run = Run(),
    **options,
) -> BronzeReport:
    """Load one table by name, in any case and with stray spaces."""
    return load_bronze(spark, lake, registry.lookup(name), landing, run, **options)
