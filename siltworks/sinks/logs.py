"""Append-only logs: catalog tables partitioned by day, with a folder for each append.

Loads that end at the same time, in one job or in several, would remove each other's files
if they shared a commit folder. An append therefore writes a folder of its own and enters it
as a partition; a report over one day reads that day's folders only. ``compact`` makes
one folder of each closed day.

Appends of a day are numbered as they are entered: the catalog takes a number once, and the one who comes second takes
the next. So all numbers up to the last are there, and a folder made of appends 1 to m is entered as ``m-all``, by one
statement: readers go by the last such entry and the numbers beyond it. Appends it covers are hidden from
then on, whether they are still in the catalog or not.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts.model import quote
from siltworks.sinks.lake import Lake

RUN_DATE = "run_date"
APPEND = "append"
ALL = "-all"


@dataclass(frozen=True)
class AppendLog:
    lake: Lake
    schema: str
    name: str
    columns: T.StructType

    @property
    def folder(self) -> str:
        return f"{self.lake.root.rstrip('/')}/{self.schema}/{self.name}"

    def ensure(self, spark: SparkSession) -> str:
        table = self.lake.table(self.schema, self.name)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({ddl}, `{RUN_DATE}` DATE, `{APPEND}` STRING) USING parquet "
            f"PARTITIONED BY (`{RUN_DATE}`, `{APPEND}`) LOCATION {quote(self.folder)}"
        )
        return table

    def append(self, rows: DataFrame, day: date) -> None:
        """Add rows to a day: one task and one small file."""
        spark, table = rows.sparkSession, self.ensure(rows.sparkSession)
        folder = self._written(rows, day)
        while True:
            number = 1 + max((_upto(a) for a in appends_of(spark, table, day)), default=0)
            try:
                self._enter(spark, table, day, f"{number:012d}", folder)
                return
            except AnalysisException as error:
                if "ALREADY_EXIST" not in (error.getCondition() or "").upper():
                    raise

    def _written(self, rows: DataFrame, day: date) -> str:
        folder = f"{self.folder}/{RUN_DATE}={day}/{APPEND}={uuid.uuid4().hex}"
        rows.select(*self.columns.names).coalesce(1).write.parquet(folder)
        return folder

    def _enter(self, spark: SparkSession, table: str, day: date, name: str, folder: str) -> None:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({RUN_DATE} = DATE'{day}', {APPEND} = {quote(name)}) LOCATION {quote(folder)}")
        spark.catalog.refreshTable(table)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows with their day; a filter on ``run_date`` is answered from the catalog."""
        table = self.ensure(spark)
        spark.catalog.refreshTable(table)
        rows = spark.table(table)
        for day, appends in hidden_appends(spark, table).items():
            rows = rows.where(~((F.col(RUN_DATE) == F.lit(day).cast("date")) & F.col(APPEND).isin(appends)))
        return rows.drop(APPEND)

    def compact(self, spark: SparkSession, before: date) -> list[str]:
        """Make one append of each day before ``before`` that has several; returns the days.

        A reader sees the day's appends or the folder made of them, each row once. Old folders stay on disk.
        """
        table, done = self.ensure(spark), []
        for day, appends in sorted(appends_by_day(spark, table).items()):
            closed = date.fromisoformat(day)
            shown = [a for a in appends if a not in covered(appends) and _upto(a)]
            if closed < before and len(shown) > 1:
                rows = spark.table(table).where((F.col(RUN_DATE) == F.lit(day).cast("date")) & F.col(APPEND).isin(shown))
                folder = self._written(rows, closed)
                self._enter(spark, table, closed, f"{max(map(_upto, shown)):012d}{ALL}", folder)
                done.append(day)
                appends = appends_of(spark, table, closed)
            for name in covered(appends):
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({RUN_DATE} = DATE'{day}', {APPEND} = {quote(name)})")
        spark.catalog.refreshTable(table)
        return done


def _upto(append: str) -> int:
    """The last number an append holds; 0 for one without a number."""
    digits = append.removesuffix(ALL)
    return int(digits) if digits.isdigit() else 0


def covered(appends: list[str]) -> list[str]:
    """Appends that a folder made of them has replaced."""
    last = max((_upto(a) for a in appends if a.endswith(ALL)), default=0)
    keep = f"{last:012d}{ALL}"
    return [a for a in appends if 0 < _upto(a) <= last and a != keep]


def appends_by_day(spark: SparkSession, table: str, only: str = "") -> dict[str, list[str]]:
    days: dict[str, list[str]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}{only}").collect():
        parts = dict(p.split("=", 1) for p in row["partition"].split("/"))
        days.setdefault(parts[RUN_DATE], []).append(parts[APPEND])
    return days


def appends_of(spark: SparkSession, table: str, day: date) -> list[str]:
    return appends_by_day(spark, table, f" PARTITION ({RUN_DATE} = DATE'{day}')").get(str(day), [])


def hidden_appends(spark: SparkSession, table: str) -> dict[str, list[str]]:
    """Appends of each day that readers leave out. Empty but while a day is being compacted, or after that was cut short."""
    found = {day: covered(appends) for day, appends in appends_by_day(spark, table).items()}
    return {day: names for day, names in sorted(found.items()) if names}
