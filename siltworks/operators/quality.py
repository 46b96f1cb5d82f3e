"""Cast-failure metrics and the gate that decides whether a load may be published."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators.projection import FAIL_SUFFIX, ROW_FAILED, flag_columns

TOP_COLUMNS = 10


def metric_columns(checked: DataFrame) -> list[Column]:
    """Aggregates usable both in ``agg`` and in ``observe``: one pass for all columns."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(ROW_FAILED)).alias("cast_error_rows"),
        *[F.count_if(F.col(c)).alias(c) for c in flag_columns(checked)],
    ]


def _percent(errors: Column, total: Column) -> Column:
    return F.when(total > 0, errors / total * F.lit(100.0)).otherwise(F.lit(0.0))


def dq_metrics(checked: DataFrame) -> DataFrame:
    """One row: totals, failing rows, their percentage and a count per checked column."""
    return checked.agg(*metric_columns(checked)).withColumn(
        "cast_error_pct", _percent(F.col("cast_error_rows"), F.col("total_rows"))
    )


def dq_by_column(checked: DataFrame) -> DataFrame:
    """One row per column that has failures, in contract order (``position``)."""
    flags = flag_columns(checked)
    counts = checked.agg(*[F.count_if(F.col(c)).alias(c) for c in flags])
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c.removesuffix(FAIL_SUFFIX)).alias("column_name"),
                F.col(c).alias("cast_failures"),
            )
            for i, c in enumerate(flags)
        ]
    )
    return counts.select(F.inline(entries)).filter("cast_failures > 0")


def dq_top_columns(checked: DataFrame, n: int = TOP_COLUMNS) -> DataFrame:
    """The n columns with most failures; ties keep contract order."""
    return dq_by_column(checked).orderBy(F.desc("cast_failures"), "position").limit(n)


@dataclass(frozen=True)
class Gate:
    """Publishing limits. A limit of 0 is off; unarmed, the gate never refuses."""

    armed: bool = False
    max_rows: int = 0
    max_pct: float = 0.0

    def _breaches(self, rows, pct) -> list:
        # Works on plain numbers and on Columns alike.
        limits = []
        if self.max_rows > 0:
            limits.append(rows > self.max_rows)
        if self.max_pct > 0:
            limits.append(pct > self.max_pct)
        return limits or [rows > 0]

    def refuses(self, rows: int, pct: float) -> bool:
        return self.armed and rows > 0 and any(self._breaches(rows, pct))

    def refuses_column(self, rows: Column, pct: Column) -> Column:
        if not self.armed:
            return F.lit(False)
        return reduce(or_, self._breaches(rows, pct))


def dq_gate(checked: DataFrame, gates: Mapping[str, Gate]) -> DataFrame:
    """The verdict of each named gate over one pass of the data."""
    rows, pct = F.col("cast_error_rows"), F.col("cast_error_pct")
    verdicts = F.array(
        *[
            F.struct(
                F.lit(name).alias("gate"),
                F.lit(g.armed).alias("armed"),
                F.lit(g.max_rows).cast("bigint").alias("max_rows"),
                F.lit(g.max_pct).cast("double").alias("max_pct"),
                g.refuses_column(rows, pct).alias("refused"),
            )
            for name, g in gates.items()
        ]
    )
    return dq_metrics(checked).select(
        "total_rows", "cast_error_rows", F.inline(verdicts)
    )


class GateRefused(ValueError):
    """Raised instead of publishing a load whose cast failures exceed the limits."""


@dataclass(frozen=True)
class DqReport:
    total_rows: int
    cast_error_rows: int
    column_failures: Mapping[str, int]

    @staticmethod
    def of(metrics: Mapping[str, int | None]) -> DqReport:
        return DqReport(
            total_rows=int(metrics.get("total_rows") or 0),
            cast_error_rows=int(metrics.get("cast_error_rows") or 0),
            column_failures={
                k.removesuffix(FAIL_SUFFIX): int(v)
                for k, v in metrics.items()
                if k.endswith(FAIL_SUFFIX) and v
            },
        )

    @property
    def cast_error_pct(self) -> float:
        return self.cast_error_rows / self.total_rows * 100.0 if self.total_rows else 0.0

    def top_columns(self, n: int = TOP_COLUMNS) -> list[tuple[str, int]]:
        return sorted(self.column_failures.items(), key=lambda kv: -kv[1])[:n]

    def message(self, table: str) -> str:
        return (
            f"{table}: {self.cast_error_rows} of {self.total_rows} rows failed a cast "
            f"({self.cast_error_pct:.4f}%); most failing columns: {self.top_columns()}"
        )

    def enforce(self, gate: Gate, table: str) -> None:
        if gate.refuses(self.cast_error_rows, self.cast_error_pct):
            raise GateRefused(self.message(table))
