"""Checks of the constraints a contract declares: keys, references, required columns."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.contracts import Contract
from siltworks.operators.projection import (
    RAW_PREFIX,
    ROW_FAILED,
    fail_flag,
    failed_columns,
    flag_columns,
    raw_names,
    typed_columns,
)


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count.

    Counting combines before the shuffle, so one key holding much of the table still
    sends one partial count per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def all_key_violations(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Values of any of several unique keys that more than one row holds: key, key_values, n_rows.

    One scan and one exchange for all keys, as grouping sets: tasks count their own rows of every key before
    any is sent. A row with a NULL in a key's columns does not violate that key, as in SQL. ``key`` names the
    key's columns, ``key_values`` gives them as text.
    """
    sets = [list(k) for k in keys]
    columns = list(dict.fromkeys(c for k in sets for c in k))
    counted = df.groupingSets([[F.col(c) for c in k] for k in sets], *columns).agg(
        F.grouping_id(*columns).alias("__set"), F.count(F.lit(1)).alias("n_rows")
    )
    # A set's number has a 1 for each column that is not in it.
    number = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in k): k for k in sets}
    whole = [(F.col("__set") == n) & reduce(and_, [F.col(c).isNotNull() for c in k]) for n, k in number.items()]
    of_set = lambda value: F.coalesce(*[F.when(F.col("__set") == n, value(k)) for n, k in number.items()])
    return counted.where((F.col("n_rows") > 1) & reduce(or_, whole)).select(
        of_set(lambda k: F.lit(",".join(k))).alias("key"),
        of_set(lambda k: F.array(*[F.col(c).cast("string") for c in k])).alias("key_values"),
        "n_rows",
    )


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values the parent lacks, with the number of rows holding each.

    The child is reduced to one row per key first. That removes skew before the join,
    and the anti join reuses the aggregate's partitioning. Whether the parent is
    broadcast is left to Spark's size check.
    """
    held = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).cast(held.schema["key"].dataType).alias("key"))
    return held.join(known, "key", "left_anti")


def not_null_audit(typed: DataFrame, contract: Contract) -> DataFrame:
    """NULL count of each required column, zero counts included."""
    required = contract.required
    counts = typed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in required],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in required]
    )
    return counts.select("total_rows", F.inline(entries))


def default_value(contract: Contract, column: str, run_time: datetime) -> Column:
    """A column's declared default; the clock is the run's, the same for every row."""
    text = contract.defaults[column]
    target = contract.schema[column].dataType
    if text.strip().lower() in ("current_timestamp()", "now()"):
        return F.lit(run_time).cast(target)
    return F.expr(text).cast(target)


def fill_defaults(
    checked: DataFrame, contract: Contract, run_time: datetime, absent: Collection[str] = ()
) -> DataFrame:
    """Declared defaults where the landed field was blank or its column is ``absent``.

    ``checked`` is a ``check_contract`` result. A value that did not cast stays NULL: the default
    would be a value nobody sent.
    """
    flags = set(flag_columns(checked))

    def filled(c: str) -> Column:
        value = F.coalesce(F.col(c), default_value(contract, c, run_time))
        if c in absent or fail_flag(c) not in flags:
            return value
        return F.when(~F.col(fail_flag(c)), value)

    return checked.withColumns({c: filled(c) for c in contract.defaults if c in checked.columns})


def _cast_once(checked: DataFrame) -> DataFrame:
    """Keeps a later filter on the flags above the casts.

    Pushed below them it would compute every cast a second time. A filter does not
    move past an observed count, and the count itself costs next to nothing.
    """
    return checked.observe(f"rows_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def failing_rows(checked: DataFrame) -> DataFrame:
    return _cast_once(checked).filter(F.col(ROW_FAILED))


def valid_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    return typed_columns(_cast_once(checked).filter(~F.col(ROW_FAILED)), contract)


def quarantined_rows(checked: DataFrame) -> DataFrame:
    """Failing rows as landed (``check_contract(keep_raw=True)``) and what failed in them."""
    return failing_rows(checked).select(
        *[F.col(RAW_PREFIX + c).alias(c) for c in raw_names(checked)],
        failed_columns(checked).alias("failed_columns"),
    )
