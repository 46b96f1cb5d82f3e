"""Casts, projection and cast-failure metrics over spoiled text (lazy, one scan each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import declared
from siltworks.functions import clean, empty_to_null
from siltworks.operators.constraints import failing_rows
from siltworks.operators.projection import (
    ROW_FAILED,
    check_contract,
    fail_flag,
    project_contract,
)
from siltworks.operators.quality import Gate, dq_by_column, dq_gate, dq_metrics, dq_top_columns
from siltworks.queries.checks import (
    blank,
    cast_sql,
    checked_names,
    checked_sql,
    columns_of,
)
from siltworks.queries.inputs import (
    EVENTS,
    EVENTS_DIRTY,
    FEEDS,
    LINEITEM,
    LINEITEM_DIRTY,
    WIDE,
    WIDE_DIRTY,
    WIDE_MISSING,
    dirty,
    feed_sql,
    plain,
)


def comparable(df: DataFrame) -> DataFrame:
    """Session-zone times as plain ones and floats as decimals, so engines print alike."""
    casts = {"timestamp": "timestamp_ntz", "float": "decimal(18,4)"}
    return df.select(
        *[
            F.col(f.name).cast(casts[f.dataType.simpleString()]).alias(f.name)
            if f.dataType.simpleString() in casts
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE)


_WIDE_CHECK = checked_sql(plain(WIDE_DIRTY), WIDE)
_WIDE_FLAGS = checked_names(WIDE)


def _shown(name: str, kind: str) -> str:
    return f"cast({name} as decimal(18,4)) as {name}" if kind == "FLOAT" else name


def _of_types(*types: str):
    """Query and check for the wide table's columns of some types, with their flags."""
    picked = [(n, k) for n, k, _ in columns_of(WIDE) if k.split("(")[0].lower() in types]
    names = [n for n, _ in picked]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _checked(spark, sf_dir)
        return comparable(df.select(*names, *[fail_flag(n) for n in names]))

    shown = ", ".join([_shown(n, k) for n, k in picked] + [fail_flag(n) for n in names])
    return run, f"select {shown} from ({_WIDE_CHECK})"


def cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(spark, sf_dir, WIDE_DIRTY).select(clean(F.col("l_returnflag")).alias("flag_text"))


def empty_to_null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(spark, sf_dir, WIDE_DIRTY).select(
        *[empty_to_null(F.col(c)).alias(c) for c in ("l_returnflag", "l_suppkey", "l_linestatus")]
    )


def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = check_contract(dirty(spark, sf_dir, EVENTS_DIRTY), EVENTS)
    return comparable(df.select("event_id", "ts", fail_flag("ts")))


def cast_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(project_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE))


def contract_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Absent columns become typed NULLs, surplus ones go, order is the contract's.
    source = dirty(spark, sf_dir, LINEITEM_DIRTY)
    return project_contract(source, WIDE_MISSING)


def cast_fail_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("l_orderkey", *[fail_flag(c) for c in _WIDE_FLAGS])


def missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_contract(dirty(spark, sf_dir, LINEITEM_DIRTY), WIDE_MISSING)
    return dq_by_column(checked)


def row_fail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_contract(dirty(spark, sf_dir, LINEITEM_DIRTY), LINEITEM)
    return failing_rows(checked).select(*LINEITEM.schema.names)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_metrics(_checked(spark, sf_dir))


def by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_by_column(_checked(spark, sf_dir))


def top_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_top_columns(_checked(spark, sf_dir))


GATES = {
    "report_only": Gate(armed=False, max_rows=1, max_pct=0.1),
    "no_limits": Gate(armed=True),
    "rows_exceeded": Gate(armed=True, max_rows=10),
    "rows_within": Gate(armed=True, max_rows=10**15),
    "pct_exceeded": Gate(armed=True, max_pct=5.0),
    "pct_within": Gate(armed=True, max_pct=99.5),
    "either": Gate(armed=True, max_rows=10**15, max_pct=5.0),
}


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_contract(dirty(spark, sf_dir, LINEITEM_DIRTY), LINEITEM)
    return dq_gate(checked, GATES)


def _counts(names) -> str:
    return ", ".join(f"cast(count(*) filter (where {fail_flag(n)}) as bigint) as {fail_flag(n)}" for n in names)


def _long(source: str, names) -> str:
    rows = " union all ".join(
        f"select cast({i} as int) as position, '{n}' as column_name, {fail_flag(n)} as cast_failures from counts"
        for i, n in enumerate(names)
    )
    return (
        f"with counts as (select {_counts(names)} from ({source})) "
        f"select * from ({rows}) where cast_failures > 0"
    )


def _gate_check() -> str:
    source = checked_sql(plain(LINEITEM_DIRTY), LINEITEM)
    rows = []
    for name, g in GATES.items():
        limits = []
        if g.max_rows:
            limits.append(f"bad > {g.max_rows}")
        if g.max_pct:
            limits.append(f"total > 0 and 100.0 * bad / total > {g.max_pct}")
        refused = f"({' or '.join(limits) or 'bad > 0'})" if g.armed else "false"
        rows.append(
            f"select total as total_rows, bad as cast_error_rows, '{name}' as gate, "
            f"{str(g.armed).lower()} as armed, cast({g.max_rows} as bigint) as max_rows, "
            f"cast({g.max_pct} as double) as max_pct, {refused} as refused from m"
        )
    return (
        "with m as (select count(*) as total, cast(count(*) filter (where __row_failed) as bigint) as bad "
        f"from ({source})) " + " union all ".join(rows)
    )


def _feed(name: str):
    contract = declared().lookup(name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = check_contract(dirty(spark, sf_dir, feed_sql(name)), contract)
        return comparable(checked.select(*contract.schema.names, F.col(ROW_FAILED).alias("row_failed")))

    names = ", ".join(n for n, _, _ in columns_of(contract))
    check = checked_sql(plain(feed_sql(name)), contract)
    return run, f"select {names}, __row_failed as row_failed from ({check})"


_LINEITEM_CHECK = checked_sql(plain(LINEITEM_DIRTY), LINEITEM)
_MISSING_CHECK = checked_sql(plain(LINEITEM_DIRTY), WIDE_MISSING, absent=("comment", "batch"))

QUERIES = {
    "empty_to_null": (
        empty_to_null_text,
        "select "
        + ", ".join(
            f"case when trim({c}) <> '' then {c} end as {c}"
            for c in ("l_returnflag", "l_suppkey", "l_linestatus")
        )
        + f" from ({plain(WIDE_DIRTY)})",
    ),
    "cast_string": (
        cast_string,
        f"select {blank('l_returnflag')} as flag_text from ({plain(WIDE_DIRTY)})",
    ),
    "cast_integer": _of_types("tinyint", "smallint", "int", "bigint"),
    "cast_decimal": _of_types("decimal"),
    "cast_double": _of_types("double", "float"),
    "cast_boolean": _of_types("boolean"),
    "cast_date": _of_types("date"),
    "cast_timestamp": (
        cast_timestamp,
        f"select event_id, ts, ts__cast_fail from ({checked_sql(plain(EVENTS_DIRTY), EVENTS)})",
    ),
    "cast_timestamp_styles": _of_types("timestamp"),
    "cast_all_types": (
        cast_all_types,
        f"select {', '.join(_shown(n, k) for n, k, _ in columns_of(WIDE))} from ({_WIDE_CHECK})",
    ),
    "contract_projection": (
        contract_projection,
        f"select l_orderkey, price, comment, batch from ({_MISSING_CHECK})",
    ),
    "cast_fail_flags": (
        cast_fail_flags,
        f"select l_orderkey, {', '.join(fail_flag(n) for n in _WIDE_FLAGS)} from ({_WIDE_CHECK})",
    ),
    "missing_required": (
        missing_required,
        _long(_MISSING_CHECK, checked_names(WIDE_MISSING, absent=("comment", "batch"))),
    ),
    "row_fail_rows": (
        row_fail_rows,
        "select l_orderkey, l_linenumber, price, shipdate, flag "
        f"from ({_LINEITEM_CHECK}) where __row_failed",
    ),
    "dq_metrics": (
        metrics,
        "select total_rows, cast_error_rows, "
        + ", ".join(fail_flag(n) for n in _WIDE_FLAGS)
        + ", case when total_rows > 0 then cast_error_rows / total_rows * 100.0 else 0.0 end as cast_error_pct"
        " from (select count(*) as total_rows, "
        "cast(count(*) filter (where __row_failed) as bigint) as cast_error_rows, "
        f"{_counts(_WIDE_FLAGS)} from ({_WIDE_CHECK}))",
    ),
    "dq_by_column": (by_column, _long(_WIDE_CHECK, _WIDE_FLAGS)),
    "dq_top_columns": (
        top_columns,
        _long(_WIDE_CHECK, _WIDE_FLAGS) + " order by cast_failures desc, position limit 10",
    ),
    "dq_gate": (gates, _gate_check()),
    **{f"silver_{name}": _feed(name) for name in FEEDS},
}
