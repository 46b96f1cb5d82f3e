"""Declared constraints checked over the given tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import constraints as c
from siltworks.operators.projection import check_contract, project_contract, typed_columns
from siltworks.queries.checks import checked_names, checked_sql, columns_of
from siltworks.queries.inputs import (
    LINEITEM,
    LINEITEM_DIRTY,
    WIDE,
    WIDE_DIRTY,
    dirty,
    plain,
    table,
)
from siltworks.queries.typing import _shown, comparable

RUN_TIME = datetime(2024, 1, 31, 6, 30)
REFERENCES = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
]


def unique_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = project_contract(dirty(spark, sf_dir, LINEITEM_DIRTY), LINEITEM)
    return c.unique_key_violations(typed, LINEITEM.unique_keys[0])


KEY_SETS = [("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_quantity"), ("l_orderkey", "l_extendedprice"), ("l_returnflag",)]


def all_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four keys of one typed table in one pass; a missing value violates nothing."""
    typed = project_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE)
    found = c.all_key_violations(typed, KEY_SETS)
    return found.select("key", F.array_join("key_values", "|").alias("key_values"), "n_rows")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole tables against whole tables; labels cover only some of the documents."""
    named = [
        c.fk_orphans(table(spark, sf_dir, child), column, table(spark, sf_dir, parent), key).select(
            F.lit(f"{child}.{column}").alias("reference"), "key", "n_rows"
        )
        for child, column, parent, key in REFERENCES
    ]
    return reduce(lambda a, b: a.unionByName(b), named)


def not_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.not_null_audit(project_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE), WIDE)


def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE)
    return comparable(typed_columns(c.fill_defaults(checked, WIDE, RUN_TIME), WIDE))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE, keep_raw=True)
    return c.quarantined_rows(checked).withColumn(
        "failed_columns", F.array_join("failed_columns", ",")
    )


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_contract(dirty(spark, sf_dir, WIDE_DIRTY), WIDE)
    return comparable(c.valid_rows(checked, WIDE))


_WIDE = checked_sql(plain(WIDE_DIRTY), WIDE)
_NAMES = [n for n, _, _ in columns_of(WIDE)]
_REQUIRED = [n for n, _, required in columns_of(WIDE) if required]
_FILL = {
    "l_returnflag": "'blank'",
    "l_linestatus": "false",
    "l_discount": "cast(0 as decimal(4,2))",
    "l_shipts": "timestamp '2024-01-31 06:30:00'",
}


def _filled(name: str) -> str:
    """The default for a blank field; nothing for one that did not cast."""
    value = f"coalesce({name}, {_FILL[name]})"
    if name not in checked_names(WIDE):
        return f"{value} as {name}"
    return f"case when not {name}__cast_fail then {value} end as {name}"


def _quarantine_check() -> str:
    # Failing rows are told apart on the landed text, so it is carried beside the flags.
    raw = ", ".join(f"src.{n} as raw_{n}" for n in _NAMES)
    flags = checked_names(WIDE)
    both = checked_sql(plain(WIDE_DIRTY), WIDE).replace(" from (select ", f" from (select {raw}, ", 1)
    reasons = ", ".join(f"case when {n}__cast_fail then '{n}' end" for n in flags)
    shown = ", ".join(f"raw_{n} as {n}" for n in _NAMES)
    return f"select {shown}, concat_ws(',', {reasons}) as failed_columns from ({both}) where __row_failed"


QUERIES = {
    "unique_key_violations": (
        unique_key_violations,
        "select l_orderkey, cast(l_linenumber as int) as l_linenumber, count(*) as n_rows "
        "from lineitem group by 1, 2 having count(*) > 1",
    ),
    "all_key_violations": (
        all_key_violations,
        " union all ".join(
            f"select '{','.join(k)}' as key, {' || chr(124) || '.join(f'cast({x} as varchar)' for x in k)} as key_values, count(*) as n_rows "
            f"from ({_WIDE}) where {' and '.join(f'{x} is not null' for x in k)} group by {', '.join(k)} having count(*) > 1"
            for k in KEY_SETS
        ),
    ),
    "fk_orphans": (
        fk_orphans,
        " union all ".join(
            f"select '{child}.{column}' as reference, {column} as key, count(*) as n_rows from {child} "
            f"where {column} not in (select {key} from {parent}) group by 2"
            for child, column, parent, key in REFERENCES
        ),
    ),
    "not_null_audit": (
        not_null_audit,
        " union all ".join(
            f"select count(*) as total_rows, '{n}' as column_name, "
            f"count(*) - count({n}) as null_rows from typed"
            for n in _REQUIRED
        ).join([f"with typed as ({_WIDE}) ", ""]),
    ),
    "default_fill": (
        default_fill,
        "select "
        + ", ".join(
            _filled(n) if n in _FILL else _shown(n, k)
            for n, k, _ in columns_of(WIDE)
        )
        + f" from ({_WIDE})",
    ),
    "quarantine_rows": (quarantine_rows, _quarantine_check()),
    "valid_rows": (
        valid_rows,
        f"select {', '.join(_shown(n, k) for n, k, _ in columns_of(WIDE))} from ({_WIDE}) "
        "where not __row_failed",
    ),
}
