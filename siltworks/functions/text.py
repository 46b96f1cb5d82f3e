"""Casts as SQL text: what the cast functions use of Columns, written down instead of built.

A Column is built by calls into the JVM, thousands for a wide contract; a projection given as text is parsed there in
one. The cast functions take this module in place of ``pyspark.sql.functions`` and return the same expressions.
"""

from __future__ import annotations

from pyspark.sql import types as T

from siltworks.contracts.model import quote


class Text:
    """A SQL expression with the operations of a Column that the casts use."""

    def __init__(self, sql: str):
        self.sql = sql

    def cast(self, target) -> Text:
        return Text(f"CAST({self.sql} AS {_type(target)})")

    def try_cast(self, target) -> Text:
        return Text(f"TRY_CAST({self.sql} AS {_type(target)})")

    def contains(self, mark: str) -> Text:
        return Text(f"CONTAINS({self.sql}, {_sql(mark)})")

    def rlike(self, pattern: str) -> Text:
        return Text(f"({self.sql} RLIKE {_sql(pattern)})")

    def isin(self, *values) -> Text:
        return Text(f"({self.sql} IN ({', '.join(map(_sql, values))}))")

    def between(self, low, high) -> Text:
        return Text(f"({self.sql} BETWEEN {_sql(low)} AND {_sql(high)})")

    def isNull(self) -> Text:
        return Text(f"({self.sql} IS NULL)")

    def isNotNull(self) -> Text:
        return Text(f"({self.sql} IS NOT NULL)")

    def alias(self, name: str) -> Text:
        return Text(f"{self.sql} AS {name_of(name)}")

    def __ne__(self, other) -> Text:
        return Text(f"({self.sql} <> {_sql(other)})")

    def __le__(self, other) -> Text:
        return Text(f"({self.sql} <= {_sql(other)})")

    def __or__(self, other) -> Text:
        return Text(f"({self.sql} OR {_sql(other)})")

    def __and__(self, other) -> Text:
        return Text(f"({self.sql} AND {_sql(other)})")


class When(Text):
    """CASE WHEN; without ``otherwise`` it is NULL where nothing holds."""

    def __init__(self, branches):
        self.branches = branches
        super().__init__(f"CASE {self._whens()} END")

    def _whens(self) -> str:
        return " ".join(f"WHEN {_sql(c)} THEN {_sql(v)}" for c, v in self.branches)

    def when(self, condition, value) -> When:
        return When([*self.branches, (condition, value)])

    def otherwise(self, value) -> Text:
        return Text(f"CASE {self._whens()} ELSE {_sql(value)} END")


def _type(target) -> str:
    return target.simpleString() if isinstance(target, T.DataType) else target


def _sql(value) -> str:
    if isinstance(value, Text):
        return value.sql
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}" if -(1 << 31) <= value < 1 << 31 else f"{value}L"
    return quote(value)


def name_of(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def col(name: str) -> Text:
    return Text(name_of(name))


def lit(value) -> Text:
    return Text("NULL" if value is None else _sql(value))


def when(condition, value) -> When:
    return When([(condition, value)])


def _call(name: str):
    def call(*arguments) -> Text:
        return Text(f"{name}({', '.join(map(_sql, arguments))})")

    return call


trim, lower, nullif, coalesce, concat, length = map(_call, ("trim", "lower", "nullif", "coalesce", "concat", "length"))
replace, regexp_replace, substring, substring_index = map(_call, ("replace", "regexp_replace", "substring", "substring_index"))
try_to_timestamp = _call("try_to_timestamp")
