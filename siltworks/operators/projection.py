"""Projection of landed text onto a contract, with failure flags."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import Contract
from siltworks.functions import clean, parse, prepare, text

ROW_FAILED = "__row_failed"
FAIL_SUFFIX = "__cast_fail"
RAW_PREFIX = "__raw_"


def fail_flag(column: str) -> str:
    return column + FAIL_SUFFIX


def _found(columns: Sequence[str], contract: Contract) -> dict[str, int]:
    """Where the contract's columns are among a source's."""
    # Names are matched without regard to case; of two that collide the later one wins.
    positions = {name.lower(): i for i, name in enumerate(columns)}
    found = {}
    for f in contract.schema:
        at = positions.get(contract.source_name(f.name).lower(), positions.get(f.name.lower()))
        if at is not None:
            found[f.name] = at
    return found


def _checked(present: Collection[str], contract: Contract) -> list[str]:
    return [
        f.name
        for f in contract.schema
        if (f.name in present and not isinstance(f.dataType, T.StringType))
        or (f.name not in present and not f.nullable)
    ]


def checked_columns(source: DataFrame, contract: Contract) -> list[str]:
    """Columns that can fail: non-string ones present in the source, required ones absent."""
    return _checked(_found(source.columns, contract), contract)


def absent_columns(source: DataFrame, contract: Contract) -> list[str]:
    """Contract columns the source does not have."""
    present = _found(source.columns, contract)
    return [f.name for f in contract.schema if f.name not in present]


def check_contract(source: DataFrame, contract: Contract, keep_raw: bool = False) -> DataFrame:
    """Typed contract columns, a flag per checked column and one per row.

    ``<column>__cast_fail`` is true where a non-blank value did not cast, and for every
    row where a required column is absent from the source. ``__row_failed`` is true
    where any flag is. ``keep_raw`` carries the landed text along as ``__raw_<column>``.

    The projections are SQL text, worked out once for a contract and a header, so that a wide contract costs a few calls.
    Every cast step is a select of its own. They stay separate in the plan: Catalyst
    does not merge a projection into the next when that would compute a value twice.
    """
    # Positional names sidestep duplicates and names that would need quoting.
    rows = source.toDF(*[f"c{i}" for i in range(len(source.columns))])
    for step in _steps(contract.to_json(), tuple(source.columns), keep_raw):
        rows = rows.selectExpr(*step)
    return rows


@lru_cache(maxsize=256)
def _steps(contract_json: str, columns: tuple[str, ...], keep_raw: bool) -> tuple[tuple[str, ...], ...]:
    """The projections of ``check_contract`` as SQL text, worked out once for a contract and a source's header."""
    contract = Contract.from_json(contract_json)
    present = _found(columns, contract)
    checked = _checked(present, contract)
    raw = [RAW_PREFIX + name for name in present if keep_raw]
    kept = [text.name_of(c) for c in raw]
    types = {f.name: f.dataType for f in contract.schema}

    def failed(name: str) -> text.Text:
        if name not in present:
            return text.lit(True)
        return text.col(_had_text(name)) & text.col(name).isNull()

    any_failed = reduce(or_, [failed(name) for name in checked], text.lit(False))
    landed = [text.col(f"c{at}").cast("string").alias(RAW_PREFIX + name) for name, at in present.items() if keep_raw]
    cleaned = [clean(text.col(f"c{at}"), text).alias(name) for name, at in present.items()]
    prepared = [prepare(text.col(c), types[c], text).alias(c) for c in present]
    typed = [(parse(text.col(c), t, text) if c in present else text.lit(None).cast(t)).alias(c) for c, t in types.items()]
    had = [text.col(c).isNotNull().alias(_had_text(c)) for c in checked if c in present]
    flags = [failed(name).alias(fail_flag(name)) for name in checked]
    steps = (
        [x.sql for x in (*cleaned, *landed)],
        [*(x.sql for x in prepared), *kept],
        [*(x.sql for x in (*typed, *had)), *kept],
        [*map(text.name_of, contract.schema.names), *(x.sql for x in flags), *kept, any_failed.alias(ROW_FAILED).sql],
    )
    return tuple(tuple(step) for step in steps if step)


def _had_text(name: str) -> str:
    return name + "__had_text"


def project_contract(source: DataFrame, contract: Contract) -> DataFrame:
    """Only the typed contract columns, in contract order."""
    return typed_columns(check_contract(source, contract), contract)


def typed_columns(checked: DataFrame, contract: Contract) -> DataFrame:
    return checked.select(*contract.schema.names)


def raw_names(checked: DataFrame) -> list[str]:
    """Columns of a ``keep_raw`` check whose landed text is carried along."""
    return [c.removeprefix(RAW_PREFIX) for c in checked.columns if c.startswith(RAW_PREFIX)]


def flag_columns(checked: DataFrame) -> list[str]:
    return [c for c in checked.columns if c.endswith(FAIL_SUFFIX)]


def failed_columns(checked: DataFrame) -> Column:
    """Names of the failing columns of a row, in contract order."""
    return F.array_compact(
        F.array(
            *[F.when(F.col(c), F.lit(c.removesuffix(FAIL_SUFFIX))) for c in flag_columns(checked)]
        ).cast("array<string>")
    )
