"""SQL for the checks: the casts in the check tool's own functions.

These texts are written from the accepted values, not from the Spark expressions, and
gate by pattern first because the tool's own parsers accept more.
"""

from __future__ import annotations

from siltworks.contracts import Contract


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def number(x: str) -> str:
    bare = f"replace(replace({blank(x)}, ',', ''), '$', '')"
    return f"trim(regexp_replace({bare}, '^\\((.*)\\)$', '-\\1'))"


def integer(x: str, kind: str) -> str:
    n = number(x)
    return (
        f"case when regexp_full_match({n}, '[+-]?\\d+(\\.0+)?') "
        f"then try_cast(split_part({n}, '.', 1) as {kind}) end"
    )


def fractional(x: str, kind: str) -> str:
    n = number(x)
    return (
        f"case when regexp_full_match({n}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)') "
        f"then try_cast({n} as {kind}) end"
    )


def boolean(x: str) -> str:
    b = f"lower({blank(x)})"
    return (
        f"case when {b} in ('1','1.0','true','t','y','yes') then true "
        f"when {b} in ('0','0.0','false','f','n','no') then false end"
    )


_ISO = "\\d{4}-\\d{2}-\\d{2}"
_US = "\\d{2}/\\d{2}/\\d{4}"
_HM = "\\d{2}:\\d{2}"
_NAMED = "[A-Za-z]{3} \\d{1,2} \\d{4}"

_MOMENTS = (
    (f"{_NAMED} \\d{{1,2}}:\\d{{2}}:\\d{{2}}:\\d{{1,3}}[AaPp][Mm]", "%b %d %Y %I:%M:%S:%g%p"),
    (f"{_ISO} {_HM}:\\d{{2}}", "%Y-%m-%d %H:%M:%S"),
    (f"{_ISO} {_HM}", "%Y-%m-%d %H:%M"),
    (f"{_US} {_HM}:\\d{{2}}", "%m/%d/%Y %H:%M:%S"),
    (f"{_US} {_HM}", "%m/%d/%Y %H:%M"),
    (f"{_ISO}T{_HM}:\\d{{2}}", "%Y-%m-%dT%H:%M:%S"),
    (f"{_ISO}T{_HM}:\\d{{2}}\\.\\d{{1,3}}", "%Y-%m-%dT%H:%M:%S.%f"),
)
_DAYS = (
    (_ISO, "%Y-%m-%d"),
    (_US, "%m/%d/%Y"),
    ("\\d{2}-\\d{2}-\\d{4}", "%m-%d-%Y"),
    ("\\d{8}", "%Y%m%d"),
    (_NAMED, "%b %d %Y"),
)


def _parse(x: str, layouts) -> str:
    t = f"regexp_replace({blank(x)}, '\\s+', ' ', 'g')"
    tries = [
        f"case when regexp_full_match({t}, '{shape}') then try_strptime({t}, '{layout}') end"
        for shape, layout in layouts
    ]
    return f"coalesce({', '.join(tries)})"


def timestamp(x: str) -> str:
    return f"cast({_parse(x, (*_MOMENTS, _DAYS[0]))} as timestamp)"


def date(x: str) -> str:
    return f"cast({_parse(x, (*_MOMENTS, *_DAYS))} as date)"


def cast_sql(x: str, kind: str) -> str:
    kind = kind.lower()
    if kind == "string":
        return blank(x)
    if kind == "boolean":
        return boolean(x)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return integer(x, kind)
    if kind in ("float", "double") or kind.startswith("decimal"):
        return fractional(x, kind)
    if kind == "timestamp":
        return timestamp(x)
    return date(x)


def columns_of(contract: Contract) -> list[tuple[str, str, bool]]:
    """(name, type, required) read from the contract's column list."""
    # A comma inside decimal(p,s) is not followed by a space, one between columns is.
    parts = [part.split() for part in " ".join(contract.columns.split()).split(", ")]
    return [(words[0], words[1], words[2:] == ["NOT", "NULL"]) for words in parts]


def checked_sql(source: str, contract: Contract, absent: tuple[str, ...] = ()) -> str:
    """Typed columns, ``<c>__cast_fail`` per checked column and ``__row_failed``."""
    typed, flags = [], []
    for name, kind, required in columns_of(contract):
        if name in absent:
            typed.append(f"cast(null as {kind}) as {name}")
            if required:
                flags.append((name, "true"))
            continue
        x = f"src.{contract.source_name(name).lower()}"
        typed.append(f"{cast_sql(x, kind)} as {name}")
        if kind.lower() != "string":
            flags.append((name, f"({blank(x)} is not null and ({cast_sql(x, kind)}) is null)"))
    flag_list = ", ".join(f"{test} as {name}__cast_fail" for name, test in flags)
    any_flag = " or ".join(f"{name}__cast_fail" for name, _ in flags) or "false"
    return (
        f"select *, ({any_flag}) as __row_failed from ("
        f"select {', '.join(typed)}{', ' + flag_list if flags else ''} from ({source}) src)"
    )


def checked_names(contract: Contract, absent: tuple[str, ...] = ()) -> list[str]:
    return [
        n
        for n, kind, required in columns_of(contract)
        if (n in absent and required) or (n not in absent and kind.lower() != "string")
    ]
