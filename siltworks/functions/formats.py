"""Date and time layouts accepted from source files."""

from __future__ import annotations

import re

# Timestamp layouts, in the order they are tried.
TIMESTAMP_FORMATS = (
    "MMM dd yyyy h:mm:ss:SSSa",
    "MMM d yyyy h:mm:ss:SSSa",
    "MMM dd yyyy hh:mm:ss:SSSa",
    "MMM d yyyy hh:mm:ss:SSSa",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd",
)

# Date-only layouts, tried after the date-and-time ones.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "MM-dd-yyyy",
    "yyyyMMdd",
    "MMM dd yyyy",
    "MMM d yyyy",
)

# Two-digit fields in the ranges a strict parser takes.
_MONTH = r"(0[1-9]|1[0-2])"
_DAY = r"(0[1-9]|[12]\d|3[01])"
_HOUR = r"([01]\d|2[0-3])"
_SIXTY = r"[0-5]\d"

# Text in the numeric layouts above with a four-digit year. Spark's own cast reads the
# first as it stands and the others once their date is put in ISO order, several times
# faster than a layout parser and with the same result.
_CLOCK = rf"{_HOUR}:{_SIXTY}(:{_SIXTY})?"
ISO_TEXT = (
    rf"^\d{{4}}-{_MONTH}-{_DAY}( {_CLOCK}|T{_HOUR}:{_SIXTY}:{_SIXTY}(\.\d{{1,3}})?)?$"
)
US_MOMENT_TEXT = rf"^{_MONTH}/{_DAY}/\d{{4}} {_CLOCK}$"
US_TEXT = rf"^{_MONTH}/{_DAY}/\d{{4}}( {_CLOCK})?$"

# Whitespace other than single blanks.
UNEVEN_SPACE = ("  ", "\t", "\n", "\x0b", "\f", "\r")

# What each layout token can look like. Every entry admits at least all the text the
# parser would take for it, so a value outside the shape can never parse.
_TOKENS = {
    "yyyy": r"[+-]?\d{4,}",
    "MMM": r"\p{L}+\.?",
    "MM": _MONTH,
    "dd": _DAY,
    "d": r"0*([1-9]|[12]\d|3[01])",
    "HH": _HOUR,
    "hh": r"(0[1-9]|1[0-2])",
    "h": r"0*([1-9]|1[0-2])",
    "mm": _SIXTY,
    "ss": _SIXTY,
    "SSS": r"\d+",
    "a": r"\D+",
}
_TOKEN = re.compile(r"'([^']*)'|([A-Za-z])\2*|[^A-Za-z']")


def shape(layout: str) -> str:
    """A regular expression every text that parses under ``layout`` matches."""
    parts = []
    for m in _TOKEN.finditer(layout):
        quoted, token = m.group(1), m.group(0)
        if quoted is not None:
            parts.append(re.escape(quoted))
        elif token in _TOKENS:
            parts.append(_TOKENS[token])
        else:
            parts.append(re.escape(token))
    return "(?i)^" + "".join(parts) + "$"


def any_width(layout: str) -> str:
    """The layout with day and hour of one or two digits. Its value is the same for all text the stricter one takes."""
    return re.sub(r"\bhh\b", "h", re.sub(r"\bdd\b", "d", layout))


def starts_with_month_name(layout: str) -> bool:
    return layout.startswith("MMM")
