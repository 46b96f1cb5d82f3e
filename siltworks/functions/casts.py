"""Safe casts from landed text to contract types.

Every function maps a Column to a Column of built-in expressions, so the same code
runs in batch and streaming plans. With ``functions.text`` for ``f`` they map SQL text to SQL text. A value that does not fit becomes NULL; nothing
raises, with ANSI mode on or off.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.formats import (
    DATE_FORMATS,
    ISO_TEXT,
    TIMESTAMP_FORMATS,
    UNEVEN_SPACE,
    US_MOMENT_TEXT,
    US_TEXT,
    any_width,
    shape,
    starts_with_month_name,
)

# Accepted numeric texts and boolean spellings.
INTEGER_TEXT = r"^[+-]?\d+(\.0+)?$"
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)$"
PARENTHESISED = r"^\((.*)\)$"
TRUE_TEXT = ("1", "1.0", "true", "t", "y", "yes")
FALSE_TEXT = ("0", "0.0", "false", "f", "n", "no")

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_WHOLE = tuple(_BITS)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_NUMERIC = _WHOLE + _FRACTIONAL


def empty_to_null(col: Column) -> Column:
    """Blank text (nothing but spaces) becomes NULL; other text is left as it is."""
    text = col.cast("string")
    return F.when(F.trim(text) != "", text)


def clean(col: Column, f=F) -> Column:
    """Trimmed text, NULL when blank. Casts expect their input in this form."""
    return f.nullif(f.trim(col.cast("string")), f.lit(""))


# A cast runs in two steps, each reading its input more than once. Only a value that is
# a column of its own is computed once for all readers, so a projection over many
# columns makes one select per step; ``cast_text`` nests them.


def prepare(cleaned: Column, target: T.DataType, f=F) -> Column:
    """Text in the one spelling ``parse`` knows.

    Numbers lose separators and dollar signs, and parenthesised ones become negative;
    booleans lose case; dates and times have single blanks.
    """
    if isinstance(target, _NUMERIC):
        bare = _without(_without(cleaned, ",", f), "$", f)
        signed = f.regexp_replace(bare, PARENTHESISED, "-$1")
        return f.trim(f.when(cleaned.contains("("), signed).otherwise(bare))
    if isinstance(target, T.BooleanType):
        return f.lower(cleaned)
    if isinstance(target, (T.TimestampType, T.DateType)):
        uneven = reduce(or_, [cleaned.contains(space) for space in UNEVEN_SPACE])
        return f.when(uneven, f.regexp_replace(cleaned, r"\s+", " ")).otherwise(cleaned)
    return cleaned


def _without(text: Column, mark: str, f=F) -> Column:
    return f.replace(text, f.lit(mark), f.lit(""))


def parse(text: Column, target: T.DataType, f=F) -> Column:
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, T.BooleanType):
        return _boolean(text, f)
    if isinstance(target, _WHOLE):
        return _integer(text, target, f)
    if isinstance(target, _FRACTIONAL):
        return f.when(text.rlike(DECIMAL_TEXT), text.try_cast(target))
    if isinstance(target, T.TimestampType):
        return _moment(text, US_MOMENT_TEXT, _first_parse(text, TIMESTAMP_FORMATS, _by_layout, f), f)
    if isinstance(target, T.DateType):
        return _date(text, f)
    return text.try_cast(target)


def cast_text(cleaned: Column, target: T.DataType, f=F) -> Column:
    """The whole cast of one ``clean`` column."""
    return parse(prepare(cleaned, target, f), target, f)


def _boolean(text: Column, f=F) -> Column:
    return f.when(text.isin(*TRUE_TEXT), f.lit(True)).when(text.isin(*FALSE_TEXT), f.lit(False))


def _integer(text: Column, target: T.DataType, f=F) -> Column:
    """Range-checked by comparison: a try_cast that overflows throws and catches per row."""
    # The fraction is all zeros when the gate passes, so cutting it off is exact.
    whole = f.substring_index(text, ".", 1)
    bound = 2 ** (_BITS[type(target)] - 1)

    def in_range(value: Column) -> Column:
        return f.when(value.between(f.lit(-bound), f.lit(bound - 1)), value.cast(target))

    # Eighteen characters always fit a long; longer text may be zeros or too large.
    short = whole.try_cast(T.LongType())
    return f.when(
        text.rlike(INTEGER_TEXT),
        f.when(f.length(text) <= 18, short if bound == 2**63 else in_range(short)).otherwise(
            in_range(whole.try_cast(T.DecimalType(38, 0)))
        ),
    )


def _first_parse(text: Column, layouts: tuple[str, ...], attempt, f=F) -> Column:
    """The first layout that parses.

    A failed parse costs a thrown exception per row, so each layout is only tried on
    text of its shape. Layouts that begin with a month name and layouts that begin
    with a digit cannot both match, which halves the shapes to look at. Of named layouts that
    differ in the width of day and hour only the widest is tried: it takes all their text.
    """

    def first(some):
        return f.coalesce(*[f.when(text.rlike(shape(x)), attempt(text, x, f)) for x in some])

    named = list(dict.fromkeys(any_width(x) for x in layouts if starts_with_month_name(x)))
    numeric = [x for x in layouts if not starts_with_month_name(x)]
    return f.when(text.rlike(r"^\p{L}"), first(named)).otherwise(first(numeric))


def _by_layout(text: Column, layout: str, f=F) -> Column:
    return f.try_to_timestamp(text, f.lit(layout)).cast(T.TimestampType())


def _moment(text: Column, us_text: str, otherwise: Column, f=F) -> Column:
    """Everyday numeric layouts by a plain cast, ``otherwise`` for the rest."""
    iso_order = f.concat(
        f.substring(text, 7, 4),
        f.lit("-"),
        f.substring(text, 1, 2),
        f.lit("-"),
        f.substring(text, 4, 2),
        f.substring(text, 11, 9),
    )
    return (
        f.when(text.rlike(ISO_TEXT), text.try_cast(T.TimestampType()))
        .when(text.rlike(us_text), iso_order.try_cast(T.TimestampType()))
        .otherwise(otherwise)
    )


def _date(text: Column, f=F) -> Column:
    # The date-only layout of the timestamp list comes back as the first of the date list.
    with_time = tuple(x for x in TIMESTAMP_FORMATS if x not in DATE_FORMATS)
    by_layout = f.coalesce(
        _first_parse(text, with_time, _by_layout, f),
        _first_parse(text, DATE_FORMATS, _by_layout, f),
    )
    return _moment(text, US_TEXT, by_layout, f).cast(T.DateType())
