from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import cast_text, clean, empty_to_null, parse, prepare, text
from siltworks.functions.formats import DATE_FORMATS, TIMESTAMP_FORMATS, shape

D = Decimal

CASES = {
    "int": [
        ("7", 7), ("+7", 7), ("-7", -7), ("1,234", 1234), ("$5", 5), ("(5)", -5), ("12.0", 12),
        ("12.000", 12), (" 9 ", 9), ("$ 5", 5), ("($1,000)", -1000), ("2147483647", 2147483647),
        ("-2147483648", -2147483648), ("0000000000000000000000007", 7),
        ("12.7", None), ("1e3", None), ("abc", None), ("99999999999", None), ("2147483648", None),
        ("(-5)", None), ("- 5", None), ("--5", None), ("5-", None), ("\t", None), (".", None),
        ("99999999999999999999999999999999999999999999", None), ("12.", None), ("", None), ("  ", None),
    ],
    "tinyint": [("127", 127), ("-128", -128), ("300", None), ("128", None), ("1.0", 1)],
    "smallint": [("32767", 32767), ("32768", None), ("(12)", -12)],
    "bigint": [
        ("9223372036854775807", 9223372036854775807), ("-9223372036854775808", -9223372036854775808),
        ("9223372036854775808", None), ("123456789012345678.00", 123456789012345678),
    ],
    "decimal(4,2)": [
        ("1.235", D("1.24")), ("-1.235", D("-1.24")), (".5", D("0.50")), ("1.", D("1.00")),
        ("$1.50", D("1.50")), ("(1.50)", D("-1.50")), ("1,0.5", D("10.50")), ("99.994", D("99.99")),
        ("123.45", None), ("99.995", None), (".", None), ("N/A", None), ("1e5", None), ("", None),
    ],
    "double": [
        ("1.", 1.0), (".5", 0.5), ("+3", 3.0), ("-.5", -0.5), ("1,000.25", 1000.25),
        ("1e5", None), ("NaN", None), ("Infinity", None), (".", None), (" ", None),
    ],
    "float": [("1.5", 1.5), ("(2.5)", -2.5), ("x", None)],
    "boolean": [
        *[(v, True) for v in ("1", "1.0", "true", "T", "y", "YES", " Yes ")],
        *[(v, False) for v in ("0", "0.0", "false", "F", "n", "NO")],
        ("maybe", None), ("2", None), ("", None), ("1.00", None),
    ],
    "timestamp": [
        ("Jan  5 2024 12:00:00:000AM", datetime(2024, 1, 5)),
        ("JAN 15 2024 1:05:09:123PM", datetime(2024, 1, 15, 13, 5, 9, 123000)),
        ("Jan 15 2024 01:05:09:5pm", datetime(2024, 1, 15, 13, 5, 9, 500000)),
        ("Jan 05 2024 12:30:00:000PM", datetime(2024, 1, 5, 12, 30)),
        ("2024-01-05 10:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05 10:00:59", datetime(2024, 1, 5, 10, 0, 59)),
        ("2024-01-05T10:00:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05t10:00:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05T10:00:00.5", datetime(2024, 1, 5, 10, 0, 0, 500000)),
        ("01/05/2024 10:00", datetime(2024, 1, 5, 10)),
        ("01/05/2024   10:00:07", datetime(2024, 1, 5, 10, 0, 7)),
        ("2024-01-05", datetime(2024, 1, 5)),
        (" 2024-01-05 10:00:00 ", datetime(2024, 1, 5, 10)),
        ("2024-01-05\t10:00:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05 10:00:00.123", None), ("01/05/2024", None), ("1/5/2024 10:00", None),
        ("2024-01-05T10:00:00Z", None), ("2024-01-05T10:00", None), ("2024-02-30", None),
        ("2024-13-01", None), ("2024-01-05 24:00:00", None), ("2024-01-05 10:60", None),
        ("Jan 32 2024 1:00:00:000AM", None), ("Jan 5 2024 13:00:00:000AM", None),
        ("Foo 5 2024 1:00:00:000AM", None), ("20240105", None), ("now", None), ("", None), ("  ", None),
    ],
    "date": [
        ("2024-01-05", date(2024, 1, 5)), ("01/05/2024", date(2024, 1, 5)),
        ("01-05-2024", date(2024, 1, 5)), ("20240105", date(2024, 1, 5)),
        ("Jan 5 2024", date(2024, 1, 5)), ("jan  05 2024", date(2024, 1, 5)),
        ("Jan  5 2024 12:00:00:000AM", date(2024, 1, 5)), ("2024-01-05 23:59", date(2024, 1, 5)),
        ("01/05/2024 23:59:59", date(2024, 1, 5)), ("2024-01-05T10:00:00.25", date(2024, 1, 5)),
        ("2024-1-5", None), ("garbage", None), ("2023-02-29", None), ("02/30/2024", None),
        ("2024-01-05 24:00", None), ("2024-01-05 10", None), ("20241305", None), ("", None),
    ],
}


@pytest.mark.parametrize("kind", CASES)
def test_cast_table(spark, kind):
    target = T.StructType.fromDDL(f"v {kind}")["v"].dataType
    rows = [(i, text) for i, (text, _) in enumerate(CASES[kind])]
    df = spark.createDataFrame(rows, "i int, text string").repartition(2)
    value = cast_text(clean(F.col("text")), target)
    got = dict(df.select("i", value.alias("v")).collect())
    for i, (text, want) in enumerate(CASES[kind]):
        assert got[i] == want, (kind, text, got[i], want)


def test_casts_do_not_depend_on_ansi_mode(spark):
    df = spark.createDataFrame([("99999999999",), ("x",), ("2024-02-30",)], "t string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            rows = df.select(
                cast_text(clean(F.col("t")), T.IntegerType()), cast_text(clean(F.col("t")), T.DateType())
            ).collect()
            assert {v for r in rows for v in r} == {None}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_other_types_use_a_plain_safe_cast(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00.123",), ("bad",)], "t string")
    got = [r[0] for r in df.select(cast_text(clean(F.col("t")), T.TimestampNTZType())).collect()]
    assert got == [datetime(2024, 1, 5, 10, 0, 0, 123000), None]


def test_blank_text(spark):
    df = spark.createDataFrame([("",), ("   ",), ("\t",), (" a ",), (None,)], "t string")
    rows = df.select(empty_to_null(F.col("t")), clean(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (None, None), (None, None), ("\t", "\t"), (" a ", "a"), (None, None),
    ]


def _spellings():
    """Texts in and around every layout: all field values at their edges and beyond."""
    days = ["00", "01", "9", "09", "28", "29", "30", "31", "32", "001", "-1", "+5"]
    months = ["00", "01", "1", "02", "04", "12", "13"]
    years = ["0000", "0001", "1582", "1900", "2023", "2024", "9999", "10000", "+10000", "-0001", "24"]
    clocks = ["00:00", "23:59", "24:00", "7:05", "10:00:59", "10:00:60", "10:60:00", "10:00:00.1",
              "10:00:00.1234", "10:00:00,5", "10", "10:00:00 ", "10:00:00Z"]
    named = ["12:00:00:000AM", "0:00:00:000AM", "13:00:00:000PM", "1:05:09:1pm", "01:05:09:1234PM", "1:05:09PM"]
    names = ["Jan", "FEB", "sept", "Sep", "March", "xyz"]
    out = []
    for y in years:
        for m in months:
            for d in days:
                out += [f"{y}-{m}-{d}", f"{m}/{d}/{y}", f"{m}-{d}-{y}", f"{y}{m}{d}"]
    for y in years:
        for d in days:
            out += [f"{n} {d} {y}" for n in names]
            out += [f"{n} {d} {y} {c}" for n in names[:3] for c in named]
    for c in clocks:
        for sep in (" ", "T", "t", "  ", ""):
            out += [f"2024-02-29{sep}{c}", f"02/29/2024{sep}{c}", f"02-29-2024{sep}{c}", f"10000-02-28{sep}{c}"]
    return sorted(set(out))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_shortcuts_agree_with_trying_every_layout(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = _spellings() + ["2024-03-10 02:30:00", "03/10/2024 02:30"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
        t = F.regexp_replace(clean(F.col("t")), r"\s+", " ")
        moments = [F.try_to_timestamp(t, F.lit(f)) for f in TIMESTAMP_FORMATS]
        days = [F.try_to_date(t, f) for f in DATE_FORMATS]
        with_time = [m for m, f in zip(moments, TIMESTAMP_FORMATS) if f not in DATE_FORMATS]
        got = df.select(
            "t",
            cast_text(clean(F.col("t")), T.TimestampType()).cast("string").alias("ts"),
            F.coalesce(*moments).cast("string").alias("ts_all"),
            cast_text(clean(F.col("t")), T.DateType()).cast("string").alias("d"),
            F.coalesce(F.coalesce(*with_time).cast("date"), *days).cast("string").alias("d_all"),
        )
        wrong = got.filter(~F.col("ts").eqNullSafe(F.col("ts_all")) | ~F.col("d").eqNullSafe(F.col("d_all")))
        assert wrong.collect() == []
        assert got.filter("ts is not null").count() > 100
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_shape_of_a_layout():
    assert shape("yyyy-MM-dd'T'HH:mm").startswith("(?i)^[+-]?")
    assert "T" in shape("yyyy-MM-dd'T'HH:mm")


@pytest.mark.parametrize("kind", ["string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(9,3)", "date", "timestamp", "timestamp_ntz"])
def test_text_is_the_same_expression(spark, kind):
    """Each cast step written as SQL text gives the plan that its Columns give."""
    target = T.StructType.fromDDL(f"x {kind}")[0].dataType
    df = spark.createDataFrame([("1",)], "t string")

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().canonicalized().toString()

    for step in (lambda c, f: clean(c, f), lambda c, f: prepare(c, target, f), lambda c, f: parse(c, target, f), lambda c, f: cast_text(clean(c, f), target, f)):
        assert plan(df.selectExpr(step(text.col("t"), text).alias("x").sql)) == plan(df.select(step(F.col("t"), F).alias("x")))
