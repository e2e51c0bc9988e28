"""Literal inputs and results of the conversions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from quayload.functions import checks, temporal, zones
from quayload.operators import conform, quality
from quayload.policy import LoadPlan, PlannedColumn, PlanOptions, SourceType, TargetType


def evaluate(spark, rows, kind, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    out = df.select("i", *columns).orderBy("i").collect()
    return [tuple(r[1:]) if len(r) > 2 else r[1] for r in out]


V = F.col("v")


@pytest.mark.parametrize("rounding, expected", [
    ("two_step", [(25567, 2), (46174, 25498105), (46174, 25498106), (46174, 25498106), (46022, 0), (25566, 25919999)]),
    ("one_step", [(25567, 1), (46174, 25498105), (46174, 25498105), (46174, 25498106), (46022, 0), (25567, 0)]),
])
def test_datetime_rounding(spark, rounding, expected):
    micros = [4500, 1780529793684400, 1780529793684582, 1780529793685000, 1767311999999500, -1584]
    value = temporal.datetime_fragments(temporal.instant_from_units(V, "us"), rounding).value
    assert evaluate(spark, micros, "bigint", value["day"], value["fragments"]) == expected


def test_datetime_lower_bound_is_tested_before_rounding(spark):
    checked = temporal.datetime_fragments(temporal.instant_from_units(V, "us"), "two_step")
    got = evaluate(spark, [-6847804800001000, -6847804800000001, -6847804800000000, None], "bigint", checked.code)
    assert got == ["TimestampOutOfRange", "TimestampOutOfRange", None, None]


def test_datetime_text(spark):
    value = temporal.datetime_fragments(temporal.instant_from_units(V, "us"), "two_step").value
    got = evaluate(spark, [-315619200000000, 1700, 86399999000], "bigint", temporal.datetime_text(value))
    assert got == ["1960-01-01T00:00:00.000", "1970-01-01T00:00:00.003", "1970-01-02T00:00:00.000"]


@pytest.mark.parametrize("precision, unit, rule, value, expected", [
    (0, "us", None, 1600000, "1970-01-01T00:00:02"),
    (0, "us", None, 86399600000, "1970-01-02T00:00:00"),
    (3, "us", None, 1234567, "1970-01-01T00:00:01.235"),
    (3, "us", None, 86399999500, "1970-01-02T00:00:00.000"),
    (6, "ns", "reject", 1234567500, "1970-01-01T00:00:01.234568"),
    (6, "ns", "reject", 86399999999500, "1970-01-02T00:00:00.000000"),
    (7, "ns", "truncate", 123456789, "1970-01-01T00:00:00.1234567"),
    (7, "ns", "truncate", -149, "1969-12-31T23:59:59.9999998"),
    (7, "ms", None, -1, "1969-12-31T23:59:59.9990000"),
    (7, "ms", None, 86400123, "1970-01-02T00:00:00.1230000"),
    (3, "ms", None, -1, "1969-12-31T23:59:59.999"),
])
def test_datetime2(spark, precision, unit, rule, value, expected):
    instant = temporal.instant_from_nanos(V, rule) if unit == "ns" else temporal.instant_from_units(V, unit)
    checked = temporal.datetime2(instant, precision)
    assert evaluate(spark, [value], "bigint", temporal.datetime2_text(checked.value, precision)) == [expected]


def test_datetime2_extremes_do_not_overflow(spark):
    longs = [2**63 - 1, -(2**63)]
    for unit in ("s", "ms", "us"):
        code = temporal.datetime2(temporal.instant_from_units(V, unit), 0).code
        assert evaluate(spark, longs, "bigint", code) == ["TimestampOutOfRange"] * 2
    code = temporal.datetime2(temporal.instant_from_nanos(V, "round"), 7).code
    assert evaluate(spark, longs, "bigint", code) == [None, None]


def test_value_just_below_the_maximum_is_rounded_out_of_range(spark):
    last = 253402300799999
    checked = temporal.datetime2(temporal.instant_from_units(V, "ms"), 0)
    assert evaluate(spark, [last, last - 999], "bigint", checked.code) == ["TimestampOutOfRange", None]


@pytest.mark.parametrize("unit, value, expected", [
    ("s", 11111, "03:05:11"), ("ms", 11111111, "03:05:11.111"), ("us", 11111111111, "03:05:11.111111"),
    ("ns", 11111111111100, "03:05:11.1111111"), ("us", 86399999999, "23:59:59.999999"),
])
def test_times(spark, unit, value, expected):
    checked = temporal.time_of_day(V, unit)
    precision = temporal.TIME_PRECISION[unit]
    assert evaluate(spark, [value], "bigint", temporal.time_text(checked.value, precision)) == [expected]


def test_time_that_rounds_to_midnight_is_rejected(spark):
    checked = temporal.time_of_day(V, "ns", "round")
    assert evaluate(spark, [86399999999999, 86399999999949, 86400000000000, -1], "bigint", checked.code) == [
        "TimestampOutOfRange", None, "TimestampOutOfRange", "TimestampOutOfRange"]


@pytest.mark.parametrize("second, zone, expected", [
    (1738411200, "America/New_York", "2025-02-01T07:00:00.0000000-05:00"),
    (1750593600, "America/New_York", "2025-06-22T08:00:00.0000000-04:00"),
    (0, "+02:30", "1970-01-01T02:30:00.0000000+02:30"),
])
def test_offsets(spark, second, zone, expected):
    plan = LoadPlan((PlannedColumn(0, "v", True, SourceType("timestamp", unit="s", zone=zone),
                                   TargetType("datetimeoffset", precision=7)),), PlanOptions(timezone="offset"))
    df = spark.createDataFrame([(second,), (None,)], "v bigint")
    rows = conform.loadable(conform.conform_table(df, plan), plan).collect()
    assert sorted((r["v"] for r in rows), key=str) == sorted([expected, None], key=str)
    assert all(not r["errors"] for r in rows)


def test_unusable_zone_is_reported_for_null_cells(spark):
    plan = LoadPlan((PlannedColumn(0, "v", True, SourceType("timestamp", unit="us", zone="Mars/Olympus"),
                                   TargetType("datetimeoffset", precision=7)),), PlanOptions(timezone="offset"))
    df = spark.createDataFrame([(None,)], "v timestamp")
    assert conform.conform_table(df, plan).first()["errors"][0]["code"] == "TimezoneUnsupported"


@pytest.mark.parametrize("zone, code", [("Europe/Paris", None), ("+02:30", None), ("UTC", None), ("Mars/Olympus", "TimezoneUnsupported"), ("+15", "TimezoneUnsupported")])
def test_utc_policy_still_needs_a_usable_zone(spark, zone, code):
    plan = LoadPlan((PlannedColumn(0, "v", True, SourceType("timestamp", unit="s", zone=zone),
                                   TargetType("datetime2", precision=0)),), PlanOptions(timezone="utc"))
    df = spark.createDataFrame([(0,), (None,)], "v bigint")
    got = [r["v_code"] for r in conform.conform_columns(df, plan).collect()]
    assert got == [code, code]


def test_decimal_bytes_follow_the_value(spark):
    from quayload.operators import sizing

    digits = {1: 4, 9: 4, 10: 8, 19: 8, 20: 12, 28: 12, 29: 16, 38: 16}
    planned = PlannedColumn(0, "v", True, SourceType("decimal", precision=38, scale=2), TargetType("decimal", precision=38, scale=2))
    # As text: decimals of more than 34 digits do not survive the way into the session.
    values = [sign + "9" * n + "E-2" for n in digits for sign in ("", "-")] + [None]
    got = evaluate(spark, values, "string", sizing.cell_bytes(planned, V.cast("decimal(38,2)")))
    assert got == [2 + digits[n] for n in digits for _ in (1, -1)] + [1]


def test_zone_names(spark):
    names = ["Z", "utc", "+14:00", "+14:01", "+12:60", "-0030", "+5", "+05:3", "Europe/Paris", "EST5EDT", "PST",
             "UTC+1", "GMT0", " Europe/Paris", "Nowhere"]
    moment = F.lit("2024-07-01 00:00:00").cast("timestamp")
    offset = zones.zone_offset(moment, V)
    got = evaluate(spark, names, "string", offset.minutes)
    assert got == [0, 0, 840, None, None, -30, None, None, 120, -240, None, None, 0, None, None]
    codes = evaluate(spark, names, "string", offset.code)
    assert [c is None for c in codes] == [m is not None for m in got]


def test_decimals(spark):
    got = evaluate(spark, ["123456789012345678901234567890", "-5", None, "1" + "0" * 30], "string",
                   checks.wide_decimal(V, 30, 0).value, checks.wide_decimal(V, 30, 0).code)
    assert got == [(Decimal("123456789012345678901234567890"), None), (Decimal(-5), None), (None, None),
                   (None, "DecimalOutOfRange")]
    assert evaluate(spark, [123, -123, None], "bigint", checks.negative_scale_decimal(V, 5, 2).value) == [12300, -12300, None]
    value = [Decimal("123.45"), Decimal("1000.00"), None]
    assert evaluate(spark, value, "decimal(9,2)", checks.decimal(V, 5, 2).code) == [None, "DecimalOutOfRange", None]
    tiny = [Decimal("0." + "0" * 37 + "1"), None]
    assert evaluate(spark, tiny, "decimal(38,38)", checks.decimal(V, 38, 38).code) == ["DecimalOutOfRange", None]


def test_text_length_counts_utf16_units(spark):
    words = ["", "ascii", "東京", "emoji 😀", None]
    assert evaluate(spark, words, "string", checks.utf16_units(V)) == [0, 5, 2, 8, None]
    assert evaluate(spark, words, "string", checks.nvarchar(V, 7).code) == [None, None, None, "ValueTooLong", None]
    assert evaluate(spark, [b"", b"abc", b"abcd"], "binary", checks.fixed_binary(V, 3).code) == [
        "ValueTypeMismatch", None, "ValueTypeMismatch"]


def test_non_finite(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), None]
    assert evaluate(spark, values, "double", checks.finite(V, "double").code) == [
        None, "NonFiniteFloat", "NonFiniteFloat", "NonFiniteFloat", None]


def test_unsigned(spark):
    values = [Decimal(0), Decimal(2**63 - 1), Decimal(2**63), Decimal(2**64 - 1), None]
    assert evaluate(spark, values, "decimal(20,0)", checks.uint64_as_bigint(V).value) == [0, 2**63 - 1, None, None, None]
    assert evaluate(spark, [0, 255, 256, -1, None], "int", checks.tinyint(V).code) == [
        None, None, "IntegerOutOfRange", "IntegerOutOfRange", None]


def test_names(spark):
    names = ["", "bad\x07", "x" * 129, "x" * 128, "a]b"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: (r["problem"], r["quoted"]) for r in quality.name_audit(df, "name").collect()}
    assert [got[n][0] for n in names] == ["empty", "control_character", "too_long", None, None]
    assert got["a]b"][1] == "[a]]b]"


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_timestamps_without_zone_ignore_the_session_zone(utc, zone):
    df = utc.sql("SELECT * FROM VALUES (timestamp_ntz'2024-03-10 02:30:00.123456'), (timestamp_ntz'1969-12-31 23:59:59.999999'), "
                 "(timestamp_ntz'0001-01-01 00:00:00') AS t(v)")
    plan = LoadPlan((PlannedColumn(0, "v", True, SourceType("timestamp", unit="us"), TargetType("datetime2", precision=6)),))

    def texts():
        return sorted(r["v"] for r in conform.loadable(conform.conform_table(df, plan), plan).collect())

    expected = texts()
    assert expected[2] == "2024-03-10T02:30:00.123456"
    utc.conf.set("spark.sql.session.timeZone", zone)
    assert texts() == expected


def test_value_matrix(spark):
    """Smallest, largest, empty and missing values of six kinds in one table."""
    schema = T.StructType([
        T.StructField("flag", T.BooleanType()), T.StructField("i32", T.IntegerType()), T.StructField("i64", T.LongType()),
        T.StructField("f64", T.DoubleType()), T.StructField("text", T.StringType()), T.StructField("bytes", T.BinaryType())])
    rows = [(False, -2**31, -2**63, -123.5, "", b""), (True, 0, 0, 0.0, "ascii", b"\x00\x01\xfe\xff"),
            (True, 2**31 - 1, 2**63 - 1, 42.25, "東京", b"abc"), (None,) * 6]
    from quayload.operators.planning import plan_schema

    df = spark.createDataFrame(rows, schema)
    out = conform.conform_table(df, plan_schema(schema)).collect()
    assert all(not r["errors"] for r in out)
    key = str
    assert sorted((tuple(r[:6]) for r in out), key=key) == sorted(rows, key=key)
