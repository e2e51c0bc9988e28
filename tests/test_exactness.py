"""Conversions of many values, extremes included, against whole-number arithmetic in Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quayload.functions import exact, temporal, zones

TICKS = {"s": 10_000_000, "ms": 10_000, "us": 10}
DAY = 864_000_000_000
LONGS = [0, 1, -1, 2**63 - 1, -(2**63)]


def values(unit, seed):
    """Random longs, and values close to every bound."""
    rng = random.Random(seed)
    size = TICKS[unit]
    bounds = [-719_162 * DAY, (3_652_059 - 719_162) * DAY, (-53_690 - 25_567) * DAY, (2_958_464 - 25_567) * DAY, 0]
    near = [b // size + rng.randint(-3, 3) for b in bounds for _ in range(40)]
    near += [b // size + rng.randint(-20_000, 20_000) for b in bounds for _ in range(200)]
    wide = [rng.randint(-(2**63), 2**63 - 1) for _ in range(200)]
    inside = [rng.randint(bounds[0] // size, bounds[1] // size) for _ in range(2_000)]
    return LONGS + near + wide + inside


def half_up(ticks, factor):
    return (2 * ticks + factor) // (2 * factor)


def expected_datetime2(ticks, precision):
    factor = 10 ** (7 - precision)
    rounded = half_up(ticks, factor) * factor
    day, rest = divmod(rounded, DAY)
    if ticks < -719_162 * DAY or not 0 <= day + 719_162 <= 3_652_058:
        return "TimestampOutOfRange", None, None
    return None, day + 719_162, rest // factor


def expected_datetime(ticks, rounding):
    if rounding == "two_step":
        fragments = half_up(half_up(ticks, 10_000) * 10_000 * 300, 10_000_000)
    else:
        fragments = half_up(ticks * 300, 10_000_000)
    day, rest = divmod(fragments, 25_920_000)
    if ticks < (-53_690 - 25_567) * DAY or not -53_690 <= day + 25_567 <= 2_958_463:
        return "TimestampOutOfRange", None, None
    return None, day + 25_567, rest


def run(spark, unit, seed, build, part):
    data = values(unit, seed)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v long").repartition(4)
    checked = build(temporal.instant_from_units(F.col("v"), unit))
    rows = df.select("i", checked.code.alias("c"), checked.value["day"].alias("d"), checked.value[part].alias("p")).collect()
    return [(data[r["i"]] * TICKS[unit], (r["c"], r["d"], r["p"])) for r in rows]


@pytest.mark.parametrize("unit", ["s", "ms", "us"])
@pytest.mark.parametrize("precision", [0, 1, 4, 6, 7])
def test_datetime2(spark, unit, precision):
    for ticks, got in run(spark, unit, precision, lambda i: temporal.datetime2(i, precision), "increments"):
        assert got == expected_datetime2(ticks, precision)


@pytest.mark.parametrize("unit", ["s", "ms", "us"])
@pytest.mark.parametrize("rounding", ["two_step", "one_step"])
def test_datetime(spark, unit, rounding):
    for ticks, got in run(spark, unit, 9, lambda i: temporal.datetime_fragments(i, rounding), "fragments"):
        assert got == expected_datetime(ticks, rounding)


@pytest.mark.parametrize("rule", ["round", "truncate"])
def test_datetime_from_100ns(spark, rule):
    rng = random.Random(5)
    data = LONGS + [rng.randint(-(2**63), 2**63 - 1) for _ in range(3_000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v long")
    checked = temporal.datetime2(temporal.instant_from_nanos(F.col("v"), rule), 3)
    for row in df.select("i", checked.code.alias("c"), checked.value["day"].alias("d"), checked.value["increments"].alias("p")).collect():
        ticks = half_up(data[row["i"]], 100) if rule == "round" else data[row["i"]] // 100
        assert (row["c"], row["d"], row["p"]) == expected_datetime2(ticks, 3)


@pytest.mark.parametrize("divisor", [1, 7, 100, 86_400_000_000])
def test_floor_division(spark, divisor):
    rng = random.Random(divisor)
    data = LONGS + [rng.randint(-(2**63), 2**63 - 1) for _ in range(500)] + list(range(-30, 30))
    df = spark.createDataFrame([(v,) for v in data], "v long")
    for row in df.select("v", exact.floor_div(F.col("v"), divisor).alias("q"), exact.floor_mod(F.col("v"), divisor).alias("r")).collect():
        assert (row["q"], row["r"]) == divmod(row["v"], divisor)


def test_sums_stop_at_the_limits(spark):
    df = spark.createDataFrame([(0, 2**63 - 1), (0, 5), (1, -(2**63)), (1, -5), (2, 7), (3, None)], "k int, v long")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact.saturated_sum(F.col("v")).alias("s")).collect()}
    assert got == {0: 2**63 - 1, 1: -(2**63), 2: 7, 3: None}


def test_offsets_of_named_zones(spark):
    """Random instants of 1970 to 2036 against Python's own zone data."""
    zoneinfo = pytest.importorskip("zoneinfo")
    names = ["America/New_York", "Europe/London", "Australia/Lord_Howe", "Asia/Kathmandu", "Pacific/Apia", "America/St_Johns"]
    available = zoneinfo.available_timezones()
    names = [n for n in names if n in available]
    if not names:
        pytest.skip("no zone data")
    rng = random.Random(11)
    data = [(i, n, rng.randint(0, 2_082_758_400)) for i, n in enumerate(names * 400)]
    df = spark.createDataFrame(data, "i int, zone string, s long")
    offset = zones.zone_offset(F.timestamp_seconds("s"), F.col("zone"))
    for row in df.select("i", offset.minutes.alias("m"), offset.code.alias("c")).collect():
        _, name, second = data[row["i"]]
        moment = datetime.datetime.fromtimestamp(second, zoneinfo.ZoneInfo(name))
        assert (row["m"], row["c"]) == (moment.utcoffset().total_seconds() // 60, None)


def test_values_a_conversion_would_change_are_refused(spark):
    """Carriers out of an unsigned range, decimals of another scale, text that is no whole number."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from quayload.functions import checks

    def codes(values, kind, rule):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        checked = rule(F.col("v"))
        return [(r["value"], r["code"]) for r in df.select(checked.value.alias("value"), checked.code.alias("code")).collect()]

    bad = (None, "IntegerOutOfRange")
    assert codes([-5, 0, 65535, 70000, None], "int", lambda c: checks.unsigned(c, 16, "int")) == [bad, (0, None), (65535, None), bad, (None, None)]
    assert codes([-7, 2**32 - 1, 2**40], "long", lambda c: checks.unsigned(c, 32, "bigint")) == [bad, (2**32 - 1, None), bad]
    most = Decimal(2**64 - 1)
    got = codes([Decimal(-1), most, Decimal(5 * 10**19)], "decimal(20,0)", checks.uint64_as_decimal)
    assert got == [bad, (most, None), bad]
    assert codes([Decimal("12.345"), Decimal("12.300")], "decimal(9,3)", lambda c: checks.decimal(c, 5, 1)) == [
        (None, "SchemaMismatch"), (Decimal("12.3"), None)]
    got = codes(["1.5", "15", "-3", "", "1e3", None], "string", lambda c: checks.wide_decimal(c, 9, 1))
    wrong = (None, "ValueTypeMismatch")
    assert got == [wrong, (Decimal("1.5"), None), (Decimal("-0.3"), None), wrong, wrong, (None, None)]


def test_deltas_and_drift_at_the_limits(spark):
    from quayload.operators import drift, telemetry

    top = 2**63 - 1
    first = spark.createDataFrame([("w", -top, 0, 5)], "wait_type string, waiting_tasks_count long, wait_time_ms long, signal_wait_time_ms long")
    last = spark.createDataFrame([("w", top, 9, 5)], first.schema)
    row = telemetry.wait_deltas(first, last, []).first()
    assert (row["waiting_tasks_count"], row["wait_time_ms"], row["signal_wait_time_ms"]) == (top, 9, 0)
    schema = drift.CATALOG_SCHEMA + ", claimed_ordinal long"
    plan = spark.createDataFrame([("t", 0, "a", "int", True, None, None, 0)], schema)
    unknown = spark.createDataFrame([("t", 0, None, None, None, None, None, None)], schema)
    assert {r["difference"] for r in drift.target_drift(plan, unknown).collect()} == {"ordinal", "name", "nullability"}
    assert [r["difference"] for r in drift.target_type_drift(plan, unknown).collect()] == ["type"]
    assert [r["reason"] for r in drift.schema_drift(plan, unknown).collect()] == ["name"]
