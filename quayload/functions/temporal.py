"""Dates, times and instants.

An instant is a raw count of units, split into a day since 1970-01-01 and 100 ns
ticks within that day. All fit a long for every 64-bit source value, so nothing
here can overflow, and a rounding that carries into the next day is a plain
``+ 1``. Whether a value is in range is told from the raw count alone, by two
constants that allow for the rounding: a filter on violations stays cheap.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, SparkSession, functions as F

from quayload import policy as P
from quayload.functions.checks import Checked, code_when
from quayload.functions.exact import floor_div, floor_mod, quotient
from quayload.functions.hold import DECODED, JUDGED, ROUNDED, SCALED, SPLIT, Holder, inline

# 100 ns ticks, and the day numbers of the target's calendars.
TICKS_PER_DAY = 864_000_000_000
TICKS_PER_UNIT = {"s": 10_000_000, "ms": 10_000, "us": 10}
UNITS_PER_DAY = {"s": 86_400, "ms": 86_400_000, "us": 86_400_000_000, "ns": 86_400_000_000_000}
TIME_PRECISION = {"s": 0, "ms": 3, "us": 6, "ns": 7}
EPOCH_DAY_FROM_0001 = 719_162
MAX_DAY_FROM_0001 = 3_652_058
EPOCH_DAY_FROM_1900 = 25_567
MIN_DAY_FROM_1900 = -53_690
MAX_DAY_FROM_1900 = 2_958_463
FRAGMENTS_PER_DAY = 25_920_000
FIRST_TICK = -EPOCH_DAY_FROM_0001 * TICKS_PER_DAY
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00")


@dataclass(frozen=True)
class Instant:
    """``raw`` counts units of ``unit_ticks`` x 100 ns since the epoch. ``day`` and
    ``ticks`` split it; ``code`` marks a value lost on the way."""

    raw: Column
    unit_ticks: int
    day: Column
    ticks: Column
    code: Column | None = None

    def outside(self, first_tick: int, last_tick: int) -> Column:
        """Whether the raw value lies outside two ticks: a comparison with constants."""
        low = -(-first_tick // self.unit_ticks)
        return ~self.raw.between(F.lit(low), F.lit(last_tick // self.unit_ticks))


def _split(raw: Column, unit_ticks: int, hold: Holder, code: Column | None = None) -> Instant:
    per_day = TICKS_PER_DAY // unit_ticks
    ticks = floor_mod(raw, per_day)
    return Instant(
        raw, unit_ticks, hold(SPLIT, floor_div(raw, per_day)),
        hold(SPLIT, ticks * unit_ticks if unit_ticks > 1 else ticks), code,
    )


def instant_from_units(value: Column, unit: str, hold: Holder = inline) -> Instant:
    """Seconds, milliseconds or microseconds since the epoch."""
    return _split(value.cast("bigint"), TICKS_PER_UNIT[unit], hold)


def instant_from_nanos(value: Column, nanosecond: str, hold: Holder = inline) -> Instant:
    """Nanoseconds since the epoch, brought to 100 ns under the policy."""
    ticks, code = nanos_to_ticks(value.cast("bigint"), nanosecond)
    return _split(hold(DECODED, ticks), 1, hold, code)


def instant_from_ntz(value: Column, hold: Holder = inline) -> Instant:
    """Timestamp without zone, whatever the session's zone is.

    In a UTC session the wall clock is the instant, and one cast decodes it. In
    any other session the fields are read, as that cast would apply the zone.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        micros = F.unix_micros(value.cast("timestamp"))
    else:
        day = F.unix_date(value.cast("date")).cast("bigint")
        minutes = (F.hour(value) * 60 + F.minute(value)).cast("bigint")
        seconds = F.extract(F.lit("SECOND"), value).cast("decimal(18,6)") * F.lit(1_000_000)
        micros = day * 86_400_000_000 + minutes * 60_000_000 + seconds.cast("bigint")
    return instant_from_units(hold(DECODED, micros), "us", hold)


def instant_from_timestamp(value: Column, hold: Holder = inline) -> Instant:
    """Timestamp with zone: already an instant on the UTC line."""
    return instant_from_units(hold(DECODED, F.unix_micros(value)), "us", hold)


def nanos_to_ticks(value: Column, nanosecond: str) -> tuple[Column, Column | None]:
    """100 ns ticks and, where the policy forbids the loss, a code."""
    base, rest = floor_div(value, 100), floor_mod(value, 100)
    if nanosecond == "round":
        return base + F.when(rest >= 50, F.lit(1)).otherwise(F.lit(0)).cast("bigint"), None
    if nanosecond == "truncate":
        return base, None
    return base, code_when(rest != 0, P.LOSSY)


def date_number(value: Column, hold: Holder = inline) -> Checked:
    """Day number from 0001-01-01 of a date, which must lie in 0001..9999."""
    day = F.unix_date(value) + EPOCH_DAY_FROM_0001
    code = hold(JUDGED, code_when(~day.between(0, MAX_DAY_FROM_0001), P.TIMESTAMP_RANGE))
    return Checked(F.when(code.isNull(), day), code)


def date64_midnight(value: Column, hold: Holder = inline) -> Checked:
    """Milliseconds as a date day number; anything but midnight is lossy."""
    value = value.cast("bigint")
    day = floor_div(value, UNITS_PER_DAY["ms"]) + EPOCH_DAY_FROM_0001
    code = hold(JUDGED, F.when(
        floor_mod(value, UNITS_PER_DAY["ms"]) != 0, F.lit(P.LOSSY)
    ).when(~day.between(0, MAX_DAY_FROM_0001), F.lit(P.TIMESTAMP_RANGE)))
    return Checked(F.when(code.isNull(), day.cast("int")), code)


def time_of_day(value: Column, unit: str, nanosecond: str = "reject", hold: Holder = inline) -> Checked:
    """Increments since midnight at time(0/3/6/7); a full day is out of range."""
    value = value.cast("bigint")
    outside = ~value.between(0, UNITS_PER_DAY[unit] - 1)
    if unit != "ns":
        code = hold(JUDGED, code_when(outside, P.TIMESTAMP_RANGE))
        return Checked(F.when(code.isNull(), value), code)
    ticks, lossy = nanos_to_ticks(value, nanosecond)
    ticks = hold(DECODED, ticks)
    code = F.when(outside, F.lit(P.TIMESTAMP_RANGE))
    if lossy is not None:
        code = code.when(lossy.isNotNull(), lossy)
    code = hold(JUDGED, code.when(ticks >= TICKS_PER_DAY, F.lit(P.TIMESTAMP_RANGE)))
    return Checked(F.when(code.isNull(), ticks), code)


def datetime2(instant: Instant, precision: int, hold: Holder = inline) -> Checked:
    """Day number and increments of 10^-p s, rounded half up.

    The lower bound holds before rounding, the upper bound after it: the last
    good tick is the last one that is not rounded up to the year 10000.
    """
    factor = 10 ** (7 - precision)
    per_day = TICKS_PER_DAY // factor
    last = (MAX_DAY_FROM_0001 - EPOCH_DAY_FROM_0001 + 1) * TICKS_PER_DAY - 1 - factor // 2
    code = hold(JUDGED, _range_code(instant, instant.outside(FIRST_TICK, last)))
    rounded = instant.ticks if factor == 1 else hold(ROUNDED, quotient(instant.ticks + factor // 2, factor))
    carried = rounded >= per_day
    number = instant.day + EPOCH_DAY_FROM_0001 + _one_if(carried)
    value = F.struct(
        number.cast("int").alias("day"),
        F.when(carried, F.lit(0).cast("bigint")).otherwise(rounded).alias("increments"),
    )
    return Checked(F.when(code.isNull() & instant.day.isNotNull(), value), code)


def datetime_fragments(instant: Instant, rounding: str, hold: Holder = inline) -> Checked:
    """Days since 1900 and 1/300 s fragments.

    ``two_step`` rounds to a millisecond before it rounds to a fragment;
    ``one_step`` rounds once.
    """
    end = (MAX_DAY_FROM_1900 - EPOCH_DAY_FROM_1900 + 1) * FRAGMENTS_PER_DAY
    if rounding == "two_step":
        millis = hold(SCALED, quotient(instant.ticks + 5_000, 10_000))
        rounded = hold(ROUNDED, quotient(millis * 3 + 5, 10))
        last = -(-(10 * end - 5) // 3) * 10_000 - 5_000 - 1
    else:
        rounded = hold(ROUNDED, quotient(instant.ticks * 300 + 5_000_000, 10_000_000))
        last = -(-(10_000_000 * end - 5_000_000) // 300) - 1
    first = (MIN_DAY_FROM_1900 - EPOCH_DAY_FROM_1900) * TICKS_PER_DAY
    code = hold(JUDGED, _range_code(instant, instant.outside(first, last)))
    carried = rounded >= FRAGMENTS_PER_DAY
    days = instant.day + EPOCH_DAY_FROM_1900 + _one_if(carried)
    value = F.struct(
        days.cast("int").alias("day"),
        F.when(carried, F.lit(0).cast("bigint")).otherwise(rounded).cast("int").alias("fragments"),
    )
    return Checked(F.when(code.isNull() & instant.day.isNotNull(), value), code)


def datetimeoffset(instant: Instant, offset_minutes: Column, offset_code: Column,
                   hold: Holder = inline) -> Checked:
    """UTC day number and ticks plus the offset; the local day is checked as well.

    A zone that cannot be used is reported for NULL cells, too.
    """
    last = (MAX_DAY_FROM_0001 - EPOCH_DAY_FROM_0001 + 1) * TICKS_PER_DAY - 1
    minute = 600_000_000 // instant.unit_ticks
    local = replace(instant, raw=instant.raw + offset_minutes.cast("bigint") * minute)
    code = F.when(offset_code.isNotNull(), offset_code)
    if instant.code is not None:
        code = code.when(instant.code.isNotNull(), instant.code)
    # The sum of the second test cannot overflow: the first one has bounded it.
    code = code.when(instant.outside(FIRST_TICK, last), F.lit(P.TIMESTAMP_RANGE))
    code = hold(JUDGED, code.when(local.outside(FIRST_TICK, last), F.lit(P.TIMESTAMP_RANGE)))
    value = F.struct(
        (instant.day + EPOCH_DAY_FROM_0001).cast("int").alias("day"),
        instant.ticks.alias("increments"),
        offset_minutes.cast("int").alias("offset_minutes"),
    )
    return Checked(F.when(code.isNull() & instant.day.isNotNull(), value), code)


def date_text(number: Column) -> Column:
    """``yyyy-mm-dd`` of a day number from 0001-01-01."""
    day = F.date_from_unix_date(number - EPOCH_DAY_FROM_0001)
    return F.concat(
        F.lpad(F.year(day).cast("string"), 4, "0"), F.lit("-"),
        F.lpad(F.month(day).cast("string"), 2, "0"), F.lit("-"),
        F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    )


def time_text(increments: Column, precision: int) -> Column:
    """``hh:mm:ss.fff`` of increments since midnight."""
    unit = 10 ** precision
    seconds = quotient(increments, unit)
    parts = F.concat(
        F.lpad(quotient(seconds, 3600).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((quotient(seconds, 60) % 60).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((seconds % 60).cast("string"), 2, "0"),
    )
    if precision == 0:
        return parts
    return F.concat(parts, F.lit("."), F.lpad((increments % unit).cast("string"), precision, "0"))


def datetime2_text(value: Column, precision: int) -> Column:
    """Text form a target casts without loss."""
    return F.concat(
        date_text(value["day"]), F.lit("T"), time_text(value["increments"], precision)
    )


def datetime_text(value: Column) -> Column:
    """Text form of days since 1900 and 1/300 s fragments, in milliseconds."""
    millis = quotient(value["fragments"].cast("bigint") * 10 + 1, 3)
    number = value["day"] - EPOCH_DAY_FROM_1900 + EPOCH_DAY_FROM_0001
    return F.concat(date_text(number), F.lit("T"), time_text(millis, 3))


def datetimeoffset_text(value: Column) -> Column:
    """Local text form with the offset, e.g. ``2025-02-01T07:00:00.0000000-05:00``."""
    minutes = value["offset_minutes"]
    local = value["increments"] + minutes.cast("bigint") * 600_000_000
    day = value["day"] + floor_div(local, TICKS_PER_DAY).cast("int")
    size = F.abs(minutes)
    return F.concat(
        date_text(day), F.lit("T"), time_text(floor_mod(local, TICKS_PER_DAY), 7),
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(quotient(size.cast("bigint"), 60).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def _one_if(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _range_code(instant: Instant, outside: Column) -> Column:
    if instant.code is None:
        return code_when(outside, P.TIMESTAMP_RANGE)
    return F.when(instant.code.isNotNull(), instant.code).when(outside, F.lit(P.TIMESTAMP_RANGE))
