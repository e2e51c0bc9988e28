"""Time zone names and offsets, per instant, from a column or a fixed name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quayload import policy as P
from quayload.functions.exact import quotient
from quayload.functions.hold import DECODED, SCALED, SPLIT, Hold, Holder, inline

# Offsets are at most 14 hours; these three-letter names are zones
# of the tz database, other three-letter names are only abbreviations.
MAX_OFFSET_MINUTES = 840
SHORT_ZONE_NAMES = (
    "CET", "EET", "EST", "GMT", "HST", "MET", "MST", "PRC", "ROC", "ROK", "UCT", "UTC", "WET",
)
FIXED_OFFSET = r"^[+-](\d\d):?(\d\d)$|^[+-](\d\d)$"
ZONE_NAME = r"^[A-Za-z][A-Za-z0-9_+\-]*(/[A-Za-z0-9_+\-]+)*$"
PREFIXED_OFFSET = r"^(UTC|UT|GMT)[+-][0-9].*$"


@dataclass(frozen=True)
class Offset:
    """Minutes east of UTC, and a code where the zone has none."""

    minutes: Column
    code: Column


def is_zone_name(zone: Column) -> Column:
    """A tz database name, told by whether a timestamp with it can be read."""
    readable = F.concat(F.lit("2000-01-01 00:00:00 "), zone).try_cast("timestamp").isNotNull()
    shape = zone.rlike(ZONE_NAME) & ~zone.startswith("SystemV/")
    abbreviation = zone.rlike("^[A-Z]{2,3}$") & ~zone.isin(*SHORT_ZONE_NAMES, "GB", "NZ")
    prefixed = zone.rlike(PREFIXED_OFFSET) & ~zone.isin("GMT+0", "GMT-0")
    return shape & ~abbreviation & ~prefixed & readable


def fixed_offset(zone: Column, hold: Holder = inline) -> Offset:
    """``Z``, ``UTC``, ``+HH``, ``+HHMM`` and ``+HH:MM``."""
    digits = hold(DECODED, F.replace(F.substring(zone, 2, 5), F.lit(":"), F.lit("")))
    hours = F.substring(digits, 1, 2).try_cast("int")
    minutes = F.when(F.length(digits) > 2, F.substring(digits, 3, 2).try_cast("int")).otherwise(F.lit(0))
    minutes = hold(SPLIT, minutes)
    total = hold(SCALED, hours * 60 + minutes)
    shaped = zone.rlike(FIXED_OFFSET)
    good = shaped & (minutes < 60) & (total <= MAX_OFFSET_MINUTES)
    signed = F.when(zone.startswith("-"), -total).otherwise(total)
    utc = F.upper(zone).isin("Z", "UTC")
    value = F.when(utc, F.lit(0)).when(good, signed)
    code = F.when(~utc & ~F.coalesce(good, F.lit(False)), F.lit(P.TIMEZONE))
    return Offset(value, code)


def zone_offset(timestamp: Column, zone: Column, hold: Holder = inline) -> Offset:
    """Offset of ``timestamp`` (with zone) in the zone a column names."""
    utc = F.upper(zone).isin("Z", "UTC")
    signed = zone.rlike("^[+-]")
    fixed = fixed_offset(zone, hold)
    named = hold(DECODED, is_zone_name(zone))
    # Unusable names must not reach the conversion, which would fail the job.
    usable = F.when(named & ~utc & ~signed, zone).otherwise(F.lit("UTC"))
    micros = hold(SPLIT, F.unix_micros(F.from_utc_timestamp(timestamp, usable)) - F.unix_micros(timestamp))
    whole = micros % 60_000_000 == 0
    minutes = quotient(micros, 60_000_000).cast("int")
    fits = whole & (F.abs(minutes) <= MAX_OFFSET_MINUTES)
    value = F.when(utc | signed, fixed.minutes).when(named & fits, minutes)
    code = (
        F.when(zone.isNull(), F.lit(P.TIMEZONE))
        .when(utc | signed, fixed.code)
        .when(~named, F.lit(P.TIMEZONE))
        .when(timestamp.isNotNull() & ~fits, F.lit(P.TIMEZONE))
    )
    return Offset(value, code)


def judged_names(df: DataFrame, zone: str) -> DataFrame:
    """One row for each zone name of ``df``: ``__zone``, whether it is a tz database name, and its fixed offset.

    What it takes to judge a name, among it reading a timestamp, is done once for each
    name instead of once for each row.
    """
    names = df.select(F.col(zone).alias("__zone")).distinct()
    held = Hold()
    fixed = fixed_offset(F.col("__zone"), held)
    return held.add_to(names).select(
        "__zone", (F.upper("__zone").isin("Z", "UTC") | F.col("__zone").rlike("^[+-]")).alias("__signed"),
        is_zone_name(F.col("__zone")).alias("__named"), fixed.minutes.alias("__minutes"))


def with_offsets(df: DataFrame, timestamp: str, zone: str, minutes: str = "offset_minutes", code: str = "code") -> DataFrame:
    """``df`` with the offset of ``timestamp`` in the zone that column ``zone`` names, and a code where it has none.

    The same result as :func:`zone_offset` gives row by row. Names are joined by the
    planner's choice: they are few in a clean table, and as many as its errors in another.
    """
    names = judged_names(df, zone)
    joined = df.join(names, F.col(zone) == F.col("__zone"), "left")
    at, named = F.col(timestamp), F.coalesce("__named", F.lit(False)) & ~F.coalesce("__signed", F.lit(False))
    # Unusable names must not reach the conversion, which would fail the job.
    usable = F.when(named, F.col("__zone")).otherwise(F.lit("UTC"))
    shifted = joined.withColumn("__micros", F.unix_micros(F.from_utc_timestamp(at, usable)) - F.unix_micros(at))
    whole = F.call_function("div", F.col("__micros"), F.lit(60_000_000)).cast("int")
    fits = (F.col("__micros") % 60_000_000 == 0) & (F.abs(whole) <= MAX_OFFSET_MINUTES)
    value = F.when(F.col("__signed"), F.col("__minutes")).when(named & fits, whole)
    bad = F.when(F.col("__signed"), F.col("__minutes").isNull()).otherwise(~named | (at.isNotNull() & ~fits))
    return shifted.select(*df.columns, value.alias(minutes), F.when(bad, F.lit(P.TIMEZONE)).alias(code))


def zone_code(zone: str) -> Column:
    """A code where a zone known to the plan cannot be used; folds to a constant."""
    literal = F.lit(zone)
    if _is_fixed(zone):
        return fixed_offset(literal).code
    return F.when(~is_zone_name(literal), F.lit(P.TIMEZONE))


def named_offset(timestamp: Column, zone: str, hold: Holder = inline) -> Offset:
    """Offset in one zone that is known when the plan is made.

    Only the rule that applies is put into the plan: a fixed offset is a literal.
    """
    literal = F.lit(zone)
    if _is_fixed(zone):
        return fixed_offset(literal)
    named = is_zone_name(literal)
    usable = F.when(named, literal).otherwise(F.lit("UTC"))
    micros = hold(SPLIT, F.unix_micros(F.from_utc_timestamp(timestamp, usable)) - F.unix_micros(timestamp))
    fits = (micros % 60_000_000 == 0) & (F.abs(micros) <= MAX_OFFSET_MINUTES * 60_000_000)
    code = F.when(~named | (timestamp.isNotNull() & ~fits), F.lit(P.TIMEZONE))
    minutes = F.when(named & fits, quotient(micros, 60_000_000).cast("int"))
    return Offset(hold(SCALED, minutes), hold(SCALED, code))


def _is_fixed(zone: str) -> bool:
    return zone.upper() in ("Z", "UTC") or zone[:1] in ("+", "-")
