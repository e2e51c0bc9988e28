"""Conversions of numbers, text and bytes, each with the code of a value that fails.

A check never changes a value it cannot keep: the result is NULL and the code
says why. NULL in gives NULL out with no code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from quayload import policy as P
from quayload.functions.exact import LONG_MAX
from quayload.functions.hold import DECODED, JUDGED, NULL_JUDGED, Holder, inline


@dataclass(frozen=True)
class Checked:
    """Value of the target type, and the code of the violation (NULL when good)."""

    value: Column
    code: Column
    checked: bool = True

    def never_fails(self, planned) -> bool:
        """Nothing to check: a lossless conversion into a nullable column."""
        return planned.nullable and not self.checked


def no_code() -> Column:
    return F.lit(None).cast("string")


def code_when(bad: Column, code: str) -> Column:
    return F.when(bad, F.lit(code))


def widen(column: Column, spark_type: str) -> Checked:
    """Lossless widening of booleans and integers."""
    return Checked(column.cast(spark_type), no_code(), checked=False)


def unsigned(column: Column, bits: int, spark_type: str, hold: Holder = inline) -> Checked:
    """Unsigned integer of ``bits`` bits; its carrier is wider and signed, so the range is checked."""
    code = hold(JUDGED, code_when(~column.between(0, (1 << bits) - 1), P.INTEGER_RANGE))
    return Checked(F.when(code.isNull(), column.cast(spark_type)), code)


def tinyint(column: Column, hold: Holder = inline) -> Checked:
    """Unsigned byte: 0..255 carried in a smallint."""
    code = hold(JUDGED, code_when(~column.between(0, 255), P.INTEGER_RANGE))
    return Checked(F.when(code.isNull(), column.cast("smallint")), code)


def uint64_as_decimal(column: Column, hold: Holder = inline) -> Checked:
    """Unsigned 64-bit value as decimal(20,0); its carrier also holds signed and larger numbers."""
    limit = F.lit(str((1 << 64) - 1)).cast("decimal(20,0)")
    code = hold(JUDGED, code_when(~column.between(F.lit(0).cast("decimal(20,0)"), limit), P.INTEGER_RANGE))
    return Checked(F.when(code.isNull(), column.cast("decimal(20,0)")), code)


def uint64_as_bigint(column: Column, hold: Holder = inline) -> Checked:
    """Unsigned 64-bit value as bigint, when it is small enough.

    The range is compared, not tried: a cast that fails costs an exception per row.
    """
    limit = F.lit(str(LONG_MAX)).cast("decimal(20,0)")
    outside = ~column.between(F.lit(0).cast("decimal(20,0)"), limit)
    code = hold(JUDGED, code_when(outside, P.INTEGER_RANGE))
    return Checked(F.when(code.isNull(), column.cast("bigint")), code)


def finite(column: Column, spark_type: str, hold: Holder = inline) -> Checked:
    """Float that is neither NaN nor infinite."""
    value = column.cast(spark_type)
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")).cast(spark_type))
    code = hold(JUDGED, code_when(bad, P.NON_FINITE))
    return Checked(F.when(code.isNull(), value), code)


def utf16_units(column: Column) -> Column:
    """Length in UTF-16 code units; plain ASCII needs no re-encoding."""
    characters = F.char_length(column)
    return (
        F.when(F.octet_length(column) == characters, characters)
        .otherwise(F.shiftright(F.octet_length(F.encode(column, "UTF-16LE")), 1))
    )


def nvarchar(column: Column, length: int | None, hold: Holder = inline) -> Checked:
    """Text of at most ``length`` UTF-16 units; never cut short."""
    if length is None:
        return Checked(column, no_code(), checked=False)
    # More code points than units is already too long, and needs no encoding.
    bad = (F.char_length(column) > length) | (utf16_units(column) > length)
    code = hold(JUDGED, code_when(bad, P.TOO_LONG))
    return Checked(F.when(code.isNull(), column), code)


def varbinary(column: Column, length: int | None, hold: Holder = inline) -> Checked:
    """Bytes of at most ``length``."""
    if length is None:
        return Checked(column, no_code(), checked=False)
    code = hold(JUDGED, code_when(F.octet_length(column) > length, P.TOO_LONG))
    return Checked(F.when(code.isNull(), column), code)


def fixed_binary(column: Column, length: int, hold: Holder = inline) -> Checked:
    """Bytes of exactly ``length``."""
    code = hold(JUDGED, code_when(F.octet_length(column) != length, P.TYPE_MISMATCH))
    return Checked(F.when(code.isNull(), column), code)


def decimal(column: Column, precision: int, scale: int, hold: Holder = inline) -> Checked:
    """Decimal of unchanged scale whose digits fit ``precision``."""
    if scale >= P.MAX_DECIMAL_PRECISION:
        code = code_when(column.isNotNull(), P.DECIMAL_RANGE)
        return Checked(F.lit(None).cast(f"decimal({precision},{scale})"), code)
    value = hold(DECODED, column.try_cast(f"decimal({precision},{scale})"))
    # A source of another scale would be rounded by the cast.
    wrong = F.when(column.isNotNull() & value.isNull(), F.lit(P.DECIMAL_RANGE)).when(value != column, F.lit(P.SCHEMA_MISMATCH))
    code = hold(JUDGED, wrong)
    return Checked(F.when(code.isNull(), value), code)


def negative_scale_decimal(unscaled: Column, precision: int, digits: int, hold: Holder = inline) -> Checked:
    """``unscaled`` x 10^digits as an integer decimal of ``precision`` digits."""
    factor = F.lit("1" + "0" * digits).cast("decimal(38,0)")
    product = F.try_multiply(unscaled.cast("decimal(38,0)"), factor)
    value = hold(DECODED, product.try_cast(f"decimal({precision},0)"))
    code = hold(JUDGED, code_when(unscaled.isNotNull() & value.isNull(), P.DECIMAL_RANGE))
    return Checked(value, code)


def wide_decimal(unscaled_text: Column, precision: int, scale: int, hold: Holder = inline) -> Checked:
    """Unscaled integer text of any width, brought down to decimal(p,s)."""
    shifted = F.concat(unscaled_text, F.lit(f"E{-scale}"))
    target = max(scale, 0)
    if target >= P.MAX_DECIMAL_PRECISION:
        value = F.lit(None).cast(f"decimal({precision},{target})")
    else:
        value = hold(DECODED, shifted.try_cast(f"decimal({precision},{target})"))
    whole = unscaled_text.rlike("^[+-]?[0-9]+$")
    wrong = F.when(~whole, F.lit(P.TYPE_MISMATCH)).when(whole & value.isNull(), F.lit(P.DECIMAL_RANGE))
    code = hold(JUDGED, wrong)
    return Checked(F.when(code.isNull(), value), code)


def not_null(checked: Checked, source: Column, nullable: bool, hold: Holder = inline) -> Checked:
    """NULL where the target column takes none."""
    if nullable:
        return checked
    missing = F.when(source.isNull(), F.lit(P.NULL_VALUE))
    code = missing.otherwise(checked.code) if checked.checked else missing
    return Checked(checked.value, hold(NULL_JUDGED, code))
