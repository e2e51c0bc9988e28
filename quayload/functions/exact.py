"""Integer arithmetic that stays exact for every 64-bit input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LONG_MAX = 9_223_372_036_854_775_807


def quotient(value: Column, divisor: int | Column) -> Column:
    """Integer quotient, truncating toward zero."""
    return F.call_function("div", value, _column(divisor))


def floor_div(value: Column, divisor: int) -> Column:
    """Quotient rounded toward minus infinity, for a positive divisor."""
    n = F.lit(divisor).cast("bigint")
    return quotient(value, n) - F.when(value % n < 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def floor_mod(value: Column, divisor: int) -> Column:
    """Remainder in ``0 .. divisor - 1``."""
    return F.pmod(value, F.lit(divisor).cast("bigint"))


def saturated_sum(value: Column) -> Column:
    """Sum of longs that stops at the 64-bit limits instead of failing."""
    total = F.sum(value.cast("decimal(20,0)")).cast("decimal(38,0)")
    high = F.lit(LONG_MAX).cast("decimal(38,0)")
    low = F.lit(-LONG_MAX).cast("decimal(38,0)") - 1
    return F.when(total > high, high).when(total < low, low).otherwise(total).cast("bigint")


def saturated_difference(left: Column, right: Column) -> Column:
    """``left - right`` of longs, held at the 64-bit limits instead of failing."""
    exact = F.try_subtract(left.cast("bigint"), right.cast("bigint"))
    limit = F.when(left < right, F.lit(-LONG_MAX).cast("bigint") - 1).otherwise(F.lit(LONG_MAX))
    return F.when(left.isNotNull() & right.isNotNull(), F.coalesce(exact, limit))


def _column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")
