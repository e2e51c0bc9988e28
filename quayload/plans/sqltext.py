"""Fragments of oracle SQL that several queries share."""

from __future__ import annotations


def fmod(x: str, n: int) -> str:
    """Remainder in 0 .. n - 1."""
    return f"((({x}) % {n}) + {n}) % {n}"


def fdiv(x: str, n: int) -> str:
    """Quotient rounded down."""
    return f"((({x}) - ({fmod(x, n)})) // {n})"


def utf16(x: str) -> str:
    """UTF-16 units: code points, and one more for each beyond U+FFFF."""
    return rf"(length({x}) + length(regexp_replace({x}, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')))"


def datetime2(ticks: str, precision: int) -> tuple[str, str, str]:
    """(day, increments, in range) of 100 ns ticks since the epoch, as HUGEINT SQL."""
    factor = 10 ** (7 - precision)
    rounded = f"({fdiv(f'({ticks}) + {factor // 2}', factor)})" if factor > 1 else f"({ticks})"
    per_day = 864_000_000_000 // factor
    day = f"({fdiv(rounded, per_day)} + 719162)"
    inc = f"({fmod(rounded, per_day)})"
    ok = f"(({ticks}) >= -621355968000000000 AND {day} <= 3652058)"
    return day, inc, ok


def fragments(ticks: str, two_step: bool) -> tuple[str, str, str]:
    """(day since 1900, 1/300 s, in range) of 100 ns ticks since the epoch."""
    base = f"({fdiv(f'({ticks}) + 5000', 10_000)} * 10000)" if two_step else f"({ticks})"
    frag = f"({fdiv(f'{base} * 300 + 5000000', 10_000_000)})"
    day = f"({fdiv(frag, 25_920_000)} + 25567)"
    part = f"({fmod(frag, 25_920_000)})"
    ok = f"(({ticks}) >= {(-53_690 - 25_567) * 864_000_000_000} AND {day} <= 2958463)"
    return day, part, ok
