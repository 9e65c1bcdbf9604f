"""Rounding that does not depend on binary floating point.

Averages and percentages are computed from whole numbers (counts, cents,
seconds), so a value that lies exactly on a rounding tie always goes up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def whole(col: Column) -> Column:
    return col.cast("decimal(38,0)")


def cents(amount: Column) -> Column:
    """A two-digit decimal amount as a whole number of cents."""
    return whole(amount * 100)


def _half_up_units(num: Column, den: Column, digits: int) -> Column:
    """num/den in units of 10**-digits, half away from zero; NULL for a zero den."""
    bottom = F.nullif(whole(den), F.lit(0).cast("decimal(38,0)"))
    top = whole(F.abs(num)) * F.lit(2 * 10 ** digits)
    return F.sign(num).cast("bigint") * F.call_function("div", top + bottom, bottom * 2)


def half_up(num: Column, den: Column, digits: int = 2) -> Column:
    """Ratio of two whole numbers, rounded, as DOUBLE."""
    return _half_up_units(num, den, digits) / F.lit(float(10 ** digits))


def percent(part: Column, base: Column, digits: int = 2) -> Column:
    return half_up(whole(part) * 100, base, digits)


def money_average(total: Column, n: Column) -> Column:
    """Average of a decimal amount over ``n`` rows, rounded to cents, as DECIMAL."""
    units = _half_up_units(cents(total), n * 100, 2)
    return (units.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
