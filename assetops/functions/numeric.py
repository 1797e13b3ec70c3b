"""Exact rounding and ratios.

Money is DECIMAL; a rounded average is computed in whole units with integer
arithmetic, so it depends neither on binary fractions nor on the order in
which partial sums arrive.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def cents(money: Column) -> Column:
    """DECIMAL(.., 2) as whole cents."""
    return (money * 100).cast("bigint")


def rounded_ratio(num: Column, den: Column, digits: int, num_digits: int = 0) -> Column:
    """``num / den`` rounded half away from zero to ``digits`` places.

    ``num`` is integral and counts units of ``10**-num_digits``; ``den`` is a
    non-negative integer.  NULL when ``den`` is 0 or NULL.  Intermediate values
    have 38 digits; only the quotient has to fit a BIGINT.
    """
    shift = digits - num_digits
    top, bottom = _wide(num), _wide(den)
    if shift > 0:
        top = _wide(top * 10**shift)
    elif shift < 0:
        bottom = _wide(bottom * 10**-shift)
    bottom = F.nullif(bottom, _wide(F.lit(0)))
    magnitude = F.call_function("div", _wide(F.abs(top) * 2) + bottom, _wide(bottom * 2))
    return scaled(F.sign(top).cast("bigint") * magnitude, digits)


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def scaled(units: Column, digits: int) -> Column:
    """Whole units of ``10**-digits`` as a DECIMAL."""
    if digits == 0:
        return units.cast("decimal(20,0)")
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(20,{digits})")


def percent(num: Column, den: Column, digits: int = 1, num_digits: int = 0) -> Column:
    return rounded_ratio(_wide(num) * 100, den, digits, num_digits)


def plain_ratio(num: Column, den: Column) -> Column:
    """Unrounded quotient as DOUBLE, NULL on a zero denominator."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")
