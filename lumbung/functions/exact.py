"""Sums that do not depend on the order of rows, and quotients rounded once (Q5, Q13, Q14, Q18).

Adding doubles rounds at every step, so a sum depends on how rows are dealt to tasks.
A double stands here for the shortest decimal number that is read back as the same
double (53.3, not 53.2999...); such numbers are added as ``decimal(38, 18)``, where partial
sums merge without rounding.

Guard: a value has at most 18 digits after the point, and a sum at most 20 before it.
A value outside (NaN, infinite, too small, too large) is an error that names it; nothing
is cut off silently.  ``scale`` moves the point where smaller or larger values are due.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

SCALE = 18


def exact_value(value: Column, kind: DataType, scale: int = SCALE) -> Column:
    """``value`` as a number whose sum is exact; whole numbers and decimals are so already."""
    if isinstance(kind, DecimalType):
        return value.cast(DecimalType(38, kind.scale))
    if not isinstance(kind, (DoubleType, FloatType)):
        return value.cast("decimal(38,0)")
    # a float by its own shortest text: as a double it would get more digits
    text = value.cast("string") if isinstance(kind, FloatType) else value
    fixed = text.try_cast(f"decimal(38,{scale})")
    message = F.concat(F.lit(f"no exact sum with {scale} digits after the point: "), value.cast("string"))
    kept = fixed.cast(kind) == value
    return F.when(value.isNull() | F.coalesce(kept, F.lit(False)), fixed).otherwise(
        F.raise_error(message).cast(f"decimal(38,{scale})")
    )


def exact_sum(value: Column, kind: DataType, scale: int = SCALE) -> Column:
    """An aggregate: the sum as a decimal, the same for every order and partitioning."""
    return F.sum(exact_value(value, kind, scale))


def rounded_quotient(total: Column, divisor: Column, digits: int = 4) -> Column:
    """``total / divisor`` rounded half up, away from zero, by whole-number division.

    ``total`` is a decimal and ``divisor`` a positive whole number or decimal of few digits.
    NULL where either is NULL or the divisor is zero.
    """
    # types with so few digits before the point that no operation below has to give up digits after it
    divisor = divisor.cast("decimal(22,4)")
    divisor = F.when(divisor > 0, divisor)
    unit = divisor * F.lit(Decimal(1).scaleb(-digits))  # one step of the result, times the divisor
    half = divisor * F.lit(Decimal(5).scaleb(-digits - 1))
    whole = F.call_function("div", total, unit)
    away = F.when(F.abs(total % unit) >= half, F.signum(total).cast("bigint")).otherwise(F.lit(0))
    return ((whole + away) / F.lit(10**digits)).cast("double")
