"""Numeric expressions that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's cast also takes Java literals such as '1d' or '2.5F'; they are not numbers here.
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def null_if_nan(value: Column) -> Column:
    """NaN is missing, so that aggregates skip it."""
    return F.when(~F.isnan(value), value)


def to_number(value: Column, text: bool = True) -> Column:
    """Double, with NULL for whatever is not a number."""
    number = null_if_nan(value.try_cast("double"))
    return F.when(~value.rlike(_JAVA_SUFFIX), number) if text else number


def decimal_comma(value: Column) -> Column:
    """``'0,53'`` to 0.53."""
    return to_number(F.replace(value, F.lit(","), F.lit(".")))


def percent_of(part: Column, base: Column, scale: float = 100.0) -> Column:
    """``part / base * scale``, NULL on a zero base."""
    return F.try_divide(part, base) * F.lit(float(scale))


def clamp(value: Column, low: float, high: float) -> Column:
    """Keep ``value`` in the range; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(
        value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    )


def rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)
