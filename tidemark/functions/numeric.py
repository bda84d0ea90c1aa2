"""Null / NaN / Infinity rules for series values.

* NaN is never a value: it becomes NULL after every arithmetic step.
* +-Infinity is a value for arithmetic, lag and composites, but rolling
  windows and ema treat it as missing.
* ``x / 0`` is +-Infinity (sign of the zero respected), ``0 / 0`` is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _null() -> Column:
    return F.lit(None).cast("double")


def clean(c: Column) -> Column:
    """NaN -> NULL."""
    return F.when(F.isnan(c), _null()).otherwise(c)


def finite(c: Column) -> Column:
    """NaN and +-Infinity -> NULL (input rule of rolling windows and ema)."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), _null()).otherwise(c)


def ieee_divide(left: Column, right: Column) -> Column:
    """IEEE-754 double division, without ANSI's DIVIDE_BY_ZERO error.

    ``r ** -1`` is +Infinity for 0.0 and -Infinity for -0.0, so ``l * r**-1``
    gives inf / NaN / -inf for a zero divisor; the caller cleans NaN.
    """
    return (F.when(right == 0, left * F.pow(right, F.lit(-1.0)))
            .otherwise(left / right))
