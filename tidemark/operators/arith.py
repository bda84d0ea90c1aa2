"""M1-M5: binary series math on aligned columns, NaN -> NULL after each step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import clean, ieee_divide

SERIES_MATH_OPS = ("add", "subtract", "multiply", "ratio")


def binary(op: str, left: Column, right: Column) -> Column:
    if op == "add":
        r = left + right
    elif op == "subtract":
        r = left - right
    elif op == "multiply":
        r = left * right
    elif op == "ratio":
        r = ieee_divide(left, right)
    else:
        raise ValueError(f"Unknown series_math op: {op}")
    return clean(r)


def scaled(c: Column, scale) -> Column:
    """M5: ``scale`` multiplies a series_math result; None means no scaling."""
    if scale is None:
        return c
    return clean(c * F.lit(float(scale)))
