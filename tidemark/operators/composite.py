"""Row-wise composites over aligned operands (NULLs skipped).

An all-NULL row gives sum 0.0 and NULL for avg/max/min; Infinity counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import clean

COMPOSITE_OPS = ("sum", "avg", "max", "min")


def composite(op: str, cols: list[Column]) -> Column:
    if len(cols) < 2:
        raise ValueError("Composite requires at least 2 operands")
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    if op == "sum":
        return clean(total)
    if op == "avg":
        n = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols])
        return F.when(n > 0, clean(total / n.cast("double")))
    if op == "max":
        return F.greatest(*cols)
    if op == "min":
        return F.least(*cols)
    raise ValueError(f"Unknown composite op: {op}")
