"""Data model: a *panel* is a long DataFrame of many series.

Columns: ``*keys, series_code, obs_time TIMESTAMP_NTZ, value DOUBLE``.
``keys`` name independent instances (an entity, a dataset, a return flag):
every expression is evaluated per key, all keys in one plan.  A leaf of an
expression selects one ``series_code``.

``unique`` records whether ``(keys, series_code, obs_time)`` is unique —
true by construction for aggregated panels.  It lets the compiler align
operands with one union + group-by and skip self-joins; with duplicates it
falls back to outer joins, which multiply rows as the reference does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import clean

OBS_TIME = "obs_time"
VALUE = "value"
SERIES_CODE = "series_code"


@dataclass
class SeriesPanel:
    df: DataFrame
    keys: list[str] = field(default_factory=list)
    unique: bool = False

    def leaf(self, code: str) -> DataFrame:
        """One series per key: ``keys, obs_time, value`` (pushed-down filter)."""
        return (self.df.where(F.col(SERIES_CODE) == F.lit(code))
                .select(*self.keys, OBS_TIME, VALUE))

    def codes(self) -> DataFrame:
        return self.df.select(SERIES_CODE).distinct()


def as_panel(df: DataFrame, keys: list[str], code, time_col: str, value_col: str,
             unique: bool = False) -> SeriesPanel:
    """Normalise an observation table into a panel.

    ``code`` is a column name or a ``Column``; times are cast to
    ``timestamp_ntz``, values to double with NaN cleaned (rule V1).
    """
    code_col = F.col(code) if isinstance(code, str) else code
    out = df.select(*[F.col(k) for k in keys],
                    code_col.cast("string").alias(SERIES_CODE),
                    F.col(time_col).cast("timestamp_ntz").alias(OBS_TIME),
                    clean(F.col(value_col).cast("double")).alias(VALUE))
    return SeriesPanel(out, list(keys), unique)
