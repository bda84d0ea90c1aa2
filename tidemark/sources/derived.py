"""Series panels derived from fact tables by Spark aggregation.

``daily_panel`` turns any fact table into daily series: one row per
``(keys, series code, day)`` with the aggregated value.  The aggregation is
a partial (map-side) + final hash aggregate; a filter on the code column
(what a leaf does) is pushed below it into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import clean
from tidemark.model import OBS_TIME, SERIES_CODE, VALUE, SeriesPanel


def day_of(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date").cast("timestamp_ntz")


def daily_panel(df: DataFrame, keys: list[str], code: str | Column, time_col: str,
                value_col: str | Column, agg: str = "sum") -> SeriesPanel:
    code_col = (F.col(code) if isinstance(code, str) else code).cast("string").alias(SERIES_CODE)
    v = F.col(value_col) if isinstance(value_col, str) else value_col
    fn = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}[agg]
    out = (df.groupBy(*[F.col(k) for k in keys], code_col, day_of(time_col).alias(OBS_TIME))
           .agg(clean(fn(v).cast("double")).alias(VALUE)))
    return SeriesPanel(out, list(keys), unique=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The series used by the driver queries.
def user_events(spark: SparkSession, sf_dir: str) -> SeriesPanel:
    """U: per (user_id, event type, day) sum of event value — sparse."""
    return daily_panel(table(spark, sf_dir, "events"), ["user_id"], "event_type", "ts", "value")


def event_types(spark: SparkSession, sf_dir: str) -> SeriesPanel:
    """E: per (event type, day) sum of event value; no key."""
    return daily_panel(table(spark, sf_dir, "events"), [], "event_type", "ts", "value")


def order_priorities(spark: SparkSession, sf_dir: str) -> SeriesPanel:
    """O: per order priority (key), daily total price; code ``orders_total``."""
    return daily_panel(table(spark, sf_dir, "orders"), ["o_orderpriority"], F.lit("orders_total"),
                       "o_orderdate", "o_totalprice")


def lineitem_flags(spark: SparkSession, sf_dir: str) -> SeriesPanel:
    """L: per return flag (key), daily extended price; code ``revenue``."""
    return daily_panel(table(spark, sf_dir, "lineitem"), ["l_returnflag"], F.lit("revenue"),
                       "l_shipdate", "l_extendedprice")
