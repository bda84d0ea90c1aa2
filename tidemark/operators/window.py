"""Window operators over many series at once.

Every op keeps the rows of its input and adds one column.  Rows are ordered
per key by ``obs_time`` (nulls last), ties by the op's input value.

Physical strategies (``auto`` picks one per evaluation):

``partition``
    plain ``Window.partitionBy(keys)``: one shuffle, but each series lives in
    one task.  Fine for many small series.
``chunked`` (default)
    survives a hot series (one key holding a large share of all rows).
    ``_dealt`` writes the rows once, range-partitioned and sorted by
    (key, time, value, row), with boundaries from a sample of the data, so outlier dates, one
    dominant instant, equal rows and null times are split like any others; each task's
    range is cut into contiguous *buckets* of ``chunk_rows`` rows.  Then:

    * rolling sum/avg/max/min and positional shift: a per-key ordinal
      ``g`` = bucket offset (prefix sum over the small bucket-count table)
      + place in the bucket; rows are re-cut into fixed chunks
      ``g div C`` and the last ``n-1`` rows of each chunk are copied as a
      halo into the next chunk, so each window sees its whole frame;
    * calendar lag (as-of backward): every row is dealt twice, at its time
      and, as a question, at ``t - N days``; a question takes the last
      observation ahead of it in its bucket, else the carry (last observation of
      all earlier buckets, from the small bucket table);
    * ema: a running sum of decayed terms in blocks of bounded decay, each taking the last
      average of the block before; places and decay ahead of a bucket come from small tables.

Rolling windows over more than ``LONG_WINDOW`` rows use running aggregates of blocks, forwards and
backwards, so that their cost per row does not grow with the window.

No step puts a whole series into one task or onto the driver.  The bucketed rows and the
small tables are written while the plan is built (they are jobs of their own).

``auto`` (default) runs one small aggregate — the largest number of panel
rows under one key — and uses ``partition`` when times are unique and that is within
``chunk_rows`` (every series fits a task with room to spare), else
``chunked``.  Both give the same rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import finite
from tidemark.model import OBS_TIME
from tidemark.operators.align import CELL_ROWS
from tidemark.session import scratch_folder

ROLLING_AGGS = ("sma", "sum", "max", "min")
LONG_WINDOW = 64  # from here on frames cost more per row than two running aggregates and a lag
NATS = 80.0  # decay of an ema block: e ** 80 is no overflow, e ** -80 far below a double's precision

_K, _B, _G, _C, _HALO = "__k", "__b", "__g", "__c", "__halo"
_U, _P = "__u", "__p"
_PLACE_BITS = 33  # of monotonically_increasing_id: the record number within a partition
TASK_ROWS = 1 << 18  # rows of a task that deals rows, at least: small buckets share one
_DAY_US = 86_400_000_000


def _small(df: DataFrame, tag: str) -> DataFrame:
    """Materialise a per-key or per-bucket table once in the shared folder.  Its size
    in bytes is then known to the planner, which chooses the join by it."""
    spark = df.sparkSession
    path = scratch_folder(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class WindowPlan:
    strategy: str = "auto"
    chunk_rows: int = 1_000_000
    cell_rows: int = CELL_ROWS  # of alignments: rows of one instant that meet in a task

    @classmethod
    def from_session(cls, spark: SparkSession | None = None) -> "WindowPlan":
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            return cls()
        return cls(spark.conf.get("spark.tidemark.window.strategy", "auto"),
                   int(spark.conf.get("spark.tidemark.window.chunkRows", "1000000")),
                   int(spark.conf.get("spark.tidemark.align.cellRows", str(CELL_ROWS))))

    def resolve(self, panel_df: DataFrame, keys: list[str], unique: bool = True) -> "WindowPlan":
        """Concrete strategy for a panel: ``partition`` only when its times are unique
        per series and no key holds more than ``chunk_rows`` rows (a derived frame
        then holds at most its key's panel rows; duplicate times multiply them)."""
        if self.strategy != "auto":
            return self
        if not unique:
            return replace(self, strategy="chunked")
        biggest = (panel_df.groupBy(*keys).count().agg(F.max("count")).collect()[0][0]) or 0
        return replace(self, strategy="partition" if biggest <= self.chunk_rows else "chunked")


def _t_us(c: str = OBS_TIME) -> Column:
    """Microseconds since the epoch of a naive timestamp (no session time
    zone involved, so day arithmetic is exact across DST changes)."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                  f"CAST(`{c}` AS TIMESTAMP_NTZ))")


def _order(value_col: str) -> list[Column]:
    return [F.col(OBS_TIME).asc_nulls_last(), F.col(value_col).asc_nulls_last()]


def _key(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_"))


def _dealt(df: DataFrame, keys: list[str], plan: WindowPlan, order: list[Column]) -> DataFrame:
    """The rows with ``__k`` (struct key), ``__b`` (bucket: a contiguous range of
    (key, *order) of ``chunk_rows`` rows at most, numbered in that order) and ``__p`` (place in
    the bucket).  Rows are numbered in a written table first: equal rows can then be
    split, and a lost task deals its rows as it did before.  A task sorts a range of
    ``TASK_ROWS`` rows or more and cuts it into buckets: the driver's sample of the ranges and
    the tasks' results follow the tasks, not the buckets."""
    rows = _small(df.withColumn(_K, _key(keys)).withColumn(_U, F.monotonically_increasing_id()), "rows")
    n = rows.count()
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    tasks = max(1, min(tasks, -(-n // plan.chunk_rows)))
    by = [F.col(_K), *order, F.col(_U)]
    # partition number and place in the partition
    at = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    place = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    size = F.lit(plan.chunk_rows).cast("long")
    return _small(at.withColumn(_B, F.col("__at") - place + F.floor(place / size))
                  .withColumn(_P, place % size).drop("__at", _U), "buckets")


def _with_ordinal(base: DataFrame) -> DataFrame:
    """Add ``__g``: 0-based row position inside the key (skew-safe)."""
    counts = base.groupBy(_K, _B).agg(F.count(F.lit(1)).alias("__cnt"), F.min(_P).alias("__first"))
    prior = Window.partitionBy(_K).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _small(counts.select(
        _K, _B, (F.coalesce(F.sum("__cnt").over(prior), F.lit(0)) - F.col("__first")).alias("__off")), "offsets")
    return base.join(offsets, [_K, _B]).withColumn(_G, F.col("__off") + F.col(_P)).drop("__off")


def _halo_chunks(df: DataFrame, halo: int, plan: WindowPlan) -> tuple[DataFrame, int]:
    """Cut rows into chunks of ``size`` ordinals; copy the last ``halo`` rows
    of each chunk into the next one (flag ``__halo``)."""
    size = max(plan.chunk_rows, halo, 1)
    copies = (F.when((F.col(_G) % size) >= size - halo, F.array(F.lit(0), F.lit(1)))
              .otherwise(F.array(F.lit(0)))) if halo > 0 else F.array(F.lit(0))
    out = (df.withColumn("__d", F.explode(copies))
           .withColumn(_C, F.floor(F.col(_G) / size).cast("long") + F.col("__d"))
           .withColumn(_HALO, F.col("__d") == 1).drop("__d"))
    return out, size


def _rolling_expr(agg: str, x: Column, w, n: int) -> Column:
    fn = {"sma": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[agg]
    return F.when(F.count(x).over(w) == n, fn(x).over(w))


def _long_rolling(df: DataFrame, part: list[str], place: str, col: str, n: int, agg: str, out: str) -> DataFrame:
    """The rolling aggregate at a cost per row that does not grow with ``n``.

    ``place`` numbers the rows of each ``part``.  They are cut into blocks of ``n``; a frame is
    the tail of one block and the head of the next (or a whole block), so two running
    aggregates, forwards and backwards, and one lag give it.  Sums are added from parts
    of the frame only, never subtracted, so they are as exact as direct ones.
    """
    fn = {"sma": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[agg]
    df = df.withColumn("__x", finite(F.col(col))).withColumn("__blk", F.floor(F.col(place) / n))
    until = lambda order: Window.partitionBy(*part, "__blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    head, tail = until(F.col(place)), until(F.col(place).desc())
    state = lambda w: F.struct(fn("__x").over(w).alias("v"), F.count("__x").over(w).alias("c"))
    df = df.withColumn("__tail", state(tail)).withColumn("__head", state(head))
    df = df.withColumn("__old", F.lag("__tail", n - 1).over(Window.partitionBy(*part).orderBy(place)))
    whole = F.col(place) % n == n - 1
    both = {"max": F.greatest, "min": F.least}.get(agg, lambda a, b: a + b)(F.col("__old.v"), F.col("__head.v"))
    v = F.when(whole, F.when(F.col("__head.c") == n, F.col("__head.v"))).otherwise(
        F.when(F.col("__old.c") + F.col("__head.c") == n, both))
    return df.withColumn(out, v / n if agg == "sma" else v)


def _drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def rolling(df: DataFrame, keys: list[str], col: str, n: int, agg: str, out: str,
            plan: WindowPlan | None = None) -> DataFrame:
    """Full-window-only rolling aggregate over ``n`` rows.

    NaN/±Infinity count as missing; any missing value in the frame, or
    fewer than ``n`` rows so far, gives NULL (pandas ``min_periods=n``).
    """
    if agg not in ROLLING_AGGS:
        raise ValueError(f"unknown rolling aggregate {agg}")
    plan = plan or WindowPlan.from_session()
    x = finite(F.col(col))
    if plan.strategy == "partition":
        w = Window.partitionBy(*keys).orderBy(*_order(col))
        if n > LONG_WINDOW:
            placed = df.withColumn(_G, F.row_number().over(w) - 1)
            return _drop_internal(_long_rolling(placed, keys, _G, col, n, agg, out))
        return df.withColumn(out, _rolling_expr(agg, x, w.rowsBetween(-(n - 1), 0), n))
    base = _with_ordinal(_dealt(df, keys, plan, _order(col)))
    chunks, _ = _halo_chunks(base, n - 1, plan)
    if n > LONG_WINDOW:
        res = _long_rolling(chunks, [_K, _C], _G, col, n, agg, out)
    else:
        w = Window.partitionBy(_K, _C).orderBy(_G).rowsBetween(-(n - 1), 0)
        res = chunks.withColumn(out, _rolling_expr(agg, x, w, n))
    return _drop_internal(res.where(~F.col(_HALO)))


def shift(df: DataFrame, keys: list[str], col: str, n: int, out: str,
          plan: WindowPlan | None = None) -> DataFrame:
    """Positional lag by ``n`` rows (values kept as they are)."""
    plan = plan or WindowPlan.from_session()
    if plan.strategy == "partition":
        return df.withColumn(out, F.lag(col, n).over(Window.partitionBy(*keys).orderBy(*_order(col))))
    base = _with_ordinal(_dealt(df, keys, plan, _order(col)))
    chunks, _ = _halo_chunks(base, n, plan)
    res = (chunks.withColumn(out, F.lag(col, n).over(Window.partitionBy(_K, _C).orderBy(_G)))
           .where(~F.col(_HALO)))
    return _drop_internal(res)


def _null_time_guard(c: Column) -> Column:
    return F.when(F.col(OBS_TIME).isNull(),
                  F.raise_error(F.lit("Invalid lag input: obs_time must not be null"))).otherwise(c)


def calendar_lag(df: DataFrame, keys: list[str], col: str, days: int, out: str,
                 plan: WindowPlan | None = None) -> DataFrame:
    """Value of the last row with ``obs_time <= t - days`` (as-of
    backward, no tolerance; a NULL there is returned, not skipped).

    Ties on the target time resolve to the largest value.
    """
    plan = plan or WindowPlan.from_session()
    obs = F.struct(F.col(OBS_TIME).alias("t"), F.col(col).alias("v"))
    if plan.strategy == "partition":
        w = (Window.partitionBy(*keys).orderBy(_t_us())
             .rangeBetween(Window.unboundedPreceding, -days * _DAY_US))
        return df.withColumn(out, _null_time_guard(F.max(obs).over(w)["v"]))

    asks = F.col("__kind") == 1
    both = df.withColumn("__kind", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.select(
        *keys, "__kind", *[F.when(asks, F.col(c)).alias(c) for c in df.columns if c not in keys],
        F.when(asks, F.col(OBS_TIME) - F.expr(f"INTERVAL {int(days)} DAYS")).otherwise(F.col(OBS_TIME)).alias("__t"),
        F.when(~asks, obs).alias("__obs"))
    both = _dealt(both, keys, plan, [F.col("__t").asc_nulls_last(), F.col("__kind"), F.col("__obs.v")])
    w_in = Window.partitionBy(_K, _B).orderBy(_P).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__in", F.max("__obs").over(w_in))
    last_per_bucket = both.groupBy(_K, _B).agg(F.max("__obs").alias("__last"))
    prior = Window.partitionBy(_K).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = _small(last_per_bucket.select(_K, _B, F.max("__last").over(prior).alias("__carry")), "lagcarry")
    res = (both.where(asks).join(carry, [_K, _B], "left")
           .withColumn(out, _null_time_guard(F.coalesce(F.col("__in"), F.col("__carry"))["v"])))
    return res.select(*df.columns, out)


# ---------------------------------------------------------------- ema ----

def ema(df: DataFrame, keys: list[str], col: str, span: int, out: str,
        plan: WindowPlan | None = None) -> DataFrame:
    """Exponential moving average, ``span`` n, ``adjust=False``.

    Leading missing rows give NULL; interior missing rows carry the last
    average and decay the next weight by the gap in rows (ignore_na=False).

    A valid row maps the average y before it to ``A y + B x``; with ``w = (1 - alpha) ** gap``
    A is w / (w + alpha) and B alpha / (w + alpha).  Such maps compose by products, so y
    is a running sum of B x, each term decayed by the product of the A after it.  In logs these
    products are sums ("nats").  A series is cut where its running nats pass a multiple
    of NATS: within a block terms are scaled by at most e ** NATS, the block before gives its
    last average, and what lies before that has decayed by NATS at least.
    """
    plan = plan or WindowPlan.from_session()
    alpha = 2.0 / (span + 1.0)
    cols = df.columns
    order = [F.col(OBS_TIME).asc_nulls_last(), finite(F.col(col)).asc_nulls_last()]
    upto, before = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    alone = plan.strategy == "partition"
    if alone:
        part, bucket = keys, []
        rows = df.withColumn(_G, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        part, bucket = [_K], [_B]
        rows = _dealt(df, keys, plan, order)
        # of each bucket: the ordinal of its first row, less its place, and the last valid ordinal before
        prior = Window.partitionBy(_K).orderBy(_B).rowsBetween(*before)
        counts = rows.groupBy(_K, _B).agg(F.count(F.lit(1)).alias("__cnt"), F.min(_P).alias("__first"),
                                          F.max(F.when(finite(F.col(col)).isNotNull(), F.col(_P))).alias("__lastp"))
        counts = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(prior), F.lit(0)) - F.col("__first"))
        counts = counts.select(_K, _B, "__off", F.max(F.col("__off") + F.col("__lastp")).over(prior).alias("__valid0"))
        rows = rows.join(_small(counts, "offsets"), [_K, _B]).withColumn(_G, F.col("__off") + F.col(_P))
    run = Window.partitionBy(*part, *bucket).orderBy(_G)
    rows = rows.withColumn("__x", finite(F.col(col)))
    rows = rows.withColumn("__valid", F.when(F.col("__x").isNotNull(), F.col(_G)))
    earlier = F.lit(None) if alone else F.col("__valid0")
    last = F.coalesce(F.max("__valid").over(run.rowsBetween(*before)), earlier)
    if span == 1:  # nothing of the past is left
        rows = rows.withColumn("__at", F.coalesce(F.max("__valid").over(run.rowsBetween(*upto)), earlier))
        there = rows.where(F.col("__valid").isNotNull()).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(part)],
                                                                F.col("__valid").alias("__v"), F.col("__x").alias(out))
        on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(part)] + [F.col("__at") == F.col("__v")]
        return rows.join(there, on, "left").select(*cols, out)
    rows = rows.withColumn("__gap", F.when(F.col("__x").isNotNull(), F.col(_G) - last))
    w = F.exp(F.col("__gap") * math.log1p(-alpha))
    # the first valid row of a series has no gap: nothing decays into it, and it counts in full
    rows = rows.withColumn("__nats", F.when(F.col("__x").isNotNull(), F.coalesce(
        F.log(w + alpha) - F.col("__gap") * math.log1p(-alpha), F.lit(0.0))))
    rows = rows.withColumn("__bx", F.col("__x") * F.coalesce(alpha / (w + alpha), F.lit(1.0)))
    total = F.sum("__nats").over(run.rowsBetween(*upto))
    if not alone:
        nats = rows.groupBy(_K, _B).agg(F.sum("__nats").alias("__own"))
        rows = rows.join(_small(nats.select(_K, _B, F.sum("__own").over(prior).alias("__nats0")), "nats"), [_K, _B])
        earlier = F.col("__nats0")
        total = F.when(total.isNotNull() | earlier.isNotNull(), F.coalesce(total, F.lit(0.0)) + F.coalesce(earlier, F.lit(0.0)))
    rows = rows.withColumn("__blk", F.floor(total / NATS))
    block = Window.partitionBy(*part, "__blk").orderBy(_G)
    # nats since the block's first valid row, and the step into that row
    rows = rows.withColumn("__into", F.first("__nats", ignorenulls=True).over(block.rowsBetween(*upto)))
    rows = rows.withColumn("__since", F.sum("__nats").over(block.rowsBetween(*upto)) - F.col("__into"))
    rows = rows.withColumn("__s", F.exp(-F.col("__since")) * F.sum(F.col("__bx") * F.exp("__since")).over(block.rowsBetween(*upto)))
    decay = F.exp(-(F.col("__since") + F.col("__into")))
    if alone:
        rows = rows.withColumn("__before", F.lag("__s").over(Window.partitionBy(*keys).orderBy(_G)))
        rows = rows.withColumn("__before", F.first("__before").over(block.rowsBetween(*upto)))
    else:  # the row before a block's first row is the last one of the block before
        rows = _small(rows.select(_K, *cols, _G, "__blk", "__since", "__into", "__s"), "emarows")
        ends = rows.where(F.col("__blk").isNotNull()).groupBy(_K, "__blk").agg(
            F.min(_G).alias("__from"), F.max(_G).alias("__to"), F.max_by("__s", _G).alias("__end"))
        ends = _small(ends, "emablocks")
        before_it = ends.select(_K, (F.col("__to") + 1).alias("__from"), F.col("__end").alias("__before"))
        rows = rows.join(ends.join(before_it, [_K, "__from"]).select(_K, "__blk", "__before"), [_K, "__blk"], "left")
    return rows.select(*cols, (F.col("__s") + F.coalesce(decay * F.col("__before"), F.lit(0.0))).alias(out))
