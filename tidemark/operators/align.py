"""Align operands on ``(keys, obs_time)`` with full-outer semantics.

Each operand is ``(DataFrame with keys + obs_time, value column)``.  The
result has ``keys, obs_time, _a0 .. _a{n-1}``: one row per matched time,
NULL where an operand has no row.  Null keys and null times match each
other (pandas merge semantics).

* operands unique on (keys, obs_time): one ``union`` + ``groupBy`` — one
  shuffle for any number of operands, hash aggregation, no sort.  The
  group key includes ``obs_time``, so a hot series spreads over tasks.
* otherwise a left fold of null-safe full outer joins, which multiplies
  duplicate times as the reference does (2 x 2 -> 4 rows).  An instant where an
  operand has more than ``cell_rows`` rows, or the operands give more than ``HOT_OUT`` (one aggregate tells; setting
  ``spark.tidemark.align.cellRows`` in ``WindowPlan``) would meet in one task, and a full outer join
  is not split at run time.  Its rows are dealt to a grid instead: every operand is
  cut into parts, a cell takes one part of each, and gives the product of their rows.
  Parts have about ``cell_rows`` rows, more where that would be more than ``GRID_CELLS`` cells
  (up to ``MOST_CELLS``, where a cell would give over ``CELL_OUT`` rows): a row has a bounded
  number of copies, so what is shuffled grows with the rows and not with their products.
  The copies are of *blocks*, arrays of a part's values; only a cell's task unfolds them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import OBS_TIME
from tidemark.session import written

CELL_ROWS = 2_000
GRID_CELLS, MOST_CELLS = 36, 4_096  # of one instant
CELL_OUT = 1 << 22  # rows that a cell gives
HOT_OUT = 1 << 18  # combinations from which an instant is hot: tasks are cut by the size of what meets, not of what it gives
BLOCK_PAIRS = 1 << 15  # combinations that a meeting of blocks gives: they are in memory together
BLOCK_ROWS = 32  # of the first operand
TASK_OUT = 1 << 23  # rows that a task of cells gives
MOST_TASKS = 4_096
_CELL, _HERE, _ID, _HOT, _BLOCK = "__cell", "__here", "__id", "__hot", "__block"


def slot(i: int) -> str:
    return f"_a{i}"


def _fold(sides: list[DataFrame], on: list[str]) -> DataFrame:
    """Null-safe full outer joins of ``sides``, from the left."""
    acc = sides[0]
    for side in sides[1:]:
        cols = [c for c in side.columns if c not in on]
        right = side.select(*[F.col(k).alias(f"__r_{k}") for k in on], *cols)
        cond = reduce(lambda a, b: a & b, [acc[k].eqNullSafe(right[f"__r_{k}"]) for k in on])
        acc = acc.join(right, cond, "full").select(
            *[F.coalesce(acc[k], right[f"__r_{k}"]).alias(k) for k in on], *[c for c in acc.columns if c not in on], *cols)
    return acc


def _hot_instants(sides: list[DataFrame], on: list[str], cell_rows: int) -> DataFrame:
    """``on``, the operands that have rows there, and the number of parts of each, of the
    instants where one has more than ``cell_rows`` rows or they give more than ``HOT_OUT``."""
    rows = reduce(lambda a, b: a.unionByName(b), [s.select(*on, F.lit(i).alias("__slot")) for i, s in enumerate(sides)])
    # counts per operand are merged map-side: a hot instant is a few rows here
    counts = rows.groupBy(*on, "__slot").agg(F.count(F.lit(1)).alias("n")).groupBy(*on).agg(
        F.map_from_entries(F.collect_list(F.struct("__slot", "n"))).alias("n"), F.max("n").alias("most"))
    n = [F.coalesce(F.col("n")[i], F.lit(0)) for i in range(len(sides))]
    out = reduce(lambda a, b: a * b, [F.greatest(F.lit(1), x).cast("double") for x in n])
    cells = F.least(F.lit(float(MOST_CELLS)), F.greatest(F.lit(float(GRID_CELLS)), out / CELL_OUT))
    most = F.greatest(F.lit(1), F.floor(F.pow(cells, F.lit(1.0 / len(sides))) + 1e-9))
    parts = F.array(*[F.greatest(F.lit(1), F.least(most, F.ceil(x / cell_rows))).cast("long") for x in n])
    hot = counts.where((F.col("most") > cell_rows) | (out > HOT_OUT)).select(
        *on, F.sort_array(F.map_keys("n")).alias(_HERE), parts.alias("__parts"), F.array(*n).alias("__rows"), out.alias("__out"))
    # numbered: cells are known by the number of their instant
    return written(hot.withColumn(_HOT, F.monotonically_increasing_id()), "hot-instants")


def _met(side: DataFrame, hot: DataFrame, on: list[str], how: str) -> DataFrame:
    """``side`` at the instants of ``hot`` (inner, with its columns) or at the others (left_anti)."""
    other = hot.select(*[F.col(k).alias(f"__h_{k}") for k in on], _HOT)
    cond = reduce(lambda a, b: a & b, [side[k].eqNullSafe(other[f"__h_{k}"]) for k in on])
    return side.join(other, cond, how)


def _block_rows(i: int, n_sides: int) -> int:
    """Values in a block of operand ``i``: blocks that meet give ``BLOCK_PAIRS`` rows at most, or nearly."""
    return BLOCK_ROWS if i == 0 else max(1, int((BLOCK_PAIRS / BLOCK_ROWS) ** (1 / (n_sides - 1)) + 1e-9))


def _blocks(side: DataFrame, i: int, n_sides: int, hot: DataFrame, on: list[str]) -> DataFrame:
    """The hot rows of operand ``i`` as blocks: the instant's number, the block's part, the
    array of its values (instants without rows of this operand: one block of a null).  Blocks
    go by the rows' numbers, which are written before use, so a repeated task deals them alike."""
    rows = written(_met(side, hot, on, "inner").select(_HOT, slot(i), F.monotonically_increasing_id().alias(_ID)), "hot-rows")
    own = F.col("__parts")[i]
    sizes = hot.select(_HOT, own.alias("__own"), (own * F.ceil(F.col("__rows")[i] / (own * _block_rows(i, n_sides)))).alias("__n"))
    # a block holds its share of the rows: null values stand as such
    dealt = rows.join(sizes, _HOT).select(
        _HOT, F.pmod(F.xxhash64(_ID), "__n").alias(_BLOCK), "__own", F.struct(F.col(slot(i)).alias("v")).alias("__v"))
    blocks = dealt.groupBy(_HOT, _BLOCK, "__own").agg(F.collect_list("__v").alias("__vs")).select(
        _HOT, (F.col(_BLOCK) % F.col("__own")).alias("__part"), F.col("__vs.v").alias("__vs"))
    none = hot.where(~F.array_contains(_HERE, i)).select(_HOT, F.lit(0).cast("long").alias("__part"),
                                                         F.array(F.lit(None).cast(side.schema[slot(i)].dataType)).alias("__vs"))
    return blocks.unionByName(none)


def _celled_blocks(side: DataFrame, i: int, n_sides: int, hot: DataFrame, on: list[str]) -> DataFrame:
    """The blocks of operand ``i``, once in every cell of their part: the instant's number,
    the cell, the values; for the first operand also ``on``."""
    met = _blocks(side, i, n_sides, hot, on).join(hot.select(_HOT, "__parts", *(on if i == 0 else [])), _HOT)
    below = F.aggregate(F.slice("__parts", 1, i), F.lit(1).cast("long"), lambda a, x: a * x)
    met = met.withColumn("__own", F.col("__parts")[i]).withColumn("__below", below).withColumn(
        "__others", F.expr("aggregate(__parts, 1L, (a, x) -> a * x) div __own"))
    met = met.withColumn("__o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__others") - 1)))
    cell = F.expr("__o % __below + __below * (__part + __own * (__o div __below))")
    return met.select(_HOT, cell.alias(_CELL), *(on if i == 0 else []), F.col("__vs").alias(slot(i)))


def _celled(side: DataFrame, i: int, hot: DataFrame, on: list[str], n_sides: int = 2) -> DataFrame:
    """The hot rows of operand ``i`` in their cells, unfolded."""
    return _celled_blocks(side, i, n_sides, hot, on).withColumn(slot(i), F.explode(slot(i)))


def _grid(sides: list[DataFrame], hot: DataFrame, on: list[str]) -> DataFrame:
    """All combinations of the operands' rows at the hot instants: ``on``, the values."""
    out = hot.agg(F.sum("__out")).first()[0]
    tasks = int(min(MOST_TASKS, max(int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), out // TASK_OUT)))
    # as many tasks as the result needs: it is far larger than the blocks that meet
    dealt = [_celled_blocks(s, i, len(sides), hot, on).repartition(tasks, _HOT, _CELL) for i, s in enumerate(sides)]
    met = reduce(lambda a, b: a.join(b.hint("merge"), [_HOT, _CELL]), dealt)
    for i in range(len(sides)):
        met = met.withColumn(slot(i), F.explode(slot(i)))
    return met.select(*on, *[slot(i) for i in range(len(sides))])


def align(operands: list[tuple[DataFrame, str]], keys: list[str], unique: bool, cell_rows: int = CELL_ROWS) -> DataFrame:
    if not operands:
        raise ValueError("Empty series list")
    on = [*keys, OBS_TIME]
    if unique:
        parts = [df.select(*on, F.lit(i).alias("__slot"), F.col(c).alias("__v"))
                 for i, (df, c) in enumerate(operands)]
        u = reduce(lambda a, b: a.unionByName(b), parts)
        return u.groupBy(*on).agg(*[F.max(F.when(F.col("__slot") == i, F.col("__v"))).alias(slot(i))
                                    for i in range(len(operands))])
    sides = [df.select(*on, F.col(c).alias(slot(i))) for i, (df, c) in enumerate(operands)]
    if len(sides) == 1:
        return sides[0]
    hot = _hot_instants(sides, on, cell_rows)
    if hot.isEmpty():
        return _fold(sides, on)
    cold = _fold([_met(s, hot, on, "left_anti") for s in sides], on)
    return cold.unionByName(_grid(sides, hot, on))
