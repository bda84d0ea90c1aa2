"""Full outer alignment with duplicate times: hot instants in cells equal plain outer joins."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import align as A
from tests.conftest import day


def plain(sides):
    """Every combination of the rows of one (key, time), absent operands null."""
    at = collections.defaultdict(lambda: [[] for _ in sides])
    for i, rows in enumerate(sides):
        for k, t, v in rows:
            at[(k, t)][i].append(v)
    return collections.Counter((k, t, *vs) for (k, t), held in at.items() for vs in itertools.product(*[h or [None] for h in held]))


def frames(spark, sides):
    return [(spark.createDataFrame(r, "k string, obs_time timestamp_ntz, v double").repartition(3), "v") for r in sides]


@pytest.mark.parametrize("n_sides,cell_rows", [(2, 3), (2, 1), (3, 4), (2, 10_000)])
def test_grid_equals_outer_joins(spark, n_sides, cell_rows):
    rng = np.random.default_rng(n_sides * 100 + cell_rows)
    sides = []
    for i in range(n_sides):
        rows = [(str(rng.integers(2)), day(int(rng.integers(8))), float(rng.integers(5))) for _ in range(30)]
        rows += [("hot", day(1), float(j % 3)) for j in range(12 + i)]  # one instant, equal rows
        rows += [("only" + str(i), day(2), 1.0)] * 9  # many rows that meet none
        rows += [(None, None, None if j % 2 else 2.0) for j in range(5 + i)]  # null keys, times and values
        rows += [("few", day(3), float(j)) for j in range(11 if i == 0 else 1)]
        sides.append(rows)
    got = A.align(frames(spark, sides), ["k"], unique=False, cell_rows=cell_rows)
    assert got.columns == ["k", "obs_time", *[A.slot(i) for i in range(n_sides)]]
    assert collections.Counter(tuple(r) for r in got.collect()) == plain(sides)


def test_hot_instant_is_spread_over_cells(spark):
    sides = [[("a", day(0), float(j)) for j in range(300)], [("a", day(0), float(j)) for j in range(200)]]
    ops = [df.select("k", "obs_time", F.col("v").alias(A.slot(i))) for i, (df, _) in enumerate(frames(spark, sides))]
    hot = A._hot_instants(ops, ["k", "obs_time"], 50)
    assert [tuple(r["__parts"]) for r in hot.collect()] == [(6, 4)]
    for i, (df, copies) in enumerate(zip(ops, (4, 6))):
        cells = collections.Counter(r["__cell"] for r in A._celled(df, i, hot, ["k", "obs_time"]).collect())
        assert len(cells) == 24 and sum(cells.values()) == len(sides[i]) * copies and max(cells.values()) <= 100


def test_empty_sides(spark):
    none = [[], []]
    assert A.align(frames(spark, none), ["k"], unique=False, cell_rows=1).collect() == []
    half = [[("a", day(0), 1.0)] * 5, []]
    assert len(A.align(frames(spark, half), ["k"], unique=False, cell_rows=1).collect()) == 5


def test_copies_of_hot_rows_are_bounded(spark):
    """What is dealt to cells follows the rows, not the pairs: few parts, values in blocks."""
    on, copied = ["k", "obs_time"], []
    for n in (1000, 4000):
        sides = [[("a", day(0), float(j)) for j in range(n)], [("a", day(0), None if j % 5 == 0 else float(j)) for j in range(n // 2)]]
        ops = [df.select("k", "obs_time", F.col("v").alias(A.slot(i))) for i, (df, _) in enumerate(frames(spark, sides))]
        hot = A._hot_instants(ops, on, 2)
        assert hot.count() == 1 and np.prod(hot.first()["__parts"]) <= A.GRID_CELLS
        copied.append(sum(A._celled(df, i, hot, on).count() for i, df in enumerate(ops)))
        blocks = A._celled_blocks(ops[0], 0, 2, hot, on).select(F.size(A.slot(0)).alias("n"), A._CELL).collect()
        assert len(blocks) < sum(r["n"] for r in blocks) / 8
    assert copied[0] <= 1500 * 6 and copied[1] <= 4 * copied[0]


def test_grid_of_many_blocks(spark, monkeypatch):
    """Several blocks a part, in several cells, of three operands with an absent one."""
    monkeypatch.setattr(A, "BLOCK_ROWS", 3)
    monkeypatch.setattr(A, "BLOCK_PAIRS", 12)
    sides = [[("a", day(0), float(j % 7) if j % 3 else None) for j in range(40)] + [("b", None, 1.0)] * 8,
             [("a", day(0), float(j % 4)) for j in range(25)], [("a", day(0), float(j)) for j in range(6)] + [(None, day(1), 2.0)] * 9]
    got = A.align(frames(spark, sides), ["k"], unique=False, cell_rows=5)
    assert collections.Counter(tuple(r) for r in got.collect()) == plain(sides)


def test_large_products_of_few_rows_are_spread_over_tasks(spark):
    """Instants below ``cell_rows`` rows that give many: the rows that meet are small enough for
    one task, what they give is not."""
    sides = [[("a", day(d), float(j)) for d in range(12) for j in range(550)] for _ in range(2)]
    out = A.align(frames(spark, sides), ["k"], unique=False)
    rows = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r["n"] for r in rows) == 12 * 550 * 550 and len(rows) > 1
