"""Compile an expression into one lazy DataFrame over a panel.

Intermediate results are columns of *frames*: a frame is a DataFrame of
rows keyed by ``(keys, obs_time)``; a window op keeps the rows of its input
and adds a column to the same frame.  Rewrites, all on the tree before
Spark sees it:

* R1 — operands on the same frame with unique times need no alignment:
  ``(x - lag30(x)) / lag30(x)`` is one window plus a projection, not two
  self-joins.
* R2 — operands on different unique frames align with one union+groupBy
  (``tidemark.operators.align``); duplicates fall back to outer joins.
* R3 — equal sub-trees (canonical JSON) are compiled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import OBS_TIME, SERIES_CODE, VALUE, SeriesPanel
from tidemark.operators import window as W
from tidemark.operators.align import align, slot
from tidemark.operators.arith import binary, scaled
from tidemark.operators.composite import composite
from tidemark.plans import expr as X


class Frame:
    def __init__(self, df: DataFrame, unique: bool):
        self.df = df
        self.unique = unique


class Val:
    def __init__(self, frame: Frame, col: str, code: str | None = None):
        self.frame = frame
        self.col = col
        self.code = code  # set for panel leaves


class Compiler:
    def __init__(self, panel: SeriesPanel, plan: W.WindowPlan | None = None):
        self.panel = panel
        self.keys = list(panel.keys)
        self.plan = plan or W.WindowPlan.from_session(panel.df.sparkSession)
        self._memo: dict[str, Val] = {}
        self._aligned: dict[tuple, Frame] = {}
        self._n = 0

    def _fresh(self) -> str:
        self._n += 1
        return f"_n{self._n}"

    # -- leaves and operands ------------------------------------------------
    def leaf(self, code: str) -> Val:
        key = "leaf:" + code
        if key not in self._memo:
            c = self._fresh()
            self._memo[key] = Val(Frame(self.panel.leaf(code).withColumnRenamed(VALUE, c),
                                        self.panel.unique), c, code)
        return self._memo[key]

    def operand(self, operand) -> Val:
        kind, what = X.classify_operand(operand)
        return self.leaf(what) if kind == "leaf" else self.node(operand, what)

    def node(self, node: dict, t: str) -> Val:
        key = t + ":" + X.canonical(node)
        if key not in self._memo:
            self._memo[key] = {"series_math": self._series_math, "window_op": self._window_op,
                               "composite": self._composite}[t](node)
        return self._memo[key]

    # -- alignment ------------------------------------------------------------
    def _pivot_leaves(self, vals: list[Val]) -> tuple[Frame, list[Column]]:
        """Leaves of one unique panel: a single scan with ``code IN (...)``
        and one pivoting aggregate equal their full outer alignment."""
        codes = sorted({v.code for v in vals})
        key = ("pivot", tuple(codes))
        if key not in self._aligned:
            p = self.panel.df
            self._aligned[key] = Frame(
                p.where(F.col(SERIES_CODE).isin(codes)).groupBy(*self.keys, OBS_TIME).agg(
                    *[F.max(F.when(F.col(SERIES_CODE) == c, F.col(VALUE))).alias(f"_p{i}")
                      for i, c in enumerate(codes)]), True)
        return self._aligned[key], [F.col(f"_p{codes.index(v.code)}") for v in vals]

    def _together(self, vals: list[Val]) -> tuple[Frame, list[Column]]:
        if self.panel.unique and all(v.code for v in vals) and len({v.code for v in vals}) > 1:
            return self._pivot_leaves(vals)
        frames = []
        for v in vals:
            if not any(v.frame is f for f in frames):
                frames.append(v.frame)
        if all(f.unique for f in frames):
            if len(frames) == 1:
                return frames[0], [F.col(v.col) for v in vals]
            names = list(dict.fromkeys(v.col for v in vals))
            key = (frozenset(id(f) for f in frames), tuple(sorted(names)))
            if key in self._aligned:  # same frames, same columns: align once
                return self._aligned[key], [F.col(v.col) for v in vals]
            on = [*self.keys, OBS_TIME]
            parts = []
            for f in frames:
                cols = list(dict.fromkeys(v.col for v in vals if v.frame is f))
                parts.append(f.df.select(*on, *cols))
            u = parts[0]
            for p in parts[1:]:
                u = u.unionByName(p, allowMissingColumns=True)
            aligned = Frame(u.groupBy(*on).agg(*[F.max(c).alias(c) for c in names]), True)
            self._aligned[key] = aligned
            return aligned, [F.col(v.col) for v in vals]
        aligned = align([(v.frame.df, v.col) for v in vals], self.keys, unique=False, cell_rows=self.plan.cell_rows)
        return Frame(aligned, False), [F.col(slot(i)) for i in range(len(vals))]

    # -- node kinds -------------------------------------------------------------
    def _series_math(self, node: dict) -> Val:
        op = X.check_op(node, "series_math")
        left = self.operand(node.get("left"))
        right = self.operand(node.get("right"))
        frame, (cl, cr) = self._together([left, right])
        out = self._fresh()
        frame.df = frame.df.withColumn(out, scaled(binary(op, cl, cr), node.get("scale")))
        return Val(frame, out)

    def _window_op(self, node: dict) -> Val:
        op = X.check_op(node, "window_op")
        n = X.check_window(node)
        src = self.operand(node.get("series"))
        frame, out = src.frame, self._fresh()
        self.plan = self.plan.resolve(self.panel.df, self.keys, self.panel.unique)  # once, on first window op
        if op in W.ROLLING_AGGS:
            frame.df = W.rolling(frame.df, self.keys, src.col, n, op, out, self.plan)
        elif op == "ema":
            frame.df = W.ema(frame.df, self.keys, src.col, n, out, self.plan)
        elif op == "lag":
            frame.df = W.calendar_lag(frame.df, self.keys, src.col, n, out, self.plan)
        else:
            frame.df = W.shift(frame.df, self.keys, src.col, n, out, self.plan)
        return Val(frame, out)

    def _composite(self, node: dict) -> Val:
        op = X.check_op(node, "composite")
        vals = [self.operand(o) for o in X.check_operands(node)]
        frame, cols = self._together(vals)
        out = self._fresh()
        frame.df = frame.df.withColumn(out, composite(op, cols))
        return Val(frame, out)

    def compile_val(self, expression, expression_type) -> Val:
        return self.node(X.parse(expression), X.check_type(expression_type))

    def compile(self, expression, expression_type) -> DataFrame:
        v = self.compile_val(expression, expression_type)
        return v.frame.df.select(*self.keys, OBS_TIME, F.col(v.col).alias(VALUE))


def missing_series(panel: SeriesPanel, codes: list[str]) -> list[str]:
    """Wanted codes absent from the panel (one small aggregate)."""
    spark = panel.df.sparkSession
    wanted = spark.createDataFrame([(c,) for c in codes], "series_code string")
    found = panel.df.select("series_code").where(F.col("series_code").isin(codes)).distinct()
    return sorted(r[0] for r in wanted.join(found, "series_code", "left_anti").collect())


def evaluate(expression, expression_type, panel: SeriesPanel,
             plan: W.WindowPlan | None = None, check_series: bool = True) -> DataFrame:
    """Validate on the driver, then return the lazy result DataFrame
    ``keys, obs_time, value``.  A leaf without any row in the panel is an error (one
    pruned pass over the codes); ``check_series=False`` takes it as all NULL."""
    codes = X.validate(expression, expression_type)
    if check_series and codes:
        missing = missing_series(panel, codes)
        if missing:
            raise X.ExpressionEvaluationError(f"Series not found: {missing[0]}")
    return Compiler(panel, plan).compile(expression, expression_type)
