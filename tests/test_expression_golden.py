"""Evaluator results against pandas primitives on irregular random series, and
hand-made cases for the rules (NaN/Inf, gaps, duplicates, errors)."""

import math

import numpy as np
import pandas as pd
import pytest

from tests.conftest import make_panel, values
from tidemark.operators.window import WindowPlan
from tidemark.plans.compile import evaluate
from tidemark.plans.expr import ExpressionEvaluationError, InvalidExpressionError, infer_type

A = {"series_code": "A"}
B = {"series_code": "B"}
C = {"series_code": "C"}
PLANS = [WindowPlan("partition"), WindowPlan("chunked", 2)]


def ev(spark, series, expr, etype, plan=None, **kw):
    return values(evaluate(expr, etype, make_panel(spark, series, **kw), plan=plan))



def irregular(seed, n=40, span=70, nulls=0.1, days=None):
    """A series on ``n`` of ``span`` days, some values missing."""
    rng = np.random.default_rng(seed)
    at = sorted(rng.choice(span, n, replace=False).tolist()) if days is None else days
    return pd.Series([None if rng.random() < nulls else round(float(rng.normal(20, 9)), 3) for _ in at], index=at, dtype="float64")


def rows_of(series):
    return [(d, None if math.isnan(v) else v) for d, v in series.items()]


def same(got, want):
    want = [None if math.isnan(v) else v for v in want]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g is None if w is None else g == pytest.approx(w, rel=1e-9)


@pytest.mark.parametrize("scale", [None, -2.5])
@pytest.mark.parametrize("op", ["add", "ratio", "subtract", "multiply"])
def test_series_math(spark, op, scale):
    a, b = irregular(11), irregular(12)
    x, y = a.align(b, join="outer")
    want = {"add": x + y, "ratio": x / y, "subtract": x - y, "multiply": x * y}[op] * (1 if scale is None else scale)
    e = {"op": op, "left": A, "right": B} | ({} if scale is None else {"scale": scale})
    same(ev(spark, {"A": rows_of(a), "B": rows_of(b)}, e, "series_math"), want)


def test_ratio_by_zero_is_ieee(spark):
    got = ev(spark, {"A": [1.0, 0.0, -1.0, 1.0], "B": [0.0, 0.0, 0.0, -0.0]},
             {"op": "ratio", "left": A, "right": B}, "series_math")
    assert got[0] == math.inf and got[1] is None and got[2] == -math.inf and got[3] == -math.inf


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
@pytest.mark.parametrize("n", [1, 4, 41])
@pytest.mark.parametrize("op", ["sma", "sum", "max", "min", "lag", "shift"])
def test_window_ops(spark, plan, op, n):
    a = irregular(21, nulls=0.05)
    if op == "lag":  # the last row at or before n days earlier
        at = np.array(a.index)
        found = np.searchsorted(at, at - n, side="right") - 1
        want = pd.Series([a.iloc[i] if i >= 0 else math.nan for i in found])
    elif op == "shift":
        want = a.shift(n)
    else:
        want = getattr(a.rolling(n, min_periods=n), {"sma": "mean"}.get(op, op))()
    same(ev(spark, {"A": rows_of(a)}, {"op": op, "series": A, "window": n}, "window_op", plan), want)


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
def test_ema_equals_pandas(spark, plan):
    a = irregular(22, nulls=0.3)
    want = a.ewm(span=7, adjust=False).mean()
    same(ev(spark, {"A": rows_of(a)}, {"op": "ema", "series": A, "window": 7}, "window_op", plan), want)


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
def test_ema_with_gaps(spark, plan):
    got = ev(spark, {"A": [1.0, None, None, 4.0]}, {"op": "ema", "series": A, "window": 3}, "window_op", plan)
    assert got[:3] == [1, 1, 1] and abs(got[3] - 3.4) < 1e-12


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
def test_ema_leading_nulls_and_inf(spark, plan):
    got = ev(spark, {"A": [None, 2.0, math.inf, 2.0]}, {"op": "ema", "series": A, "window": 3}, "window_op", plan)
    assert got[0] is None and got[1] == 2 and got[2] == 2 and abs(got[3] - 2) < 1e-12


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
def test_rolling_inf_and_null_blank_window(spark, plan):
    got = ev(spark, {"A": [1.0, math.inf, 3.0, 4.0, None, 6.0, 7.0]}, {"op": "sum", "series": A, "window": 2},
             "window_op", plan)
    assert got == [None, None, None, 7, None, None, 13]


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
def test_calendar_lag_is_asof_backward(spark, plan):
    # days 0,1,5,9: lag 3 days looks up t-3 -> last row at or before it
    data = {"A": [(0, 10.0), (1, 11.0), (5, None), (9, 19.0)]}
    got = ev(spark, data, {"op": "lag", "series": A, "window": 3}, "window_op", plan)
    assert got == [None, None, 11, None]  # t=9 -> day 6 -> row of day 5 (null, not skipped)


@pytest.mark.parametrize("op", ["sum", "avg", "max", "min"])
def test_composites(spark, op):
    parts = {k: irregular(i, nulls=0.2) for i, k in enumerate("ABC", 31)}
    table = pd.concat(parts, axis=1).sort_index()
    want = getattr(table, {"avg": "mean"}.get(op, op))(axis=1)
    same(ev(spark, {k: rows_of(v) for k, v in parts.items()}, {"op": op, "operands": [A, B, C]}, "composite"), want)


@pytest.mark.parametrize("op,want", [("sum", 0.0), ("avg", None), ("max", None), ("min", None)])
def test_composite_all_null_row(spark, op, want):
    got = ev(spark, {"A": [None, 1.0], "B": [None, math.inf]}, {"op": op, "operands": [A, B]}, "composite")
    assert got[0] == want
    assert got[1] == (1.0 if op == "min" else math.inf)


def test_nested_math_and_composite(spark):
    parts = {k: irregular(i) for i, k in enumerate("ABC", 41)}
    t = pd.concat(parts, axis=1).sort_index()
    data = {k: rows_of(v) for k, v in parts.items()}
    e = {"op": "subtract", "left": {"op": "multiply", "left": A, "right": B}, "right": C}
    same(ev(spark, data, e, "series_math"), t.A * t.B - t.C)
    e = {"op": "ratio", "left": {"op": "avg", "operands": [A, B]}, "right": C}
    same(ev(spark, data, e, "series_math"), t[["A", "B"]].mean(axis=1) / t.C)


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.strategy)
def test_nested_window_of_shift(spark, plan):
    a = irregular(51, nulls=0)
    e = {"op": "max", "series": {"op": "shift", "series": A, "window": 2}, "window": 3}
    same(ev(spark, {"A": rows_of(a)}, e, "window_op", plan), a.shift(2).rolling(3, min_periods=3).max())


@pytest.mark.parametrize("unique", [True, False])
def test_duplicates_multiply_in_join(spark, unique):
    data = {"A": [(0, 1.0), (0, 2.0)], "B": [(0, 10.0), (0, 20.0)]}
    if unique:
        data = {"A": [(0, 1.0)], "B": [(0, 10.0)]}
    got = ev(spark, data, {"op": "add", "left": A, "right": B}, "series_math", unique=False)
    assert sorted(got) == ([11, 12, 21, 22] if not unique else [11])


def test_growth_self_alignment(spark):
    a = irregular(61, n=50, span=50, nulls=0)
    lag = {"op": "lag", "series": A, "window": 7}
    e = {"op": "ratio", "left": {"op": "subtract", "left": A, "right": lag}, "right": lag, "scale": 100}
    same(ev(spark, {"A": rows_of(a)}, e, "series_math"), a.pct_change(7, fill_method=None) * 100)


# ----------------------------------------------------------------- errors ---
@pytest.mark.parametrize("expr,etype,msg", [
    ({"left": A, "right": B}, "series_math", "Missing operation in series_math expression"),
    ({"op": "pow", "left": A, "right": B}, "series_math", "Unknown series_math op: pow"),
    ({"series": A, "window": 3}, "window_op", "Missing operation in window_op expression"),
    ({"op": "median", "series": A, "window": 3}, "window_op", "Unknown window_op: median"),
    ({"op": "sma", "series": A, "window": 0}, "window_op", "Invalid window: 0"),
    ({"op": "sma", "series": A, "window": "3"}, "window_op", "Invalid window: 3"),
    ({"op": "sma", "series": A, "window": True}, "window_op", "Invalid window: True"),
    ({"op": "sma", "series": A, "window": 2.5}, "window_op", "Invalid window: 2.5"),
    ({"operands": [A, B]}, "composite", "Missing operation in composite expression"),
    ({"op": "median", "operands": [A, B]}, "composite", "Unknown composite op: median"),
    ({"op": "sum", "operands": [A]}, "composite", "Composite requires at least 2 operands"),
    ({"op": "add", "left": A}, "series_math", "Missing operand"),
    ({"op": "add", "left": A, "right": {"foo": 1}}, "series_math", "Cannot resolve operand"),
    ({"op": "add", "left": A, "right": {"op": ""}}, "series_math", "Missing operation in operand"),
    ({"op": "add", "left": A, "right": {"op": "nope", "left": A, "right": B}}, "series_math",
     "Unknown operation: nope"),
    ({"op": "add", "left": A, "right": B}, "pipeline_x", "Unknown expression type: pipeline_x"),
])
def test_validation_errors(spark, expr, etype, msg):
    with pytest.raises(InvalidExpressionError, match=msg):
        evaluate(expr, etype, make_panel(spark, {"A": [1.0], "B": [2.0]}))


def test_series_not_found(spark):
    with pytest.raises(ExpressionEvaluationError, match="Series not found: Z"):
        evaluate({"op": "add", "left": A, "right": {"series_code": "Z"}}, "series_math",
                 make_panel(spark, {"A": [1.0]}), check_series=True)


def test_type_inference_by_structure():
    assert infer_type({"op": "sum", "series": A, "window": 3}) == "window_op"
    assert infer_type({"op": "sum", "operands": [A, B]}) == "composite"
    assert infer_type({"op": "add", "left": A, "right": B}) == "series_math"
    assert infer_type({"op": "max"}) == "composite"
    with pytest.raises(InvalidExpressionError, match="Unknown operation: sma"):
        infer_type({"op": "sma"})
