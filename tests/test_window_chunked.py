"""Skew-safe (chunked) windows equal the per-key ones and pandas, on a panel
with one hot key, gaps, nulls and infinities, cut into many small chunks."""

import math
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark import registry
from tidemark.model import as_panel
from pyspark.sql import functions as F

from tidemark.operators import window as W
from tidemark.operators.window import WindowPlan
from tidemark.plans.compile import evaluate

A = {"series_code": "A"}


@pytest.fixture(scope="module")
def panel_data():
    rng = np.random.default_rng(7)
    rows = []
    for key, n in (("hot", 400), ("k1", 30), ("k2", 3)):
        days = np.sort(rng.choice(np.arange(n * 3), size=n, replace=False))
        for d in days:
            r = rng.random()
            v = None if r < 0.12 else (math.inf if r < 0.15 else float(np.round(rng.normal(100, 30), 2)))
            rows.append((key, "A", datetime(2020, 1, 1) + timedelta(days=int(d)), v))
    return rows


def _pandas_expected(rows, op, n):
    pdf = pd.DataFrame(rows, columns=["k", "code", "t", "v"]).astype({"v": "float64"})
    out = []
    for k, g in pdf.groupby("k"):
        g = g.sort_values("t")
        s = g.set_index("t")["v"]
        if op == "sma":
            r = s.rolling(n, min_periods=n).mean()
        elif op == "sum":
            r = s.rolling(n, min_periods=n).sum()
        elif op == "max":
            r = s.rolling(n, min_periods=n).max()
        elif op == "min":
            r = s.rolling(n, min_periods=n).min()
        elif op == "ema":
            r = s.ewm(span=n, adjust=False).mean()
        elif op == "shift":
            r = s.shift(n)
        else:  # lag: as-of backward by n days
            tgt = pd.DataFrame({"tt": s.index - pd.Timedelta(days=n)})
            m = pd.merge_asof(tgt, s.rename("v").reset_index().rename(columns={"t": "tt"}), on="tt")
            r = pd.Series(m["v"].to_numpy(), index=s.index)
        out += [(k, t, None if (isinstance(x, float) and math.isnan(x)) else x) for t, x in r.items()]
    return sorted(out, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("op,n", [("sma", 5), ("sum", 3), ("max", 4), ("min", 7), ("ema", 6),
                                  ("ema", 1), ("ema", 90), ("shift", 3), ("lag", 10), ("lag", 45)])
@pytest.mark.parametrize("plan", [WindowPlan("chunked", 16), WindowPlan("chunked", 3), WindowPlan("partition")],
                         ids=["chunk16", "chunk3", "partition"])
def test_matches_pandas(spark, panel_data, op, n, plan):
    df = spark.createDataFrame(panel_data, "k string, code string, t timestamp_ntz, v double")
    panel = as_panel(df, ["k"], "code", "t", "v", unique=True)
    got = evaluate({"op": op, "series": A, "window": n}, "window_op", panel, plan=plan).toPandas()
    got = sorted(((r.k, r.obs_time, None if r.value != r.value else r.value) for r in got.itertuples()),
                 key=lambda r: (r[0], r[1]))
    want = _pandas_expected(panel_data, op, n)
    assert len(got) == len(want)
    for (gk, gt, gv), (wk, wt, wv) in zip(got, want):
        assert (gk, gt) == (wk, pd.Timestamp(wt).to_pydatetime())
        if wv is None or gv is None:
            assert gv is None and wv is None, (gk, gt, gv, wv)
        elif math.isinf(wv):
            assert gv == wv
        else:
            assert abs(gv - wv) <= 1e-9 * max(1.0, abs(wv)), (gk, gt, gv, wv)


@pytest.mark.parametrize("when", ["outlier", "instant", "equal", "null"])
def test_buckets_are_even(spark, when):
    """One key with an outlier date, all rows at one instant, all rows equal, or null times."""
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(5000):
        t = {"outlier": start + timedelta(hours=i), "null": None}.get(when, start)
        rows.append((datetime(1900, 1, 1) if when == "outlier" and i == 0 else t, 1.0 if when == "equal" else float(i * 7919 % 5000)))
    df = spark.createDataFrame(rows, "obs_time timestamp_ntz, v double").withColumn("k", F.lit("hot"))
    dealt = W._dealt(df, ["k"], WindowPlan("chunked", 100), W._order("v"))
    sizes = [r["count"] for r in dealt.groupBy("__b").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 200
    # places follow (key, time, value) over the buckets
    got = [r["v"] for r in dealt.orderBy("__b", "__p").collect()]
    assert got == [r[1] for r in sorted(rows, key=lambda r: (r[0] or start, r[1]))]
    out = W.shift(df, ["k"], "v", 1, "before", WindowPlan("chunked", 100)).collect()
    assert len(out) == 5000 and sum(r["before"] is None for r in out) == 1


def test_small_buckets_share_tasks(spark):
    """Dealing takes tasks by rows, not by buckets, so what the driver gets doesn't grow with the buckets."""
    rows = [(datetime(2024, 1, 1) + timedelta(hours=i % 700), float(i * 7919 % 5000), "ab"[i % 5 == 0]) for i in range(5000)]
    df = spark.createDataFrame(rows, "obs_time timestamp_ntz, v double, k string")
    dealt = W._dealt(df, ["k"], WindowPlan("chunked", 10), W._order("v"))
    assert len(dealt.inputFiles()) <= spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in dealt.groupBy("__b").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 10
    got = [(r["k"], r["obs_time"], r["v"]) for r in dealt.orderBy("__b", "__p").collect()]
    assert got == sorted((k, t, v) for t, v, k in rows)


@pytest.fixture(scope="module")
def lines_dir(tmp_path_factory):
    """2,000 order lines, most of one flag, many of one day or of equal price."""
    sf = tmp_path_factory.mktemp("lines")
    i = np.arange(2000)
    pd.DataFrame({"l_orderkey": i // 5, "l_linenumber": i % 5 + 1, "l_returnflag": np.where(i % 9 < 6, "N", np.where(i % 2, "A", "R")),
                  "l_shipdate": np.datetime64("1994-01-01", "us") + (i * 7919 % 300).astype("timedelta64[D]"),
                  "l_extendedprice": (i * 104729 % 1500) / 4}).to_parquet(sf / "lineitem.parquet")
    return str(sf)


@pytest.mark.parametrize("name", ["hot_key_lag_7", "uneven_shift_3", "uneven_sum_30", "hot_key_shift_3",
                                  "hot_key_sum_30", "uneven_max_100", "hot_key_max_100", "uneven_ema_20"])
def test_driver_gets_results_by_tasks_not_by_buckets(spark, lines_dir, monkeypatch, name):
    """Rows cut into 125 buckets or more are dealt by a few tasks, with the rows of the SQL."""
    files, small = [], W._small

    def counted(df, tag):
        out = small(df, tag)
        if tag == "buckets":
            files.append(len(out.inputFiles()))
        return out
    monkeypatch.setattr(W, "_small", counted)
    monkeypatch.setattr(registry, "HOT_CHUNK", WindowPlan("chunked", 16))
    df = registry.QUERIES[name](spark, lines_dir)
    assert files and max(files) <= spark.sparkContext.defaultParallelism
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{lines_dir}/lineitem.parquet')")
    want = con.execute(registry.ORACLE[name])
    assert df.columns == [c[0] for c in want.description]
    by = lambda r: (r[0], r[1], r[2] is None, r[2])
    assert sorted((tuple(r) for r in df.collect()), key=by) == sorted(want.fetchall(), key=by)


@pytest.mark.parametrize("plan", [WindowPlan("chunked", 50), WindowPlan("partition")], ids=["chunk50", "partition"])
def test_long_windows_equal_pandas(spark, panel_data, monkeypatch, plan):
    """Block heads and tails in place of frames; no value is lost beside much larger ones."""
    monkeypatch.setattr(W, "LONG_WINDOW", 1)
    rng = np.random.default_rng(3)
    rows = [("mixed", "A", datetime(2020, 1, 1) + timedelta(days=i), float(rng.normal() * 10.0 ** rng.integers(-8, 9))) for i in range(200)]
    rows += [r for r in panel_data if r[0] == "hot"][:150] + [("dense", "A", datetime(2021, 1, 1) + timedelta(days=i), float(i % 17)) for i in range(130)]
    df = spark.createDataFrame(rows, "k string, code string, obs_time timestamp_ntz, v double")
    for op, n in (("sma", 2), ("sum", 5), ("max", 9), ("min", 100), ("sum", 130)):
        got = {(r.k, r.obs_time): r.o for r in W.rolling(df, ["k"], "v", n, op, "o", plan).collect()}
        pdf = pd.DataFrame(rows, columns=["k", "code", "t", "v"]).astype({"v": "float64"})
        checked = 0
        for k, g in pdf.sort_values("t").groupby("k"):
            v = np.where(np.isfinite(g["v"]), g["v"], np.nan)
            for i, t in enumerate(g["t"]):
                part, have = v[max(0, i - n + 1):i + 1], got.pop((k, t.to_pydatetime()))
                if len(part) < n or np.isnan(part).any():
                    assert have is None
                    continue
                checked += 1
                exact = {"max": max, "min": min}.get(op, math.fsum)(part.tolist()) / (n if op == "sma" else 1)
                assert abs(have - exact) <= 1e-12 * math.fsum(abs(part)), (op, n, k, have, exact)
        assert not got and checked > 30


def test_ema_over_many_blocks_and_long_gaps(spark):
    rng = np.random.default_rng(5)
    v = [None if 300 < i < 900 or rng.random() < 0.3 else float(rng.normal() * 10.0 ** rng.integers(0, 6)) for i in range(2000)]
    df = spark.createDataFrame([(datetime(2020, 1, 1) + timedelta(hours=i), x) for i, x in enumerate(v)], "obs_time timestamp_ntz, v double")
    for span in (2, 7):
        want = pd.Series(v, dtype="float64").ewm(span=span, adjust=False).mean().tolist()
        scale = pd.Series(v, dtype="float64").abs().ewm(span=span, adjust=False).mean().tolist()
        for plan in (WindowPlan("partition"), WindowPlan("chunked", 300)):
            out = W.ema(df.withColumn("k", F.lit(None).cast("string")), ["k"], "v", span, "o", plan)
            plan_text = out._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in plan_text and "Pandas" not in plan_text
            got = [r.o for r in out.orderBy("obs_time").collect()]
            assert len(got) == len(want)
            assert all((g is None and math.isnan(w)) or abs(g - w) <= 1e-11 * s for g, w, s in zip(got, want, scale))
