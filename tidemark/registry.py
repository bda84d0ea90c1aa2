"""Driver queries: each is a metric (or a run-data query) over the given
tables, with the equivalent DuckDB SQL used as the correctness oracle.

Series come from ``tidemark.sources.derived`` (SURVEY §7.3):
U = events per (user_id, event_type, day), E = events per (event_type, day),
O = orders per (o_orderpriority, day), L = lineitem per (l_returnflag, day).
Values are rounded identically on both sides (2 places for money series,
4 for event values; 3 where an average of 2 or 30 cent values can end in an
exact half cent): engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import OBS_TIME, VALUE, SeriesPanel
from tidemark.operators.window import WindowPlan
from tidemark.plans.compile import evaluate
from tidemark.sources import derived as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def load_all() -> None:
    """Import the modules whose queries register themselves."""
    from tidemark import registry_io, registry_runs  # noqa: F401


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int) -> DataFrame:
    return df.withColumn(VALUE, F.round(F.col(VALUE), places))


def leaf(code: str) -> dict:
    return {"series_code": code}


# ----------------------------------------------------------------- SQL ---
def nn(x: str) -> str:
    """NaN -> NULL (rule V1)."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def fin(x: str) -> str:
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END)"


DAY = "CAST(CAST({c} AS DATE) AS TIMESTAMP)"
U_SQL = (f"SELECT user_id, event_type AS code, {DAY.format(c='ts')} AS obs_time, SUM(value) AS value "
         "FROM events GROUP BY ALL")
E_SQL = (f"SELECT event_type AS code, {DAY.format(c='ts')} AS obs_time, SUM(value) AS value "
         "FROM events GROUP BY ALL")
O_SQL = (f"SELECT o_orderpriority, {DAY.format(c='o_orderdate')} AS obs_time, SUM(o_totalprice) AS value "
         "FROM orders GROUP BY ALL")
L_SQL = (f"SELECT l_returnflag, {DAY.format(c='l_shipdate')} AS obs_time, SUM(l_extendedprice) AS value "
         "FROM lineitem GROUP BY ALL")


def user_pair_sql(expr: str, left: str = "purchase", right: str = "view") -> str:
    return (f"WITH u AS ({U_SQL}), a AS (SELECT * FROM u WHERE code = '{left}'), "
            f"b AS (SELECT * FROM u WHERE code = '{right}') "
            "SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.obs_time, b.obs_time) AS obs_time, "
            f"ROUND({expr}, 4) AS value FROM a FULL JOIN b "
            "ON a.user_id = b.user_id AND a.obs_time = b.obs_time")


# ------------------------------------------------- M1-M5, V2: series math ---
def _user_math(op: str, scale=None, left="purchase", right="view"):
    e = {"op": op, "left": leaf(left), "right": leaf(right)}
    if scale is not None:
        e["scale"] = scale

    def q(spark, sf):
        return rounded(evaluate(e, "series_math", D.user_events(spark, sf)), 4)
    return q


register("series_add", user_pair_sql(nn("a.value + b.value")))(_user_math("add"))
register("series_subtract", user_pair_sql(nn("a.value - b.value")))(_user_math("subtract"))
register("series_multiply", user_pair_sql(nn("a.value * b.value")))(_user_math("multiply"))
register("series_ratio", user_pair_sql(nn("a.value / b.value")))(_user_math("ratio"))
register("series_scale", user_pair_sql(nn(nn("a.value / b.value") + " * 100.0")))(_user_math("ratio", 100))


@register("ratio_by_zero", user_pair_sql(nn("a.value / " + nn("b.value - b.value"))))
def ratio_by_zero(spark, sf):
    e = {"op": "ratio", "left": leaf("purchase"),
         "right": {"op": "subtract", "left": leaf("view"), "right": leaf("view")}}
    return rounded(evaluate(e, "series_math", D.user_events(spark, sf)), 4)


# -------------------------------------------------------- C1-C4: composites ---
def user_triple_sql(expr: str, source: str = U_SQL) -> str:
    return (f"WITH u AS ({source}), a AS (SELECT * FROM u WHERE code = 'click'), "
            "b AS (SELECT * FROM u WHERE code = 'view'), c AS (SELECT * FROM u WHERE code = 'purchase') "
            f"SELECT user_id, obs_time, ROUND({expr}, 4) AS value "
            "FROM a FULL JOIN b USING (user_id, obs_time) FULL JOIN c USING (user_id, obs_time)")


_SUM3 = "COALESCE(a.value, 0) + COALESCE(b.value, 0) + COALESCE(c.value, 0)"
_CNT3 = ("((a.value IS NOT NULL)::INT + (b.value IS NOT NULL)::INT + (c.value IS NOT NULL)::INT)")
_COMPOSITE_SQL = {
    "sum": _SUM3,
    "avg": f"CASE WHEN {_CNT3} > 0 THEN ({_SUM3}) / {_CNT3} END",
    "max": "GREATEST(a.value, b.value, c.value)",
    "min": "LEAST(a.value, b.value, c.value)",
}
# nulls injected by value: daily user sums under 20.0 become NULL
U_NULLS_SQL = (f"SELECT user_id, code, obs_time, CASE WHEN value < 20.0 THEN NULL ELSE value END AS value "
               f"FROM ({U_SQL})")


def _user_nulls(spark, sf) -> SeriesPanel:
    p = D.user_events(spark, sf)
    return SeriesPanel(p.df.withColumn(VALUE, F.when(F.col(VALUE) >= 20.0, F.col(VALUE))), p.keys, True)


def _composite_q(op: str, with_nulls: bool = False):
    e = {"op": op, "operands": [leaf("click"), leaf("view"), leaf("purchase")]}

    def q(spark, sf):
        panel = _user_nulls(spark, sf) if with_nulls else D.user_events(spark, sf)
        return rounded(evaluate(e, "composite", panel), 4)
    return q


for _op, _sql in _COMPOSITE_SQL.items():
    register(f"composite_{_op}", user_triple_sql(_sql))(_composite_q(_op))
register("composite_sum_all_null", user_triple_sql(_SUM3, U_NULLS_SQL))(_composite_q("sum", True))
register("composite_avg_nulls", user_triple_sql(_COMPOSITE_SQL["avg"], U_NULLS_SQL))(_composite_q("avg", True))
register("composite_max_nulls", user_triple_sql(_COMPOSITE_SQL["max"], U_NULLS_SQL))(_composite_q("max", True))


# ------------------------------------------------ W1, W3-W5: rolling ops ---
_SERIES = {
    "O": (D.order_priorities, "orders_total", "o_orderpriority", O_SQL),
    "L": (D.lineitem_flags, "revenue", "l_returnflag", L_SQL),
}
_ROLL_SQL = {"sma": "AVG", "sum": "SUM", "max": "MAX", "min": "MIN"}


def rolling_sql(series: str, agg: str, n: int, places: int = 2) -> str:
    _, _, key, src = _SERIES[series]
    x = fin("value")
    return (f"WITH s AS ({src}), x AS (SELECT {key}, obs_time, {x} AS fx FROM s) "
            f"SELECT {key}, obs_time, ROUND(CASE WHEN COUNT(fx) OVER w = {n} THEN {_ROLL_SQL[agg]}(fx) OVER w END, {places}) "
            f"AS value FROM x WINDOW w AS (PARTITION BY {key} ORDER BY obs_time, fx "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")


def _window_q(series: str, op: str, n: int, places: int = 2):
    loader, code, _, _ = _SERIES[series]
    e = {"op": op, "series": leaf(code), "window": n}

    def q(spark, sf):
        return rounded(evaluate(e, "window_op", loader(spark, sf)), places)
    return q


for _agg in _ROLL_SQL:
    register(f"{_agg}_7", rolling_sql("O", _agg, 7))(_window_q("O", _agg, 7))
    register(f"{_agg}_30", rolling_sql("L", _agg, 30, 3))(_window_q("L", _agg, 30, 3))


# ------------------------------------------------------------- W2: ema ---
def ema_sql(n: int, source: str, key: str) -> str:
    a = 2.0 / (n + 1.0)
    f = 1.0 - a
    return (f"WITH RECURSIVE s AS ({source}), "
            f"x AS (SELECT {key} AS k, obs_time, {fin('value')} AS fx, "
            f"ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY obs_time) AS rn FROM s), "
            "r(k, rn, obs_time, y, ow) AS ("
            "SELECT k, rn, obs_time, fx, 1.0::DOUBLE FROM x WHERE rn = 1 "
            "UNION ALL SELECT x.k, x.rn, x.obs_time, "
            f"CASE WHEN r.y IS NULL THEN x.fx WHEN x.fx IS NULL THEN r.y "
            f"ELSE ((r.ow * {f!r}) * r.y + {a!r} * x.fx) / ((r.ow * {f!r}) + {a!r}) END, "
            f"CASE WHEN r.y IS NULL OR x.fx IS NOT NULL THEN 1.0::DOUBLE ELSE r.ow * {f!r} END "
            "FROM r JOIN x ON x.k = r.k AND x.rn = r.rn + 1) "
            f"SELECT k AS {key}, obs_time, ROUND(y, 2) AS value FROM r")


register("ema_12", ema_sql(12, O_SQL, "o_orderpriority"))(_window_q("O", "ema", 12))
# gaps: daily totals under 200,000 become NULL
O_GAPS_SQL = (f"SELECT o_orderpriority, obs_time, CASE WHEN value < 200000.0 THEN NULL ELSE value END AS value "
              f"FROM ({O_SQL})")


def _orders_gaps(spark, sf) -> SeriesPanel:
    p = D.order_priorities(spark, sf)
    return SeriesPanel(p.df.withColumn(VALUE, F.when(F.col(VALUE) >= 200000.0, F.col(VALUE))), p.keys, True)


@register("ema_gaps", ema_sql(5, O_GAPS_SQL, "o_orderpriority"))
def ema_gaps(spark, sf):
    e = {"op": "ema", "series": leaf("orders_total"), "window": 5}
    return rounded(evaluate(e, "window_op", _orders_gaps(spark, sf)), 2)


# ---------------------------------------------- W6/J3, W7: lag and shift ---
def asof_sql(source: str, key: str, days: int, places: int) -> str:
    return (f"WITH s AS ({source}) SELECT a.{key}, a.obs_time, ROUND(b.value, {places}) AS value "
            f"FROM s a ASOF LEFT JOIN s b ON a.{key} = b.{key} "
            f"AND a.obs_time - INTERVAL {days} DAY >= b.obs_time")


register("lag_calendar_30", asof_sql(O_SQL, "o_orderpriority", 30, 2))(_window_q("O", "lag", 30))
_U_PURCHASE = f"SELECT user_id, obs_time, value FROM ({U_SQL}) WHERE code = 'purchase'"


@register("lag_calendar_sparse", asof_sql(_U_PURCHASE, "user_id", 7, 4))
def lag_calendar_sparse(spark, sf):
    e = {"op": "lag", "series": leaf("purchase"), "window": 7}
    return rounded(evaluate(e, "window_op", D.user_events(spark, sf)), 4)


register("shift_5", f"WITH s AS ({O_SQL}) SELECT o_orderpriority, obs_time, "
         "ROUND(LAG(value, 5) OVER (PARTITION BY o_orderpriority ORDER BY obs_time), 2) AS value FROM s"
         )(_window_q("O", "shift", 5))


# ------------------------------------------------- E2: nested expressions ---
GROWTH = {"op": "ratio",
          "left": {"op": "subtract", "left": leaf("orders_total"),
                   "right": {"op": "lag", "series": leaf("orders_total"), "window": 30}},
          "right": {"op": "lag", "series": leaf("orders_total"), "window": 30},
          "scale": 100}


@register("growth_30d",
          f"WITH s AS ({O_SQL}), l AS (SELECT a.o_orderpriority, a.obs_time, a.value AS v, b.value AS lv "
          "FROM s a ASOF LEFT JOIN s b ON a.o_orderpriority = b.o_orderpriority "
          "AND a.obs_time - INTERVAL 30 DAY >= b.obs_time) "
          f"SELECT o_orderpriority, obs_time, ROUND({nn(nn(nn('v - lv') + ' / lv') + ' * 100.0')}, 4) AS value FROM l")
def growth_30d(spark, sf):
    return rounded(evaluate(GROWTH, "series_math", D.order_priorities(spark, sf)), 4)


@register("sma_of_lag",
          f"WITH s AS ({O_SQL}), l AS (SELECT a.o_orderpriority, a.obs_time, b.value AS lv "
          "FROM s a ASOF LEFT JOIN s b ON a.o_orderpriority = b.o_orderpriority "
          "AND a.obs_time - INTERVAL 1 DAY >= b.obs_time), "
          f"x AS (SELECT o_orderpriority, obs_time, {fin('lv')} AS fx FROM l) "
          "SELECT o_orderpriority, obs_time, ROUND(CASE WHEN COUNT(fx) OVER w = 2 THEN AVG(fx) OVER w END, 3) "
          "AS value FROM x WINDOW w AS (PARTITION BY o_orderpriority ORDER BY obs_time "
          "ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)")
def sma_of_lag(spark, sf):
    e = {"op": "sma", "series": {"op": "lag", "series": leaf("orders_total"), "window": 1}, "window": 2}
    return rounded(evaluate(e, "window_op", D.order_priorities(spark, sf)), 3)


@register("avg_plus_series",
          f"WITH u AS ({E_SQL}), a AS (SELECT * FROM u WHERE code = 'click'), "
          "b AS (SELECT * FROM u WHERE code = 'view'), c AS (SELECT * FROM u WHERE code = 'purchase'), "
          "ab AS (SELECT obs_time, CASE WHEN (a.value IS NOT NULL)::INT + (b.value IS NOT NULL)::INT > 0 "
          "THEN (COALESCE(a.value, 0) + COALESCE(b.value, 0)) / ((a.value IS NOT NULL)::INT + "
          "(b.value IS NOT NULL)::INT) END AS v FROM a FULL JOIN b USING (obs_time)) "
          f"SELECT obs_time, ROUND({nn('ab.v + c.value')}, 4) AS value FROM ab FULL JOIN c USING (obs_time)")
def avg_plus_series(spark, sf):
    e = {"op": "add", "left": {"op": "avg", "operands": [leaf("click"), leaf("view")]},
         "right": leaf("purchase")}
    return rounded(evaluate(e, "series_math", D.event_types(spark, sf)), 4)


@register("ratio_of_composites",
          f"WITH u AS ({U_SQL}), a AS (SELECT * FROM u WHERE code = 'click'), "
          "b AS (SELECT * FROM u WHERE code = 'view'), c AS (SELECT * FROM u WHERE code = 'purchase'), "
          "s AS (SELECT user_id, obs_time, COALESCE(a.value, 0) + COALESCE(b.value, 0) AS v "
          "FROM a FULL JOIN b USING (user_id, obs_time)), "
          "m AS (SELECT user_id, obs_time, GREATEST(b.value, c.value) AS v FROM b FULL JOIN c USING (user_id, obs_time)) "
          f"SELECT user_id, obs_time, ROUND({nn('s.v / m.v')}, 4) AS value FROM s FULL JOIN m USING (user_id, obs_time)")
def ratio_of_composites(spark, sf):
    e = {"op": "ratio", "left": {"op": "sum", "operands": [leaf("click"), leaf("view")]},
         "right": {"op": "max", "operands": [leaf("view"), leaf("purchase")]}}
    return rounded(evaluate(e, "series_math", D.user_events(spark, sf)), 4)


@register("flagship_sma_ratio",
          f"WITH u AS ({E_SQL}), a AS (SELECT * FROM u WHERE code = 'purchase'), "
          "b AS (SELECT * FROM u WHERE code = 'view'), "
          f"r AS (SELECT COALESCE(a.obs_time, b.obs_time) AS obs_time, {nn('a.value / b.value')} AS v "
          "FROM a FULL JOIN b ON a.obs_time = b.obs_time), "
          f"x AS (SELECT obs_time, {fin('v')} AS fx FROM r) "
          "SELECT obs_time, ROUND(CASE WHEN COUNT(fx) OVER w = 7 THEN AVG(fx) OVER w END, 4) AS value "
          "FROM x WINDOW w AS (ORDER BY obs_time ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")
def flagship_sma_ratio(spark, sf):
    """Daily purchase value / view value over all users, 7-row sma (E)."""
    e = {"op": "sma", "series": {"op": "ratio", "left": leaf("purchase"), "right": leaf("view")}, "window": 7}
    return rounded(evaluate(e, "window_op", D.event_types(spark, sf)), 4)



# ------------------------------------- hot key: raw lineitem rows per flag ---
# l_returnflag 'N' holds about half of all lineitem rows.  These run the
# skew-safe chunked windows (small chunks, so a key spans many chunks) over
# raw order lines: duplicate times, ties ordered by value.
HOT_CHUNK = WindowPlan("chunked", 4096)
LI_SQL = ("SELECT l_returnflag, CAST(l_shipdate AS TIMESTAMP) AS obs_time, l_extendedprice AS value "
          "FROM lineitem")
# the same lines with one outlier date and, for 'N', most lines at one instant
UNEVEN_SQL = ("SELECT l_returnflag, CASE WHEN l_orderkey = 1 THEN TIMESTAMP '1900-01-01' "
              "WHEN l_returnflag = 'N' AND l_linenumber <= 4 THEN TIMESTAMP '1996-02-29' "
              "ELSE CAST(l_shipdate AS TIMESTAMP) END AS obs_time, l_extendedprice AS value FROM lineitem")


def lineitem_lines(spark, sf) -> SeriesPanel:
    from tidemark.model import as_panel
    return as_panel(D.table(spark, sf, "lineitem"), ["l_returnflag"], F.lit("line"), "l_shipdate",
                    "l_extendedprice", unique=False)


def uneven_lines(spark, sf) -> SeriesPanel:
    from tidemark.model import as_panel
    at = F.expr("CASE WHEN l_orderkey = 1 THEN TIMESTAMP_NTZ'1900-01-01 00:00:00' "
                "WHEN l_returnflag = 'N' AND l_linenumber <= 4 THEN TIMESTAMP_NTZ'1996-02-29 00:00:00' "
                "ELSE CAST(l_shipdate AS TIMESTAMP_NTZ) END")
    return as_panel(D.table(spark, sf, "lineitem").withColumn("at", at), ["l_returnflag"], F.lit("line"), "at",
                    "l_extendedprice", unique=False)


def _hot_q(lines, op: str, n: int, places: int):
    e = {"op": op, "series": leaf("line"), "window": n}

    def q(spark, sf):
        return rounded(evaluate(e, "window_op", lines(spark, sf), plan=HOT_CHUNK), places)
    return q


for _name, _lines, _sql in (("hot_key", lineitem_lines, LI_SQL), ("uneven", uneven_lines, UNEVEN_SQL)):
    register(f"{_name}_sum_30",
             f"WITH s AS ({_sql}) SELECT l_returnflag, obs_time, ROUND(CASE WHEN COUNT(value) OVER w = 30 "
             "THEN SUM(value) OVER w END, 2) AS value FROM s WINDOW w AS (PARTITION BY l_returnflag "
             "ORDER BY obs_time, value ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)")(_hot_q(_lines, "sum", 30, 2))
    register(f"{_name}_max_100",
             f"WITH s AS ({_sql}) SELECT l_returnflag, obs_time, ROUND(CASE WHEN COUNT(value) OVER w = 100 "
             "THEN MAX(value) OVER w END, 2) AS value FROM s WINDOW w AS (PARTITION BY l_returnflag "
             "ORDER BY obs_time, value ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)")(_hot_q(_lines, "max", 100, 2))
    register(f"{_name}_shift_3",
             f"WITH s AS ({_sql}) SELECT l_returnflag, obs_time, ROUND(LAG(value, 3) OVER (PARTITION BY "
             "l_returnflag ORDER BY obs_time, value), 2) AS value FROM s")(_hot_q(_lines, "shift", 3, 2))
    register(f"{_name}_lag_7",
             f"WITH s AS ({_sql}), d AS (SELECT l_returnflag, obs_time, MAX(value) AS mv FROM s GROUP BY ALL) "
             "SELECT s.l_returnflag, s.obs_time, ROUND(d.mv, 2) AS value FROM s ASOF LEFT JOIN d "
             "ON s.l_returnflag = d.l_returnflag AND s.obs_time - INTERVAL 7 DAY >= d.obs_time")(_hot_q(_lines, "lag", 7, 2))
    register(f"{_name}_ema_20", ema_sql(20, _sql, "l_returnflag").replace(
        "ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY obs_time)",
        "ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY obs_time, value)"))(_hot_q(_lines, "ema", 20, 2))


# ----------------------------- duplicate times: lines of two flags, aligned ---
# every line of one flag meets every line of the other of its day; one instant has many times
# a day's lines of both; lines of 'A' of 1992 have no time, so those of 'R' of 1992 meet none
PAIR_SQL = ("SELECT l_returnflag AS code, CASE WHEN l_linenumber = 7 AND l_quantity < 8 THEN TIMESTAMP '1996-02-29' "
            "WHEN l_returnflag = 'A' AND l_shipdate < DATE '1993-01-01' THEN NULL "
            "ELSE CAST(l_shipdate AS TIMESTAMP) END AS t, l_extendedprice AS v FROM lineitem WHERE l_returnflag IN ('A', 'R')")


@register("aligned_duplicates",
          f"WITH s AS ({PAIR_SQL}), a AS (SELECT t, v FROM s WHERE code = 'A'), r AS (SELECT t, v FROM s WHERE code = 'R') "
          "SELECT COALESCE(a.t, r.t) AS obs_time, ROUND(a.v - r.v, 2) AS value FROM a FULL JOIN r ON a.t IS NOT DISTINCT FROM r.t")
def aligned_duplicates(spark, sf):
    """Full outer alignment of raw lines; the hot instants are dealt to a grid of cells."""
    from tidemark.model import as_panel
    at = F.expr("CASE WHEN l_linenumber = 7 AND l_quantity < 8 THEN TIMESTAMP_NTZ'1996-02-29 00:00:00' "
                "WHEN l_returnflag = 'A' AND l_shipdate < DATE'1993-01-01' THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP_NTZ) END")
    lines = D.table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("A", "R")).withColumn("at", at)
    panel = as_panel(lines, [], "l_returnflag", "at", "l_extendedprice", unique=False)
    return rounded(evaluate({"op": "subtract", "left": leaf("A"), "right": leaf("R")}, "series_math", panel,
                            plan=WindowPlan(cell_rows=32)), 2)
