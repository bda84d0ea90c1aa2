"""Driver queries over run data: requests, node tables, read sets,
validation, ledger, manifests (S11/S12, N, E3/E5/E6, J4, T7-T10).

Requests are derived from ``customer`` (one metric run per customer; the
segment picks the expression, the nation key its parameters), so their
number grows with the table.  A ledger is derived from ``orders`` (one run
per order).  Both derivations are written once in SQL, run by Spark over a
temp view and by DuckDB over the pre-registered table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.nodes import node_table, read_set, request_checks
from tidemark.registry import register
from tidemark.sinks import ledger as LG
from tidemark.sources import derived as D

_S = lambda x: f"CAST({x} AS STRING)"
REQUESTS_SQL = f"""
SELECT 'run-' || {_S('c_custkey')} AS run_id,
       'metric.' || lower(c_mktsegment) AS metric_code,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'window_op' WHEN 'FURNITURE' THEN 'composite'
                         WHEN 'MACHINERY' THEN 'composite' ELSE 'series_math' END AS expression_type,
       CASE c_mktsegment
         WHEN 'AUTOMOBILE' THEN '{{"op":"ratio","left":{{"series_code":"purchase"}},"right":{{"series_code":"view"}},"scale":' || {_S('c_nationkey')} || '}}'
         WHEN 'BUILDING' THEN '{{"op":"sma","series":{{"series_code":"click"}},"window":' || {_S('c_nationkey')} || '}}'
         WHEN 'FURNITURE' THEN '{{"op":"sum","operands":[{{"series_code":"click"}},{{"series_code":"view"}},{{"series_code":"signup"}}]}}'
         WHEN 'HOUSEHOLD' THEN '{{"op":"ratio","left":{{"op":"subtract","left":{{"series_code":"view"}},"right":{{"op":"lag","series":{{"series_code":"view"}},"window":' || {_S('c_nationkey + 1')} || '}}}},"right":{{"op":"lag","series":{{"series_code":"view"}},"window":' || {_S('c_nationkey + 1')} || '}}}}'
         ELSE '{{"op":"' || CASE WHEN c_acctbal < 0 THEN 'median' ELSE 'avg' END || '","operands":[{{"series_code":"error"}},{{"series_code":"refund"}}]}}'
       END AS expression_json
FROM __CUSTOMER__"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    D.table(spark, sf, "customer").createOrReplaceTempView("tidemark_customer")
    return spark.sql(REQUESTS_SQL.replace("__CUSTOMER__", "tidemark_customer"))


def _req_sql(body: str) -> str:
    return f"WITH req AS ({REQUESTS_SQL.replace("__CUSTOMER__", "customer")}) {body}"


# ------------------------------------------------------- S12, S11: series ---
@register("available_series",
          "SELECT DISTINCT event_type AS series_code FROM events")
def available_series(spark, sf):
    return D.user_events(spark, sf).codes()


@register("missing_series", _req_sql(
    "SELECT DISTINCT run_id, unnest(regexp_extract_all(expression_json, '\"series_code\":\"([^\"]+)\"', 1)) "
    "AS series_code FROM req EXCEPT SELECT run_id, event_type FROM req, (SELECT DISTINCT event_type FROM events)"))
def missing_series(spark, sf):
    nodes = node_table(requests(spark, sf))
    codes = D.user_events(spark, sf).codes()
    return read_set(nodes).join(codes, "series_code", "left_anti")


# ----------------------------------------------- N, E3, E5, E6: node table ---
_W = "('sma','ema','sum','max','min','lag','shift')"
_C = "('sum','avg','max','min')"
_M = "('add','subtract','multiply','ratio')"


def _infer_sql(j: str) -> str:
    op = f"json_extract_string({j}, '$.op')"
    has = lambda k: f"(json_extract({j}, '$.{k}') IS NOT NULL)"
    return (f"CASE WHEN json_extract_string({j}, '$.series_code') IS NOT NULL THEN NULL "
            f"WHEN {has('series')} AND {has('window')} AND {op} IN {_W} THEN 'window_op' "
            f"WHEN {has('operands')} AND {op} IN {_C} THEN 'composite' "
            f"WHEN {has('left')} AND {has('right')} AND {op} IN {_M} THEN 'series_math' "
            f"WHEN {op} IN {_M} THEN 'series_math' WHEN {op} IN {_C} THEN 'composite' END")


NODES_SQL = (f"WITH RECURSIVE req AS ({REQUESTS_SQL.replace("__CUSTOMER__", "customer")}), "
             "n(run_id, node, parent, slot, j, t) AS ("
             "SELECT run_id, '0', NULL::VARCHAR, NULL::VARCHAR, expression_json::JSON, "
             "CASE WHEN json_extract_string(expression_json, '$.series_code') IS NULL THEN expression_type END FROM req "
             "UNION ALL "
             f"SELECT n.run_id, n.node || '.' || CAST(c.idx AS VARCHAR), n.node, c.slot, c.cj, {_infer_sql('c.cj')} "
             "FROM n, LATERAL ("
             "SELECT 'left' AS slot, 0::BIGINT AS idx, json_extract(n.j, '$.left') AS cj WHERE n.t = 'series_math' "
             "UNION ALL SELECT 'right', 1, json_extract(n.j, '$.right') WHERE n.t = 'series_math' "
             "UNION ALL SELECT 'series', 0, json_extract(n.j, '$.series') WHERE n.t = 'window_op' "
             "UNION ALL SELECT 'operands', i, json_extract(n.j, '$.operands[' || i || ']') "
             "FROM range(0::BIGINT, COALESCE(json_array_length(n.j, '$.operands'), 0)::BIGINT) r(i) "
             "WHERE n.t = 'composite') c) ")


@register("expression_nodes", NODES_SQL +
          "SELECT run_id, node, parent, slot, t AS node_type, json_extract_string(j, '$.op') AS op, "
          "json_extract_string(j, '$.series_code') AS series_code, json_extract_string(j, '$.window') AS window "
          "FROM n")
def expression_nodes(spark, sf):
    return node_table(requests(spark, sf)).select("run_id", "node", "parent", "slot", "node_type", "op",
                                                  "series_code", "window")


@register("request_read_set", NODES_SQL +
          "SELECT DISTINCT run_id, json_extract_string(j, '$.series_code') AS series_code FROM n "
          "WHERE json_extract_string(j, '$.series_code') IS NOT NULL")
def request_read_set(spark, sf):
    return read_set(node_table(requests(spark, sf)))


# Oracle for the checks on these requests: the rules that can fire on them
# (window below 1 at the root of a window op; unknown composite op).
@register("request_checks", _req_sql(
    "SELECT run_id, CASE "
    "WHEN expression_type = 'window_op' AND CAST(json_extract_string(expression_json, '$.window') AS BIGINT) < 1 "
    "THEN 'Invalid window: ' || json_extract_string(expression_json, '$.window') "
    f"WHEN expression_type = 'composite' AND json_extract_string(expression_json, '$.op') NOT IN {_C} "
    "THEN 'Unknown composite op: ' || json_extract_string(expression_json, '$.op') END AS error FROM req"))
def request_checks_q(spark, sf):
    return request_checks(node_table(requests(spark, sf)))


# ------------------------------------------------ ledger from orders ---
def ledger(spark: SparkSession, sf: str) -> DataFrame:
    o = D.table(spark, sf, "orders")
    p = F.col("o_totalprice")
    err = (F.when(p < 50000, F.lit("Series not found: refund"))
           .when(p < 100000, F.lit("Invalid window: 0"))
           .when(p < 150000, F.lit("Manifest run_id mismatch: a != b"))
           .when(p < 200000, F.lit("Missing operation in series_math expression"))
           .when(p < 250000, F.lit("Failed to write output"))
           .when(p < 300000, F.lit("Expression too deep"))
           .when(p < 350000, F.lit("Schema validation failed"))
           .otherwise(F.lit("worker lost")))
    status = (F.when(F.col("o_orderstatus") == "F", "SUCCESS")
              .when(F.col("o_orderstatus") == "O", "FAILURE").otherwise("STARTED"))
    return o.select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderpriority").alias("metric_code"), status.alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH-mm-ss").alias("version_ts"),
        ((F.floor(F.col("o_totalprice")).cast("long") % 1000) - 100).alias("row_count"),
        F.when(status == "FAILURE", F.concat(LG.classify_error(err), F.lit(": "), err)).alias("error"),
        F.col("o_orderdate").alias("started_at"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_custkey") % 2000).cast("decimal(18,6)"))
         ).alias("finished_at"),
        F.col("o_custkey"))


_ERR_SQL = ("CASE WHEN o_totalprice < 50000 THEN 'Series not found: refund' "
            "WHEN o_totalprice < 100000 THEN 'Invalid window: 0' "
            "WHEN o_totalprice < 150000 THEN 'Manifest run_id mismatch: a != b' "
            "WHEN o_totalprice < 200000 THEN 'Missing operation in series_math expression' "
            "WHEN o_totalprice < 250000 THEN 'Failed to write output' "
            "WHEN o_totalprice < 300000 THEN 'Expression too deep' "
            "WHEN o_totalprice < 350000 THEN 'Schema validation failed' ELSE 'worker lost' END")


def _code_sql(m: str) -> str:
    return (f"CASE WHEN contains({m}, 'Series not found') THEN 'INPUT_READ_ERROR' "
            f"WHEN contains({m}, 'Expression') OR contains({m}, 'Invalid') THEN 'EXPRESSION_EVAL_ERROR' "
            f"WHEN contains({m}, 'Manifest') OR contains(lower({m}), 'validation') THEN 'MANIFEST_VALIDATION_ERROR' "
            f"WHEN contains({m}, 'S3') OR contains(lower({m}), 'write') THEN 'OUTPUT_WRITE_ERROR' "
            "ELSE 'INTERNAL_ERROR' END")


LEDGER_SQL = ("SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS metric_code, "
              "CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILURE' ELSE 'STARTED' END AS status, "
              "strftime(o_orderdate, '%Y-%m-%dT%H-%M-%S') AS version_ts, "
              "(CAST(floor(o_totalprice) AS BIGINT) % 1000) - 100 AS row_count, "
              f"CASE WHEN o_orderstatus = 'O' THEN {_code_sql(_ERR_SQL)} || ': ' || {_ERR_SQL} END AS error, "
              "o_orderdate AS started_at, o_orderdate + to_seconds(o_custkey % 2000) AS finished_at, o_custkey "
              "FROM orders")


@register("error_codes", f"SELECT run_id, split_part(error, ':', 1) AS error_code FROM ({LEDGER_SQL}) "
          "WHERE status = 'FAILURE'")
def error_codes(spark, sf):
    return ledger(spark, sf).where("status = 'FAILURE'").select(
        "run_id", F.split(F.col("error"), ":").getItem(0).alias("error_code"))


@register("run_stats", f"SELECT status, CASE WHEN status = 'FAILURE' THEN split_part(error, ':', 1) END AS error_code, "
          "COUNT(*) AS runs, COUNT(*) FILTER (status = 'STARTED') AS started, " + ", ".join(
              f"SUM(CASE WHEN epoch(finished_at) - epoch(started_at) <= {b} THEN 1 ELSE 0 END) AS le_{b}s"
              for b in LG.DURATION_BUCKETS) + ", " + ", ".join(
              f"COUNT(*) FILTER (status = 'SUCCESS' AND o_custkey * 100000 <= {b} * 1048576) AS le_{LG.mb_name(b)}mb"
              for b in LG.MB_BUCKETS) + f" FROM ({LEDGER_SQL}) GROUP BY ALL")
def run_stats(spark, sf):
    wrote = F.when(F.col("status") == "SUCCESS", F.col("o_custkey").cast("long") * 100000)
    return LG.run_stats(ledger(spark, sf).withColumn("write_bytes", wrote))


def manifests(spark: SparkSession, sf: str) -> DataFrame:
    lg = ledger(spark, sf).where("status = 'SUCCESS'")
    k = F.col("o_custkey")
    return lg.select(
        "run_id", "metric_code",
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("version_ts")).alias("version_ts"), "row_count",
        F.struct(F.when(k % 13 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("metrics/"), F.col("metric_code"), F.lit("/data"))).alias("data_prefix"),
                 F.when(k % 17 == 0, F.array().cast("array<string>"))
                 .otherwise(F.array(F.lit("metrics.jsonl"))).alias("files")).alias("outputs"),
        F.when(k % 7 == 0, F.lit("run-other")).otherwise(F.col("run_id")).alias("expected_run_id"),
        F.when(k % 5 == 0, F.lit("other")).otherwise(F.col("metric_code")).alias("expected_metric_code"))


_MANIFESTS_SQL = (f"SELECT run_id, metric_code, CASE WHEN o_custkey % 11 = 0 THEN '' ELSE version_ts END AS version_ts, "
                  "row_count, CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE 'metrics/' || metric_code || '/data' END AS data_prefix, "
                  "CASE WHEN o_custkey % 17 = 0 THEN 0 ELSE 1 END AS n_files, "
                  "CASE WHEN o_custkey % 7 = 0 THEN 'run-other' ELSE run_id END AS expected_run_id, "
                  "CASE WHEN o_custkey % 5 = 0 THEN 'other' ELSE metric_code END AS expected_metric_code "
                  f"FROM ({LEDGER_SQL}) WHERE status = 'SUCCESS'")


@register("manifest_checks", f"SELECT run_id, CASE "
          "WHEN run_id <> expected_run_id THEN 'Manifest run_id mismatch: ' || run_id || ' != ' || expected_run_id "
          "WHEN metric_code <> expected_metric_code THEN 'Manifest metric_code mismatch: ' || metric_code || ' != ' || expected_metric_code "
          "WHEN version_ts = '' THEN 'Manifest missing version_ts' "
          "WHEN row_count < 0 THEN 'Invalid row_count: ' || CAST(row_count AS VARCHAR) "
          "WHEN data_prefix IS NULL THEN 'Manifest missing outputs.data_prefix' "
          "WHEN n_files = 0 THEN 'Manifest missing outputs.files' END AS error "
          f"FROM ({_MANIFESTS_SQL})")
def manifest_checks(spark, sf):
    return LG.manifest_checks(manifests(spark, sf)).select("run_id", "error")


@register("latest_output", "SELECT metric_code, run_id, version_ts, row_count FROM ("
          "SELECT *, ROW_NUMBER() OVER (PARTITION BY metric_code ORDER BY version_ts DESC, run_id DESC) AS rn "
          f"FROM ({_MANIFESTS_SQL}) WHERE version_ts <> '') WHERE rn = 1")
def latest_output(spark, sf):
    m = manifests(spark, sf).where("version_ts <> ''")
    return LG.latest_output(m).select("metric_code", "run_id", "version_ts", "row_count")


@register("runs_not_done", _req_sql(
    f"SELECT run_id, metric_code FROM req WHERE run_id NOT IN "
    f"(SELECT run_id FROM ({LEDGER_SQL}) WHERE status = 'SUCCESS')"))
def runs_not_done(spark, sf):
    return LG.not_yet_done(requests(spark, sf), ledger(spark, sf), on=("run_id",)).select("run_id", "metric_code")
