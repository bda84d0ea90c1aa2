"""Driver queries that write and read back (K1-K6, S1-S15, T1-T6, §7.4).

They write under the session's shared checkpoint folder
(``spark.checkpoint.dir``), a fresh sub-folder per call.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import OBS_TIME, VALUE
from tidemark.plans.batch import evaluate_requests
from tidemark.plans.compile import evaluate
from tidemark.registry import E_SQL, O_SQL, ORACLE, QUERIES, register
from tidemark.registry_runs import _req_sql, requests
from tidemark.session import scratch_folder
from tidemark.sinks import ledger as LG
from tidemark.sinks import output as OUT
from tidemark.sources import derived as D
from tidemark.sources import manifest as M
from tidemark.sources import series as SR
from tidemark.streaming import requests as RQ


scratch = scratch_folder


def store_events(spark: SparkSession, sf: str, root: str) -> str:
    ev = D.table(spark, sf, "events").select(
        F.col("ts").alias("obs_time"), "value", F.col("event_type").alias("internal_series_code"))
    return store(spark, ev, root, "events_store")


def store(spark: SparkSession, ev: DataFrame, root: str, dataset_id: str) -> str:
    """Write stored observations ``{root}/projections/series=X/year=Y/month=M``
    plus a dataset manifest listing the files; returns the manifest path."""
    data = f"{root}/projections"
    (ev.withColumn("series", F.col("internal_series_code"))
     .withColumn("year", F.year("obs_time")).withColumn("month", F.month("obs_time"))
     .write.mode("overwrite").option("compression", "snappy").partitionBy("series", "year", "month").parquet(data))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(data).select("path"))
    rel = files.select(F.regexp_extract("path", r"/projections/(.*)$", 1).alias("f"))
    stats = ev.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("internal_series_code").alias("k"),
                   F.min("obs_time").alias("lo"), F.max("obs_time").alias("hi"))
    manifest = stats.crossJoin(rel.agg(F.sort_array(F.collect_list("f")).alias("files"))).select(
        F.lit("v1").alias("version_id"), F.lit(dataset_id).alias("dataset_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.date_format(F.current_date(), "yyyy-MM-dd").alias("collection_date"),
        F.col("n").alias("data_points_count"), F.col("k").alias("series_count"),
        F.lit(None).cast("array<string>").alias("series_codes"),
        F.struct(F.col("lo").cast("string").alias("min_obs_time"),
                 F.col("hi").cast("string").alias("max_obs_time")).alias("date_range"),
        F.col("files").alias("parquet_files"), F.array(F.lit("series")).alias("partitions"),
        F.lit("series_year_month").alias("partition_strategy"))
    codes = ev.select("internal_series_code").distinct().agg(
        F.sort_array(F.collect_list("internal_series_code")).alias("c"))
    manifest = manifest.drop("series_codes").crossJoin(codes.select(F.col("c").alias("series_codes")))
    path = f"{root}/manifest"
    manifest.coalesce(1).write.mode("overwrite").json(path)
    return path


@register("manifest_scan",
          "SELECT 'events_store' AS dataset_id, event_type AS series_code, ts AS obs_time, value "
          "FROM events WHERE event_type IN ('click', 'view', 'purchase')")
def manifest_scan(spark, sf):
    root = scratch(spark, "store")
    mpath = store_events(spark, sf, root)
    catalog = spark.createDataFrame([("events_store", mpath, f"{root}/projections")],
                                    "dataset_id string, manifest_path string, projections_path string")
    wanted = spark.createDataFrame([("events_store", c) for c in ("click", "view", "purchase")],
                                   "dataset_id string, series_code string")
    return SR.read_series(spark, catalog, wanted).df


@register("cross_dataset_ratio",
          f"WITH o AS (SELECT obs_time AS t, value AS v FROM ({O_SQL}) WHERE o_orderpriority = '1-URGENT'), "
          f"e AS (SELECT obs_time AS t, value AS v FROM ({E_SQL}) WHERE code = 'view') "
          "SELECT COALESCE(o.t, e.t) AS obs_time, ROUND(o.v / e.v, 4) AS value FROM o FULL JOIN e ON o.t = e.t")
def cross_dataset_ratio(spark, sf):
    """One expression over series of two stored datasets."""
    catalog, wanted = [], []
    for name, day, code, value, tab in (("events_store", "ts", "event_type", "value", "events"),
                                        ("orders_store", "o_orderdate", "o_orderpriority", "o_totalprice", "orders")):
        root = scratch(spark, name)
        daily = D.table(spark, sf, tab).groupBy(F.col(day).cast("date").cast("timestamp_ntz").alias("obs_time"),
                                                F.col(code).alias("internal_series_code")).agg(F.sum(value).alias("value"))
        catalog.append((name, store(spark, daily, root, name), f"{root}/projections"))
        wanted.append((name, "view" if tab == "events" else "1-URGENT"))
    panel = SR.read_series(spark, spark.createDataFrame(catalog, "dataset_id string, manifest_path string, projections_path string"),
                           spark.createDataFrame(wanted, "dataset_id string, series_code string"))
    ratio = {"op": "ratio", "left": {"series_code": "1-URGENT"}, "right": {"series_code": "view"}}
    return evaluate(ratio, "series_math", SR.one_panel(panel)).withColumn(VALUE, F.round(VALUE, 4))


@register("jsonl_roundtrip", ORACLE["flagship_sma_ratio"])
def jsonl_roundtrip(spark, sf):
    out = scratch(spark, "jsonl")
    n = OUT.write_jsonl(QUERIES["flagship_sma_ratio"](spark, sf), out)
    back = spark.read.schema(f"{OBS_TIME} timestamp_ntz, {VALUE} double").json(out)
    if back.count() != n:
        raise RuntimeError("row count observed at write differs from rows read back")
    return back


# every request's first error: the validation rules that occur in them, else a series without rows
_CHECKED = """chk AS (
  SELECT run_id, metric_code, expression_type, expression_json AS j, regexp_extract_all(expression_json, '"series_code":"([^"]+)"', 1) AS codes,
    CAST(nullif(regexp_extract(expression_json, '"window":([0-9]+)', 1), '') AS INTEGER) AS win,
    CAST(nullif(regexp_extract(expression_json, '"scale":([0-9]+)', 1), '') AS DOUBLE) AS scale FROM req),
e AS (SELECT event_type AS code, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS t, SUM(value) AS v FROM events GROUP BY ALL),
gone AS (SELECT run_id, metric_code, min(code) AS code FROM (SELECT run_id, metric_code, unnest(codes) AS code FROM chk)
  WHERE code NOT IN (SELECT code FROM e) GROUP BY ALL),
runs AS (SELECT chk.*, CASE WHEN j LIKE '%"op":"median"%' THEN 'INTERNAL_ERROR: Unknown composite op: median'
    WHEN expression_type = 'window_op' AND win < 1 THEN 'EXPRESSION_EVAL_ERROR: Invalid window: ' || win
    WHEN gone.code IS NOT NULL THEN 'INPUT_READ_ERROR: Series not found: ' || gone.code END AS error
  FROM chk LEFT JOIN gone USING (run_id, metric_code))"""


@register("batch_requests", _req_sql(f""", {_CHECKED},
kinds AS (SELECT DISTINCT expression_type, j, codes, win, scale FROM runs WHERE error IS NULL),
pts AS (SELECT DISTINCT j, t FROM kinds, e WHERE list_contains(codes, e.code)),
wide AS (SELECT t, max(v) FILTER (code = 'purchase') AS p, max(v) FILTER (code = 'view') AS w, max(v) FILTER (code = 'click') AS c,
  max(v) FILTER (code = 'signup') AS s, max(v) FILTER (code = 'error') AS er, max(v) FILTER (code = 'refund') AS re FROM e GROUP BY t),
clicks AS (SELECT t, v, row_number() OVER (ORDER BY t) AS r FROM e WHERE code = 'click'),
val AS (
  SELECT k.j, pts.t, CASE
    WHEN k.j LIKE '%purchase%' THEN wide.p / wide.w * k.scale
    WHEN k.expression_type = 'window_op' THEN (SELECT CASE WHEN count(*) = k.win THEN avg(y.v) END FROM clicks x JOIN clicks y
      ON y.r BETWEEN x.r - k.win + 1 AND x.r WHERE x.t = pts.t)
    WHEN k.j LIKE '%"op":"sum"%' THEN coalesce(wide.c, 0) + coalesce(wide.w, 0) + coalesce(wide.s, 0)
    WHEN k.j LIKE '%"op":"lag"%' THEN (wide.w - (SELECT arg_max(v, b.t) FROM e b WHERE code = 'view' AND b.t <= pts.t - to_days(k.win)))
      / (SELECT arg_max(v, b.t) FROM e b WHERE code = 'view' AND b.t <= pts.t - to_days(k.win))
    ELSE list_avg([wide.er, wide.re]) END AS v
  FROM kinds k JOIN pts ON pts.j = k.j JOIN wide ON wide.t = pts.t)
SELECT run_id, val.t AS obs_time, ROUND(CASE WHEN isnan(v) THEN NULL ELSE v END, 8) AS value FROM runs JOIN val USING (j) WHERE error IS NULL"""))
def batch_requests(spark, sf):
    """All customer-derived runs in one plan over E; failures drop out."""
    results, _failed = evaluate_requests(requests(spark, sf), D.event_types(spark, sf))
    return results.withColumn(VALUE, F.round(VALUE, 8))  # no average of up to 24 sums ends in a half there


@register("request_stream", _req_sql(f""", {_CHECKED}
SELECT run_id, metric_code, CASE WHEN error IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
  CASE WHEN error IS NULL THEN (SELECT count(DISTINCT t) FROM e WHERE list_contains(runs.codes, e.code)) END AS row_count, error
FROM runs"""))
def request_stream(spark, sf):
    """Requests as JSON lines -> file stream -> foreachBatch runs -> ledger.  Every run reads
    its inputs, all event types, from the daily sums stored as a dataset."""
    root = scratch(spark, "stream")
    daily = D.event_types(spark, sf).df.select("obs_time", "value", F.col("series_code").alias("internal_series_code")).persist()
    manifest = store(spark, daily, root, "events")
    inputs = F.array(*[F.struct(F.lit("events").alias("datasetId"), F.lit(r[0]).alias("seriesCode"))
                       for r in daily.select("internal_series_code").distinct().orderBy("internal_series_code").collect()])
    req = requests(spark, sf)
    body = F.to_json(F.struct(F.lit(RQ.REQUEST_TYPE).alias("type"), F.col("run_id").alias("runId"),
                              F.col("metric_code").alias("metricCode"),
                              F.col("expression_type").alias("expressionType"),
                              F.col("expression_json").alias("expressionJson"),
                              inputs.alias("inputs"), F.struct(F.create_map(F.lit("events"), F.struct(
                                  F.lit(manifest).alias("manifestPath"), F.lit(f"{root}/projections").alias("projectionsPath")))
                                  .alias("datasets")).alias("catalog"),
                              F.struct(F.lit(f"{root}/out").alias("basePath")).alias("output")))
    # every third customer's request arrives wrapped in a notification envelope
    wrapped = F.to_json(F.struct(F.lit("Notification").alias("Type"), body.alias("Message"),
                                 F.struct(F.struct(F.lit(RQ.REQUEST_TYPE).alias("Value")).alias("type"))
                                 .alias("MessageAttributes")))
    num = F.regexp_extract("run_id", r"(\d+)$", 1).cast("long")
    req.select(F.when(num % 3 == 0, wrapped).otherwise(body).alias("value")).write.mode("overwrite").text(f"{root}/in")
    RQ.run_stream(spark, f"{root}/in", f"{root}/out", f"{root}/ledger", f"{root}/ckpt")
    daily.unpersist()
    return (LG.read_ledger(spark, f"{root}/ledger").where("status <> 'STARTED'")
            .select("run_id", "metric_code", "status", "row_count", "error"))


@register("bound_runs", f"""
WITH e AS (SELECT code, obs_time AS t, value AS v FROM ({E_SQL})), o AS (SELECT o_orderpriority AS code, obs_time AS t, value AS v FROM ({O_SQL})),
half AS (SELECT t FROM (SELECT t, row_number() OVER (ORDER BY t) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT t FROM e)) WHERE r = n // 2 + 1),
v AS (SELECT t, v FROM e WHERE code = 'view'), early AS (SELECT v.* FROM v, half WHERE v.t < half.t),
u AS (SELECT t, v FROM o WHERE code = '1-URGENT'),
kinds AS (SELECT 0 AS k, count(*) AS n, sum(v) AS s FROM early UNION ALL SELECT 1, count(*), sum(v) FROM v
  UNION ALL SELECT 2, count(*), sum(v) FROM u
  UNION ALL SELECT 3, count(*), sum(2 * coalesce(a.v, 0) + coalesce(u.v, 0)) FROM v a FULL JOIN u ON a.t = u.t
  UNION ALL SELECT 8, sum(c * c), sum(2 * s * c) FROM (
    SELECT t, count(*) AS c, sum(v) AS s FROM (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS t, value AS v FROM events WHERE event_type = 'signup') GROUP BY t)),
bad AS (SELECT * FROM (VALUES (4, 'INPUT_READ_ERROR: Series not found: click'), (5, 'MANIFEST_VALIDATION_ERROR: Manifest not found'),
  (6, 'MANIFEST_VALIDATION_ERROR: Manifest is no JSON object'), (7, 'INPUT_READ_ERROR: Series not found: click')) x(k, error))
SELECT 'run-' || n_nationkey AS run_id, CASE WHEN error IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END AS status, CAST(n AS BIGINT) AS row_count,
  round(s, 2) AS total, error
FROM nation LEFT JOIN kinds ON k = n_nationkey % 9 LEFT JOIN bad ON bad.k = n_nationkey % 9""")
def bound_runs(spark, sf):
    """Runs of one batch that name the same dataset with different
    manifests, one code from two datasets, a leaf outside their inputs, and inputs that
    can't be read, each reading its own; rows read back from each request's ``basePath``."""
    root = scratch(spark, "bound")
    day = F.col("obs_time")
    events = D.event_types(spark, sf).df.select("obs_time", "value", F.col("series_code").alias("internal_series_code"))
    days = events.select(day).distinct().orderBy(day)
    middle = days.limit(days.count() // 2 + 1).agg(F.max(day)).first()[0]
    views = events.where("internal_series_code = 'view'")
    urgent = D.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").groupBy(
        F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("obs_time")).agg(F.sum("o_totalprice").alias("value"))
    raw = D.table(spark, sf, "events").where("event_type = 'signup'").select(
        F.col("ts").cast("date").cast("timestamp_ntz").alias("obs_time"), "value", F.col("event_type").alias("internal_series_code"))
    where = {}
    for name, df in (("early", views.where(day < F.lit(middle))), ("all", views.unionByName(raw)),
                     ("other", urgent.withColumn("internal_series_code", F.lit("view"))),
                     ("gone", events.where("internal_series_code = 'click'").limit(1))):
        where[name] = {"manifestPath": store(spark, df, f"{root}/{name}", name), "projectionsPath": f"{root}/{name}/projections"}
    # a manifest that lists a file that is not there, one that is no JSON, and none at all
    listed = spark.read.text(where["gone"]["manifestPath"]).select(F.regexp_replace("value", r"part-[^\"]*parquet", "part-0.parquet").alias("value"))
    listed.write.text(f"{root}/lost")
    spark.range(1).select(F.lit("{broken").alias("value")).write.text(f"{root}/broken")
    where["gone"]["manifestPath"] = f"{root}/lost"
    leaf = {"series_code": "view"}
    once = {"op": "max", "operands": [leaf, leaf]}
    double = {"op": "sum", "operands": [leaf, leaf]}
    asks = {0: (once, [("ds", "early", "view")]), 1: (once, [("ds", "all", "view")]), 2: (once, [("ds", "all", "view"), ("or", "other", "view")]),
            3: ({"op": "sum", "operands": [leaf, leaf, {"series_code": "view2"}]}, None),
            4: (dict(once, operands=[leaf, {"series_code": "click"}]), [("ds", "all", "view")]),
            5: (double, [("ds", "none", "view")]), 6: (double, [("ds", "broken", "view")]), 7: (double, [("ds", "gone", "click")]),
            8: (dict(double, operands=[{"series_code": "signup"}] * 2), [("ds", "all", "signup")])}
    where["none"] = {"manifestPath": f"{root}/absent.json", "projectionsPath": f"{root}/none"}
    where["broken"] = {"manifestPath": f"{root}/broken", "projectionsPath": f"{root}/none"}
    where["renamed"] = {"manifestPath": store(spark, urgent.withColumn("internal_series_code", F.lit("view2")), f"{root}/renamed", "renamed"),
                        "projectionsPath": f"{root}/renamed/projections"}
    asks[3] = (asks[3][0], [("ds", "all", "view"), ("or", "renamed", "view2")])
    kinds = spark.createDataFrame([(k, json.dumps({
        "type": RQ.REQUEST_TYPE, "metricCode": f"metric.{k}", "expressionType": "composite", "expressionJson": e,
        "inputs": [{"datasetId": d, "seriesCode": c} for d, _, c in ins], "catalog": {"datasets": {d: where[n] for d, n, _ in ins}},
        "output": {"basePath": f"{root}/out/{k}/"}})) for k, (e, ins) in asks.items()], "k long, body string")
    asked = D.table(spark, sf, "nation").select("n_nationkey", (F.col("n_nationkey") % 9).alias("k")).join(kinds, "k")
    asked.select(F.concat(F.lit('{"runId":"run-'), "n_nationkey", F.lit('",'), F.expr("substring(body, 2)")).alias("value")).write.text(f"{root}/in")
    RQ.run_stream(spark, f"{root}/in", f"{root}/stream", f"{root}/ledger", f"{root}/ckpt")
    rows = spark.read.schema("run_id string, value double").option("recursiveFileLookup", "true").json(f"{root}/out/*/*/data")
    sums = rows.groupBy("run_id").agg(F.round(F.sum("value"), 2).alias("total"))
    done = LG.read_ledger(spark, f"{root}/ledger").where("status <> 'STARTED'")
    shown = F.when(F.col("error").startswith("MANIFEST"), F.substring_index("error", ":", 2)).otherwise(F.split("error", " [(]")[0])
    return done.join(sums, "run_id", "left").select("run_id", "status", "row_count", "total", shown.alias("error"))


@register("output_manifest", f"""SELECT 'run-1' AS run_id, 'flagship' AS metric_code, COUNT(*) AS row_count, TRUE AS has_files,
  TRUE AS ok FROM ({ORACLE["flagship_sma_ratio"]})""")
def output_manifest(spark, sf):
    """Ordered output, its version manifest, checks, then ``current``."""
    version = OUT.version_ts()
    paths = OUT.output_paths(scratch(spark, "out"), version, "run-1")
    rows = OUT.write_jsonl(OUT.sorted_result(QUERIES["flagship_sma_ratio"](spark, sf), []), paths["data"])
    manifest = OUT.build_manifest(spark, "run-1", "flagship", version, rows, paths["data"], OUT.written_files(spark, paths["data"]))
    OUT.write_manifest(manifest, paths["manifest"])
    checked = LG.manifest_checks(spark.read.schema(manifest.schema).json(paths["manifest"]))
    OUT.write_manifest(checked.where("ok").drop("ok", "error"), paths["current"])
    current = LG.manifest_checks(spark.read.schema(manifest.schema).json(paths["current"]))
    return current.select("run_id", "metric_code", "row_count", (F.size("outputs.files") > 0).alias("has_files"), "ok")


@register("path_parts",
          r"WITH p AS (SELECT page_id, url, regexp_replace(url, '/+\z', '') AS n FROM pages), "
          "b AS (SELECT *, string_split(n, '/') AS x FROM p) "
          "SELECT page_id, CASE WHEN n LIKE '%/%' THEN left(n, length(n) - length(x[-1]) - 1) WHEN n IS NOT NULL THEN '' END AS parent, "
          "x[-1] AS base_name, CASE WHEN x[-1] LIKE '%.%' THEN left(x[-1], length(x[-1]) - length(string_split(x[-1], '.')[-1]) - 1) "
          "ELSE x[-1] END AS stem FROM b")
def path_parts(spark, sf):
    """parent, base name and stem of a path column."""
    url = F.col("url")
    return D.table(spark, sf, "pages").select(
        "page_id", M.parent_path(url).alias("parent"), M.base_name(url).alias("base_name"), M.stem(url).alias("stem"))
