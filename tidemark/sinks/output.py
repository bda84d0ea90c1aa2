"""Versioned JSON Lines output and its manifests.

Layout under a metric's base path (K2)::

    {base}/{version_ts}/data/part-*.json      (K1, many part files; of the request stream part-*.json.gz)
    {base}/{version_ts}/manifest.json/         (K4, one-row JSON)
    {base}/current/manifest.json/              (K4, written after validation)

Divergences: Spark writes a directory per JSON "file"; ``Infinity`` is
written quoted; timestamps always print 6 fraction digits.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.model import OBS_TIME, VALUE

COMPRESSION_CONF, COMPRESSION = "spark.tidemark.output.compression", "gzip"  # of the request stream's rows; "none": plain text
VERSION_FORMAT = "yyyy-MM-dd'T'HH-mm-ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def version_ts(ts: datetime | None = None) -> str:
    """UTC, 1-second resolution, ``%Y-%m-%dT%H-%M-%S``."""
    ts = ts or datetime.now(timezone.utc)
    return ts.strftime("%Y-%m-%dT%H-%M-%S")


def version_col(c) -> F.Column:
    """F3 as a column expression."""
    return F.date_format(c, VERSION_FORMAT)


def iso_z(c) -> F.Column:
    """ISO-8601 in UTC with ``Z`` (manifests, status rows), whatever the
    session time zone."""
    return F.concat(F.date_format(F.to_utc_timestamp(c, F.current_timezone()), ISO_FORMAT), F.lit("Z"))


def utc_now_ntz() -> F.Column:
    """Current UTC wall-clock time as a naive timestamp."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def output_paths(base: str, version: str, run_id: str) -> dict:
    """K2 (F10: scheme-less, trailing '/' removed)."""
    prefix = base.split("://", 1)[1] if "://" in base else base
    prefix = prefix.rstrip("/")
    if "://" in base:
        prefix = base.split("://", 1)[0] + "://" + prefix
    return {"data": f"{prefix}/{version}/data", "manifest": f"{prefix}/{version}/manifest.json",
            "current": f"{prefix}/current/manifest.json", "marker": f"{prefix}/runs/{run_id}.ok",
            "prefix": prefix}


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str | None = None) -> int:
    """K1 + K6: write ``obs_time, value`` (and any key columns) as JSON Lines,
    NULL kept as ``null``; returns the row count observed during the write
    (no second evaluation).  A compressed file holds the same lines."""
    obs = Observation("tidemark_rows")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = (out.write.mode("overwrite").option("ignoreNullFields", "false")
         .option("timestampNTZFormat", ISO_FORMAT))
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
    return int(obs.get["rows"])


def written_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files a write produced (file metadata only)."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
               .option("recursiveFileLookup", "true").load(path).select("path"))
    return sorted(r[0].rsplit("/", 1)[-1] for r in listing.collect())


def build_manifest(spark: SparkSession, run_id: str, metric_code: str, version: str, row_count: int,
                   data_prefix: str, files: list[str]) -> DataFrame:
    """K3: one-row manifest DataFrame."""
    return spark.createDataFrame(
        [(run_id, metric_code, version, row_count, (data_prefix, files))],
        "run_id string, metric_code string, version_ts string, row_count bigint, "
        "outputs struct<data_prefix:string, files:array<string>>"
    ).withColumn("created_at", iso_z(F.current_timestamp()))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """K4: single JSON object."""
    manifest.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def sorted_result(df: DataFrame, keys: list[str]) -> DataFrame:
    """O1: output rows ordered by key and time — range-partitioned (a hot
    key spans many tasks) and sorted within partitions, no global sort task."""
    return (df.select(*keys, OBS_TIME, VALUE).repartitionByRange(*keys, OBS_TIME)
            .sortWithinPartitions(*keys, OBS_TIME))
