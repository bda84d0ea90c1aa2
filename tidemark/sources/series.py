"""Manifest-listed Parquet scan of stored observations.

Stored long form: ``obs_time, value, internal_series_code``.  All datasets
and codes of a request batch are read by ONE scan of the listed files; the
code predicate and the 3-column projection reach the Parquet reader.  The
result is a panel keyed by ``dataset_id`` (two datasets may carry the same
code).  Duplicated times are kept (``unique=False``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from tidemark.functions.numeric import clean
from tidemark.model import OBS_TIME, SERIES_CODE, VALUE, SeriesPanel
from tidemark.sources import manifest as M

OBS_SCHEMA = T.StructType([
    T.StructField("obs_time", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("internal_series_code", T.StringType()),
])


OBS_SCHEMA_NANOS = T.StructType([
    T.StructField("obs_time", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("internal_series_code", T.StringType()),
])
NANOS_CONF = "spark.sql.legacy.parquet.nanosAsLong"


def time_groups(spark: SparkSession, paths: list[str]) -> dict[bool, list[str]]:
    """Files by whether they store nanoseconds (pandas writers do; Spark reads those
    only as longs).  One parallel pass over the footers if all agree; files that
    disagree are told apart by halving the list."""
    spark.conf.set(NANOS_CONF, "true")
    try:
        t = spark.read.option("mergeSchema", "true").parquet(*paths).schema["obs_time"].dataType
        return {isinstance(t, T.LongType): paths}
    except (PySparkException, Py4JJavaError) as e:
        if len(paths) == 1 or not re.search("CANNOT_MERGE|merging schema", str(e)):
            raise
    out: dict[bool, list[str]] = {}
    for half in (paths[:len(paths) // 2], paths[len(paths) // 2:]):
        for nanos, some in time_groups(spark, half).items():
            out.setdefault(nanos, []).extend(some)
    return out


class SeriesReadError(ValueError):
    pass


def scan_files(spark: SparkSession, paths: list[str], codes: list[str]) -> DataFrame:
    """Explicit file list, pushed-down code filter, 3 columns."""
    if not paths:
        raise SeriesReadError(f"Series not found: {', '.join(codes)} (no parquet files)")
    try:
        groups = time_groups(spark, sorted(paths))
        frames = [_scan(spark, some, nanos, codes) for nanos, some in sorted(groups.items())]
    except AnalysisException as e:
        raise SeriesReadError(f"Series not found: {', '.join(codes)} (failed to open dataset from paths): {e}") from e
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _scan(spark: SparkSession, paths: list[str], nanos: bool, codes: list[str]) -> DataFrame:
    df = spark.read.schema(OBS_SCHEMA_NANOS if nanos else OBS_SCHEMA).parquet(*paths)
    t = (F.timestamp_micros(F.floor(F.col("obs_time") / 1000)) if nanos else F.col("obs_time"))
    return (df.where(F.col("internal_series_code").isin(codes))
            .select(t.cast("timestamp_ntz").alias(OBS_TIME),
                    clean(F.col("value").cast("double")).alias(VALUE),
                    F.col("internal_series_code"),
                    M.path_key(F.col("_metadata.file_path")).alias("__file")))


def available_series(df: DataFrame, n: int = 20) -> list[str]:
    """Distinct codes present in the scanned files, sorted, first ``n``."""
    return [r[0] for r in df.select("internal_series_code").distinct()
            .orderBy("internal_series_code").limit(n).collect()]


def read_series(spark: SparkSession, catalog: DataFrame, wanted: DataFrame,
                validate: bool = True) -> SeriesPanel:
    """Catalog (dataset_id, manifest_path, projections_path) + wanted
    (dataset_id, series_code) -> panel keyed by dataset_id.

    Fails like the reference: a code without files, or with no rows, raises
    ``Series not found`` (with the available codes)."""
    manifests = M.read_manifests(spark, catalog)
    if validate:
        M.validate_manifests(manifests)
    files = M.series_files(manifests, wanted)
    orphan = M.codes_without_files(wanted, files).limit(1).collect() if validate else []
    if orphan:
        raise SeriesReadError(f"Series not found: {orphan[0]['series_code']} "
                              f"(no parquet files in dataset {orphan[0]['dataset_id']})")
    plan = files
    paths = [r[0] for r in plan.select("path").distinct().collect()]  # file names: metadata
    codes = [r[0] for r in wanted.select("series_code").distinct().collect()]
    obs = scan_files(spark, paths, codes)
    owners = plan.select(M.path_key(F.col("path")).alias("__file"), "dataset_id",
                         F.col("series_code").alias("internal_series_code"))
    tagged = (obs.join(owners, ["__file", "internal_series_code"])
              .select("dataset_id", F.col("internal_series_code").alias(SERIES_CODE), OBS_TIME, VALUE))
    if validate:
        found = tagged.select("dataset_id", SERIES_CODE).distinct()
        missing = wanted.select("dataset_id", "series_code").distinct().join(
            found, ["dataset_id", "series_code"], "left_anti").limit(1).collect()
        if missing:
            code = missing[0]["series_code"]
            avail = available_series(spark.read.schema(OBS_SCHEMA).parquet(*paths))
            raise SeriesReadError(f"Series not found: {code} (searched in {len(paths)} parquet files). "
                                  f"Available series: {avail or 'none found'}")
    return SeriesPanel(tagged, ["dataset_id"], unique=False)


def one_panel(panel: SeriesPanel) -> SeriesPanel:
    """The series of several datasets side by side, so that one expression can
    take its leaves from any of them.  A code that two datasets hold is an error: the
    leaf would not say which is meant."""
    twice = (panel.df.select("dataset_id", SERIES_CODE).distinct().groupBy(SERIES_CODE)
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect())
    if twice:
        raise SeriesReadError(f"Series code in more than one dataset: {twice[0][SERIES_CODE]}")
    return SeriesPanel(panel.df.drop("dataset_id"), [k for k in panel.keys if k != "dataset_id"], panel.unique)


def write_observations(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write the stored long form with snappy compression."""
    w = df.select("obs_time", "value", "internal_series_code").write.mode("overwrite").option("compression", "snappy")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
