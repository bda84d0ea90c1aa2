"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import sys
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tidemark job relies on: UTC wall clock (timestamps are
# naive), AQE for runtime broadcast / skew splitting / partition coalescing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's builder and apply
    ``DEFAULT_CONF``."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Taken from the session's ``spark.checkpoint.dir`` (on a cluster: shared
    storage).  Only a local master may do without: driver and executors are one
    process there and a scratch folder is set on the context.  On a cluster a
    machine-local folder would be read back incomplete, so it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_folders: list[str] = []


def scratch_folder(spark: SparkSession, what: str) -> str:
    """A new folder name for an intermediate table in the shared folder; it is
    deleted when the Python process ends, or by ``clean_scratch``."""
    if not _folders:
        atexit.register(_clean_at_exit)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{what}-{uuid.uuid4().hex[:12]}"
    _folders.append(path)
    return path


def written(df, what: str):
    """``df`` written once to the shared folder and read back: cuts the lineage, and its
    size in bytes is known to the planner."""
    path = scratch_folder(df.sparkSession, what)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this process; frames that still read
    them must not be used afterwards."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _folders:
        path = jvm.org.apache.hadoop.fs.Path(_folders.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def _clean_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        clean_scratch(spark)
    except Exception as e:  # the JVM may be gone already
        print(f"intermediate tables not deleted: {type(e).__name__}", file=sys.stderr)
