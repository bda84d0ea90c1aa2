"""Helpers shared by the operators: white space rules, written tables, columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_folder

# The white space characters of the word rules, and a word.
SPACES = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, is
    computed once, survives lost executors and gives the planner real sizes."""
    spark = df.sparkSession
    path = scratch_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def n_words(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def text_batches(batch, max_bytes: int = 4 << 20):
    """Cut an Arrow batch with a ``text`` column into pieces of about
    ``max_bytes`` of text (one text at least): bounds what a task holds at once."""
    import pyarrow.compute as pc

    text = batch.column("text")
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
