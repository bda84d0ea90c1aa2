"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns the columns of documents (the last one adds shard and slot).  ``run``
writes each stage's result as Parquet in the shared folder and reads it back.

Near-duplicate removal and decontamination tell rows apart by doc_id (null is one) and
text, so texts under one doc_id have verdicts of their own.  Of rows that repeat both,
near-duplicate removal keeps one, the smallest by all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, mixing, near, shards
from tidemark.llm.common import stored, table

SHARDS = 40
BROADCAST_IDS = 2_000_000


def row_key() -> Column:
    """Never null; orders like doc_id, null first, then by the text's digest."""
    digest = F.coalesce(F.unhex(F.sha2(F.col("text"), 256)), F.lit(b""))
    return F.struct(F.col("doc_id"), digest.alias("digest"))


def keyed(docs: DataFrame) -> DataFrame:
    """The operators' input: doc_id is the row's key."""
    return docs.select(row_key().alias("doc_id"), "text")


def matched(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """doc (struct of all columns) and key of ``docs`` by a semi or anti join with
    ``keys`` (key, written and distinct), which are broadcast if counted as few."""
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    rows = docs.select(F.struct(*docs.columns).alias("doc"), row_key().alias("key"))
    return rows.join(keys.withColumnRenamed("key", "wanted"), F.col("key").eqNullSafe(F.col("wanted")), how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those below the calibrated threshold."""
    model = langid.train(docs)
    judged = langid.predict(docs, model, docs.columns)
    return judged.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= model.threshold)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group (five words, 0.8): the one with the smallest doc_id."""
    judged = near.near_dedup(keyed(docs)).groupBy(F.col("doc_id").alias("key")).agg(
        F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    judged = stored(judged.where("NOT kept OR n > 1"), "near-judged")
    out = matched(docs, judged.select("key"), "left_anti").select("doc.*")
    repeated = judged.where("kept").select("key")
    if repeated.isEmpty():
        return out
    one = matched(docs, repeated, "left_semi").groupBy("key").agg(F.min("doc").alias("doc"))
    return out.unionByName(one.select("doc.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item (five words, 0.8), whatever its item_id."""
    items = table(spark, sf_dir, "benchmark").select(F.unhex(F.sha2(F.col("text"), 256)).alias("item_id"), "text")
    leaky = decontam.leaks(keyed(docs), items).select(F.col("doc_id").alias("key")).distinct()
    return matched(docs, stored(leaky, "leaky"), "left_anti").select("doc.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 over as many words as come in: documents repeat (up
    to three times) or are left out as the targets say."""
    return mixing.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard (0 to 39) and slot; equal texts share a shard."""
    out = shards.shard(docs, SHARDS, docs.columns)
    return out.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("sharding", sharding)]
ORACLE_SQL = None  # language ID and bin packing have no SQL; tests/llm holds run() against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
