r"""Exact deduplication (operator 5): heavy-hitter split.

Texts are equal when they are after white space is deleted; null counts as empty.
Misra-Gries summaries of the digests, one per partition and then merged, find
every digest with more than rows / (counters + 1) copies.  Their exact counts and
winners (at most ``counters`` rows) are broadcast and settle the copies map-side;
no hot group is shuffled.  The other digests, none of them hot, are grouped and
joined by ordinary shuffles.  Of equal texts, the row with the most code points
in the original text, then the smallest doc_id stays.

Defined results: one row of each group stays, also where rows repeat a doc_id (of
rows alike in length and doc_id, the first in the written table); a null doc_id is
smallest; an empty table gives an empty result;
columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, stored

COUNTERS = 256
SUMMARY = "digest binary, n long"


def _merge(counts: Counter, more: dict, counters: int) -> Counter:
    """Misra-Gries merge: add, then take off the largest count that must go."""
    counts.update(more)
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        counts = Counter({k: v - cut for k, v in counts.items() if v > cut})
    return counts


def _summarise(counters: int):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        counts: Counter = Counter()
        for b in batches:
            if b.schema.names == ["digest"]:
                seen = pc.value_counts(b.column("digest"))
                more = dict(zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist()))
            else:
                more = Counter()
                for k, v in zip(b.column("digest").to_pylist(), b.column("n").to_pylist()):
                    more[k] += v
            counts = _merge(counts, more, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         names=["digest", "n"])
    return run


def heavy_hitters(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` candidate digests, with every one that has more than
    rows / (counters + 1) copies.  Summaries merge in a tree."""
    df = digests.select("digest").mapInArrow(_summarise(counters), SUMMARY)
    parts = digests.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // 32)
        df = df.repartition(parts).mapInArrow(_summarise(counters), SUMMARY)
    return df


def dedup_exact(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest (SHA-256 of the normalised text)."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select("doc_id", F.length(text).alias("chars"), F.unhex(
        F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"), F.monotonically_increasing_id().alias("row")), "exact-digests")
    n = rows.count()
    best = F.min(F.struct((-F.col("chars")).alias("short"), "doc_id", "row"))
    groups = [F.count(F.lit(1)).alias("group_size"), best.alias("best")]
    found = heavy_hitters(rows, counters)
    verified = (rows.join(F.broadcast(found.select("digest")), "digest").groupBy("digest").agg(*groups)
                .where(F.col("group_size") > n // (counters + 1)))
    # counters rows at most, of 70 bytes each
    winners = F.broadcast(stored(verified, "exact-winners"))
    heavy = rows.join(winners, "digest")
    light = rows.join(winners.select("digest"), "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(*groups), "digest")
    return heavy.unionByName(light).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "digest")
