r"""Sharding (operator 9): best-fit-decreasing bin packing of indivisible groups.

Groups are equal texts (null counts as empty); all of them are packed, whatever their
size.  By falling size they enter the shard with the least remaining capacity that still
takes them, found in a balanced search tree.  Groups of equal size are interchangeable
and, as the tightest shard stays the tightest, fill one shard after another: a run
(size, number of groups) is placed by divisions, and the driver holds only the distinct
sizes.  Their sum is below the input's bytes, so there are at most its square root times
1.5 of them; in practice they end near the longest text.  Spark gives each group its
shard by its rank inside its size.

The capacity is the smallest, found by doubling steps and bisection, for which the given
number of shards is enough.  It starts at the mean of what is left without the groups
that are larger than such a mean: those get a shard of their own each.

Slots number a shard's rows without gaps: rows get a stored number, are numbered inside
(shard, part), where parts split a shard by that number, and the counts of the parts add
up to offsets.  Groups above 1 / ``GRAIN`` of a mean shard (shards * GRAIN at most) meet
their rows by broadcast, the others by a shuffled join; ranks are taken inside (size,
bucket of the digest).  So no shard, hot group or hot size meets in one task.

Defined results: a null text has no bytes; rows that repeat are equal texts; null
doc_ids are numbered like others; an empty table gives an empty result; columns
besides doc_id and text are carried only by ``carry`` in one struct.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

OVERHEAD = 16
GRAIN = 256
PARTS = 1024
BUCKETS = 256


class CapacityTree:
    """Bins by remaining capacity in a two-level balanced tree: sorted leaves of
    bounded length under a sorted list of their largest keys."""

    def __init__(self, leaf: int = 64):
        self.leaf, self.leaves, self.tops = leaf, [], []

    def add(self, room: int, bin_: int) -> None:
        key = (room, bin_)
        if not self.leaves:
            self.leaves, self.tops = [[key]], [key]
            return
        i = min(bisect_left(self.tops, key), len(self.leaves) - 1)
        insort(self.leaves[i], key)
        self.tops[i] = self.leaves[i][-1]
        if len(self.leaves[i]) > self.leaf:
            half = len(self.leaves[i]) // 2
            self.leaves[i:i + 1] = [self.leaves[i][:half], self.leaves[i][half:]]
            self.tops[i:i + 1] = [self.leaves[i][-1], self.leaves[i + 1][-1]]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that is ``size`` at least."""
        i = bisect_left(self.tops, (size, -1))
        if i == len(self.leaves):
            return None
        key = self.leaves[i].pop(bisect_left(self.leaves[i], (size, -1)))
        if self.leaves[i]:
            self.tops[i] = self.leaves[i][-1]
        else:
            del self.leaves[i], self.tops[i]
        return key


def best_fit_decreasing(runs: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[tuple[int, list[tuple[int, int]]]] | None:
    """Of runs (size, number of equal groups): (size, [(bin, groups that it takes), ...]),
    as if the groups entered one by one.  Bins are opened as needed and numbered from 0; None
    if more than ``bins`` are needed.  A group above the capacity gets a bin of its own."""
    tree, placed, opened = CapacityTree(), [], 0
    for size, left in sorted(runs, reverse=True):
        taken = []
        while left:
            found = tree.take_tightest(size)
            if found is None and opened == bins:
                return None
            room, bin_ = found or (max(capacity, size), opened)
            opened += found is None
            n = min(left, room // size)
            tree.add(room - n * size, bin_)
            taken.append((bin_, n))
            left -= n
        placed.append((size, taken))
    return placed


def mean_room(runs: list[tuple[int, int]], shards: int) -> int:
    """What each shard holds on average, without groups larger than that (and their shards)."""
    rest = sum(size * n for size, n in runs)
    for size, n in sorted(runs, reverse=True):
        while n and shards > 1 and size * shards > rest:
            rest, shards, n = rest - size, shards - 1, n - 1
        if n:
            break
    return -(-rest // shards)


def pack_into(runs: list[tuple[int, int]], shards: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit decreasing at the smallest capacity that needs ``shards`` bins at most."""
    low = capacity = mean_room(runs, shards)
    step = 1
    while (best := best_fit_decreasing(runs, capacity, shards)) is None:
        low, capacity, step = capacity + 1, capacity + step, step * 2
    while low < capacity:
        mid = (low + capacity) // 2
        tried = best_fit_decreasing(runs, mid, shards)
        if tried is None:
            low = mid + 1
        else:
            best, capacity = tried, mid
    return best


def place_groups(groups: DataFrame, shards: int) -> DataFrame:
    """digest, bytes, shard of the written ``groups`` (digest, bytes)."""
    runs = [(r["bytes"], r["n"]) for r in groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).collect()]
    plan = []
    for size, taken in pack_into(runs, shards):
        ends = accumulate(n for _, n in taken)
        plan.append((size, [(end, bin_) for end, (bin_, _) in zip(ends, taken)]))
    plan = stored(groups.sparkSession.createDataFrame(plan, "bytes long, cuts array<struct<upto: long, shard: int>>"), "shard-plan")
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(BUCKETS)).cast("int"))
    counts = groups.groupBy("bytes", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("bytes").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    offsets = counts.select("bytes", "bucket", before.alias("before")).join(plan, "bytes")
    rank = F.row_number().over(Window.partitionBy("bytes", "bucket").orderBy("digest")) - 1
    ranked = groups.withColumn("at", rank).join(offsets, ["bytes", "bucket"])
    cut = F.get(F.filter("cuts", lambda c: c["upto"] > F.col("before") + F.col("at")), F.lit(0))
    return ranked.select("digest", "bytes", cut["shard"].alias("shard"))


def shard(docs: DataFrame, shards: int, carry: list[str]) -> DataFrame:
    """doc (struct of the ``carry`` columns), size, crc (of the text), shard (0 to
    ``shards`` - 1), slot (gapless from 0 in its shard)."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(F.struct(*carry).alias("doc"), F.monotonically_increasing_id().alias("row"), F.sha2(text, 256).alias("digest"),
                              (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("crc")), "shard-rows")
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    placed = stored(place_groups(groups, shards), "shard-groups-placed")
    large = F.col("bytes") > total // (shards * GRAIN)  # at most shards * GRAIN groups
    hot = F.broadcast(placed.where(large).select("digest", "shard"))
    light = rows.select("row", "digest")
    cold = light.join(hot, "digest", "left_anti").join(placed.where(~large).select("digest", "shard"), "digest")
    dealt = light.join(hot, "digest").unionByName(cold).select("row", "shard", F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int").alias("part"))
    dealt = stored(dealt, "shard-dealt")
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    offset = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    slots = dealt.withColumn("at", number).join(counts.select("shard", "part", offset.alias("offset")), ["shard", "part"])
    return rows.join(slots.select("row", "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot")), "row").select(
        "doc", "size", "crc", "shard", "slot")
