r"""Mixing sources to target weights (operator 2): weighted fair queueing.

Every document of a source gets a place by a hash (the shuffle) and a virtual
finish time: the source's words up to and with it, divided by the source's
weight.  A source that runs out starts over, ``max_repeats`` passes at most.  In
the order of finish time over all sources, documents are taken until the total
budget is spent: whole ones (``mix``), or with the served part of the one document that
every source has in service when the budget ends (``served``).  Between two finish times
a source is served at its weight, so the virtual time at which the budget is spent is
found among the sorted starts and finishes of all copies, as a fraction of whole numbers.

Scale: running sums are made in two steps, in hash buckets of a source and over
the buckets' sums, so a hot source is spread over all tasks; only sums per
(source, bucket) meet.  The truncation sums words (``cut``) or changes of the service
(``spent_at``) per range of the sorted finish times and runs inside one range.  Source names are few (one window holds one row of
each).

Defined results: a null text has 0 words; a null source is a source, ordered
last; a null doc_id is placed like any other; repeated rows are separate
documents; an empty table gives an empty result; documents of 0 words end when
the words before them end.  Input columns travel in one struct, so no name can
clash.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words, stored


def source_key(c: str) -> Column:
    """Orders like the source's code points, null last, and is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("~"))


def targets(sources: DataFrame, weights=(5, 2, 1), share: float = 1.0, max_repeats: int = 3) -> DataFrame:
    """``sources`` (source_key, source_size) with weight, target (double) and quota
    (whole words).  Targets share ``share`` of all sizes by weight; one stops at
    ``max_repeats`` times its source's size, the excess is reshared by weight."""
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source_key"))
    df = sources.withColumn("rank", rank).withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    df = df.withColumn("cap", F.col("source_size") * max_repeats).withColumn("fill", F.col("cap") / F.col("weight"))
    # those that fill up first come first; the level is found where filling stops
    before = Window.partitionBy(F.lit(0)).orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    df = (df.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("fill", "rank")))
          .withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), zero))
                      / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero))))
    df = df.withColumn("stop", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("place", "level"))).over(everything))
    target = F.when(F.col("place") < F.col("stop.place"), F.col("cap").cast("double")).otherwise(
        F.coalesce(F.col("weight") * F.col("stop.level"), F.col("cap").cast("double")))
    return df.select("source_key", "source_size", "weight", target.alias("target"),
                     F.floor(target + 0.5).cast("long").alias("quota"))


def schedule(docs: DataFrame, carry: list[str], weights=(5, 2, 1), share: float = 1.0, max_repeats: int = 3,
             seed: str = "mix-1", bucket_rows: int = 200_000) -> DataFrame:
    """Every document with its place in its source's queue: doc (struct of the
    ``carry`` columns), size, before (words of the source ahead of it), and its
    source's source_size, weight, target, quota."""
    digits = max(2, math.ceil(math.log(max(docs.count() / bucket_rows, 1), 16)))
    md5 = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    placed = docs.select(F.struct(*carry).alias("doc"), F.col("doc_id").alias("id"), n_words(F.col("text")).alias("size"),
                         source_key("source").alias("source_key"), md5.alias("place"))
    placed = placed.withColumn("bucket", F.substring("place", 1, digits))
    sums = stored(placed.groupBy("source_key", "bucket").agg(F.sum("size").alias("words")), "mix-sums")
    offsets = sums.select("source_key", "bucket", (F.sum("words").over(
        Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("offset"))
    wanted = targets(sums.groupBy("source_key").agg(F.sum("words").alias("source_size")), weights, share, max_repeats)
    small = stored(offsets.join(wanted, "source_key"), "mix-offsets")
    inside = Window.partitionBy("source_key", "bucket").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumn("run", F.sum("size").over(inside))
    return run.join(small, ["source_key", "bucket"]).select(
        "doc", "place", "size", (F.col("offset") + F.col("run") - F.col("size")).alias("before"),
        "source_key", "source_size", "weight", "target", "quota")


ORDER = ("finish", "place", "pass", "source_key")


def passes(at: DataFrame, max_repeats: int) -> DataFrame:
    """Every copy of the documents of ``schedule`` with its virtual finish time; sources
    without words have none."""
    copies = at.where("source_size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("pass"))
    end = F.col("source_size") * F.col("pass") + F.col("before") + F.col("size")
    return copies.withColumn("finish", end / F.col("weight"))


def spent_at(copies: DataFrame, weights: tuple[int, ...], budget: int, ranges: int) -> Fraction | None:
    """The virtual time at which ``budget`` words are served; None if all copies have fewer.

    A copy in service adds its source's weight to the words served per unit of time.  Times
    are counted in 1 / lcm(weights), so that they are whole.  With W the sum of the changes
    up to a time t and M that of change * time, t * W - M words (in that unit) are served by t."""
    unit = math.lcm(*weights)
    rate = (F.lit(unit) / F.col("weight")).cast("long")
    end = F.col("source_size") * F.col("pass") + F.col("before") + F.col("size")
    events = copies.where("size > 0").select(F.inline(F.array(
        F.struct(((end - F.col("size")) * rate).alias("time"), F.col("weight").cast("long").alias("change")),
        F.struct((end * rate).alias("time"), (-F.col("weight")).cast("long").alias("change")))))
    events = events.groupBy("time").agg(F.sum("change").alias("change")).where("change <> 0")
    events = stored(events.repartitionByRange(ranges, "time").withColumn("range", F.spark_partition_id()), "mix-events")
    moment = F.sum(F.col("change").cast("decimal(38,0)") * F.col("time")).cast("decimal(38,0)").alias("m")
    sums = events.groupBy("range").agg(F.min("time").alias("time"), F.sum("change").alias("w"), moment)
    ahead = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    sums = stored(sums.select("range", "time", F.coalesce(F.sum("w").over(ahead), zero).alias("w"),
                              F.coalesce(F.sum("m").over(ahead), zero).cast("decimal(38,0)").alias("m")), "mix-event-sums")
    limit = F.lit(Decimal(budget * unit)).cast("decimal(38,0)")
    served = (F.col("time").cast("decimal(19,0)") * F.col("w").cast("decimal(18,0)")).cast("decimal(38,0)") - F.col("m")
    last = sums.where(served <= limit).agg(F.max_by(F.struct("range", "w", "m"), "time").alias("x")).select("x.*").first()
    if last["range"] is None:
        return None
    run = Window.partitionBy("range").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    inside = events.where(F.col("range") == last["range"]).select(
        "time", (F.sum("change").over(run) + last["w"]).alias("w"),
        (F.sum(F.col("change").cast("decimal(38,0)") * F.col("time")).over(run) + F.lit(last["m"])).cast("decimal(38,0)").alias("m"))
    at = inside.where(served <= limit).agg(F.max_by(F.struct("time", "w", "m"), "time").alias("x")).select("x.*").first()
    return Fraction(budget * unit + int(at["m"]), at["w"] * unit) if at["w"] else None


def served(docs: DataFrame, carry: list[str], weights=(5, 2, 1), share: float = 1.0, max_repeats: int = 3,
           seed: str = "mix-1", range_rows: int = 200_000) -> DataFrame:
    """Every document with the words that the mix takes of it: doc (struct of the ``carry``
    columns), size, source_size, source_key, target, taken.  Copies that finish by the virtual
    time at which the budget is spent count whole, the one in service then by its part."""
    at = stored(schedule(docs, carry, weights, share, max_repeats, seed), "mix-schedule")
    n, words = at.agg(F.count(F.lit(1)), F.sum("size")).first()
    time = spent_at(passes(at.drop("doc"), max_repeats), weights, math.floor((words or 0) * share + 0.5),
                    math.ceil(max(n, 1) * max_repeats / range_rows))
    reached = F.col("source_size") * max_repeats
    if time is not None:  # words that a source of each weight is served by then, to the nearest
        by_weight = F.create_map(*[x for w in sorted(set(weights)) for x in (F.lit(w), F.lit(math.floor(w * time + Fraction(1, 2))))])
        reached = F.least(reached, F.element_at(by_weight, F.col("weight")))
    of_pass = [F.greatest(F.lit(0), F.least(F.col("size"), reached - F.col("source_size") * p - F.col("before"))) for p in range(max_repeats)]
    return at.select("doc", "size", "source_size", "source_key", "target", sum(of_pass[1:], of_pass[0]).cast("long").alias("taken"))


def cut(copies: DataFrame, budget: int, ranges: int) -> Column:
    """Whether a copy is taken.  The copies are range-sorted by ORDER; sums per range tell
    the range where ``budget`` words are spent, and only its rows get running sums.
    A copy is taken if at least half of it is below the budget."""
    key = F.struct(*ORDER)
    sized = copies.select(*ORDER, "size").repartitionByRange(ranges, *ORDER)
    sized = stored(sized.withColumn("range", F.spark_partition_id()), "mix-ranges")
    sums = sized.groupBy("range").agg(F.sum("size").alias("words"), F.min(key).alias("least"))
    ahead = F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    sums = stored(sums.select("range", "least", ahead.alias("ahead")), "mix-range-sums")
    at = sums.where(F.col("ahead") <= budget).agg(F.max(F.struct("range", "ahead")).alias("x")).select("x.*").first()
    if at["range"] is None:
        return F.lit(False)
    upto = F.sum("size").over(Window.partitionBy("range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)) + at["ahead"]
    inside = sized.where(F.col("range") == at["range"]).withColumn("upto", upto)
    out = inside.where(F.col("upto") * 2 - F.col("size") > 2 * budget).select(key.alias("least"))
    out = out.unionByName(sums.where(F.col("range") > at["range"]).select("least"))
    first = out.agg(F.min("least").alias("x")).select("x.*").first()
    return F.lit(True) if first["finish"] is None else key < F.struct(*[F.lit(first[c]).alias(c) for c in ORDER])


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.0, max_repeats: int = 3, seed: str = "mix-1",
        range_rows: int = 200_000) -> DataFrame:
    """The mixed corpus: whole documents in order of virtual finish time, until the
    budget (``share`` of all words) is spent.  Documents stay whole: the one that the
    end of the budget cuts is taken if at least half of it is below.  Columns of
    ``docs`` only."""
    light = stored(schedule(docs, [], weights, share, max_repeats, seed).drop("doc"), "mix-schedule")
    n, words = light.agg(F.count(F.lit(1)), F.sum("size")).first()
    taken = cut(passes(light, max_repeats), math.floor((words or 0) * share + 0.5), math.ceil(max(n, 1) * max_repeats / range_rows))
    copies = passes(schedule(docs, docs.columns, weights, share, max_repeats, seed), max_repeats).where(taken)
    out = copies.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return out.select("doc.*")
