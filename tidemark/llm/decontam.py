r"""Benchmark decontamination (operator 10), with DataFrame functions only.

Windows of the size of a benchmark item slide over a document; one that is similar
enough to the item leaks it.  A similar window shares shingles with the item, and a
shared shingle says where the window lies, so only those windows are made.  Each
distinct window gets a 64-bit SimHash of its words, repeats of a word counting as words
of their own; the ``radius`` + 1 blocks of the fingerprints are matched against those of
the items whose shingle the window holds: two fingerprints within the radius agree in one
block at least.  Candidates are verified by the exact weighted similarity of their word
shingles, 2 * common / (both), each shingle counted as often as it occurs.

The radius of 22 tells similar from unrelated: two unrelated fingerprints are within it
with probability 0.0084.  Of a window and an item with similarity 0.8, c common shingles
hold c + 4 common words, so a bit differs with probability 0.205 at most (0.202 for items
of 5 to 120 words) and 0.3 % of the windows right at the limit are missed; windows with
fewer edits are missed less, equal ones never.  Blocks of 64 bits alone can't find such
candidates at scale (of 23 blocks with 2 or 3 bits, unrelated pairs share one with
probability 0.98: all windows would meet all items), so they are tied to a shared shingle.

The benchmark's shingles are broadcast, ``slice_grams`` at most: a larger benchmark
is searched in several slices.  Documents are read once a slice and only the few
windows with a shared shingle are shuffled, made distinct map-side.  Fingerprints and
similarities are grouped sums over (window, word) and (window, shingle) rows, so their
work is linear in the length of an item.

Words are the runs of letters and digits of the lower-cased text.  Defined results:
null and empty texts hold no window; items with fewer words than a shingle (null ones
too) are not searched; items are told by their words, so a null item_id (of any type)
is searched as well; of items that are equally similar the smallest item_id is
reported, null last; rows that repeat a doc_id share the worst verdict; a null doc_id is
carried; an empty table gives an empty result, an empty benchmark keeps everything;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

WIDTH = 5
RADIUS = 22
SLICE_GRAMS = 2_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{Nd}]+"), "")


def gram_at(words: str, i: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), i + j) for j in range(width)])


def grams_of(words: str, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: gram_at(words, i, width))


def fingerprints(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and fp of (key, words) rows with distinct keys.  Bit b is set if more than
    half of the words' hashes have it; the hash is of a word and its number among equal
    ones, so a word that fills a window does not outvote."""
    counts = rows.select(key, F.explode("words").alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    hashes = counts.select(key, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"), "word").select(key, F.xxhash64("word", "k").alias("h"))
    bits = hashes.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)])
    return bits.select(key, F.expr(" | ".join(f"IF(2 * b{b} > n, shiftleft(1L, {b}), 0L)" for b in range(64))).alias("fp"))


def gram_counts(rows: DataFrame, key: str, width: int) -> DataFrame:
    """``key``, gram and n of (key, words) rows with distinct keys."""
    return rows.where(F.size("words") >= width).select(key, F.explode(grams_of("words", width)).alias("gram")).groupBy(
        key, "gram").agg(F.count(F.lit(1)).alias("n"))


def blocks_of(fingerprint: str, radius: int) -> Column:
    """(block, bits) of the ``radius`` + 1 blocks that the 64 bits are cut into."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(F.col(fingerprint), a).bitwiseAND(
        F.lit((1 << (b - a)) - 1)).alias("bits")) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])


def windows(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """doc_id, item, start, window: item-sized windows where a shingle is shared.
    ``items`` (item, words) is small enough to broadcast its shingles."""
    grams = items.select("item", F.size("words").alias("len"), F.posexplode(grams_of("words", width)).alias("at", "gram"))
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words")).where(F.size("words") >= width)
    # the position is exploded, not the hashes: they are then computed in generated code
    rows = rows.select("doc_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("i"))
    hits = rows.withColumn("gram", gram_at("words", F.col("i"), width)).join(F.broadcast(grams), "gram")
    start = F.greatest(F.lit(0), F.least(F.col("i") - F.col("at"), F.size("words") - F.col("len")))
    hits = hits.select("doc_id", "item", start.alias("start"), F.array_join(F.slice("words", start + 1, F.col("len")), " ").alias("window"))
    return hits.distinct()


def near_prints(pairs: DataFrame, windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """win, item, hamming of the ``pairs`` (win, item) whose fingerprints are within the
    radius, by their blocks; ``windows`` (win, words) and ``items`` (item, words)."""
    left = pairs.join(fingerprints(windows, "win"), "win").select("win", "item", "fp", F.inline(blocks_of("fp", radius)))
    right = fingerprints(items, "item").withColumnRenamed("fp", "item_fp").select("item", "item_fp", F.inline(blocks_of("item_fp", radius)))
    found = left.join(right, ["item", "block", "bits"]).withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))))
    return found.where(F.col("hamming") <= radius).select("win", "item", "hamming").distinct()


def similarities(pairs: DataFrame, windows: DataFrame, items: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``pairs`` (win, item, more columns) that are similar enough, with similarity."""
    sizes = lambda rows, key, name: rows.select(key, (F.size("words") - (width - 1)).alias(name))
    common = (pairs.select("win", "item").join(gram_counts(windows, "win", width), "win")
              .join(gram_counts(items, "item", width).withColumnRenamed("n", "m"), ["item", "gram"])
              .groupBy("win", "item").agg(F.sum(F.least("n", "m")).alias("common")))
    found = pairs.join(common, ["win", "item"]).join(sizes(windows, "win", "x"), "win").join(sizes(items, "item", "y"), "item")
    both = F.col("x") + F.col("y")
    return found.where(F.col("common") * 200 >= both * percent).withColumn("similarity", F.col("common") * 2 / both).drop("common", "x", "y")


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = 80, radius: int = RADIUS,
          slice_grams: int = SLICE_GRAMS) -> DataFrame:
    """doc_id, item_id, start, hamming, similarity of every leaking window; items of the
    same words are one, with their smallest item_id."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") >= width)
    items = items.groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn("item", F.sha2(F.array_join("words", " "), 256))
    items = stored(items, "leak-benchmark")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    slices = max(1, math.ceil(total / slice_grams))
    made = [windows(docs, items.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == s), width) for s in range(slices)]
    found = made[0]
    for more in made[1:]:
        found = found.unionByName(more)
    found = stored(found.withColumn("win", F.sha2("window", 256)), "leak-windows")
    texts = stored(found.select("win", "window").distinct().select("win", F.split("window", " ").alias("words")), "leak-texts")
    near = stored(near_prints(found.select("win", "item").distinct(), texts, items, radius), "leak-near")
    good = stored(similarities(near, texts, items, width, percent).join(items.select("item", "item_id"), "item"), "leak-pairs")
    return found.join(good, ["win", "item"]).select("doc_id", "item_id", "start", "hamming", "similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = 80, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, kept, and of its most similar leak item_id and similarity."""
    worst = leaks(docs, benchmark, width, percent, radius).groupBy("doc_id").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), F.col("item_id").isNull().alias("unknown"), "item_id")).alias("worst"))
    worst = worst.select(F.col("doc_id").alias("leaky"), "worst.item_id", (-F.col("worst.s")).alias("similarity"))
    ids = docs.select("doc_id")
    return ids.join(worst, ids["doc_id"].eqNullSafe(worst["leaky"]), "left").select(
        "doc_id", F.col("similarity").isNull().alias("kept"), "item_id", "similarity")
