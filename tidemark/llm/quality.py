r"""Quality classifier (operator 4): interpolated modified Kneser-Ney model.

A character model of order 4 (16-bit units, case kept) is counted over all trusted
text.  A document's perplexity under it is compared with a quantile of the trusted
documents' perplexities in its language.

Training is a few aggregations over the n-gram counts: discounts D1, D2, D3+ per
order from counts of counts, continuation counts below the highest order,
interpolation down to a uniform distribution.  Scoring joins counts in shards: the
documents are dealt into blocks of about ``block_bytes`` of text, each block asks once
for every distinct n-gram it holds, the asked n-grams meet the count tables by
shuffled joins on their keys, and the answers go back to the block, where its
documents are summed.  So what is gathered grows with the corpus, nothing passes
through the driver, and no table is broadcast by hand.

Defined results: null and empty texts have no tokens, perplexity null, and are not
kept; a null lang is a language of its own; languages without trusted documents take
the threshold over all; without any trusted text nothing is judged (kept null);
rows that repeat are judged alike; repeated labels count once; an empty table gives an
empty result; columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_batches

ORDER = 4
UNIT = 16
BROADCAST_IDS = 2_000_000
START = 2  # the unit before a text's first


def gram_keys(text: str) -> np.ndarray:
    """The 4-gram that ends at each 16-bit unit of a text, packed in an int64."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint64)
    x = np.concatenate((np.full(ORDER - 1, START, np.uint64), units))
    n = len(units)
    key = x[:n]
    for i in range(1, ORDER):
        key = (key << np.uint64(UNIT)) | x[i:i + n]
    return key.view(np.int64)


def count_grams(texts: DataFrame) -> DataFrame:
    """key, c: the 4-grams of all texts."""
    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for b in text_batches(whole):
                keys = [gram_keys(t) for t in b.column("text").to_pylist() if t]
                if keys:
                    key, c = np.unique(np.concatenate(keys), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(c)], names=["key", "c"])

    return texts.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def suffix(key: Column, order: int) -> Column:
    return key.bitwiseAND(F.lit((1 << (UNIT * order)) - 1))


def context(key: Column) -> Column:
    return F.shiftrightunsigned(key, UNIT)


def discounts(grams: DataFrame) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams that occur 1 to 4 times."""
    n = grams.agg(*[F.sum((F.col("c") == i).cast("long")) for i in range(1, 5)]).first()
    n1, n2, n3, n4 = [float(x or 0) for x in n]
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]


class Model:
    """Per order: n-grams with their discounted share, contexts with the weight left."""

    def __init__(self, texts: DataFrame):
        self.grams, self.contexts = {}, {}
        table = stored(count_grams(texts), "kn-4")
        for order in range(ORDER, 0, -1):
            d = discounts(table)
            less = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
            ctx = table.groupBy(context(F.col("key")).alias("ctx")).agg(F.sum("c").alias("total"), F.sum(less).alias("left"))
            self.contexts[order] = stored(ctx.select("ctx", "total", (F.col("left") / F.col("total")).alias("rest")), f"kn-context-{order}")
            self.grams[order] = table.select("key", (F.col("c") - less).alias("over"))
            if order > 1:
                table = stored(table.groupBy(suffix(F.col("key"), order - 1).alias("key")).agg(F.count(F.lit(1)).alias("c")), f"kn-{order - 1}")
        self.units = table.count() + 1  # one for all that are unknown

    def log_probs(self, keys: DataFrame) -> DataFrame:
        """key, logp of distinct 4-grams: joins with the counts of every order."""
        df, p = keys, F.lit(1.0 / self.units)
        for order in range(1, ORDER + 1):
            gram = self.grams[order].toDF(f"g{order}", "over")
            ctx = self.contexts[order].toDF(f"x{order}", "total", "rest")
            df = df.withColumn(f"g{order}", suffix(F.col("key"), order) if order < ORDER else F.col("key"))
            df = df.withColumn(f"x{order}", context(F.col(f"g{order}")))
            df = df.join(gram, f"g{order}", "left").join(ctx, f"x{order}", "left")
            p = F.when(F.col("total").isNull(), p).otherwise(F.coalesce(F.col("over") / F.col("total"), F.lit(0.0)) + F.col("rest") * p)
            df = df.withColumn("p", p).select("key", "p")
            p = F.col("p")
        return df.select("key", F.log("p").alias("logp"))


def _packed(batches):
    import pyarrow as pa

    codec = pa.Codec("zstd", 3)
    for b in batches:
        raw = [None if x is None else x.encode("utf-8", "surrogatepass") for x in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("block", "doc_id", "lang")), pa.array([None if x is None else len(x) for x in raw], pa.int32()),
             pa.array([None if x is None else codec.compress(x, asbytes=True) for x in raw], pa.binary())],
            names=["block", "doc_id", "lang", "size", "text"])


def _unpacked(t):
    """The texts of a block, one at a time."""
    import pyarrow as pa

    codec = pa.Codec("zstd")
    for size, x in zip(t.column("size"), t.column("text")):
        size, x = size.as_py(), x.as_py()
        yield None if x is None else codec.decompress(x, size, asbytes=True).decode("utf-8", "surrogatepass") if size else ""


def perplexities(docs: DataFrame, model: Model, block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, lang, n_units, perplexity."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int").alias("block"), "doc_id", "lang", "text")
    # texts travel compressed; both readers of the blocks are in one job and share its exchange
    dealt = dealt.mapInArrow(_packed, dealt.select("block", "doc_id", "lang").schema.add("size", "integer").add("text", "binary"))

    def ask(t):
        import pyarrow as pa

        found, held, size = np.zeros(0, np.int64), [], 0
        for x in _unpacked(t):
            if x:
                held.append(gram_keys(x))
                size += len(held[-1])
                if size > 1 << 21:
                    found, held, size = np.union1d(found, np.concatenate(held)), [], 0
        found = np.union1d(found, np.concatenate([found, *held]))
        block = t.column("block")[0].as_py()
        return pa.table({"block": pa.array(np.full(len(found), block, np.int32)), "key": pa.array(found)})

    def answer(t, known):
        import pyarrow as pa

        order = np.argsort(known.column("key").to_numpy())
        key, logp = known.column("key").to_numpy()[order], known.column("logp").to_numpy()[order]
        n, score = [], []
        for x in _unpacked(t):
            if x:
                own, times = np.unique(gram_keys(x), return_counts=True)
                n.append(int(times.sum()))
                score.append(float(np.exp(-(logp[np.searchsorted(key, own)] @ times) / n[-1])))
            else:
                n.append(0)
                score.append(None)
        return pa.table({"doc_id": t.column("doc_id"), "lang": t.column("lang"), "n_units": pa.array(n, pa.int64()),
                         "perplexity": pa.array(score, pa.float64())})

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, key long")
    known = asked.join(model.log_probs(asked.select("key").distinct()), "key").select("block", "key", "logp")
    schema = docs.select("doc_id", "lang").schema.add("n_units", "long").add("perplexity", "double")
    return dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(answer, schema)


def thresholds(scored: DataFrame, quantile: float, margin: float) -> DataFrame:
    """lang_key, threshold: the quantile of the trusted documents' perplexity, times
    ``margin``, from a histogram of its logarithm in steps of 0.001."""
    step = F.floor(F.log("perplexity") * 1000).cast("long")
    hist = scored.where("trusted AND perplexity IS NOT NULL").groupBy("lang_key", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("lang_key")
    at = hist.withColumn("up", F.sum("n").over(w.orderBy("step"))).withColumn("all", F.sum("n").over(w))
    return at.where(F.col("up") >= F.col("all") * quantile).groupBy("lang_key").agg(
        (F.exp((F.min("step") + 1) / 1000) * margin).alias("threshold"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, margin: float = 1.1) -> DataFrame:
    """doc_id, lang, n_units, perplexity, threshold, kept.  Trusted: labelled with
    quality 1 and not toxic."""
    good = stored(labels.where("quality = 1 AND toxic = 0").select("doc_id").distinct(), "kn-trusted")
    few = good.count() <= BROADCAST_IDS  # else a shuffled join
    model = Model(docs.select("doc_id", "text").join(F.broadcast(good) if few else good, "doc_id", "left_semi"))
    scored = perplexities(docs, model)
    marked = scored.join(good.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    scored = stored(marked.withColumn("lang_key", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("~"))), "kn-scored")
    limit = thresholds(scored, quantile, margin)
    general = thresholds(scored.withColumn("lang_key", F.lit("")), quantile, margin).first()
    out = scored.join(limit, "lang_key", "left")
    limit = F.coalesce("threshold", F.lit(general["threshold"] if general else None).cast("double"))
    kept = F.when(limit.isNotNull(), F.coalesce(F.col("perplexity") <= limit, F.lit(False)))
    return out.select("doc_id", "lang", "n_units", "perplexity", limit.alias("threshold"), kept.alias("kept"))
