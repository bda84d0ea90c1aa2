r"""Language ID (operator 3): averaged hashed subword embeddings, linear softmax.

A text is lower-cased and cut into words of letters; the 1- to 4-grams of its
words, with their boundaries, are hashed to buckets.  The average of the buckets'
embeddings goes through a linear softmax.  Both layers are trained by stochastic
gradient descent in numpy on a bounded sample: ``per_lang`` labelled rows of each
language, the smallest by a hash of doc_id and text, chosen on Spark.  A quarter of
the sample only calibrates: a temperature makes the scores probabilities, and the rejection threshold is the
smaller of 1/2 and the score that ``reject`` of its rightly judged texts stay under.

Executors score whole texts: the two layers fold into one bucket x language
table (bounded by the parameters), applied to bucket counts.

Defined results: null text or text without a letter (``str.isalpha``) gives
``und`` with score 0; rows with null lang are not learned from; a null doc_id is
not held out; repeated rows are judged alike and learned from once; an empty table gives an empty
result; if no row can be learned from, every text is ``und``; columns besides
doc_id, text and lang are ignored.  Languages are few: their names are collected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_batches

UND = "und"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """By code point: whether it is a letter.  Made once per Python worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)
    return _letters


def gram_counts(text: str | None, buckets: int) -> np.ndarray | None:
    """Counts of a text's hashed subword n-grams; None without a letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return None
    before = np.concatenate(([False], letter[:-1]))
    kept = letter | before  # one boundary between words
    x = np.concatenate((np.zeros(1, np.uint32), np.where(letter, codes, 0)[kept].astype(np.uint32), np.zeros(1, np.uint32)))
    inner = x != 0
    total = np.bincount(_bucket(x[inner], 1, buckets), minlength=buckets)
    gram, valid = x, np.ones(len(x), np.bool_)
    for n in (2, 3, 4):
        if len(x) < n:
            break
        gram = gram[:-1] * np.uint32(0x01000193) + x[n - 1:]
        # only the first and last character may be a boundary
        valid = valid[:-1] if n == 2 else valid[:-1] & inner[n - 2:-1]
        total += np.bincount(_bucket(gram[valid], n, buckets), minlength=buckets)
    return total


def _bucket(gram: np.ndarray, n: int, buckets: int) -> np.ndarray:
    h = (gram + np.uint32(n)) * np.uint32(0x9E3779B1)
    return (h ^ (h >> np.uint32(15))) & np.uint32(buckets - 1)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # bucket x language, float32: the two layers folded, over the temperature
    bias: np.ndarray
    threshold: float
    buckets: int

    def judge(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text, self.buckets) if self.langs else None
        if counts is None:
            return UND, 0.0
        z = counts.astype(np.float32) @ self.table / counts.sum() + self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], buckets: int, dim: int = 16, epochs: int = 12,
        rate: float = 0.5, reject: float = 0.002, seed: int = 7) -> Model:
    """``samples``: (lang, buckets, counts) in a fixed order."""
    langs = sorted({s[0] for s in samples})
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1, 1, (buckets, dim)) / dim
    out, bias = np.zeros((dim, len(langs))), np.zeros(len(langs))
    data = [(langs.index(lang), idx, n / n.sum()) for lang, idx, n in samples]
    train, calib = [d for i, d in enumerate(data) if i % 4], data[::4]
    train, calib = train or data, calib or data
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            y, idx, w = train[i]
            lr = rate * (1 - step / steps)
            step += 1
            h = w @ emb[idx]
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= lr * np.outer(h, p)
            bias -= lr * p
            emb[idx] -= lr * (w / (w @ w))[:, None] * back  # moves the average by lr * back, whatever the text's length
    z = np.array([(w @ emb[idx]) @ out + bias for _, idx, w in calib]).reshape(len(calib), len(langs))
    y = np.array([d[0] for d in calib], dtype=int)

    def probs(t: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(probs(t)[np.arange(len(y)), y], 1e-12)).mean())

    # the floor keeps scores below 1 when the calibration rows are all judged rightly
    temperature = min(np.geomspace(0.2, 20, 80), key=loss) if len(calib) else 1.0
    p = probs(temperature)
    right = p.argmax(axis=1) == y
    threshold = min(0.5, float(np.quantile(p.max(axis=1)[right], reject))) if right.any() else 0.5
    return Model(langs, (emb @ out / temperature).astype(np.float32), (bias / temperature).astype(np.float32), threshold, buckets)


def smallest_places(texts: DataFrame, per_lang: int) -> DataFrame:
    """``texts`` (lang, place, text) to the ``per_lang`` smallest distinct places of each
    language whose text has a letter: of every partition, then merged in a tree, so no
    language is gathered."""
    def run(batches):
        import pyarrow as pa

        kept: dict[str, set[int]] = {}
        pieces = (b for whole in batches for b in (text_batches(whole) if "text" in whole.schema.names else [whole]))
        for b in pieces:
            if "text" in b.schema.names:
                b = b.filter(pa.array([any(map(str.isalpha, t.lower())) for t in b.column("text").to_pylist()], pa.bool_()))
            for lang, place in zip(b.column("lang").to_pylist(), b.column("place").to_pylist()):
                own = kept.setdefault(lang, set())
                own.add(place)
                if len(own) > 4 * per_lang:
                    kept[lang] = set(sorted(own)[:per_lang])
        found = [(lang, place) for lang, own in kept.items() for place in sorted(own)[:per_lang]]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())],
                                         names=["lang", "place"])

    parts = texts.rdd.getNumPartitions()
    df = texts.mapInArrow(run, "lang string, place long")
    while parts > 1:
        parts = -(-parts // 32)
        df = df.repartition(parts).mapInArrow(run, "lang string, place long")
    return df


def sample(docs: DataFrame, per_lang: int, buckets: int) -> DataFrame:
    """lang, place, idx, n (bucket counts): of each language the ``per_lang`` rows with the
    smallest places that are not held out and have a letter; rows that repeat one
    doc_id and text share a place and come once."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    usable = usable.select("lang", F.xxhash64("doc_id", "text").alias("place"), "text")

    # languages x per_lang rows of a name and a number
    chosen = F.broadcast(stored(smallest_places(usable, per_lang), "lang-places"))

    def features(batches):
        import pyarrow as pa

        seen = set()
        for whole in batches:
            for b in text_batches(whole):
                rows = []
                for lang, place, t in zip(*(b.column(c).to_pylist() for c in ("lang", "place", "text"))):
                    if (lang, place) not in seen:
                        seen.add((lang, place))
                        rows.append((lang, place, gram_counts(t, buckets)))
                rows = [(lang, place, np.flatnonzero(c), c[c > 0]) for lang, place, c in rows if c is not None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2].astype(np.int32).tobytes() for r in rows], pa.binary()),
                     pa.array([r[3].astype(np.int32).tobytes() for r in rows], pa.binary())], names=["lang", "place", "idx", "n"])

    found = usable.join(chosen, ["lang", "place"], "left_semi").mapInArrow(features, "lang string, place long, idx binary, n binary")
    return found.groupBy("lang", "place").agg(F.min(F.struct("idx", "n")).alias("x")).select("lang", "place", "x.idx", "x.n")


def train(docs: DataFrame, per_lang: int = 400, buckets: int = 1 << 13) -> Model:
    """Learn from the rows that are not held out.  ``per_lang`` bounds what comes to the
    driver: the bucket counts (of whole texts) of the sample."""
    got = sorted((r["lang"], r["place"], bytes(r["idx"]), bytes(r["n"])) for r in sample(docs, per_lang, buckets).collect())
    samples = [(lang, np.frombuffer(idx, np.int32), np.frombuffer(n, np.int32).astype(float)) for lang, _, idx, n in got]
    if not samples:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros(0, np.float32), 0.5, buckets)
    return fit(samples, buckets)


def predict(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """doc (struct of the ``carry`` columns), lang_pred, score; only the text is read
    for the judgement."""
    schema = docs.select(F.struct(*carry).alias("doc")).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for b in text_batches(whole):
                judged = [model.judge(t) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc"), pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.float64())],
                    names=["doc", "lang_pred", "score"])

    return docs.select(F.struct(*carry).alias("doc"), "text").mapInArrow(run, schema)
