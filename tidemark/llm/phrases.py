r"""Phrase collocation mining (operator 13): HAT-tries of word numbers.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and the
pieces into words at spaces and tabs; null languages count as ``und``.  A phrase of two to
``most_words`` words that stands at least ``least`` times in a language is a candidate.

Counting runs in rounds over all texts: single words, pairs, then all longer phrases.
A phrase stands no more often than its parts, so a round counts only phrases whose
words (then: whose pairs) are frequent.  Those are told by a bitmap of ``FILTER_BITS``
bits, one for each hash of a frequent part: its size is fixed (8 MB), what it lets
through by chance is counted like the rest and fails the exact count.

* Map side: a task numbers its words and counts phrases in a HAT-trie: a trie node
  for the first word, under it a hash container from the other words to counts; a
  container that grows over ``BURST`` bursts into a node with a container for each next word.
  When the trie holds more than ``HELD`` counts, the largest subtrees are spilled
  whole, as runs sorted by their words.
* Merge: runs are dealt by prefixes of up to ``PREFIX`` words, and each prefix partition sums
  what the runs hold of a phrase.  A phrase has a row per spill and a prefix one for each last
  word, so neither can gather the occurrences of a hot one.

Scores: cutting a candidate after k words gives l and r, the counts of both parts,
and ``floor(2000000 * a / (l + r))`` in exact decimal arithmetic; the lowest counts.
Candidates inside a longer one that has at least ``percent`` of their count are dropped.
The best of a language are found among the best of its shares (by hash), so no task
sorts a whole language.

Defined results: null or empty texts have no words; repeated rows count as often as they
come; without candidates the result is empty; other columns than text and lang are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_batches

RUNS = "lang string, prefix string, rest string, n bigint"
FILTER_BITS = 1 << 26
MIX = (0x2545F491, 0x1B873593)  # odd, under 2 ** 30: sums of products with 32-bit hashes fit a long
HELD = 1_000_000
BURST = 20_000
PREFIX = 3
RUN_ROWS = 50_000
SHARES = 64
BREAK = 0xFF  # no byte of UTF-8 text


def _bytes_table() -> bytes:
    """A-Z lower-cased, tabs as spaces, ends of pieces as BREAK."""
    table = bytearray(bytes(range(256)).lower())
    table[0x09] = 0x20
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = BREAK
    return bytes(table)


class HatTrie:
    """Counts of phrases: int32 word numbers, the first apart, the others as bytes."""

    def __init__(self) -> None:
        self.containers: dict[int, Counter] = {}
        self.nodes: dict[int, defaultdict[bytes, Counter]] = {}  # of first words whose container has burst
        self.sizes: dict[int, int] = {}
        self.held = 0

    def add(self, phrases: np.ndarray) -> None:
        """Counts the rows of ``phrases``, each an occurrence."""
        width = phrases.shape[1] - 1
        phrases = phrases[np.argsort(phrases[:, 0], kind="stable")]
        rest = np.ascontiguousarray(phrases[:, 1:], np.int32).view(f"V{4 * width}").ravel().tolist()
        starts = np.flatnonzero(np.diff(phrases[:, 0], prepend=-1))
        for word, a, b in zip(phrases[starts, 0].tolist(), starts.tolist(), [*starts[1:].tolist(), len(rest)]):
            if word in self.nodes:
                node = self.nodes[word]
                for key in rest[a:b]:
                    node[key[:4]][key[4:]] += 1
                size = sum(map(len, node.values()))
            else:
                box = self.containers.setdefault(word, Counter())
                box.update(rest[a:b])
                size = len(box)
                if size > BURST and width > 1:
                    self.nodes[word] = node = defaultdict(Counter)
                    for key, n in self.containers.pop(word).items():
                        node[key[:4]][key[4:]] = n
            self.held += size - self.sizes.get(word, 0)
            self.sizes[word] = size

    def subtree(self, word: int) -> dict[bytes, int]:
        """Takes out the subtree of a first word: the other words to their count."""
        self.held -= self.sizes.pop(word)
        if word in self.nodes:
            return {second + key: n for second, box in self.nodes.pop(word).items() for key, n in box.items()}
        return self.containers.pop(word)

    def largest(self) -> list[int]:
        return sorted(self.sizes, key=self.sizes.get, reverse=True)


class LanguageCounts:
    """One task's counts of one language in one round (phrases of ``sizes`` words)."""

    def __init__(self, lang: str, sizes: range, frequent: np.ndarray | None):
        self.lang, self.prefix, self.sizes, self.frequent = lang, lang.encode() + b" ", sizes, frequent
        self.reset()

    def reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.single = np.zeros(1024, np.int64)
        self.trie = HatTrie()

    def held(self) -> int:
        return len(self.words) + self.trie.held

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words), np.int64)
        for i, w in enumerate(words):
            out[i] = k = self.number.setdefault(w, len(self.words))
            if k == len(self.words):
                self.words.append(w)
        return out

    def _set(self, at: np.ndarray) -> np.ndarray:
        return (self.frequent[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(np.bool_)

    def count(self, texts: list[bytes], table: bytes) -> None:
        """Adds texts; ``table`` by ``_bytes_table``."""
        import pyarrow as pa

        mark = bytes([BREAK])
        words = mark.join(texts).translate(table).replace(mark, b" " + mark + b" ").split()
        if not words:
            return
        coded = pa.array(words, pa.binary()).dictionary_encode()
        ids, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        word = np.array([w != mark for w in distinct])
        if self.sizes[0] == 1:
            times, wanted = np.bincount(ids, minlength=len(distinct)), np.flatnonzero(word)
            numbers = self._numbers([distinct[i] for i in wanted.tolist()])
            if len(self.single) < len(self.words):
                self.single = np.concatenate((self.single, np.zeros(2 * len(self.words), np.int64)))
            self.single[numbers] += times[wanted]
            return
        hashes = np.fromiter((zlib.crc32(self.prefix + w) for w in distinct), np.int64, len(distinct))
        if self.sizes[0] == 2:
            good = (word & self._set(place(hashes)))[ids]
            live = good[:-1] & good[1:]
        else:
            live = word[ids[:-1]] & word[ids[1:]]
            live[live] = self._set(place(hashes[ids[:-1][live]], hashes[ids[1:][live]]))
        phrases, pairs = [], live
        for size in self.sizes:  # live: of each place, if all pairs of a phrase of size words are
            if size > 2:
                live = live[:-1] & pairs[size - 2:]
            phrases.append(ids[np.flatnonzero(live)[:, None] + np.arange(size)])
        used = np.unique(np.concatenate([x.ravel() for x in phrases]))
        if not len(used):
            return
        numbers = np.zeros(len(distinct), np.int32)
        numbers[used] = self._numbers([distinct[i] for i in used.tolist()])
        for x in phrases:
            if len(x):
                self.trie.add(numbers[x])

    def spill(self, keep: int):
        """Sorted runs (prefix, rest, n as Arrow arrays) of the largest subtrees until at
        most ``keep`` counts are held."""
        import pyarrow as pa

        words = pa.array(self.words, pa.binary())
        if self.sizes[0] == 1:
            order = np.array(words.to_numpy(zero_copy_only=False)).argsort() if len(words) else np.zeros(0, np.int64)
            for a in range(0, len(order), RUN_ROWS):
                part = order[a:a + RUN_ROWS]
                yield _run(words, part[:, None], self.single[part])
        else:
            rank = np.empty(len(words), np.int64)
            rank[np.array(words.to_numpy(zero_copy_only=False)).argsort()] = np.arange(len(words))
            taken: dict[int, list] = {}
            rows = 0
            for head in self.trie.largest():
                if self.held() <= keep:
                    break
                for rest, n in self.trie.subtree(head).items():
                    first, others, counts = taken.setdefault(len(rest), ([], [], []))
                    first.append(head)
                    others.append(rest)
                    counts.append(n)
                    rows += 1
                if rows >= RUN_ROWS:
                    yield from _runs(words, rank, taken)
                    taken, rows = {}, 0
            yield from _runs(words, rank, taken)
        if not self.trie.held:
            self.reset()  # all is out, the words' numbers may go as well


def _runs(words, rank: np.ndarray, taken: dict[int, list]):
    for width, (first, others, counts) in taken.items():
        rest = np.frombuffer(b"".join(others), np.int32).reshape(-1, width // 4)
        phrases = np.concatenate((np.array(first, np.int32)[:, None], rest), axis=1)
        order = np.lexsort(rank[phrases].T[::-1])
        yield _run(words, phrases[order], np.array(counts, np.int64)[order])


def _run(words, phrases: np.ndarray, counts: np.ndarray):
    import pyarrow as pa
    import pyarrow.compute as pc

    join = lambda xs: pc.binary_join_element_wise(*[words.take(pa.array(x)) for x in xs], b" ") if len(xs) else pa.nulls(len(counts), pa.binary())
    columns = [np.ascontiguousarray(c) for c in phrases.T]
    return join(columns[:PREFIX]).cast(pa.string()), join(columns[PREFIX:]).cast(pa.string()), pa.array(counts, pa.int64())


def place(first, last=None):
    """Place in the bitmap of a word or pair, from the words' hashes: for numpy arrays and
    for Spark columns (non-negative longs)."""
    x = first * MIX[0] if last is None else first * MIX[0] + last * MIX[1]
    return (F.shiftright(x, 20) if isinstance(x, Column) else x >> 20) % FILTER_BITS


def runs_of(docs: DataFrame, sizes: range, frequent=None) -> DataFrame:
    """RUNS: sorted runs of the counts of phrases of ``sizes`` words; ``frequent`` is the
    broadcast bitmap of the parts."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        table, counters = _bytes_table(), {}
        bits = None if frequent is None else np.frombuffer(frequent.value, np.uint8)

        def spilled(keep: int):
            for c in sorted(counters.values(), key=LanguageCounts.held, reverse=True):
                for prefix, rest, n in c.spill(keep):
                    yield pa.RecordBatch.from_arrays([pa.repeat(c.lang, len(n)), prefix, rest, n], names=["lang", "prefix", "rest", "n"])
                if sum(map(LanguageCounts.held, counters.values())) <= keep:
                    return

        for batch in batches:
            for piece in text_batches(batch):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
                    by_lang.setdefault(lang, []).append(text.encode())
                for lang, texts in by_lang.items():
                    counters.setdefault(lang, LanguageCounts(lang, sizes, bits)).count(texts, table)
                if sum(map(LanguageCounts.held, counters.values())) > HELD:
                    yield from spilled(HELD // 4)
        yield from spilled(-1)

    return rows.mapInArrow(run, RUNS)


def merged(runs: DataFrame) -> DataFrame:
    """lang, phrase, n: the runs merged by prefix partitions."""
    dealt = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "rest").agg(F.sum("n").alias("n"))
    return dealt.select("lang", F.concat_ws(" ", "prefix", "rest").alias("phrase"), "n")


def bitmap(phrases: DataFrame):
    """A broadcast of FILTER_BITS bits: those at the places of the words or pairs are set."""
    spark = phrases.sparkSession
    words = F.split("phrase", " ")
    hashed = lambda i: F.crc32(F.concat_ws(" ", "lang", words[i]))
    at = F.when(F.size(words) == 1, place(hashed(0))).otherwise(place(hashed(0), F.crc32(F.concat_ws(" ", "lang", F.get(words, F.lit(1)))))) + 1
    parts = phrases.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = bytearray(FILTER_BITS // 8)
    for r in parts.toLocalIterator():  # 2,048 rows of 4 KB at most, whatever the input
        start = (r["part"] - 1) * 4096  # Spark's bitmaps count from 1
        bits[start:start + 4096] = r["bits"]
    return spark.sparkContext.broadcast(bytes(bits))


def count_phrases(docs: DataFrame, least: int, most_words: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, size) of all phrases up to ``most_words`` words with ``least``
    occurrences, and (lang, n): all words."""
    levels, frequent = [], None
    singles = stored(merged(runs_of(docs, range(1, 2))), "words")
    words = stored(singles.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    levels.append(singles.where(F.col("n") >= least))
    for sizes in (range(2, 3), range(3, most_words + 1)):
        if not len(sizes):
            break
        frequent = bitmap(levels[-1])
        levels.append(stored(merged(runs_of(docs, sizes, frequent)).where(F.col("n") >= least), "phrases"))
        frequent.unpersist()
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("*", F.size(F.split("phrase", " ")).alias("size")), words


def exact_score(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both), exact for all longs."""
    return F.call_function("div", (a.cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)")), both.cast("decimal(20,0)"))


def collocations(docs: DataFrame, least: int = 30, most_words: int = 4, best: int = 2000, percent: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` phrases of each language."""
    counts, words = count_phrases(docs, least, most_words)
    words_of = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words_of, start, size), " ")
    candidates = counts.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size")
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "size", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), part(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))).alias("c"))
    met = cuts.select("lang", "phrase", "a", "k", "c.left", "c.part").join(parts, ["lang", "part"])
    both = met.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("part_n"))).alias("l"),
                                                       F.max(F.when(~F.col("left"), F.col("part_n"))).alias("r"))
    score = exact_score(F.col("a"), F.col("l").cast("decimal(19,0)") + F.col("r")).alias("score")
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("cut"))
    # the largest count of the longer candidates around each candidate
    inside = candidates.where("size > 2").select("lang", "a", words_of.alias("w"), "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inside = inside.select("lang", "a", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("s"))
    around = inside.groupBy("lang", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("around"))
    dec = lambda c: F.col(c).cast("decimal(19,0)")
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (dec("around") * 100 < dec("a") * percent))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    top = flat.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= best)
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return top.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
