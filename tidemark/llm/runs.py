r"""Periodic runs of words (operator 12): Baier's grouping, Lyndon roots, extension.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and at least ``max(least_words, repeats * q)`` words that no neighbouring word
extends keeping the period; ``repeats`` is 3 at least.  For every text:

1. Words become numbers.  Each word of a run stands in it ``repeats`` times, so a word
   that is rarer in its stretch of text lies in no run and cuts the stretch; that is
   repeated until nothing is cut any more.  No run is lost, and ordinary prose
   leaves little for the next steps.
2. Phase one of Baier's suffix sorter (``lyndon_groups``): groups of positions, highest
   first, move the next lower position to their left into a finer group.  A
   position's last group is the longest Lyndon word that starts there, so its length is
   the Lyndon array, and positions of one group start with equal Lyndon words.
   Done under both orders of the words, since each run has its root under one.
3. Neighbouring positions p apart of one group of length p are repeated roots.  Chains
   of them are extended to both sides by longest common extensions, under p words each.

The work is linear in the words, texts are handled one Arrow batch piece at a time
without any shuffle, and a task holds one piece (one text at least).

Defined results: a null or empty text has no words and no runs, its collapsed text is
empty; runs are ordered by start, then period; a word is dropped from the collapsed
text if a run holds it after the run's first period; repeated rows have a result
each; an empty table gives an empty result; a ``doc`` struct carries the columns
asked for, so names never clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, text_batches

RUN = "struct<start: bigint, length: bigint, period: bigint>"
PIECE_BYTES = 1 << 20


def frequent_stretches(ids: np.ndarray, stretch: np.ndarray, repeats: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) and stretch numbers that can lie in runs.  ``stretch`` never
    falls along ``ids``; equal numbers are neighbours."""
    places = np.arange(len(ids))
    while len(places):
        _, word = np.unique(stretch * (int(ids.max()) + 1) + ids, return_inverse=True)
        _, size = np.unique(stretch, return_inverse=True)
        stay = (np.bincount(word)[word] >= repeats) & (np.bincount(size)[size] >= least)
        if stay.all():
            break
        places, ids, stretch = places[stay], ids[stay], stretch[stay]
        if len(places):
            new = (np.diff(places) > 1) | (np.diff(stretch) > 0)
            stretch = np.concatenate(([0], np.cumsum(new)))
    return places, stretch


def lyndon_groups(codes: list[int], kinds: int) -> tuple[list[int], list[int]]:
    """(group of each position, word length of each group): phase one of Baier's
    sorter over ``codes`` (0 to kinds - 1)."""
    n = len(codes)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, c in enumerate(codes):
        members[c].append(i)
    group, length = list(codes), [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))  # above[kinds - 1] is no group
    jump = list(range(-1, n))  # for positions whose group is done: a position to their left
    done = bytearray(n + 1)  # position -1 is never done
    g = kinds - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        for i in own:
            done[i] = 1
            jump[i] = i - 1
        before: dict[int, int] = {}
        for i in own:
            j = i - 1
            while done[j]:
                j = jump[j]
            k = i
            while k != j:  # shorten the way for those that come after
                step = jump[k]
                jump[k] = j
                k = step
            if j >= 0:
                before[j] = before.get(j, 0) + 1
        finer: dict[tuple[int, int], list[int]] = {}
        for j, times in before.items():
            finer.setdefault((-times, group[j]), []).append(j)
        for (times, old), moved in sorted(finer.items()) if len(finer) > 1 else finer.items():
            new = len(members)
            members.append(moved)
            length.append(length[old] - times * length[g])
            for j in moved:
                group[j] = new
            over = above[old]  # the more often repeated went in before and stands higher
            above.append(over)
            below.append(old)
            above[old] = new
            if over < new and below[over] == old:
                below[over] = new
        g = below[g]
    return group, length


def _extension(ids: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many places ids[a], ids[a + step], ... equal ids[b], ids[b + step], ..."""
    have, size = 0, 16
    while have < most:
        m = min(size, most - have)
        if step > 0:
            x, y = ids[a + have:a + have + m], ids[b + have:b + have + m]
        else:
            x, y = ids[a - have - m + 1:a - have + 1][::-1], ids[b - have - m + 1:b - have + 1][::-1]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return have + int(differ[0])
        have, size = have + m, size * 2
    return have


def runs_of(ids: np.ndarray, stretch: np.ndarray, repeats: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs inside the stretches, ordered.  Stretches
    are laid out behind one another, with a code of its own between each two."""
    if not len(ids):
        return []
    n = len(ids)
    _, word = np.unique(ids, return_inverse=True)
    gaps = np.flatnonzero(np.diff(stretch)) + 1
    cuts, kinds = len(gaps), int(word.max()) + 1
    at = np.arange(n) + np.searchsorted(gaps, np.arange(n), side="right")
    text = np.empty(n + cuts, np.int64)
    origin = np.full(n + cuts, -1, np.int64)
    origin[at] = np.arange(n)
    found = set()
    for order in (word, kinds - 1 - word):
        text[origin < 0] = np.arange(cuts)
        text[at] = order + cuts
        group, length = lyndon_groups(text.tolist(), kinds + cuts)
        group = np.array(group)
        period = np.array(length)[group]
        here = np.arange(len(text))
        after = here + period
        again = (after < len(text)) & (group[np.minimum(after, len(text) - 1)] == group)
        ahead = (here >= period) & (group[np.maximum(here - period, 0)] == group)
        for i in np.flatnonzero(again & ~ahead).tolist():  # the first root of each chain
            p, end = int(period[i]), i + 2 * int(period[i])
            while end < len(text) and group[end] == group[i]:
                end += p
            if (end - i) // p < repeats - 1:
                continue
            right = _extension(text, end - p, end, min(p, len(text) - end), 1)
            left = _extension(text, i - 1, i + p - 1, min(p, i), -1)
            size = left + end - i + right
            if size >= max(least, repeats * p):
                found.add((int(origin[i - left]), size, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def batch_runs(texts: list[bytes], repeats: int, least: int) -> list[tuple[int, list, bytes]]:
    """For each text: number of words, its runs, the text without repeats."""
    import pyarrow as pa

    split = [t.split() for t in texts]  # at the six ASCII white space characters
    firsts = np.cumsum([0] + [len(w) for w in split])
    ids = pa.array([w for ws in split for w in ws], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(split)), np.diff(firsts))
    places, stretch = frequent_stretches(ids, owner, repeats, least)
    found: list[list] = [[] for _ in split]
    for start, size, p in runs_of(ids[places], stretch, repeats, least):
        at = int(places[start])
        d = int(owner[at])
        found[d].append((at - int(firsts[d]), size, p))
    out = []
    for words, runs in zip(split, found):
        kept = words
        if runs:
            drop = np.zeros(len(words), np.bool_)
            for start, size, p in runs:
                drop[start + p:start + size] = True
            kept = [words[i] for i in np.flatnonzero(~drop).tolist()]
        out.append((len(words), runs, b" ".join(kept)))
    return out


def find_runs(docs: DataFrame, columns: list[str], repeats: int = 4, least_words: int = 6) -> DataFrame:
    """doc (struct of ``columns``), n_words, runs (array of start, length, period in
    words, by start and period) and collapsed (the kept words joined by one space)."""
    if repeats < 3:
        raise ValueError("repeats must be 3 at least")
    doc = F.struct(*columns).alias("doc")
    rows = docs.select(doc, F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, n_words bigint, runs array<{RUN}>, collapsed string"

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for piece in text_batches(batch, PIECE_BYTES):
                res = batch_runs([t.encode() for t in piece.column("text").to_pylist()], repeats, least_words)
                runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for _, r, _ in res]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), pa.array([n for n, _, _ in res], pa.int64()), pa.array(runs, kind),
                     pa.array([c.decode() for _, _, c in res], pa.string())], names=["doc", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema)


def longest(runs: Column) -> Column:
    """The run of greatest length; ties: smallest start, then period (null: no run)."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def runs_text(runs: Column) -> Column:
    """Every run's ``start,length,period`` and a line feed, in order."""
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with repeats planted by the crc32 h of the decimal doc_id:
    if h % 10 = 0, the n words from a = g % n on repeat the first p of them, where
    g = h div 10 and p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    chosen = (h % 10 == 0) & F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False))
    d = docs.select("doc_id", "text", F.when(chosen, words).alias("words"), F.expr("crc32(cast(doc_id AS string)) div 10").alias("g"))
    d = d.select("*", F.expr("cast(g % size(words) AS int)").alias("a"))
    d = d.select("*", F.expr("cast(1 + (size(words) - a) div (3 + g % 8) AS int)").alias("p"))
    planted = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')")
    return d.select("doc_id", F.when(F.col("words").isNotNull(), planted).otherwise(F.col("text")).alias("text"))
