r"""MinHash near-duplicates (operator 8): bottom-k sketches.

A document's set is its distinct word shingles under one 64-bit hash; its sketch
is the ``k`` smallest.  Steps:

1. Documents with equal sets become one class (by a 128-bit digest of the set).
2. Inverted lists: a sketch value that two classes retain links nothing by
   itself, but linked classes share many.  Of k values of a union, about 0.8 k are
   common to both if the similarity is 0.8; fewer than k / 2 = 32 of 64 has
   probability under 1e-7 per link.  Two sketches with t common values share one
   among the s - t + 1 values that are rarest in the whole corpus (s: sketch size),
   so only those are listed.  Sets of at most 0.8 k shingles are whole in their
   sketch, so t is exact there.  Text that many documents share thus makes no lists
   unless it is half of a document.
3. A list offers each member the list's hub, its member with the most common sketch.
   That is linear in the list.  Pairs are filtered by sizes and by the union sketch's
   estimate, then verified on full sets, and components are formed.
4. Members of lists that still hold several components meet in blocks, full sets
   against full sets (``block_links``), leaving out pairs of one component.  So no list
   is cut short, and only links come out, never all pairs of a group.

Links are exact up to the chance in 2; classes of copies need no pairs at all.

Defined results: without words or text (or null) the set is empty and linked with
nothing; with fewer words than a shingle the whole sequence is one; rows that repeat a
doc_id are nodes of their own that share the id; a null doc_id is smaller than all
(its component_id is null); an empty table gives an empty result; columns besides
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidemark.llm.common import SPACES, stored, text_batches
from tidemark.llm.components import components

K = 64
BASE = 0x9E3779B97F4A7C15 | 1
MULTIPLIERS = [0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0x165667B19E3779F9, 0xA0761D6478BD642F]
BROADCAST_IDS = 2_000_000
BLOCK_ITEMS = 200_000
BLOCK_SETS = 2_000

_tables: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, kept by the worker."""
    if len(_tables.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(n, np.uint64(base))
            p[0] = 1
            _tables[name] = np.cumprod(p)
    return _tables["up"][:n], _tables["down"][:n]


def _bytes_tables() -> tuple[np.ndarray, np.ndarray]:
    if "lower" not in _tables:
        low = np.arange(256, dtype=np.uint64)
        low[65:91] += 32
        space = np.zeros(256, np.bool_)
        space[[ord(c) for c in SPACES]] = True
        _tables["lower"], _tables["space"] = low + 1, space
    return _tables["lower"], _tables["space"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(text, width: int) -> list[np.ndarray]:
    """For an Arrow string array: each text's distinct shingles as sorted int64 hashes.
    Words are the runs between white space bytes, A-Z lower-cased."""
    import pyarrow as pa

    text = text.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(text) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(data):
        return [np.zeros(0, np.int64)] * len(text)
    low, is_space = _bytes_tables()
    space = is_space[data]
    ahead = np.concatenate(([True], space[:-1]))
    ahead[offsets[:-1][offsets[:-1] < len(data)]] = True
    after = np.concatenate((space[1:], [True]))
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & ahead), np.flatnonzero(~space & after) + 1
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(low[data] * up, out=sums[1:])
    word = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    m = [np.uint64(x) for x in MULTIPLIERS[:width]]
    first = np.searchsorted(starts, offsets)  # each text's first word
    full = np.zeros(0, np.uint64)
    if len(word) >= width:
        size = len(word) - width + 1
        full = word[:size] * m[0]
        for j in range(1, width):
            full += word[j:j + size] * m[j]
        full = _mix(full).view(np.int64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(full[a:b - width + 1]))
        elif b > a:
            h = np.array([(b - a) * 0x2545F4914F6CDD1D % (1 << 64)], np.uint64)
            h += (word[a:b] * np.array(m[:b - a])).sum()
            out.append(_mix(h).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, width: int, k: int = K) -> DataFrame:
    """doc_id, n (set size), node (digest of the set, null if empty), sketch."""
    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema.add("n", "long").add("node", "binary").add("sketch", ArrayType(LongType()))

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for b in text_batches(whole, 2 << 20):
                sets = shingle_sets(b.column("text"), width)
                sizes = np.array([len(s) for s in sets], np.int64)
                held = np.concatenate(([0], np.cumsum(np.minimum(sizes, k)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(sizes), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(held, pa.array(np.concatenate([s[:k] for s in sets])))],
                    names=["doc_id", "n", "node", "sketch"])

    return rows.mapInArrow(run, schema)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """node, items (all hashes, packed) of the documents whose doc_id is in ``ids``;
    ids are broadcast if they are counted as few, else joined by a shuffle."""
    wanted = stored(ids.select(F.col("doc_id").alias("wanted")).distinct(), "near-ids")
    few = wanted.count() <= BROADCAST_IDS
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("wanted")),
                                              "left_semi").select("text")

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for b in text_batches(whole, 2 << 20):
                sets = [s for s in shingle_sets(b.column("text"), width) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "items"])

    return rows.mapInArrow(run, "node binary, items binary").dropDuplicates(["node"])


def prefix_lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """value, node, n, fame: the listed sketch values.  fame: how common a sketch is."""
    each = classes.select("node", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    shared = each.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    w = Window.partitionBy("node")
    whole = F.col("n") * 100 <= k * percent  # such sets and all their partners are whole in their sketches
    least = F.when(whole, F.ceil(F.col("n") * percent / 100)).otherwise(k // 2)
    return (each.join(shared, "value")
            .withColumn("place", F.row_number().over(w.orderBy("df", "value")))
            .withColumn("fame", F.sum("df").over(w))
            .withColumn("alone", F.col("s") - F.count(F.lit(1)).over(w))
            .where(F.col("place") + F.col("alone") <= F.col("s") - least + 1)
            .select("value", "node", "n", "fame"))


def _near_sizes(x: str, y: str, percent: int):
    return (F.least(x, y) * 100) >= (F.greatest(x, y) * percent)


def hub_pairs(lists: DataFrame, order, percent: int) -> DataFrame:
    """(a, b): each list's members with its hub, the first by ``order`` (descending)."""
    hub = lists.groupBy("value").agg(F.max(F.struct(order.alias("o"), "node", "n")).alias("hub"))
    pairs = lists.join(hub, "value").where(F.col("node") != F.col("hub.node"))
    return pairs.where(_near_sizes("n", "hub.n", percent)).select(
        F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Pairs whose union sketch holds enough common values."""
    sk = classes.select("node", "sketch")
    df = (pairs.join(sk.toDF("a", "sa"), "a").join(sk.toDF("b", "sb"), "b")
          .withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)))
    common = F.size(F.array_intersect("u", F.array_intersect("sa", "sb")))
    return df.where(common * 2 >= F.size("u")).select("a", "b")


def block_links(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between different components inside the lists, verified on full
    sets; of the links between two components in a block pair, one.

    A node belongs to the block of its value with the longest list, large blocks being
    cut to about BLOCK_ITEMS shingles and BLOCK_SETS sets (a task counts common shingles
    in a square table of two blocks' sets).  Two blocks meet if a list has members in both, so
    a node is sent once per partner block, not once per list."""
    sizes = lists.groupBy("value").agg(F.count(F.lit(1)).alias("m"))
    own = lists.join(sizes, "value").groupBy("node").agg(
        F.max(F.struct("m", "value")).alias("p"), F.first("n").alias("n"), F.first("label").alias("label"))
    own = own.withColumn("p", F.col("p.value"))
    cuts = own.groupBy("p").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_ITEMS), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("int").alias("cuts"))
    block = F.concat_ws(":", "p", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("string"))
    own = stored(own.join(cuts, "p").select("node", "n", "label", block.alias("block")), "near-blocks")
    seen = stored(lists.join(own.select("node", "block"), "node").select("value", "block").distinct(), "near-block-lists")
    meet = (seen.withColumnRenamed("block", "i").join(seen.withColumnRenamed("block", "j"), "value").where("i <= j")
            .select("i", "j").distinct())
    rows = meet.select(F.concat_ws("|", "i", "j").alias("pair"), F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    rows = rows.join(own, "block").join(sets, "node").select("pair", "block", "node", "label", "items")

    def run(batches):
        import pyarrow as pa

        held, pair = [], None
        for t in batches:
            for row in zip(*(t.column(i).to_pylist() for i in range(5))):
                if row[0] != pair:
                    if held:
                        yield _links(held, percent)
                    held, pair = [], row[0]
                held.append(row[1:])
        if held:
            yield _links(held, percent)
        yield pa.RecordBatch.from_pydict({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})

    return rows.repartition("pair").sortWithinPartitions("pair").mapInArrow(run, "a binary, b binary").distinct()


def _links(rows: list[tuple], percent: int):
    """``rows``: block, node, label, items of the members of two blocks (or one)."""
    import pyarrow as pa

    sets = [np.frombuffer(r[3], np.int64) for r in rows]
    n = np.array([len(x) for x in sets])
    _, ids, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # what only one member has adds nothing; the rest are columns of an incidence matrix
    column = np.cumsum(times > 1) - 1
    some = times[ids] > 1
    row, col = np.repeat(np.arange(len(sets)), n)[some], column[ids][some]
    common = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers below 2 ** 24
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for start in range(0, int(col[-1]) + 1 if len(col) else 0, 2048):
        x, y = np.searchsorted(col, (start, start + 2048))
        has = np.zeros((len(sets), 2048), np.float32)
        has[row[x:y], col[x:y] - start] = 1
        common += has @ has.T
    linked = 100 * common.astype(np.int64) >= percent * (np.add.outer(n, n) - common.astype(np.int64))
    block, label = [np.unique([r[i] for r in rows], return_inverse=True)[1] for i in (0, 2)]
    if block.max():
        linked &= np.not_equal.outer(block, block)
    linked &= np.not_equal.outer(label, label)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    a, b = [], []
    for x, y in np.argwhere(np.triu(linked, 1)).tolist():
        p, q = root(int(label[x])), root(int(label[y]))
        if p != q:
            parent[p] = q
            a.append(rows[x][1])
            b.append(rows[y][1])
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough: 100 common >= percent united."""
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")

    def run(batches):
        import pyarrow as pa

        for t in batches:
            keep = []
            for x, y in zip(t.column("x").to_pylist(), t.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def near_links(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): every row's doc_id, n, node; and (node, label) of the nodes
    that have links to other nodes."""
    sk = stored(sketches(docs, width, k), "near-sketches")
    classes = stored(sk.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "near-classes")
    lists = stored(prefix_lists(classes, k, percent), "near-lists")
    pairs = stored(estimated(hub_pairs(lists, F.col("fame"), percent), classes, k), "near-pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(full_sets(docs, classes.join(nodes, "node", "left_semi").select("doc_id"), width), "near-sets")
    links = stored(verified(pairs, sets, percent), "near-links")
    labels = stored(components(links), "near-labels")
    named = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    left = stored(named.join(mixed.select("value"), "value", "left_semi"), "near-left")
    if not left.isEmpty():
        ids = classes.join(left.select("node").distinct(), "node", "left_semi").select("doc_id")
        sets = stored(full_sets(docs, ids, width), "near-sets")
        links = links.unionByName(stored(block_links(left, sets, percent), "near-links"))
        labels = stored(components(links), "near-labels")
    return sk.select("doc_id", "n", "node"), labels


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    rows, labels = near_links(docs, width, percent, k)
    named = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = stored(named.select("doc_id", F.col("n").alias("n_shingles"), "label"), "near-named")
    ids = named.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id")).alias("least"))
    linked = named.where("label IS NOT NULL").join(ids, "label").select("doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"))
    alone = named.where("label IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
