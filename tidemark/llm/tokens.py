r"""Token counts (operator 6): trie-shared dynamic programming.

A text is cut into pre-tokens (a word with the space before it, or white space),
and each is cut into vocabulary pieces at the least total cost, the cost of a
piece being the log of its rank (unigram scores by Zipf's law; the vocabulary is
a parameter and is not trained).  The distinct pre-tokens of a block of text are
put in a trie, and the forward score of a prefix is computed once for its node,
level by level in numpy, whatever the number of pre-tokens that share it; a
pre-token's count is stored at its last node.  Of equal costs the fewest pieces
count.  Costs are integers: cost << 20 | pieces, so one minimum decides both.

Map-only: nothing is shuffled and memory is bounded by the block (``block_bytes``
of text; a longer text is a block of its own).  Pre-tokens over 64 bytes are few and
deep: they walk the same kind of trie depth first, in sorted order, with the scores of
the current path on a stack, so a prefix shared with the one before is not scored anew.

Defined results: null and empty texts have 0 tokens; a null doc_id is carried;
repeated rows count alike; an empty table gives an empty result; columns besides
doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import math
import re

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import text_batches

PRETOKEN = re.compile(r" ?[^ \t\n\v\f\r]+|[ \t\n\v\f\r]+")
SHIFT = 20
FAR = np.int64(1) << np.int64(60)
LONG = 64
COUNT_BITS = 40


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Pieces:
    """The vocabulary as a trie in sorted arrays: edges state * 256 + byte -> state,
    and the cost of the piece that ends in a state (FAR: none)."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes, e.g. {missing[0]}: some texts could not be cut")
        children: dict[int, int] = {}
        costs = [int(FAR)]
        for piece, rank in ranks.items():
            state = 0
            for byte in piece:
                key = state << 8 | byte
                if key not in children:
                    children[key] = len(costs)
                    costs.append(int(FAR))
                state = children[key]
            costs[state] = round(math.log(rank + 2) * (1 << 16)) << SHIFT | 1
        self.keys = np.array(sorted(children), np.int64)
        self.next = np.array([children[k] for k in self.keys.tolist()], np.int64)
        self.cost = np.array(costs, np.int64)

    def step(self, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The states after one more byte; -1 where no piece goes on."""
        out = np.full(len(states), -1, np.int64)
        alive = np.flatnonzero(states >= 0)
        if len(alive):
            key = states[alive] << 8 | bytes_[alive]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[alive] = np.where(self.keys[at] == key, self.next[at], -1)
        return out

    def edges(self) -> dict[int, int]:
        if not hasattr(self, "_edges"):
            self._edges = dict(zip(self.keys.tolist(), self.next.tolist()))
            self._cost = self.cost.tolist()
        return self._edges

    def count_deep(self, tokens: list[bytes]) -> list[int]:
        """Pieces of each of the sorted ``tokens``: a walk of their trie, depth first.  Scores
        of the path down to the node where the next one branches off are kept; a node takes
        its score from the starts of pieces that end there."""
        edges, costs = self.edges(), self._cost
        best, before, out = [0], b"", []
        # per start of a piece that may go on at the path's end: (start, state), one list a node
        open_ = [[(0, 0)]]
        for token in tokens:
            depth = 0
            for x, y in zip(before, token):
                if x != y:
                    break
                depth += 1
            del best[depth + 1:], open_[depth + 1:]
            for at in range(depth, len(token)):
                byte, score, going = token[at], 1 << 200, []
                for start, state in open_[at]:
                    state = edges.get(state << 8 | byte)
                    if state is not None:
                        going.append((start, state))
                        if costs[state] < FAR:
                            score = min(score, best[start] + (costs[state] >> SHIFT << COUNT_BITS) + 1)
                going.append((at + 1, 0))
                best.append(score)
                open_.append(going)
            out.append(best[-1] & ((1 << COUNT_BITS) - 1))
            before = token
        return out

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Pieces of each of the distinct, sorted pre-tokens."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        out = np.zeros(len(tokens), np.int64)
        deep = np.flatnonzero(lengths > LONG)
        out[deep] = self.count_deep([tokens[i] for i in deep])
        ids = np.flatnonzero((lengths > 0) & (lengths <= LONG))
        text = np.frombuffer(b"".join(tokens[i] for i in ids), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths[ids])
        start, size = ends - lengths[ids], lengths[ids]
        node = np.zeros(len(ids), np.int64)  # each word's node in the level
        # per level and start of a piece: its state, and the best score where it starts
        states, scores = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        level = 0
        while len(ids):
            byte = text[start + level]
            key = node << 8 | byte
            new = np.concatenate(([True], key[1:] != key[:-1]))  # sorted words: equal prefixes are neighbours
            parent, at_byte = node[new], byte[new]
            node = np.cumsum(new) - 1
            best = np.full(len(parent), FAR, np.int64)
            next_states, next_scores = [], []
            for state, score in zip(states, scores):
                moved, from_ = self.step(state[parent], at_byte), score[parent]
                if (moved >= 0).any():
                    reach = np.where(moved >= 0, self.cost[moved], FAR)
                    best = np.minimum(best, np.where(reach < FAR, from_ + reach, FAR))
                    next_states.append(moved)
                    next_scores.append(from_)
            level += 1
            done = size == level
            out[ids[done]] = best[node[done]] & ((1 << SHIFT) - 1)
            states, scores = [np.zeros(len(best), np.int64), *next_states], [best, *next_scores]
            go = ~done
            ids, start, size, node = ids[go], start[go], size[go], node[go]
        return out


def count_texts(pieces: Pieces, texts: list[str | None]) -> np.ndarray:
    """Tokens of each text; the distinct pre-tokens of all share one trie."""
    import pyarrow as pa
    import pyarrow.compute as pc

    cut = [PRETOKEN.findall(t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    found = pa.array([x for c in cut for x in c], pa.string()).cast(pa.binary()).dictionary_encode()
    order = pc.array_sort_indices(found.dictionary)
    counts = np.zeros(len(found.dictionary), np.int64)
    counts[order.to_numpy()] = pieces.count(found.dictionary.take(order).to_pylist())
    sums = np.concatenate(([0], np.cumsum(counts[found.indices.to_numpy()])))
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def count_tokens(docs: DataFrame, vocabulary: str, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_tokens.  ``vocabulary``: path of a rank file, read on the driver
    and broadcast (its size is that of the vocabulary)."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(read_ranks(vocabulary)))

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for b in text_batches(whole, block_bytes):
                n = count_texts(shared.value, b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, rows.select("doc_id").schema.add("n_tokens", "long"))
