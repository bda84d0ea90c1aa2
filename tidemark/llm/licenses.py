r"""License scans (operator 11): fuzzy search for short notices.

Texts are lower-cased (A-Z) and cut into words of digits, letters a-z and all
characters from U+0080 on; the words joined by one space are what is searched.
A notice is (label, phrase, errors): its phrase may stand with up to ``errors``
inserted, dropped or changed characters, from the start of a word to the end of one.

* Seeds: the phrase is cut into ``errors + 1`` pieces of about equal length.  Any match
  leaves one piece untouched (pigeonhole), so an Aho-Corasick automaton over the pieces
  of all notices finds every candidate in one pass over the text.
* Verification: around each seed, as far as a match could reach, the regex library's
  fuzzy matching ``(?:phrase){e<=errors}`` finds the spans and their edits.  Windows
  that touch are searched as one, so a match is found once.
* A notice with no errors allowed is one piece, the phrase between spaces; all its
  places count, overlapping ones too.
* Where fuzzy matches of several notices overlap, the one with the smallest share of
  edits stays (ties: the longer, the earlier, the first in the list).

Every text is scanned where it lies, without a shuffle; the notices are a parameter and the
only thing sent to the tasks.

Defined results: a null or empty text has no words and no matches; repeated rows have a
result each; an empty table gives an empty result; a ``doc`` struct carries the
columns asked for, so names never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches

# Phrases of the base labels (no errors allowed).
BASE = [("mit", "mit license", 0), ("apache", "apache license", 0), ("gpl", "general public license", 0)]
# Wordings of common short notices, as words of the normal form.
SHORT_NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 2"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license"),
    ("isc", "permission to use copy modify and or distribute"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("unlicense", "this is free and unencumbered software"),
    ("reserved", "all rights reserved"),
]
CHARACTERS_AN_ERROR = 12  # the cost of bounded-error matching grows fast with the errors
WINDOWS_KEPT = 10_000  # verified windows that a task remembers
MATCH = "struct<label: string, phrase: string, edits: int, word: bigint, words: int, start: bigint, end: bigint>"


def notices(characters_an_error: int = CHARACTERS_AN_ERROR) -> list[tuple[str, str, int]]:
    """The base phrases, and the short notices with an error for so many characters."""
    return BASE + [(label, phrase, len(phrase) // characters_an_error) for label, phrase in SHORT_NOTICES]


def pieces(phrase: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): ``errors + 1`` pieces of the phrase, none empty."""
    if errors >= len(phrase):
        raise ValueError(f"more errors than characters: {phrase}")
    cuts = [len(phrase) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The automaton and the patterns of some notices."""

    def __init__(self, wanted: list[tuple[str, str, int]]):
        import ahocorasick
        import regex

        self.notices, self.patterns, self.seen, seeds = wanted, [], {}, {}
        for k, (_, phrase, errors) in enumerate(wanted):
            self.patterns.append(regex.compile(rf"(?e)(?<= )(?:{regex.escape(phrase, literal_spaces=True)}){{e<={errors}}}(?= )") if errors else None)
            for offset, piece in pieces(phrase, errors) if errors else [(0, f" {phrase} ")]:
                seeds.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        if seeds:
            self.automaton.make_automaton()

    def verified(self, k: int, window: str) -> list[tuple[int, int, int]]:
        """(start, end, edits) of notice ``k`` in a window; windows repeat as notices do."""
        find = lambda: [(*m.span(), sum(m.fuzzy_counts)) for m in self.patterns[k].finditer(window)]
        if len(window) > 1000:
            return find()
        if (k, window) not in self.seen:
            if len(self.seen) >= WINDOWS_KEPT:
                self.seen.clear()
            self.seen[k, window] = find()
        return self.seen[k, window]

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in ``text``: words with a space before, between
        and after; ordered by place."""
        exact, windows = [], {}
        for end, (size, places) in self.automaton.iter(text) if self.notices else ():
            for k, offset in places:
                _, phrase, errors = self.notices[k]
                if not errors:
                    exact.append((k, end - size + 2, end, 0))
                    continue
                at = end - size + 1 - offset  # where the phrase starts if nothing is edited
                a, b = max(0, at - errors - 1), at + len(phrase) + errors + 1
                own = windows.setdefault(k, [])
                if own and a <= own[-1][1]:  # seeds come by their ends, windows nearly by their starts
                    own[-1] = (min(a, own[-1][0]), max(b, own[-1][1]))
                else:
                    own.append((a, b))
        fuzzy = []
        for k, own in windows.items():
            for a, b in _joined(own):
                fuzzy += [(k, max(0, a) + x, max(0, a) + y, edits) for x, y, edits in self.verified(k, text[max(0, a):b])]
        fuzzy.sort(key=lambda m: (m[3] / len(self.notices[m[0]][1]), m[1] - m[2], m[1], m[0]))
        return sorted(exact + _apart(fuzzy), key=lambda m: (m[1], m[2], m[0]))


def _joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _apart(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Those that overlap none before them in the list."""
    import bisect

    kept: list[tuple[int, int, int, int]] = []
    order: list[tuple[int, int]] = []
    for m in spans:
        i = bisect.bisect_left(order, (m[1], m[2]))
        if (i and order[i - 1][1] > m[1]) or (i < len(order) and order[i][0] < m[2]):
            continue
        order.insert(i, (m[1], m[2]))
        kept.append(m)
    return kept


def _word_bytes() -> bytes:
    """Byte to byte: A-Z lower-cased, what is no part of a word a space."""
    low = bytes(range(256)).lower()
    return bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in low)


def scan_text(scanner: Scanner, raw: bytes, normal: bytes) -> tuple[int, list[tuple]]:
    """(number of words, matches as MATCH) of one text; ``normal`` by ``_word_bytes``."""
    import re

    words = normal.split()
    text = f" {b' '.join(words).decode()} "
    hits = scanner.matches(text)
    if not hits:
        return len(words), []
    spans = [m.span() for m in re.finditer(rb"[^ ]+", normal)]
    out, at, word, place, chars = [], 0, -1, 0, 0
    for k, start, end, edits in hits:  # ordered by start
        word += text.count(" ", at, start)
        at = start
        size = text.count(" ", start, end) + 1
        a, b = spans[word][0], spans[word + size - 1][1]
        chars += len(raw[place:a].decode())
        place = a
        label, phrase, _ = scanner.notices[k]
        out.append((label, phrase, edits, word, size, chars, chars + len(raw[a:b].decode())))
    return len(words), out


def scan(docs: DataFrame, columns: list[str], wanted: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """doc (struct of ``columns``), n_words and matches (array ordered by place): label
    and phrase of the notice, edits, first word (from 0), number of words, and the span
    in code points of the text."""
    rows = docs.select(F.struct(*columns).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, n_words bigint, matches array<{MATCH}>"
    wanted = notices() if wanted is None else wanted

    def run(batches):
        import pyarrow as pa

        names = ["label", "phrase", "edits", "word", "words", "start", "end"]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        kind = pa.list_(pa.struct(list(zip(names, kinds))))
        scanner, normal = Scanner(wanted), _word_bytes()
        for batch in batches:
            for piece in text_batches(batch):
                texts = [t.encode() for t in piece.column("text").to_pylist()]
                res = [scan_text(scanner, t, t.translate(normal)) for t in texts]
                found = pa.array([[dict(zip(names, m)) for m in ms] for _, ms in res], kind)
                yield pa.RecordBatch.from_arrays([piece.column("doc"), pa.array([n for n, _ in res], pa.int64()), found],
                                                 names=["doc", "n_words", "matches"])

    return rows.mapInArrow(run, schema)


def labels(matches: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(matches["label"])), ",")


def exact_only(matches: Column) -> Column:
    """Matches of base phrases."""
    return F.filter(matches, lambda m: m["phrase"].isin([p for _, p, _ in BASE]))


def score(matches: Column) -> Column:
    """1 less the smallest share of edits, 0 without a match."""
    shares = F.transform(matches, lambda m: m["edits"] / F.length(m["phrase"]))
    return F.coalesce(F.lit(1.0) - F.array_min(shares), F.lit(0.0))
