"""Operators 11 to 13 against plain Python, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, phrases, queries, runs

SCHEMA = "doc_id long, text string, lang string, doc string, n_words int, matches string, runs string, phrase int, rank int"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2, 3) for r in rows], SCHEMA).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -------------------------------------------------------------- licenses ---
NOTICE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def edited(rnd, phrase, times):
    p = list(phrase)
    for _ in range(times):
        i, how = rnd.randrange(len(p)), rnd.randrange(3)
        p[i:i + (how != 1)] = [] if how == 0 and len(p) > 1 else [rnd.choice("abcz ")]
    return "".join(p)


def test_scanner_finds_what_regex_finds_in_the_whole_text():
    wanted = licenses.notices()
    scanner, rnd = licenses.Scanner(wanted), random.Random(7)
    found = 0
    for _ in range(400):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            _, phrase, errors = rnd.choice(wanted)
            parts.append(edited(rnd, phrase, rnd.randint(0, errors + 1)))
            parts += rnd.choices(["under", "the", "license", "licensed", "mit", "copy", "é1"], k=rnd.randint(0, 4))
        text = f" {' '.join(' '.join(parts).split())} "
        spans, want = [], []
        for k, (_, phrase, errors) in enumerate(wanted):
            if errors:
                spans += [(k, *m.span(), sum(m.fuzzy_counts)) for m in scanner.patterns[k].finditer(text)]
            else:
                want += [(k, m.start() + 1, m.start() + 1 + len(phrase), 0) for m in re.finditer(f"(?= {phrase} )", text)]
        spans.sort(key=lambda m: (m[3] / len(wanted[m[0]][1]), m[1] - m[2], m[1], m[0]))
        apart = []
        for m in spans:
            if all(m[2] <= x[1] or x[2] <= m[1] for x in apart):
                apart.append(m)
        assert scanner.matches(text) == sorted(want + apart, key=lambda m: (m[1], m[2], m[0]))
        found += len(apart)
    assert found > 300


def test_pieces_cover_the_phrase_and_keep_one_untouched():
    for _, phrase, errors in licenses.notices():
        cut = licenses.pieces(phrase, errors)
        assert len(cut) == errors + 1 and "".join(p for _, p in cut) == phrase and all(p for _, p in cut)
        assert all(phrase[at:at + len(p)] == p for at, p in cut)
    with pytest.raises(ValueError):
        licenses.pieces("ab", 2)


def test_license_scan_rows(spark):
    texts = [(1, None), (2, ""), (3, " -- "), (4, "MIT License; mit\nlicense, MIT  LICENSE"), (5, "é Licensed undr the Apache License, Version 2.0!"),
             (5, "é Licensed undr the Apache License, Version 2.0!"), (None, "general public licenses"), (6, "submit license mit licensed"),
             (7, "wort " * 60_000 + "General Public\tLicense"), (8, "All rights resrved. Licensed under CC BY-NC 4.0."), (9, "über mit license2 mité license")]
    out = licenses.scan(frame(spark, [(i, t, "en") for i, t in texts]), ["doc_id", "doc", "matches"])
    got = collections.defaultdict(list)
    for r in out.select("doc.doc_id", "n_words", "matches").collect():
        got[r["doc_id"]].append((r["n_words"], r["matches"]))
    for i, t in texts:
        words = list(NOTICE_WORD.finditer(lower(t)))
        assert got[i][0][0] == len(words)
        base = [(k, label) for label, phrase, _ in licenses.BASE for k in range(len(words))
                if [w[0] for w in words[k:k + len(phrase.split())]] == phrase.split()]
        exact = {p for _, p, _ in licenses.BASE}
        assert sorted((m["word"], m["label"]) for m in got[i][0][1] if m["phrase"] in exact) == sorted(base)
        for m in got[i][0][1]:
            assert (m["start"], m["end"]) == (words[m["word"]].start(), words[m["word"] + m["words"] - 1].end())
    assert len(got[5]) == 2 and [(m["label"], m["edits"]) for m in got[5][0][1] if m["edits"]] == [("apache", 1)]
    assert {m["label"] for m in got[8][0][1]} == {"reserved", "cc-by-nc"}
    assert licenses.scan(frame(spark, []), ["doc_id"]).count() == 0
    assert out.count() == len(texts)


def test_license_query_columns(spark, tmp_path):
    frame(spark, [(1, None, "en"), (2, "mit license x MIT license", "en"), (3, "released undr the mit licence", "en")]).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r.asDict() for r in queries.QUERIES["op11_license_scan"](spark, str(tmp_path)).collect()}
    assert got[1] == dict(doc_id=1, n_words=0, n_base=0, first_word=None, last_word=None, base_labels="", labels="", score=0.0)
    assert got[2] == dict(doc_id=2, n_words=5, n_base=2, first_word=0, last_word=3, base_labels="mit", labels="mit", score=1.0)
    assert got[3]["n_base"] == 0 and got[3]["labels"] == "mit" and 0.9 < got[3]["score"] < 1


# ------------------------------------------------------------------ runs ---
def plain_runs(w, repeats=4, least=6):
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if size >= max(least, repeats * q) and not any(
                    all(w[x] == w[x + d] for x in range(s, s + size - d)) for d in range(1, q)):
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_plain_runs():
    rnd = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            w = []
            while len(w) < rnd.randint(0, 50):
                unit = [rnd.choice("abc"[:rnd.randint(1, 3)]) for _ in range(rnd.randint(1, 6))]
                w += (unit * 9)[:rnd.randint(1, 40)]
            texts.append(w)
        for repeats in (3, 4):
            for w, (n, got, collapsed) in zip(texts, runs.batch_runs([" ".join(w).encode() for w in texts], repeats, 6)):
                want = plain_runs(w, repeats)
                gone = {i for s, size, q in want for i in range(s + q, s + size)}
                assert (n, got) == (len(w), want)
                assert collapsed.decode() == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_lyndon_groups_are_longest_lyndon_words():
    rnd = random.Random(5)
    for _ in range(300):
        s = [rnd.randrange(3) for _ in range(rnd.randint(1, 25))]
        group, length = runs.lyndon_groups(s, 3)
        lyndon = lambda x: all(x < x[i:] for i in range(1, len(x)))
        for i in range(len(s)):
            assert length[group[i]] == max(e - i for e in range(i + 1, len(s) + 1) if lyndon(s[i:e]))
        for i in range(len(s)):
            for j in range(i):
                assert (group[i] == group[j]) == (s[i:i + length[group[i]]] == s[j:j + length[group[j]]])


def test_run_rows_and_query(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice(["a", "bb", "ccc", "é"]) + rnd.choice(["", "1"]) for _ in range(rnd.randint(0, 60))), "en") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, " \t\n", "en"), (103, "x\ty\x0bx y\nx y x  y x", "en"), (103, "x\ty\x0bx y\nx y x  y x", "en"),
             (None, "z " * 9, "en"), (104, ("u v w " * 30_000).strip(), "en"), (105, "q " * 5, "en")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.defaultdict(list)
    for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect():
        got[r["doc_id"]].append(r)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    planted = 0
    for i, text, _ in rows:
        w = SPACES.findall(text or "")
        n, h = len(w), 0 if i is None else zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w, planted = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)], planted + 1
        want = [(0, 90_000, 3)] if i == 104 else plain_runs(w)
        gone = {k for s, size, q in want for k in range(s + q, s + size)}
        for r in got[i]:
            assert r["n_runs"] == len(want) and r["runs_sha256"] == sha("".join(f"{s},{z},{q}\n" for s, z, q in want))
            assert r["collapsed_sha256"] == sha(" ".join(x for k, x in enumerate(w) if k not in gone))
            top = min(want, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
            assert (r["start"], r["length"], r["period"]) == top
            assert r["exponent_milli"] == (1000 * top[1] // top[2] if want else None)
    assert planted and sum(map(len, got.values())) == len(rows)
    assert runs.find_runs(frame(spark, []), ["doc_id"]).count() == 0


# --------------------------------------------------------------- phrases ---
def plain_counts(rows, most=4):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, most + 1):
                f.update((lang or "und", *w[i:i + size]) for i in range(len(w) - size + 1))
    return f, n


def plain_collocations(rows, least, best, most=4):
    f, n = plain_counts(rows, most)
    f = {k: a for k, a in f.items() if a >= least}
    out = []
    for (lang, *w), a in f.items():
        if len(w) < 2 or any(len(v) > len(w) and v[0] == lang and 100 * b >= 80 * a and any(
                list(v[i:i + len(w)]) == w for i in range(1, len(v) - len(w) + 1)) for v, b in f.items() if len(v) > len(w) + 1):
            continue
        cuts = [(int(Fraction(2_000_000 * a, f[lang, *w[:k]] + f[lang, *w[k:]])), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    result, rank = [], collections.Counter()
    for lang, score, a, phrase, l, r in sorted(out):  # noqa: E741
        rank[lang] += 1
        if rank[lang] <= best:
            result.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return result


def phrase_rows():
    rnd = random.Random(4)
    vocabulary = ["of", "the", "New", "York", "é", "zoo\x00", "\xa0x", "a\x1f"]
    rows = [("".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\t ", ".", "\n", "\x0b"]) for _ in range(rnd.randint(0, 40))),
             rnd.choice(["en", "de", None, "und"])) for _ in range(60)]
    return rows + [("red green blue sky " * 30, "en"), ("red green blue sky " * 30, "en"), (None, "en"), ("", "fr"), (" \t.,", "fr"),
                   ("one two " * 20_000, "xx")]


def test_collocations_equal_plain_counts(spark):
    rows = phrase_rows()
    docs = frame(spark, [(1, t, lang) for t, lang in rows])
    for least, best in ((3, 2000), (8, 5)):
        got = [tuple(r) for r in phrases.collocations(docs, least=least, best=best).collect()]
        assert sorted(got) == sorted(plain_collocations(rows, least, best))
    assert phrases.collocations(docs, least=10 ** 6).count() == 0
    assert phrases.collocations(frame(spark, []), least=1).count() == 0


def test_spilled_runs_add_up_and_are_sorted(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 3)
    monkeypatch.setattr(phrases, "RUN_ROWS", 7)
    rows = [(t, "en") for t, _ in phrase_rows()]
    want, _ = plain_counts(rows)
    every = np.full(phrases.FILTER_BITS // 8, 255, np.uint8)
    for sizes, keep in ((range(1, 2), -1), (range(2, 3), 4), (range(3, 5), 4)):
        counter, total = phrases.LanguageCounts("en", sizes, every), collections.Counter()
        for i in range(0, len(rows), 6):
            counter.count([(t or "").encode() for t, _ in rows[i:i + 6]], phrases._bytes_table())
            for prefix, rest, n in counter.spill(keep if i + 6 < len(rows) else -1):
                run = [" ".join(x for x in p if x) for p in zip(prefix.to_pylist(), rest.to_pylist())]
                assert [p.encode().split(b" ") for p in run] == sorted(p.encode().split(b" ") for p in run)
                total.update(dict(zip(run, n.to_pylist())))
        assert not counter.held()
        assert total == {" ".join(k[1:]): n for k, n in want.items() if len(k) - 1 in sizes}


def test_scores_are_exact_beyond_64_bits(spark):
    a, both = 9_000_000_000_000_000_000, 9_223_372_036_854_775_807 * 2
    got = spark.range(1).select(phrases.exact_score(F.lit(a), F.lit(str(both)).cast("decimal(20,0)")).alias("s")).first()["s"]
    assert got == 2_000_000 * a // both
