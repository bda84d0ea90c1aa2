r"""URL filters (operator 7): rules, else host words and naive Bayes.

Rules (verdict, host, path) fit their host and all its subdomains where the
url's path starts with the rule's; the longest decides.  All other urls go to the
method: a unigram model of words, counted over all pages' text and urls, splits
the labels of a host into words by Viterbi, and a multinomial naive Bayes model
over host words and path words gives the odds of a blocked page.  It is trained
on all pages: those whose host has a seed word (after splitting) count as blocked.

Scale: hosts and normalised paths are made distinct before they are scored, word
counts meet hosts through a join on the hosts' substrings (63 bytes a label at
most matter for names, any length works), and pages take both scores by joins
that Spark can split on hot hosts.  Rules and seeds are parameters.

Defined results: a null url or one without ``://`` has empty host and path; no
host and path words leave the prior; repeated rows are judged alike; a null
page_id is carried; an empty table gives an empty result; columns besides
page_id, url and html are ignored (html null: no words).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

# Words that mark a host as unwanted (weak labels for training).
SEEDS = ("adult", "ads", "bet", "bets", "bingo", "casino", "gamble", "loan", "loans", "pill", "pills", "poker", "porn",
         "sex", "spam", "track", "warez", "xxx")
NUMBER = "<num>"
LONGEST_WORD = 63  # of a label by the rules of host names: no longer word can be a part of one


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) by the longest rule that fits; nulls if none."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer one is asked before
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def word_counts(pages: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """word, n over the pages' text (html without tags), paths and the parts of
    hyphenated host names; letters only.  Whole host names don't count: they are what
    is to be split.  Seeds are words of one occurrence at least."""
    parts = F.regexp_extract_all(host_of(F.col("url")), F.lit(r"\p{L}+(?=-)|(?<=-)\p{L}+"), F.lit(0))
    text = F.concat_ws(" ", F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "), path_of(F.col("url")), F.array_join(parts, " "))
    words = pages.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(2, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    least = pages.sparkSession.createDataFrame([(s, 1) for s in seeds], "word string, n long")
    return words.unionByName(least).groupBy("word").agg(F.max("n").alias("n"))


def segment(label: str, known: dict[str, int], total: int) -> list[str]:
    """Viterbi under unigram probabilities; unknown stretches cost more with length."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            word = label[start:end]
            n = known.get(word)
            p = math.log(n / total) if n else math.log(0.1 / total) - 2.3 * len(word)
            options.append((best[start][0] + p, start))
        best.append(max(options))
    words, end = [], len(label)
    while end:
        words.append(label[best[end][1]:end])
        end = best[end][1]
    return words[::-1]


def split_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """host, words (array): every label of the distinct ``hosts`` split into words."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    labels = hosts.select("host", F.posexplode(F.split("host", r"[^\p{L}\p{Nd}]+")).alias("place", "label")).where("label <> ''")
    distinct = labels.select("label").distinct()
    starts = distinct.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start"))
    parts = starts.select("label", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("start") + 1))).alias("size"), "start")
    parts = parts.select("label", F.substr("label", "start", "size").alias("word")).distinct().join(counts, "word")
    known = distinct.join(parts.groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known")), "label", "left")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            names = b.column("label").to_pylist()
            words = [segment(x, {k["word"]: k["n"] for k in ks or ()}, total) for x, ks in zip(names, b.column("known").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))],
                                             names=["label", "words"])

    cut = known.mapInArrow(run, "label string, words array<string>")
    sized = labels.join(cut, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("parts"))
    return hosts.join(sized, "host", "left").select(
        "host", F.coalesce(F.flatten(F.col("parts.words")), F.array().cast("array<string>")).alias("words"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict, odds (log odds of a blocked page)."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    shape = F.array_remove(F.split(F.regexp_replace(F.lower("path"), r"\p{Nd}+", " " + NUMBER + " "), r"[^\p{L}<>]+"), "")
    urls = urls.withColumn("shape", F.array_join(shape, " "))
    pairs = stored(urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("pages")), "url-pairs")
    hosts = pairs.groupBy("host").agg(F.sum("pages").alias("pages"))
    hosts = stored(split_hosts(hosts.select("host"), stored(word_counts(pages, seeds), "url-words")).join(hosts, "host"), "url-hosts")
    bad = F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds])).alias("bad")
    labelled = hosts.select("host", "words", "pages", bad)
    path_words = pairs.join(labelled.select("host", "bad"), "host").select(
        "bad", "pages", F.explode(F.split("shape", " ")).alias("word")).where("word <> ''")
    tokens = labelled.select("bad", "pages", F.explode("words").alias("word")).select(
        "bad", "pages", F.concat(F.lit("h:"), "word").alias("word")).unionByName(
        path_words.select("bad", "pages", F.concat(F.lit("p:"), "word").alias("word")))
    per_word = stored(tokens.groupBy("word").agg(F.sum(F.when(F.col("bad"), F.col("pages")).otherwise(0)).alias("blocked"),
                                                 F.sum(F.when(F.col("bad"), 0).otherwise(F.col("pages"))).alias("allowed")), "url-nb")
    sums = per_word.agg(F.count(F.lit(1)), F.sum("blocked"), F.sum("allowed")).first()
    prior = labelled.agg(F.sum(F.when(F.col("bad"), F.col("pages")).otherwise(0)), F.sum("pages")).first()
    kinds, blocked, allowed = sums[0], sums[1] or 0, sums[2] or 0
    start = math.log(((prior[0] or 0) + 1) / ((prior[1] or 0) - (prior[0] or 0) + 1))
    odds = (F.log((F.col("blocked") + 1) / F.lit(float(blocked + kinds + 1)))
            - F.log((F.col("allowed") + 1) / F.lit(float(allowed + kinds + 1))))
    weights = per_word.select("word", odds.alias("odds"))

    def scores(df: DataFrame, key: str, words: Column, prefix: str) -> DataFrame:
        each = df.select(key, F.explode(words).alias("w")).select(key, F.concat(F.lit(prefix), "w").alias("word"))
        return each.join(weights, "word").groupBy(key).agg(F.sum("odds").alias(f"{key}_odds"))

    by_host = stored(scores(labelled, "host", F.col("words"), "h:"), "url-host-odds")
    by_shape = stored(scores(pairs.select("shape").distinct(), "shape", F.split("shape", " "), "p:"), "url-path-odds")
    out = urls.join(by_host, "host", "left").join(by_shape, "shape", "left")
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    total = F.lit(start) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("shape_odds", F.lit(0.0))
    out = out.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), total.alias("odds"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("odds") > 0, "block").otherwise("allow"))
                      .alias("verdict"), "odds")
