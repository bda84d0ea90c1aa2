"""Queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, decontam, dedup_exact, langid, licenses, mixing, near, phrases, quality, runs, shards, tokens, urls
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed values of the contracts.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SHARDS = 40
VOCABULARY = os.environ.get("TIDEMARK_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev,
    length(regexp_replace(text, '([<\[])(\\*)(/?s>|\||/?INST\])', '\1\\\2\3', 'g')) AS text_chars,
    length(regexp_replace(regexp_replace(role, '([<\[])(\\*)(/?s>|\||/?INST\])', '\1\\\2\3', 'g'), '(\|)(\\*)(>)', '\1\\\2\3', 'g')) AS role_chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(text_chars + CASE WHEN prev = role THEN 8 ELSE role_chars + 10 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@register("op1_chat_format", OP1_SQL)
def op1(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix-1|' || CAST(doc_id AS VARCHAR)) AS place FROM documents),
s AS (SELECT source, sum(size) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(r - 1) % 3 + 1] AS w, s * 3 AS cap, CAST(s * 3 AS DOUBLE) / [5, 2, 1][(r - 1) % 3 + 1] AS fill FROM s),
p AS (SELECT *, row_number() OVER (ORDER BY fill, r) AS place,
    (CAST(sum(s) OVER () AS DOUBLE) - CAST(coalesce(sum(cap) OVER b, 0) AS DOUBLE)) / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS level
  FROM w WINDOW b AS (ORDER BY fill, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
st AS (SELECT min(place) AS sp, arg_min(level, place) AS level FROM p WHERE level <= fill),
t AS (SELECT p.source, p.s, CASE WHEN p.place < st.sp THEN CAST(cap AS DOUBLE) ELSE w * st.level END AS target FROM p, st),
q AS (SELECT doc_id, size, t.s, target, CAST(floor(target + 0.5) AS BIGINT) AS quota,
    sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, CAST(
  greatest(0, least(size, quota - before)) + greatest(0, least(size, quota - s - before)) + greatest(0, least(size, quota - 2 * s - before))
  AS BIGINT) AS taken FROM q"""


@register("op2_mix_sources", OP2_SQL)
def op2(spark, sf):
    out = mixing.served(table(spark, sf, "documents").select("doc_id", "source", "text"), ["doc_id"])
    return out.select("doc.doc_id", "size", "source_size", "target", "taken")


@register("op3_language_id")
def op3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    judged = langid.predict(docs, langid.train(docs), ["doc_id"])
    return judged.select("doc.doc_id", langid.held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")


@register("op4_quality")
def op4(spark, sf):
    return quality.judge(table(spark, sf, "documents").select("doc_id", "text", "lang"), table(spark, sf, "labels"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY chars DESC, doc_id NULLS FIRST) AS keep_id,
  row_number() OVER (PARTITION BY h ORDER BY chars DESC, doc_id NULLS FIRST) AS place, count(*) OVER (PARTITION BY h) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, h AS text_sha256 FROM k"""


@register("op5_exact_dedup", OP5_SQL)
def op5(spark, sf):
    out = dedup_exact.dedup_exact(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@register("op6_token_counts")
def op6(spark, sf):
    return tokens.count_tokens(table(spark, sf, "documents"), VOCABULARY)


@register("op7_url_filter")
def op7(spark, sf):
    out = urls.judge(table(spark, sf, "pages"), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("odds", 6).alias("odds"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS d, a AS reach FROM e UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.reach),
m AS (SELECT d, min(reach) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, w.doc_id) AS component_id,
  coalesce(m.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.d = w.doc_id"""


@register("op8_near_dedup", OP8_SQL)
def op8(spark, sf):
    return near.near_dedup(table(spark, sf, "documents").select("doc_id", "text"), width=4, percent=80)


@register("op9_sharding")
def op9(spark, sf):
    out = shards.shard(table(spark, sf, "documents").select("doc_id", "text"), SHARDS, ["doc_id"])
    return out.select("doc.doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


OP10_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{Nd}]+'), lambda x: x <> '') AS w FROM documents),
bw AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{Nd}]+'), lambda x: x <> '') AS w FROM benchmark),
b AS MATERIALIZED (SELECT row_number() OVER () AS k, item_id, w FROM (SELECT min(item_id) AS item_id, w FROM bw WHERE len(w) >= 5 GROUP BY w)),
dg AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
bg AS (SELECT k, i, len(w) AS n, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM b)),
hit AS (SELECT DISTINCT dg.r, k, n, greatest(0, least(dg.i - bg.i, len(d.w) - n)) AS start
  FROM dg JOIN bg ON dg.g = bg.g JOIN d ON d.r = dg.r),
win AS (SELECT hit.*, least(n, len(d.w)) AS m, d.w[start + 1:start + n] AS w FROM hit JOIN d USING (r)),
wg AS (SELECT r, k, start, g, count(*) AS c
  FROM (SELECT r, k, start, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, m - 3)) AS i FROM win WHERE m >= 5)) GROUP BY ALL),
ig AS (SELECT k, g, count(*) AS c FROM bg GROUP BY ALL),
com AS (SELECT r, k, start, sum(least(wg.c, ig.c)) AS common FROM wg JOIN ig USING (k, g) GROUP BY ALL),
sim AS (SELECT r, k, CAST(common AS BIGINT) AS common, (m - 4) + (n - 4) AS total FROM com JOIN win USING (r, k, start)),
leak AS (SELECT doc_id, item_id, CAST(common * 2 AS DOUBLE) / total AS similarity
  FROM sim JOIN d USING (r) JOIN b USING (k) WHERE common * 200 >= total * 80),
top AS (SELECT doc_id, similarity, item_id FROM leak
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id NULLS LAST) = 1)
SELECT documents.doc_id, similarity IS NULL AS kept, item_id, similarity FROM documents LEFT JOIN top ON documents.doc_id IS NOT DISTINCT FROM top.doc_id"""


@register("op10_decontamination", OP10_SQL)
def op10(spark, sf):
    return decontam.decontaminate(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


@register("op11_license_scan")
def op11(spark, sf):
    out = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    out = out.select("doc.doc_id", "n_words", "matches", licenses.exact_only(F.col("matches")).alias("base"))
    return out.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.word").alias("first_word"),
                      F.array_max("base.word").alias("last_word"), licenses.labels(F.col("base")).alias("base_labels"),
                      licenses.labels(F.col("matches")).alias("labels"), licenses.score(F.col("matches")).alias("score"))


OP12_SQL = r"""
WITH tab AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k) ORDER BY k) AS t
  FROM range(256) x(k)),
ids AS (SELECT DISTINCT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295), 4294967295) AS h
  FROM documents, tab WHERE doc_id IS NOT NULL),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT d.*, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d LEFT JOIN ids USING (doc_id)),
i AS (SELECT r, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM s)),
e AS (SELECT x.r, x.i, y.i - x.i AS q, x.i - row_number() OVER (PARTITION BY x.r, y.i - x.i ORDER BY x.i) AS island
  FROM i x JOIN i y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 4),
st AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM e GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM st WHERE NOT EXISTS (
  FROM st o WHERE o.r = st.r AND o.q < st.q AND o.s <= st.s AND o.s + o.l >= st.s + st.l)),
top AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY l DESC, s, q) = 1),
text AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM run GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM run),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM i ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(l AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * l // q AS BIGINT) AS exponent_milli, sha256(coalesce(text.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN text USING (r) LEFT JOIN top USING (r) LEFT JOIN kept USING (r)"""


@register("op12_periodic_runs", OP12_SQL)
def op12(spark, sf):
    out = runs.find_runs(runs.with_repeats(table(spark, sf, "documents").select("doc_id", "text")), ["doc_id"])
    top = runs.longest(F.col("runs"))
    return out.select("doc.doc_id", F.size("runs").cast("long").alias("n_runs"), runs.runs_text(F.col("runs")).alias("t"), "collapsed",
                      top.alias("top")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period", F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2("t", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP13_SQL = r"""
WITH pc AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pc),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM s, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
q AS (SELECT k.lang, k.phrase, k.m, k.a, k, x.a AS l, y.a AS r, CAST(CAST(k.a AS HUGEINT) * 2000000 // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS z FROM c)) GROUP BY ALL),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE around IS NULL OR CAST(around AS HUGEINT) * 100 < CAST(b.a AS HUGEINT) * 80)
SELECT r.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000"""


@register("op13_phrases", OP13_SQL)
def op13(spark, sf):
    return phrases.collocations(table(spark, sf, "documents").select("text", "lang"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
