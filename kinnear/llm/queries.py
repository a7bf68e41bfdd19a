"""The registered queries of this package: thin digests of the operators' outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from kinnear.llm.disclosure import sanitisation, span_text
from kinnear.llm.license import license_scan, with_score
from kinnear.llm.linefreq import DOC_SHARE, LEAST_DOCS, LEFT, MOST_DOCS, line_rules
from kinnear.llm.mixing import mixture
from kinnear.llm.neural import lm_scores
from kinnear.llm.passages import shared_passages
from kinnear.llm.quality import quality_scores
from kinnear.llm.resample import BUCKETS, LEAST_WORDS, PERCENT, SEED, resample
from kinnear.llm.simhash import near_duplicates
from kinnear.llm.tables import scratch_folder, table
from kinnear.llm.tokenfiles import document_index, write_token_files
from kinnear.llm.turns import damaged, repair_digests
from kinnear.llm.urlrules import url_verdicts
from kinnear.llm.winnow import contamination

TOKENIZER = "word_bpe_49k.json"
#: The rules of op13.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(spark, table(spark, sf_dir, "documents"))


def token_index(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Writes the token files of ``docs`` and reads its rows back from them.

    One row a row of ``docs``, in any order; null and empty texts, repeated
    ids and rows without one as in :func:`write_token_files`.
    """
    folder = scratch_folder(spark)
    write_token_files(docs, folder, public_tokenizers.path(TOKENIZER))
    return document_index(spark, folder)


def op4_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_score(license_scan(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        "base_labels", "labels", "score")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).drop("text_key")


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.size("removed").cast("long").alias("n_frequent_lines"))


def op8_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitisation(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", span_text().alias("spans"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "class_id", "n_links", "n_shared_words",
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x.s, x.e)), ",").alias("spans"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(damaged(table(spark, sf_dir, "conversations")))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_tokens": op3_tokens,
    "op4_license": op4_license,
    "op5_language_model": op5_language_model,
    "op6_mixture": op6_mixture,
    "op7_line_rules": op7_line_rules,
    "op8_private": op8_private,
    "op9_passages": op9_passages,
    "op10_decontaminate": op10_decontaminate,
    "op11_turns": op11_turns,
    "op12_resample": op12_resample,
    "op13_urls": op13_urls,
}

_OP10 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, l, array_to_string(w[i : i + l - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS l, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, l, array_to_string(w[i : i + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
h AS (SELECT doc_id, i, dw.l AS l, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.l = bw.l),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM h) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN s ON d.doc_id = s.doc_id
"""

_OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
g AS (SELECT doc_id, i, words[i : i + 2] AS g FROM (
        SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY 1),
lines AS (SELECT doc_id, host, text, l FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY 1),
norm AS (SELECT doc_id, host, l, trim(regexp_replace(lower(l), '[^\p{L}]+', ' ', 'g')) AS z, length(l) AS c FROM lines),
known AS (SELECT doc_id, host, c, CASE WHEN z <> '' THEN z ELSE regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') END AS z FROM norm),
often AS (SELECT a.host, a.z FROM (SELECT host, z, count(DISTINCT doc_id) AS n FROM known GROUP BY 1, 2) a
          JOIN (SELECT host, count(DISTINCT doc_id) AS n FROM d GROUP BY 1) b ON a.host = b.host
          WHERE a.n > least(greatest({least}, {share} * b.n), {most})),
left_over AS (SELECT doc_id, sum(c) AS t, sum(CASE WHEN o.z IS NULL THEN c ELSE 0 END) AS rest, count(DISTINCT o.z) AS n
              FROM known k LEFT JOIN often o ON k.host = o.host AND k.z = o.z GROUP BY 1),
base AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(again.n, 0) AS n_repeat_words
  FROM w LEFT JOIN dup ON w.doc_id = dup.doc_id LEFT JOIN again ON w.doc_id = again.doc_id)
SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(rest, 0) >= {left} * coalesce(t, 0) AS kept,
       coalesce(l.n, 0) AS n_frequent_lines
FROM base LEFT JOIN left_over l ON base.doc_id = l.doc_id
"""

_STEP = r"""CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"""
#: crc32 of the bytes in list {b}, by the rule of its table.
_CRC = r"""xor(list_reduce({b}, lambda c, b: xor(table_[xor(c % 256, b) + 1], c // 256), 4294967295), 4294967295)"""
_CRC_TABLE = f"""
crc_table AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, k: {_STEP}, i) ORDER BY i) AS table_ FROM range(256) t(i))"""

_OP11 = r"""
WITH RECURSIVE """ + _CRC_TABLE.strip() + r""",
rows_ AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda x: CAST(ascii(x) AS BIGINT)) AS bytes_ FROM conversations),
hashed AS (SELECT conv_id, turn, role, text, """ + _CRC.replace("{b}", "bytes_") + r""" % 20 AS d FROM rows_, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault
  FROM placed),
pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faults),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM pairs GROUP BY conv_id),
-- insertions: up to two, from each state
ins(s, t, c, a, r) AS (VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
  (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
moves(kind, s, t) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
emits(s, t, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
edits AS (
  SELECT conv_id, i, s, s AS t, 3 AS c, 'D' AS a, CAST([] AS VARCHAR[]) AS r FROM faults, range(4) x(s)
  UNION ALL
  SELECT conv_id, i, s, t, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END, 'K', [role || ':' || text]
  FROM faults JOIN moves ON kind = initial WHERE fault IN ('fine', 'truncated')
  UNION ALL
  SELECT conv_id, i, s, t, CASE fault WHEN 'truncated' THEN 3 ELSE 2 END, 'R', [emits.role || ':' || text]
  FROM faults, emits WHERE fault IN ('fine', 'truncated')),
steps AS (
  SELECT e.conv_id, e.i, x.s, e.t, x.c + e.c AS c, x.a || e.a AS a, list_concat(x.r, e.r) AS r FROM ins x JOIN edits e ON x.t = e.s),
walk(conv_id, i, s, c, a, r) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM counts
  UNION ALL
  SELECT w.conv_id, w.i + 1, p.t, min(w.c + p.c), arg_min(w.a || p.a, (w.c + p.c, w.a || p.a)),
         arg_min(list_concat(w.r, p.r), (w.c + p.c, w.a || p.a))
  FROM walk w JOIN steps p ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = w.i + 1 AND p.s = w.s GROUP BY 1, 2, 3),
ends AS (
  SELECT w.conv_id, w.i, w.c + x.c AS c, w.a || x.a AS a, list_concat(w.r, x.r) AS r FROM walk w JOIN ins x ON w.s = x.s WHERE x.t IN (0, 3)),
best AS (
  SELECT c.conv_id, min(e.c) AS cost, arg_min(e.a, (e.c, e.a)) AS audit, arg_min(e.r, (e.c, e.a)) AS r
  FROM counts c JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = c.n GROUP BY 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""

_OP12 = r"""
WITH """ + _CRC_TABLE.strip() + r""",
texts AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS k, text FROM documents
  UNION ALL SELECT 'b', item_id, row_number() OVER (), text FROM benchmark),
w AS (
  SELECT side, id, k, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM texts),
f AS (
  SELECT side, k, g, count(*) AS n FROM (
    SELECT side, k, unnest(words) AS g FROM w
    UNION ALL
    SELECT side, k, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM w) GROUP BY ALL),
names AS (SELECT g, hex(g) AS h FROM (SELECT DISTINCT g FROM f)),
b AS (
  SELECT g, """ + _CRC.replace("{b}", "bytes_") + r""" % {buckets} AS bucket
  FROM (SELECT g, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || h[i : i + 1] AS BIGINT)) AS bytes_ FROM names), crc_table),
counts AS (SELECT side, bucket, sum(n) AS n FROM f JOIN b ON f.g = b.g GROUP BY 1, 2),
sums AS (SELECT coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t FROM counts),
gains AS (
  SELECT x.bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(sums.s + {buckets} AS DOUBLE)
                / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST(sums.t + {buckets} AS DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM counts) x LEFT JOIN (SELECT * FROM counts WHERE side = 'd') s ON x.bucket = s.bucket
  LEFT JOIN (SELECT * FROM counts WHERE side = 'b') t ON x.bucket = t.bucket, sums),
weights AS (
  SELECT k, sum(n) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM f JOIN b ON f.g = b.g JOIN gains ON b.bucket = gains.bucket WHERE side = 'd' GROUP BY 1),
scored AS (
  SELECT w.id AS doc_id, w.k, len(words) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('{seed}:' || coalesce(CAST(w.id AS VARCHAR), '')), 1, 8)) AS BIGINT)
           + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM w LEFT JOIN weights ON w.k = weights.k WHERE side = 'd'),
ranks AS (
  SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= {least})
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT k, rank FROM ranks WHERE rank <= {percent} * n // 100) r ON scored.k = r.k
""".replace("{buckets}", str(BUCKETS)).replace("{seed}", str(SEED)).replace("{least}", str(LEAST_WORDS)).replace("{percent}", str(PERCENT))

_OP13 = r"""
WITH r(rule_host, rule_path, verdict) AS (VALUES {rules}),
u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path, row_number() OVER () AS k FROM pages),
fits AS (
  SELECT k, arg_max(rule_host || rule_path, (length(rule_host || rule_path), length(rule_host))) AS rule,
         arg_max(verdict, (length(rule_host || rule_path), length(rule_host))) AS verdict
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits ON u.k = fits.k
""".replace("{rules}", ", ".join(map(str, URL_RULES)))

ORACLE = {
    "op7_line_rules": _OP7.replace("{least}", str(LEAST_DOCS)).replace("{share}", str(DOC_SHARE)).replace("{most}", str(MOST_DOCS)).replace("{left}", str(LEFT)),
    "op10_decontaminate": _OP10,
    "op11_turns": _OP11,
    "op12_resample": _OP12,
    "op13_urls": _OP13,
}
