"""One query per operator of this subpackage, with SQL oracles where SQL can
express the operator.  Every query reads its whole table."""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import pii
from .bpe import bpe_encode
from .conversation_repair import damaged, repair_conversations
from .exact_dedup import exact_dedup
from .html_extract import extract_main_text, train_extractor
from .line_dedup import passage_dedup
from .ngram_join import ngram_jaccard_join
from .packing import pack_documents
from .prefix_trie import grafted, prefix_trie
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .secrets import RULES, scan_secrets, spans_text
from .warc import build_derivatives, page_responses


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup(table(spark, d, "documents"))


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = passage_dedup(table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks",
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    out = pack_documents(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset")


def op4_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_bpe(spark: SparkSession, d: str) -> DataFrame:
    out = bpe_encode(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = scan_secrets(table(spark, d, "documents"))
    base = [r.kind for r in RULES if r.base]

    def count(kind):
        return F.size(F.filter("spans", lambda e: e["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in base],
                        F.sha2(spans_text(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


def op7_warc(spark: SparkSession, d: str) -> DataFrame:
    out = build_derivatives(page_responses(table(spark, d, "pages")), keep=("page_id",))
    return out.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "payload_digest",
                      "block_digest", "n_bytes", F.sha2("record", 256).alias("record_sha256"))


def op8_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, d, "documents"))


def op9_html_extract(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return extract_main_text(pages, train_extractor(pages))


def op10_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_classifier(table(spark, d, "documents"))


def op11_pii(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    found = pii.find_personal_data(docs, pii.train_tagger(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.KINDS],
                        F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


def op12_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, d, "conversations")))


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie(grafted(table(spark, d, "conversations"))).drop("node", "parent")


QUERIES: Dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_bpe": op5_bpe,
    "op6_secret_scan": op6_secret_scan,
    "op7_warc": op7_warc,
    "op8_ngram_join": op8_ngram_join,
    "op9_html_extract": op9_html_extract,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_pii": op11_pii,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: Dict[str, str] = {}

ORACLES["op1_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""

ORACLES["op4_quality_rules"] = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (
  SELECT doc_id, sum(least(3, i - coalesce(p, i - 3))) AS n
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, source, len(ws) AS n_words,
         len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         (SELECT count(l) - count(DISTINCT l) FROM (SELECT unnest(string_split(t, chr(10))) AS l)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]')) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m),
h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM b WHERE source IS NOT NULL GROUP BY source),
p AS (
  SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS sq FROM h),
q AS (
  SELECT mean, greatest(mean * (1 - mean) / greatest(sq - mean * mean, 1e-6) - 1, 1) AS weight FROM p),
r AS (
  SELECT source, (f + mean * weight) / (n + weight) > 0.5 AS rejected FROM h, q)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM b LEFT JOIN r ON b.source = r.source
"""

ORACLES["op6_secret_scan"] = r"""
WITH rule(kind, rank, re, grp, least_len, base) AS (VALUES
  ('assign', 0, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12, true),
  ('access', 1, 'AKIA[A-Z0-9]+', 0, 18, true),
  ('hex', 2, '[0-9a-f]+', 0, 16, true),
  ('pem', 3, '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----', 0, 1, false),
  ('hub', 4, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 40, false)),
m AS (
  SELECT doc_id, kind, rank, least_len, base,
         CASE rank WHEN 0 THEN regexp_extract_all(coalesce(text, ''), '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
           WHEN 1 THEN regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+', 0)
           WHEN 2 THEN regexp_extract_all(coalesce(text, ''), '[0-9a-f]+', 0)
           WHEN 3 THEN regexp_extract_all(coalesce(text, ''), '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----', 0)
           ELSE regexp_extract_all(coalesce(text, ''), 'gh[pousr]_[A-Za-z0-9]{36,}', 0) END AS hits,
         CASE WHEN rank = 0 THEN regexp_extract_all(coalesce(text, ''), '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) END AS vals,
         CASE rank WHEN 0 THEN string_split_regex(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+')
           WHEN 1 THEN string_split_regex(coalesce(text, ''), 'AKIA[A-Z0-9]+')
           WHEN 2 THEN string_split_regex(coalesce(text, ''), '[0-9a-f]+')
           WHEN 3 THEN string_split_regex(coalesce(text, ''), '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----')
           ELSE string_split_regex(coalesce(text, ''), 'gh[pousr]_[A-Za-z0-9]{36,}') END AS gaps
  FROM documents, rule),
e AS (
  SELECT doc_id, kind, rank, least_len, base, i, len(hits[i]) AS n, len(gaps[i]) AS gap,
         CASE WHEN rank = 0 THEN len(vals[i]) ELSE len(hits[i]) END AS val
  FROM (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM m)),
s AS (
  SELECT *, sum(n + gap) OVER (PARTITION BY doc_id, rank ORDER BY i) AS fin FROM e),
f AS (
  SELECT doc_id, kind, rank, base, fin - n AS beg, kind || ':' || (fin - n)::VARCHAR || ':' || fin::VARCHAR AS span
  FROM s WHERE val >= least_len),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(span, ',' ORDER BY beg, rank) FILTER (base), '') AS base_spans,
         string_agg(span, ',' ORDER BY beg, rank) AS spans
  FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""

#: Unsigned CRC-32 of an ASCII string, bit by bit: eight steps for every byte.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, b:
  xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT)"""

#: The repair as a search over the four states of the role language (0 start, 1 after s, 2 after u, 3 after a): each
#: step of the recursion takes one row of every conversation and keeps the least (cost, audit) per state.
ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fate
  FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, generate_series(1, 2) AS g(copy) WHERE fate <> 0 AND (copy = 1 OR fate = 3)),
rws AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
flt AS (
  SELECT *, left(role, 1) AS ini,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault
  FROM rws),
ins(p, q, n, lines) AS (VALUES (0, 0, 0, []), (0, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']),
  (1, 1, 0, []), (1, 2, 1, ['user:']), (1, 3, 2, ['user:', 'assistant:']),
  (2, 2, 0, []), (2, 3, 1, ['assistant:']), (3, 3, 0, []), (3, 2, 1, ['user:'])),
step(p, sym, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
edit(q, letter, sym, r) AS (
  SELECT p, 'D', '', p FROM (VALUES (0), (1), (2), (3)) AS v(p) UNION ALL
  SELECT p, 'K', sym, q FROM step UNION ALL SELECT p, 'R', sym, q FROM step WHERE sym <> 's'),
path AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM raw
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT t.conv_id, f.i, e.r AS state,
           t.cost + 3 * s.n + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END AS cost,
           t.audit || repeat('I', s.n) || letter AS audit,
           t.lines || s.lines || CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text]
             ELSE [CASE e.sym WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text] END AS lines
    FROM path t JOIN flt f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i + 1
    JOIN ins s ON s.p = t.state JOIN edit e ON e.q = s.q
    WHERE letter = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (letter = 'R' OR e.sym = f.ini)))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
fin AS (
  SELECT conv_id, cost + 3 * n AS cost, audit || repeat('I', n) AS audit, t.lines || s.lines AS lines
  FROM (SELECT * FROM path QUALIFY i = max(i) OVER (PARTITION BY conv_id)) t JOIN ins s ON s.p = t.state
  WHERE (s.q = 3 OR (t.state = 0 AND s.q = 0))
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost + 3 * n, audit || repeat('I', n)) = 1),
cnt AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM flt) GROUP BY conv_id)
SELECT fin.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM fin LEFT JOIN cnt ON fin.conv_id IS NOT DISTINCT FROM cnt.conv_id
"""

ORACLES["op13_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS leader, {_CRC32.format("(conv_id::VARCHAR)")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.leader AND p < h UNION ALL
  SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p >= h),
seq AS (
  SELECT conv_id, row_number() OVER w AS depth, len(text) AS tokens,
         sha256(string_agg(len(role) || ':' || role || len(text) || ':' || text, '') OVER w) AS name
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
pre AS (
  SELECT conv_id, 0 AS depth, 0 AS tokens, '' AS name FROM c UNION ALL SELECT conv_id, depth, tokens, name FROM seq),
step AS (
  SELECT *, lag(name) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM pre),
node AS (
  SELECT name, any_value(parent) AS parent, any_value(depth) AS depth, any_value(tokens) AS tokens,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM step GROUP BY name),
kids AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, up.conv_id AS parent_conv_id
  FROM node n LEFT JOIN (SELECT parent, count(*) AS n FROM node GROUP BY parent) k ON k.parent = n.name
  LEFT JOIN node up ON up.name = n.parent),
sums AS (
  SELECT a.name, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * v.tokens)::BIGINT AS saved_tokens
  FROM kids v JOIN pre a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.name)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM kids JOIN sums USING (name)
"""
