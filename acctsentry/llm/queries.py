"""The registered queries of the training-data operators and their DuckDB SQL.

Each query reads its whole table, applies its operator with production
parameters, and derives the digest columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry.llm.common import table
from acctsentry.llm.decontamination import decontaminate
from acctsentry.llm.line_dedup import drop_shared_lines
from acctsentry.llm.mixing import mix_sources
from acctsentry.llm.near_dedup import near_duplicates
from acctsentry.llm.prefix_trie import prefix_trie, rebuilt
from acctsentry.llm.quality import quality_rules
from acctsentry.llm.secret_scan import BASE_RULES, RULES, find_secrets, span_list
from acctsentry.llm.sentence_pieces import decode, encode
from acctsentry.llm.sharding import shard_by_size
from acctsentry.llm.token_counts import count_tokens
from acctsentry.llm.toxicity import score_texts, train
from acctsentry.llm.warc import archive_pages
from acctsentry.llm.whitening import fit_whitening, identity_error, whiten


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    seen = F.translate(F.coalesce("text", F.lit("")), "\u2581", " ")
    return both.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.sha2(F.array_join("pieces", ","), 256).alias("pieces_sha256"),
        (F.col("decoded") == seen).alias("round_trip"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (
  SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
         max(page_id) OVER (PARTITION BY h) AS owner FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 1000 OR page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 1000 OR page_id = owner THEN NULL ELSE owner END AS refers_to
FROM q
"""


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    def number(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE_RULES))
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("secrets")).alias("spans"))


def _op3_rule_sql(i: int) -> str:
    pattern = RULES[i].pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {i} AS kind, unnest(regexp_extract_all(t, '{pattern}', 0)) AS m,
         unnest(regexp_extract_all(t, '{pattern}', {RULES[i].group})) AS g,
         unnest(string_split_regex(t, '{pattern}')[1:-2]) AS gap,
         unnest(range(0, len(regexp_extract_all(t, '{pattern}', 0)))) AS i FROM t"""


_KINDS = ", ".join(f"'{r.kind}'" for r in RULES)
_LEAST = ", ".join(str(r.least) for r in RULES)
OP3_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL".join(_op3_rule_sql(i) for i in range(len(RULES)))}),
s AS (
  SELECT doc_id, kind, length(g) AS n, length(m) AS len,
         sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM m),
k AS (
  SELECT doc_id, kind, e - len AS b, [{_KINDS}][kind + 1] || ':' || CAST(e - len AS BIGINT) || ':' || CAST(e AS BIGINT) AS span
  FROM s WHERE n >= [{_LEAST}][kind + 1])
SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY b, kind) FILTER (WHERE kind < {len(BASE_RULES)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY b, kind), '') AS spans
FROM t LEFT JOIN k ON k.doc_id = t.doc_id GROUP BY t.doc_id
"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
iw AS (
  SELECT DISTINCT id AS item_id, least(len(ws), 10) AS k, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS win
  FROM w, range(1, len(ws) - least(len(ws), 10) + 2) r(i) WHERE side = 'i' AND len(ws) > 0),
dw AS (
  SELECT id AS doc_id, i, k, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM w, (SELECT DISTINCT k FROM iw) kk, range(1, len(ws) - k + 2) r(i) WHERE side = 'd' AND len(ws) >= k),
hit AS (SELECT doc_id, i, k, item_id FROM dw JOIN iw USING (k, win)),
pos AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, range(0, k) r(j) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos ON pos.doc_id = w.id LEFT JOIN its ON its.doc_id = w.id WHERE side = 'd'
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
s AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS lost
  FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = train(docs, labels.where(~held_out))
    return score_texts(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    return shard_by_size(docs, F.col("text_hash")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle=4).select("doc_id", "n_shingles", "component_id", "kept")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), lead=rebuilt()).drop("words")


#: Turns become numbers first, so that prefixes are short lists.
OP12_SQL = r"""
WITH d AS (
  SELECT r, t, row_number() OVER (ORDER BY r, t) AS id, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT DISTINCT coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)),
o AS (
  SELECT conv_id AS c, list(d.id ORDER BY turn NULLS FIRST) AS seq
  FROM conversations x JOIN d ON d.r = coalesce(x.role, '') AND d.t = coalesce(x.text, '')
  WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (  -- CRC-32 of the digits, bit by bit
  SELECT c, seq, c - c % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
             lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END),
             4294967295) % 4 AS h
  FROM o),
s AS (
  SELECT h.c, list_concat(coalesce(b.seq[1 : h.h], []), h.seq[h.h + 1 :]) AS seq
  FROM h LEFT JOIN o b ON b.c = h.base),
p AS (SELECT c, len(seq) AS l, i AS depth, seq[1 : i] AS pre FROM s, range(0, len(seq) + 1) r(i)),
n AS (
  SELECT pre, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE l = depth) AS ends
  FROM p GROUP BY pre),
k AS (
  SELECT n.*, n.pre[1 : n.depth - 1] AS up, coalesce(q.kids, 0) AS kids,
         (n.n_convs - 1) * coalesce(d.w, 0) AS saves
  FROM n LEFT JOIN (SELECT pre[1 : depth - 1] AS pre, count(*) AS kids FROM n WHERE depth > 0 GROUP BY 1) q ON q.pre = n.pre
  LEFT JOIN d ON d.id = n.pre[n.depth]),
t AS (
  SELECT pre[1 : i] AS pre, sum(saves) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
  FROM k, range(0, depth + 1) r(i) GROUP BY 1)
SELECT k.conv_id, k.depth, CASE WHEN k.depth > 0 THEN u.conv_id END AS parent_conv_id, k.n_convs, k.kids AS n_children,
       t.leaves AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(k.ends, '')) AS ends_sha256
FROM k JOIN t ON t.pre = k.pre LEFT JOIN k u ON u.pre = k.up AND k.depth > 0
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    error = identity_error(vectors, model) if model else None
    return whiten(vectors, model).withColumn("identity_error", F.lit(error).cast("double"))


QUERIES = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_warc": op2_warc,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_near_dedup": op10_near_dedup,
    "op11_mixing": op11_mixing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op2_warc": OP2_SQL,
    "op3_secret_scan": OP3_SQL,
    "op5_decontamination": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op12_prefix_trie": OP12_SQL,
}
