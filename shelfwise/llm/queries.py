"""The registered queries opN_<name> and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    bpe, convtrie, linededup, lmscore, mixing, negatives, ngramjoin, polytope, pseudonyms, sharding, topk, toxicity,
    urlfilter,
)
from shelfwise.llm.common import crc_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ 1: byte-level BPE
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, vocab, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(ids, vocab).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# ------------------------------------------------------------------ 2: exact top-k
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, x.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


# ------------------------------------------------------------------ 3: personal data
def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, pseudonyms.DEMO_KEY).select(
        "doc_id", F.size("spans").cast("long").alias("n_found"), "text", "spans")


# ------------------------------------------------------------------ 4: toxicity
def op4_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_fold(F.col("doc_id"))
    scored = toxicity.score(docs, _table(spark, sf_dir, "labels"), fold != 0)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


# ------------------------------------------------------------------ 5: language-model scores
def op5_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id")) == 1
    scores = lmscore.score(docs, ~held_out)
    return scores.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


# ------------------------------------------------------------------ 6: mixing sources
def op6_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.plan(docs).select(
        F.col("id").alias("doc_id"), "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("size") * F.col("copies")).alias("taken"))


# ------------------------------------------------------------------ 7: embedding near-duplicates
def op7_polytope_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.link(_table(spark, sf_dir, "embeddings"))


#: Components of ``pairs`` (a, b), both ways: the least id that each id reaches.
_REACH = """reach(a, b) AS (
  SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b)"""

OP7_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_sum(list_transform(list_zip(x.e, y.e), lambda p: p[1] * p[2])) / (x.norm * y.norm) >= 0.93),
{_REACH},
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links ON links.a = vec_id LEFT JOIN roots ON roots.a = vec_id"""


# ------------------------------------------------------------------ 8: line dedup
def op8_bloom_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def line_dedup_sql(table: str) -> str:
    """CTEs that end in ``kept``: (doc_id, n_lines, n_dropped, text) of the documents of ``table``."""
    space = " || ".join(f"chr({c})" for c in (0x20, *range(0x09, 0x0E)))
    return f"""lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth
  FROM {table}),
keyed AS (
  SELECT *, translate(trim(line, {space}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
losing AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (keeper IS NULL OR doc_id = keeper), '') AS text
  FROM keyed LEFT JOIN losing USING (key) GROUP BY doc_id)"""


OP8_SQL = f"""
WITH {line_dedup_sql('documents')}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept"""


# ------------------------------------------------------------------ 9: URL filters
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(rule_host, rule_path, verdict) AS (VALUES """ + ", ".join(map(repr, URL_RULES)) + """),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)"""


# ------------------------------------------------------------------ 10: n-gram Jaccard join
def op10_ngram_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.classes(_table(spark, sf_dir, "documents"), size=3, similarity=(9, 10))


OP10_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[k:k + 2] END AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
pairs AS (
  SELECT a, b FROM shared JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * shared.n >= 90 * (sa.n + sb.n - shared.n)),
{_REACH},
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(roots.root, w.doc_id) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON roots.a = w.doc_id"""


# ------------------------------------------------------------------ 11: hard negatives
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
    CAST(list_sum(list_transform(list_zip(a.e, x.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND x.vec_id <> a.vec_id AND len(a.e) = len(x.e)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY rank <= 5"""


# ------------------------------------------------------------------ 12: sharding
def op12_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))


def _crc32_steps() -> list[int]:
    """What four shifts of the CRC-32 register (reversed polynomial EDB88320) add for each low half byte."""
    steps = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        steps.append(c)
    return steps


def crc32_sql(blob: str) -> str:
    """Unsigned CRC-32 of a blob, half byte by half byte."""
    halves = f"string_split(regexp_replace(hex({blob}), '(.)(.)', '\\2\\1', 'g'), '')"
    numbers = (f"list_transform(list_filter({halves}, lambda x: x <> ''), "
               "lambda x: CAST(strpos('0123456789ABCDEF', x) - 1 AS BIGINT))")
    return (f"xor(4294967295, list_reduce({numbers}, "
            f"lambda c, x: xor({_crc32_steps()}[CAST(xor(c, x) & 15 AS INTEGER) + 1], c >> 4), 4294967295))")


OP12_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT md5(text) AS key, count(*) AS n, sum(strlen(text) + 1) AS bytes FROM d GROUP BY 1),
ends AS (
  SELECT key, n, CAST(sum(bytes) OVER (ORDER BY key) AS BIGINT) AS e, CAST(sum(n) OVER (ORDER BY key) AS BIGINT) AS upto FROM g),
line AS (SELECT e, upto FROM ends UNION ALL SELECT 0, 0),
whole AS (SELECT CAST(sum(bytes) AS BIGINT) AS total, CAST(max(bytes) AS BIGINT) AS largest FROM g),
search(low, high, k, pos) AS (
  SELECT greatest(largest, (total + 15) // 16) - 1, total, 0, CAST(0 AS BIGINT) FROM whole
  UNION ALL
  SELECT if(k = 16 AND pos < total, (low + high) // 2, low), if(pos = total, (low + high) // 2, high),
    if(k = 16 OR pos = total, 0, k + 1),
    if(k = 16 OR pos = total, 0, (SELECT max(e) FROM line WHERE e <= pos + (low + high) // 2))
  FROM search, whole WHERE high - low > 1),
best AS (SELECT min(high) AS capacity FROM search),
earliest(k, e) AS (
  SELECT 15, total FROM whole
  UNION ALL
  SELECT k - 1, (SELECT min(l.e) FROM line l WHERE l.e >= greatest(0, x.e - capacity))
  FROM earliest x, best WHERE k > 0),
cuts(k, cut) AS (
  SELECT -1, CAST(0 AS BIGINT)
  UNION ALL
  SELECT k, least(greatest(if(b <= prev OR a - share < share - b, a, b), first_end), latest)
  FROM (
    SELECT c.k + 1 AS k, c.cut AS prev, x.e AS first_end, c.cut + (total - c.cut) // (15 - c.k) AS share,
      (SELECT max(e) FROM line WHERE e <= c.cut + (total - c.cut) // (15 - c.k)) AS b,
      (SELECT min(e) FROM line WHERE e >= c.cut + (total - c.cut) // (15 - c.k)) AS a,
      (SELECT max(e) FROM line WHERE e <= c.cut + capacity) AS latest
    FROM cuts c JOIN earliest x ON x.k = c.k + 1, whole, best WHERE c.k < 14)),
placed AS (
  SELECT key, (SELECT count(*) FROM cuts WHERE k >= 0 AND e > cut) AS shard, upto - n AS before FROM ends),
starts AS (SELECT shard, min(before) AS before FROM placed GROUP BY shard)
SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size, CAST({crc32_sql("encode(text)")} AS BIGINT) AS text_crc32,
  'bytes' AS law, CAST(p.shard AS INTEGER) AS shard,
  p.before - s.before + row_number() OVER (PARTITION BY p.key ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN placed p ON p.key = md5(text) JOIN starts s ON s.shard = p.shard"""


# ------------------------------------------------------------------ 13: conversation prefix trie
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.trie_of(_table(spark, sf_dir, "conversations"), group=5, heads=9)


OP13_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, count(*) AS own FROM t GROUP BY c),
heads AS (SELECT c, c - c % 5 AS base, {crc32_sql("encode(CAST(c AS VARCHAR))")} % 9 AS h FROM own),
lent AS (SELECT heads.*, least(h, coalesce(own, 0)) AS taken FROM heads LEFT JOIN own ON own.c = base),
turns AS (
  SELECT l.c, pos, role, text FROM lent l JOIN t ON t.c = base AND pos <= taken
  UNION ALL SELECT l.c, pos - h + taken, role, text FROM lent l JOIN t ON t.c = l.c AND pos > h),
prefixes AS (
  SELECT c, pos AS d, strlen(text) AS n,
    string_agg(strlen(role) || ':' || role || md5(text), '' ORDER BY pos) OVER (PARTITION BY c ORDER BY pos) AS key FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM own),
whole AS (SELECT c, max(d) AS length FROM prefixes GROUP BY c),
nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, max(n) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = length), '')) AS ends_sha256
  FROM prefixes JOIN whole USING (c) GROUP BY d, key),
parents AS (
  SELECT DISTINCT b.d, b.key, a.key AS above FROM prefixes a JOIN prefixes b ON a.c = b.c AND a.d = b.d - 1),
children AS (SELECT d - 1 AS d, above AS key, count(*) AS n_children FROM parents GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (d, key)),
sums AS (
  SELECT a.d, a.key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * f.n) AS saved_tokens
  FROM full_nodes f JOIN prefixes a ON a.c = f.conv_id AND a.d <= f.d GROUP BY a.d, a.key)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums USING (d, key) LEFT JOIN parents u ON u.d = f.d AND u.key = f.key
LEFT JOIN nodes p ON p.d = f.d - 1 AND p.key = u.above"""


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_topk": op2_exact_topk,
    "op3_feistel_pseudonyms": op3_feistel_pseudonyms,
    "op4_toxic_neighbours": op4_toxic_neighbours,
    "op5_backoff_lm": op5_backoff_lm,
    "op6_fair_queue_mix": op6_fair_queue_mix,
    "op7_polytope_dedup": op7_polytope_dedup,
    "op8_bloom_line_dedup": op8_bloom_line_dedup,
    "op9_url_rules": op9_url_rules,
    "op10_ngram_classes": op10_ngram_classes,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minimax_shards": op12_minimax_shards,
    "op13_conversation_trie": op13_conversation_trie,
}
ORACLES: dict[str, str] = {
    "op2_exact_topk": OP2_SQL,
    "op7_polytope_dedup": OP7_SQL,
    "op8_bloom_line_dedup": OP8_SQL,
    "op9_url_rules": OP9_SQL,
    "op10_ngram_classes": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_minimax_shards": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
