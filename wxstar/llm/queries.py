"""Registered queries of this subpackage and their SQL, by the names of ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.llm import (
    conversation_trie, language_id, merkle, mixing, packing, quality, secret_scan, simhash, substring_dedup, topk, toxicity, url_filter, winnowing,
)
from wxstar.llm.common import crc_fold, table, text_or_empty

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.contract_rules(spark))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    score = quality.score(text_or_empty(), model)
    return docs.select("doc_id", score.alias("score")).select(
        "doc_id", (crc_fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edited(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.rates(table(spark, sf_dir, "documents"), domains, mixing.TARGETS).drop("__rid")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"), every=True)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    score = toxicity.score(text_or_empty(), model)
    return docs.select("doc_id", score.alias("score")).select(
        "doc_id", (crc_fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit_on(docs))
    held_out = crc_fold(F.col("doc_id"), language_id.FOLDS) == language_id.HELD_OUT
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(conversation_trie.rebuilt(seqs, group=20, head=crc_fold(F.col("conv_id"), 4)))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"),
        F.sha2(secret_scan.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"), of("random"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(crc_fold(F.col("doc_id"), merkle.TAMPER) == 0, F.lit(False))
    start = F.when(tampered, merkle.leaf(merkle.lower_ascii(F.col("text"))))
    proven = merkle.manifest(docs, tampered=start)
    return proven.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", F.col("path.digests")).cast("binary"), 256).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_quality, op3_winnowing, op4_mixing, op5_substring_dedup, op6_packing, op7_toxicity, op8_simhash,
    op9_topk, op10_language_id, op11_conversation_trie, op12_secret_scan, op13_merkle)}

# unsigned CRC-32 of the decimal {id}, bit by bit (DuckDB has no function for it)
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(CAST({id} AS VARCHAR)) + 1),
          lambda k: CAST(ascii(substr(CAST({id} AS VARCHAR), CAST(k AS INTEGER), 1)) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
          lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

ORACLE_SQL = {
    "op11_conversation_trie": rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS first, {_CRC.format(id="conv_id")} % 4 AS h FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, 0 AS part, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.first AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS d, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER w AS key,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, k)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
size AS (SELECT conv_id, max(d) AS n FROM p GROUP BY conv_id),
node AS (
  SELECT p.d, p.key, min(p.conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
         coalesce(string_agg(CASE WHEN size.n = p.d THEN CAST(p.conv_id AS VARCHAR) END, ',' ORDER BY p.conv_id), '') AS ends
  FROM p JOIN size ON size.conv_id = p.conv_id GROUP BY p.d, p.key),
kids AS (SELECT d - 1 AS d, left(key, 64 * (d - 1)) AS key, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON kids.key = node.key),
below AS (
  SELECT left(key, 64 * up) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM v) GROUP BY 1)
SELECT v.conv_id, v.d AS depth, parent.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children,
       CAST(below.n_leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM v JOIN below ON below.key = v.key LEFT JOIN v parent ON v.d > 0 AND parent.key = left(v.key, 64 * (v.d - 1))""",
    "op13_merkle": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         coalesce({_CRC.format(id="doc_id")} % 5 = 0, false) AS tampered
  FROM documents),
l AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         CASE WHEN tampered THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE leaf END AS start
  FROM (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf FROM d)),
node(tree, h, i, dig) AS (
  SELECT tree, 0, r, leaf FROM l
  UNION ALL
  SELECT tree, h + 1, i // 16, sha256(string_agg(dig, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM node) WHERE n > 1 GROUP BY tree, h, i // 16),
sub AS (SELECT tree, max(h) AS tops, arg_max(dig, h) AS subroot FROM node GROUP BY tree),
s AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS p FROM sub),
top(h, i, dig) AS (
  SELECT 0, p, subroot FROM s
  UNION ALL
  SELECT h + 1, i // 16, sha256(string_agg(dig, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY h, i // 16),
root AS (SELECT max(h) AS tops, arg_max(dig, h) AS root FROM top),
others AS (
  SELECT l.tree, l.r, 0 AS stage, n.h, n.i, n.dig FROM l JOIN node n ON n.tree = l.tree
    AND n.i // 16 = l.r // CAST(pow(16, n.h + 1) AS BIGINT) AND n.i <> l.r // CAST(pow(16, n.h) AS BIGINT)
  UNION ALL
  SELECT l.tree, l.r, 1, t.h, t.i, t.dig FROM l JOIN s ON s.tree = l.tree JOIN top t
    ON t.i // 16 = s.p // CAST(pow(16, t.h + 1) AS BIGINT) AND t.i <> s.p // CAST(pow(16, t.h) AS BIGINT)),
proof AS (SELECT tree, r, sha256(string_agg(dig, '' ORDER BY stage, h, i)) AS proof FROM others GROUP BY tree, r),
up(tree, r, h, k, dig) AS (
  SELECT tree, r, 0, r, start FROM l
  UNION ALL
  SELECT up.tree, up.r, up.h + 1, up.k // 16,
         sha256(string_agg(CASE WHEN n.i = up.k THEN up.dig ELSE n.dig END, '' ORDER BY n.i))
  FROM up JOIN s ON s.tree = up.tree JOIN node n ON n.tree = up.tree AND n.h = up.h AND n.i // 16 = up.k // 16
  WHERE up.h < s.tops GROUP BY up.tree, up.r, up.h, up.k),
up2(tree, r, h, k, dig) AS (
  SELECT up.tree, up.r, 0, s.p, up.dig FROM up JOIN s ON s.tree = up.tree AND up.h = s.tops
  UNION ALL
  SELECT u.tree, u.r, u.h + 1, u.k // 16,
         sha256(string_agg(CASE WHEN t.i = u.k THEN u.dig ELSE t.dig END, '' ORDER BY t.i))
  FROM up2 u JOIN root ON u.h < root.tops JOIN top t ON t.h = u.h AND t.i // 16 = u.k // 16
  GROUP BY u.tree, u.r, u.h, u.k)
SELECT l.doc_id, l.leaf, s.subroot, root.root, coalesce(proof.proof, sha256('')) AS proof_sha256,
       f.dig AS folded_root, f.dig = root.root AS verified
FROM l JOIN s ON s.tree = l.tree CROSS JOIN root JOIN up2 f ON f.tree = l.tree AND f.r = l.r AND f.h = root.tops
LEFT JOIN proof ON proof.tree = l.tree AND proof.r = l.r""",
    "op1_url_filter": r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS t(rule_host, rule_path, action)),
hit AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(action, length(rule_host || rule_path)) AS action
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT u.page_id, u.host, u.path, hit.rule, coalesce(hit.action, 'allow') AS verdict
FROM u LEFT JOIN hit ON u.page_id = hit.page_id""",
    "op9_topk": """
WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64),
d AS (
  SELECT q.vec_id AS query_id, a.vec_id AS neighbor_id,
         CAST(list_sum(list_transform(list_zip(q.bits, a.bits), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
  FROM c q JOIN c a ON q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d)
WHERE rank <= 10""",
}
