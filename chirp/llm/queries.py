"""Registered queries of the operators, with production parameters, over
whole tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirp.llm import chat_format as chat
from chirp.llm.bpe import encode_decode
from chirp.llm.common import table
from chirp.llm.embedding_dedup import embedding_dedup
from chirp.llm.license_scan import license_scan
from chirp.llm.line_dedup import line_dedup
from chirp.llm.merkle import merkle_manifest
from chirp.llm.packing import pack
from chirp.llm.quality_classifier import classify, fit
from chirp.llm.quality_rules import quality_rules
from chirp.llm.sharding import shard_documents
from chirp.llm.simhash import simhash_dedup
from chirp.llm.topk_search import topk_search
from chirp.llm.whitening import whitening


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"),
                                   (-1, 1, "assistant", "</s>[INST] ok [/INST]")], rows.schema)
    out = chat.format_chats(chat.conversation_events(rows.unionByName(extra)))
    turns = chat.parse(F.col("formatted"))
    loss = F.transform("loss_spans", lambda s: chat.unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    out = out.select("conv_id", "formatted", turns.alias("turns"), F.array_join(loss, "").alias("loss"))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|<SYS>>|/SYS>>)|\|[A-Za-z_]+\|>)', '\1\\\2\3', 'g'))
    + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
        '([<\[])(\\*)(/?(?:s>|INST\]|<SYS>>|/SYS>>)|\|[A-Za-z_]+\|>)', '\1\\\2\3', 'g'))
    + length('<|im_start|>' || chr(10) || '<|im_end|>' || chr(10)) AS n
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "quality_posterior")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacity=4096, end_id=2)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), with_ids=False)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model, keep=["doc_id"])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, whole=True)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle_manifest(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
                      F.coalesce(F.size("copied_nodes"), F.lit(0)).alias("n_copied"))


# CRC-32 of the decimal id, bit by bit; then the levels of the lang trees and
# of the tree over them, up to the largest tree there is.
OP11_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, text, row_number() OVER () AS r,
    (CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END)
    || (CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END)
    || (CASE WHEN n_chars IS NULL THEN '-' ELSE length(CAST(n_chars AS VARCHAR)) || ':' || n_chars END) AS middle,
    CASE WHEN doc_id IS NULL THEN '-' ELSE length(CAST(doc_id AS VARCHAR)) || ':' || doc_id END AS first
  FROM documents
), tampered AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS new_text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, bit: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 3 = 0 AS changed
  FROM docs
), hashed AS (
  SELECT doc_id, lang, r, changed,
    sha256(first || middle || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    sha256(first || middle || CASE WHEN text IS NULL THEN '-' ELSE strlen(new_text) || ':' || new_text END) AS new_leaf
  FROM tampered
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), tree AS (
  SELECT lang, 0 AS lvl, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 7) // 8)
  FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 8
), langs AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS spot, count(*) OVER () AS n
  FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lvl, spot, subroot AS digest, n FROM langs
  UNION ALL
  SELECT lvl + 1, spot // 8, sha256(string_agg(digest, '' ORDER BY spot)), max((n + 7) // 8)
  FROM top WHERE n > 1 GROUP BY lvl, spot // 8
), step AS (
  SELECT l.r, t.lvl, CAST(l.pos // CAST(power(8, t.lvl) AS BIGINT) AS BIGINT) AS own, t.pos AS spot, t.digest
  FROM leaves l JOIN tree t ON l.lang IS NOT DISTINCT FROM t.lang AND t.n > 1
    AND t.pos // 8 = l.pos // CAST(power(8, t.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT l.r, 100 + t.lvl, CAST(g.spot // CAST(power(8, t.lvl) AS BIGINT) AS BIGINT), t.spot, t.digest
  FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang
  JOIN top t ON t.n > 1 AND t.spot // 8 = g.spot // CAST(power(8, t.lvl + 1) AS BIGINT)
), sides AS (
  SELECT r, lvl, coalesce(string_agg(digest, '' ORDER BY spot) FILTER (WHERE spot < own), '') AS lft,
    coalesce(string_agg(digest, '' ORDER BY spot) FILTER (WHERE spot > own), '') AS rgt
  FROM step GROUP BY r, lvl
), ways AS (
  SELECT r, sha256(string_agg(lft || rgt, '' ORDER BY lvl)) AS proof, list([lft, rgt] ORDER BY lvl) AS way
  FROM sides GROUP BY r
), folded AS (
  SELECT l.r, coalesce(w.way, []) AS way, 0 AS i, CASE WHEN l.changed THEN l.new_leaf ELSE l.leaf END AS digest
  FROM leaves l LEFT JOIN ways w USING (r)
  UNION ALL
  SELECT r, way, i + 1, sha256(way[i + 1][1] || digest || way[i + 1][2]) FROM folded WHERE i < len(way)
)
SELECT l.doc_id, l.leaf, g.subroot, t.digest AS root, coalesce(w.proof, sha256('')) AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified,
  CAST(CASE WHEN l.changed THEN len(f.way) ELSE 0 END AS INTEGER) AS n_copied
FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang
JOIN folded f ON f.r = l.r AND f.i = len(f.way) LEFT JOIN ways w ON w.r = l.r CROSS JOIN (SELECT digest FROM top WHERE n = 1) t
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings"), components=16)


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


OP13_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, c.r,
    CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.r <> c.r WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_license_scan": op2_license_scan,
    "op3_chat_format": op3_chat_format,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_bpe": op6_bpe,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_sharding": op8_sharding,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_line_dedup": op10_line_dedup,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_topk": op13_topk,
}

ORACLE = {"op3_chat_format": OP3_SQL, "op11_merkle": OP11_SQL, "op13_topk": OP13_SQL}
