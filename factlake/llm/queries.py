"""Registered queries of the corpus operators: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, embedding_dups, lexical, line_dedup, prefix_trie, quality_classifier, quality_rules, warc
from .packing import pack
from .sharding import shard
from .shared import new_path
from .simhash import near_duplicates
from .substring_dedup import substring_dedup


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary)
    ids = ids.select("doc_id", "ids", F.coalesce(F.array_max("ends"), F.lit(0)).cast("long").alias("n_chars"))
    return bpe.decode(ids, vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "n_chars",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round(F.col("p_quality") * 1000000).cast("long").alias("quality_ppm")
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.aggregate("removed", F.lit(0).cast("long"), lambda s, c: s + c["n"])
    return out.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        lines.alias("n_removed_lines"),
        F.size("removed").cast("long").alias("n_removed_runs"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations")).withColumnRenamed("ends", "ends_sha256")


def op11_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op11_embedding_dups": op11_embedding_dups,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
    "op6_ann": op6_ann,
    "op4_quality_classifier": op4_quality_classifier,
    "op3_warc": op3_warc,
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op9_sharding": op9_sharding,
    "op5_bpe": op5_bpe,
    "op7_packing": op7_packing,
    "op10_simhash": op10_simhash,
    "op8_substring_dedup": op8_substring_dedup,
}

SQL: dict[str, str] = {
    "op3_warc": """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
  s AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS d, max(page_id) OVER (PARTITION BY b) AS r FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id <> r THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> r THEN r END AS refers_to FROM s""",
    "op1_quality_rules": quality_rules.sql(),
    "op2_line_dedup": line_dedup.SQL,
    "op11_embedding_dups": embedding_dups.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_lexical_search": lexical.SQL,
    "op8_substring_dedup": """WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
  k AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM w)),
  again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM k) WHERE r > 1),
  gone AS (SELECT DISTINCT doc_id, i + j AS p FROM again, generate_series(0, 19) AS s(j)),
  each AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM w)),
  kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
}
