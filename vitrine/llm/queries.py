"""Registered queries of the text operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    block_names,
    compression_quality,
    importance_resampling,
    mixing,
    prefix_bpe,
    prefix_trie,
    quality_rules,
    simhash,
    suffix_repeats,
    superkmer_dedup,
    toxicity,
    url_templates,
    warc_zstd,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.digest(table(spark, sf_dir, "documents"))


def op2_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_templates.filter_urls(table(spark, sf_dir, "pages"), url_templates.RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict")


def op3_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = block_names.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def byte_vocabulary() -> tuple[str, str]:
    """Path and pattern of the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digest(table(spark, sf_dir, "documents"), *byte_vocabulary())


def op5_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("weight", F.round("weight", 6))


def op6_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_quality.score(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judge(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.components(table(spark, sf_dir, "documents"), words=4, lanes=1, threshold=4)
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op10_zstd_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.round_trip(table(spark, sf_dir, "pages"))


def op11_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer_dedup.digest(table(spark, sf_dir, "documents"))


def op12_time_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance_resampling.weigh(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_interval_tree": op1_interval_tree,
    "op2_path_templates": op2_path_templates,
    "op3_block_naming": op3_block_naming,
    "op4_prefix_bpe": op4_prefix_bpe,
    "op5_raking": op5_raking,
    "op6_positive_unlabelled": op6_positive_unlabelled,
    "op7_weak_rules": op7_weak_rules,
    "op8_anchor_simhash": op8_anchor_simhash,
    "op9_compression": op9_compression,
    "op10_zstd_warc": op10_zstd_warc,
    "op11_super_kmers": op11_super_kmers,
    "op12_time_forward": op12_time_forward,
    "op13_bit_sliced": op13_bit_sliced,
}

ORACLES = {
    "op10_zstd_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n FROM pages),
        g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY t) ELSE page_id END AS chief FROM p)
        SELECT page_id, n AS payload_bytes, sha1(t) AS payload_digest,
               CASE WHEN chief IS NOT DISTINCT FROM page_id OR chief IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN chief IS DISTINCT FROM page_id THEN chief END AS refers_to
        FROM g
    """,
    "op2_path_templates": url_templates.oracle(),
    "op11_super_kmers": superkmer_dedup.oracle(),
    "op12_time_forward": prefix_trie.oracle(),
    "op5_raking": mixing.oracle(),
    "op7_weak_rules": quality_rules.oracle(),
    "op3_block_naming": r"""
        WITH d AS (
            SELECT doc_id, coalesce(length(text), 0) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t ORDER BY points DESC, doc_id)
    """,
}
