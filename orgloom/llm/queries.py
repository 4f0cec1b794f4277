"""One query for each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_trie, centroid_clusters, chat_format, conversation_repair, decontam, language_id, quality_mil, quality_rules, secret_scan, simhash, substring_dedup, token_counts, url_filters
from .sql import OP3_SQL, OP4_SQL, OP10_SQL, OP11_SQL, OP13_SQL

TOKENIZER = "word_bpe_49k.json"
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_mil.score(docs, quality_mil.fit(docs, _table(spark, sf_dir, "labels")))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.verdicts(decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), matches=False))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.over_limit(token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict", "p_block")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat_format.read_back(chat_format.format_conversations(turns.union(planted)))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"), secret_scan.Forest(secret_scan.example_findings(spark)))
    return found.select("doc_id", F.size("secret_findings").cast("long").alias("n_candidates"), "n_secrets", "secret_findings", F.sha2(F.coalesce("redacted_text", F.lit("")), 256).alias("redacted_sha256"))


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters.with_inertia(*centroid_clusters.cluster(_table(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damaged(turns), copies_col="copies").facts()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_simhash_near_dedup,
        op3_benchmark_decontamination,
        op4_quality_rules,
        op5_token_counts,
        op6_url_filters,
        op7_chat_formatting,
        op8_secret_scans,
        op9_bpe_encode_decode,
        op10_substring_dedup,
        op11_centroid_clusters,
        op12_language_id,
        op13_conversation_repair,
    )
}
ORACLES: dict[str, str] = {"op3_benchmark_decontamination": OP3_SQL, "op4_quality_rules": OP4_SQL, "op10_substring_dedup": OP10_SQL, "op11_centroid_clusters": OP11_SQL, "op13_conversation_repair": OP13_SQL}
