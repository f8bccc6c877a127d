"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    decontamination,
    embedding_dedup,
    filter_audit,
    language_id,
    lm_scoring,
    minhash_dedup,
    mixing,
    prefix_trie,
    sql,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filters,
    warc,
)
from tessera.llm.common import read_table, workers_find_package

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = tuple(url_filters.Rule(*rule) for rule in sql.URL_RULES)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.url_filter(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", "strict_terms", "soft_terms", "weight"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), path, limit=512)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.similar_vectors(read_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.held_out(F.col("doc_id"), 4, 2)
    judged = language_id.identify_languages(read_table(spark, sf_dir, "documents"), ~held_out)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return warc.read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate(
        F.arrays_zip("begins", "ends"), F.lit(0).cast("long"),
        lambda total, span: total + span["ends"] - span["begins"],
    )
    return cleaned.select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.held_out(F.col("doc_id"), 5, 1)
    scored = lm_scoring.score_texts(read_table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.held_out(F.col("doc_id"), 4, 2)
    scored = toxicity.toxicity(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~held_out
    )
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), branch=(100, 6))


Query = Callable[[SparkSession, str], DataFrame]


def _with_package(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_url_filter": op1_url_filter,
        "op2_token_counts": op2_token_counts,
        "op3_decontamination": op3_decontamination,
        "op4_minhash_dedup": op4_minhash_dedup,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_mix_sources": op6_mix_sources,
        "op7_language_id": op7_language_id,
        "op8_warc": op8_warc,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_filter_audit": op11_filter_audit,
        "op12_toxicity": op12_toxicity,
        "op13_prefix_trie": op13_prefix_trie,
    }
    return {name: _with_package(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": sql.url_filter(),
        "op3_decontamination": sql.decontamination(),
        "op4_minhash_dedup": sql.near_duplicates(),
        "op5_embedding_dedup": sql.embedding_dedup(),
        "op6_mix_sources": sql.mix_sources(),
        "op8_warc": sql.warc(),
        "op9_suffix_dedup": sql.suffix_dedup(),
        "op11_filter_audit": sql.filter_audit(),
        "op13_prefix_trie": sql.prefix_trie(),
    }
