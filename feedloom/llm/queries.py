"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (embedding_dedup, exact_dedup, fill_in_middle, html_extract, language_id, lm_scoring,
               mixing, packing, prefix_trie, quality, simhash, token_files, toxicity)
from .common import scratch, ship
from .tokens import default_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")) \
        .select("doc_id", "fingerprint", "component_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")) \
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.ranked_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.size("positions")).cast("long").alias("taken"),
                       F.get("positions", F.lit(0)).alias("first_position"),
                       F.get("positions", F.lit(1)).alias("second_position"),
                       F.get("ranks", F.lit(0)).alias("first_rank"), F.get("ranks", F.lit(1)).alias("second_rank"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = scratch(spark, "token-files")
    token_files.write_token_files(docs, folder, default_tokenizer())
    return token_files.read_token_files(spark, folder)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), default_tokenizer())


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations")).drop("node_key")


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_simhash_near_dedup, op3_quality_classifier, op4_exact_dedup,
    op5_source_mixing, op6_toxicity, op7_embedding_near_dedup, op8_lm_scoring, op9_token_binary,
    op10_best_fit_packing, op11_language_id, op12_fill_in_middle, op13_prefix_trie)}

ORACLE_SQL = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op5_source_mixing": mixing.MIX_SQL,
    "op12_fill_in_middle": fill_in_middle.FIM_SQL,
    "op13_prefix_trie": prefix_trie.TRIE_SQL,
}
