"""One query per operator: each applies it, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripspark.llm import (bbit_minhash, conversation_repair, conversation_trie, decontaminate, language_id, multiprobe_lsh, packing,
                           quality_rules, secret_scan, simhash_dedup, site_style_tree, source_mixing, token_counts)
from tripspark.llm.common import crc32_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc32_mod("doc_id", 4) == 2
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = quality_rules.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("identified.nearest").alias("lang_pred"), "identified.score",
                        F.col("identified.lang").alias("lang_or_rejected"))


def op6_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style_tree.extract(table(spark, sf_dir, "pages"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multiprobe_lsh.neighbours(vectors.where(F.col("vec_id") % 100 == 0), vectors)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_source_mixing": op3_source_mixing,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_site_style_tree": op6_site_style_tree,
    "op7_secret_scan": op7_secret_scan,
    "op8_packing": op8_packing,
    "op9_multiprobe_lsh": op9_multiprobe_lsh,
    "op10_decontaminate": op10_decontaminate,
    "op11_bbit_minhash": op11_bbit_minhash,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}
