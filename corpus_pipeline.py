"""Five stages from raw documents to packed token ids.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that its
predecessor kept, and returns a DataFrame; :func:`run` writes each result as
Parquet in the shared folder and reads it again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripspark.llm import decontaminate, packing, quality_rules, simhash_dedup, source_mixing
from tripspark.llm.common import crc32_mod
from tripspark.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.7 or more; it learns from the labels outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").where(crc32_mod("doc_id", 4) != 2)
    return quality_rules.keep_good(docs, quality_rules.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link at 4 or fewer differing bits."""
    return simhash_dedup.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is 0.8 or more similar to a benchmark item."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: documents once per epoch, plus the fractional selection."""
    return source_mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_ids),
]

#: SQL can't express the trained classifier nor the tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{k}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
