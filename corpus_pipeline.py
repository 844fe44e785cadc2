"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, SentencePiece coding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is written as Parquet and read again as the
next stage's documents. A stage's output is removed once the next one's is complete. All stages but the last return the columns of their
documents; what each does with null and repeated ids, null and empty texts stands in its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spikeloom.llm import decontaminate, exact_dedup, language_id, near_dedup, pieces
from spikeloom.llm.common import remove_folder, shared_folder


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def stage_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(docs)


STAGES = [
    ("language_id", stage_language),
    ("exact_dedup", stage_exact),
    ("near_dedup", stage_near),
    ("decontaminate", stage_decontaminate),
    ("sentencepiece", stage_pieces),
]
#: SQL can't express the first, third, fourth and last stage; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; stage outputs go to the cluster's shared folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove_folder(spark, before)
        before = folder
    return docs
