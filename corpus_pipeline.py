"""The corpus pipeline: quality rules, line dedup, near-dedup, source mix, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes a stage's
result as Parquet in the shared checkpoint folder and reads it again as the
next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import line_dedup, mixing, order_minhash, packing, quality_rules
from tessera.llm.common import materialize
from tessera.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trained model."""
    return quality_rules.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least 10 of them hold."""
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return order_minhash.drop_near(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets."""
    return mixing.mix_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("source_mix", mix_stage),
    ("packing", pack_stage),
]

#: Trained models, alignments and token ids are beyond SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
