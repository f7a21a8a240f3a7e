"""Registered queries of this package (one per operator, over whole tables) and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (chunk_dedup, embedding_dedup, license_scan, line_dedup, lm_scoring, mixing, order_minhash, packing,
                         periodic_runs, quality_rules, ranking, token_alignment, token_counts)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_report(_read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.chunk_report(_read(spark, sf_dir, "documents"), inside=True)


def op9_pairwise_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(_read(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                            tokenizer_path("piece_bpe_32k.model"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(_read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_token_counts": op3_token_counts,
    "op4_order_minhash": op4_order_minhash,
    "op5_quality_rules": op5_quality_rules,
    "op6_source_mix": op6_source_mix,
    "op7_line_dedup": op7_line_dedup,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_pairwise_ranking": op9_pairwise_ranking,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_license_scan": op12_license_scan,
    "op13_periodic_runs": op13_periodic_runs,
}

_OP7 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT k.*, k.key IN (SELECT key FROM frequent) AS hit FROM keyed k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hit) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hit), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE: dict[str, str] = {"op7_line_dedup": _OP7}
