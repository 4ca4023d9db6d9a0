"""The operators' queries, each over its whole table, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillworks.llm import (
    bpe,
    exact_dedup,
    html_wrapper,
    importance,
    line_quality,
    merkle,
    mixing,
    secret_scan,
    segmentation,
    sharding,
    sql,
    simhash,
    token_count,
    token_files,
)
from tillworks.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_texts(table(spark, sf_dir, "pages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).drop("copies")


def op6_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segmentation.sampled_segmentations(table(spark, sf_dir, "documents"), PIECES)
    return found.drop("ids")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_id_digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.audited(docs, merkle.without_line_ends(docs))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_exact_dedup,
        op3_main_text,
        op4_sharding,
        op5_mixing,
        op6_segmentations,
        op7_simhash,
        op8_token_ids,
        op9_quality_rules,
        op10_secrets,
        op11_merkle,
        op12_importance,
        op13_byte_bpe,
    )
}

ORACLE_SQL = {
    "op2_exact_dedup": sql.EXACT_DEDUP,
    "op5_mixing": sql.MIXING,
    "op9_quality_rules": sql.QUALITY,
    "op11_merkle": sql.MERKLE,
    "op12_importance": sql.IMPORTANCE,
}
