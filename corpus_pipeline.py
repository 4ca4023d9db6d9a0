"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, segmentation.

Each stage takes what its predecessor wrote; all but the last return the columns of documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tillworks.llm import exact_dedup, line_quality, mixing, segmentation, simhash
from tillworks.llm.common import table
from tillworks.llm.queries import PIECES
from tillworks.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return line_quality.clean(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated or dropped by their source's rate."""
    return mixing.mix(docs)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each row."""
    return segmentation.sampled_segmentations(docs, PIECES)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", segmentations),
]

#: SQL can express neither fingerprint components nor lattice sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""

    def step(docs: DataFrame, stage) -> DataFrame:
        return materialise(stage[1](spark, docs, sf_dir), "pipeline")

    return reduce(step, STAGES, table(spark, sf_dir, "documents"))
