"""Helpers shared by the operators: tables, words, unclashing names, bounded samples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed by the contracts: words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def spare(taken: Iterable[str], name: str) -> str:
    """`name`, lengthened until no column has it (names compare without case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def bounded_sample(docs: DataFrame, rows: int, size: int) -> list[str]:
    """Pieces of the texts of at most `rows` documents, those with the smallest hashed ids, each of at
    most `size` characters from an offset that the id's hash gives: for fitting a dictionary only. Ids
    are picked first and pieces cut in the executors, so rows * size characters come to the driver."""
    ids = docs.select("doc_id").filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    picked = [r[0] for r in ids.collect()]
    text = text_of()
    offset = F.pmod(F.xxhash64("doc_id", F.lit("offset")), F.greatest(F.length(text) - size + 1, F.lit(1))).cast("int") + 1
    found = docs.filter(F.col("doc_id").isin(picked)).select("doc_id", F.substring(text, offset, F.lit(size)).alias("t"))
    found = found.filter(F.length("t") > 0).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("t"))
    return [r["t"] for r in found.limit(rows).collect()]
