"""CSV sources: text in, typed rows out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillworks.schema import SOURCES


def scan(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Every field as text, with the file it came from. The order of the columns is that of the
    first file's header; a file whose header differs raises, so no field is read under another
    name. A short or long line is kept (PERMISSIVE)."""
    header = spark.read.option("header", True).csv(path).columns  # first line of one file only
    by_name = {h.lower(): h for h in SOURCES[source]}
    schema = T.StructType([T.StructField(by_name.get(h.lower(), h), T.StringType()) for h in header])
    options = {"header": True, "mode": "PERMISSIVE", "enforceSchema": False}
    rows = spark.read.schema(schema).options(**options).csv(path)
    return rows.select(*SOURCES[source], F.col("_metadata.file_path").alias("SourceFile"))


def typed(rows: DataFrame, source: str) -> DataFrame:
    """Text to the source's declared types; text that does not convert becomes NULL."""
    return rows.select(
        *[F.col(h).try_cast(t).alias(n) for h, (n, t) in SOURCES[source].items()], "SourceFile"
    )


def read_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    return typed(scan(spark, path, source), source)


def slice_of(rows: DataFrame, column: str, value: Column | int | str | None) -> DataFrame:
    """The rows of one day or week, or all rows when no value is given (full snapshot)."""
    if value is None:
        return rows
    if not isinstance(value, Column):
        value = F.lit(value).cast(rows.schema[column].dataType)
    return rows.filter(F.col(column) == value)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of records in each source."""
    parts = [
        df.agg(F.count("*").alias("TotalRowCount")).select(F.lit(f"{n}.csv").alias("FileName"), "TotalRowCount")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_transactions(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("SourceRowCount"),
        F.min("day_no").alias("MinDay"),
        F.max("day_no").alias("MaxDay"),
        F.countDistinct("basket_id").alias("DistinctBasketCount"),
        F.countDistinct("product_id").alias("DistinctProductCount"),
    )


def profile_redemptions(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("SourceRowCount"),
        F.min("day_no").alias("MinDay"),
        F.max("day_no").alias("MaxDay"),
    )


def write_csv(rows: DataFrame, path: str, source: str) -> None:
    """Write typed rows in the source's file layout; NULL becomes an empty field."""
    rows.select(*[F.col(n).cast("string").alias(h) for h, (n, _) in SOURCES[source].items()]).write.option(
        "header", True
    ).csv(path)
