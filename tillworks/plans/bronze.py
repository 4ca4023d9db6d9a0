"""Bronze: source rows with lineage and a content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.functions.rowops import record_hash
from tillworks.schema import BRONZE, BRONZE_TABLE, conform, source_columns


def to_bronze(
    rows: DataFrame,
    source: str,
    batch: str,
    process_date: str,
    source_system: str = "RETAIL_FILES",
    loaded_at: Column | None = None,
) -> DataFrame:
    """Typed source rows as Bronze rows of one batch, loaded now or when their column says."""
    loaded = rows.select(
        "*",
        F.lit(source_system).alias("SourceSystem"),
        F.lit(batch.strip()).alias("BatchID"),
        F.lit(process_date).cast("date").alias("ProcessDate"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("ETLTime"),
        record_hash(*source_columns(source)).alias("RecordHash"),
    )
    return conform(loaded, BRONZE[BRONZE_TABLE[source]])


def loaded_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Loaded rows, day range and number of different records per table."""
    parts = [
        df.agg(
            F.count("*").alias("LoadedRowCount"),
            F.min("day_no").alias("MinDay"),
            F.max("day_no").alias("MaxDay"),
            F.countDistinct("RecordHash").alias("DistinctRecordCount"),
        ).withColumn("SourceName", F.lit(name))
        for name, df in tables.items()
    ]
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def wrong_days(df: DataFrame, process_day: int) -> DataFrame:
    """Rows of a batch that belong to another day."""
    wrong = df.filter(F.col("day_no") != F.lit(process_day).cast("decimal(10,0)"))
    return wrong.agg(F.count("*").alias("WrongProcessValueCount"))
