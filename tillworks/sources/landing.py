"""Landing store: delivered CSV files as typed Parquet, partitioned by the day or week that they load.

A CSV file is parsed once, when it is delivered. A batch then reads the folder of its day or week only,
and the planner reads no rows at all: which days and weeks there are is the list of folders, and how many
rows they hold is in the files' footers."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillworks.schema import SOURCES
from tillworks.session import at_the_same_time
from tillworks.sources.csvfiles import read_source

#: The sources that a batch loads a part of, and the column that says which.
SLICED = {"transaction_data": "day_no", "coupon_redempt": "day_no", "causal_data": "week_no"}
_PART = "load_value"


def _schema(source: str) -> T.StructType:
    columns = [T.StructField(n, t) for n, t in SOURCES[source].values()] + [T.StructField("SourceFile", T.StringType())]
    return T.StructType([*columns, T.StructField(_PART, T.IntegerType())] if source in SLICED else columns)


def land(spark: SparkSession, csv_path: str, store: str, source: str) -> None:
    """Parse a delivery of one source into the store. A sliced source replaces the days (or weeks) that
    the delivery holds and leaves the others; a snapshot replaces the one before. Rows without a day go
    to a folder of their own, which no batch reads."""
    rows = read_source(spark, csv_path, source)
    if source not in SLICED:
        rows.write.mode("overwrite").parquet(f"{store}/{source}")
        return
    # rows of a value together, in few files, with large values split: rebalance is a hint to adaptive execution
    parted = rows.withColumn(_PART, F.col(SLICED[source]).cast("int")).hint("rebalance", _PART)
    parted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_PART).parquet(f"{store}/{source}")


def land_all(spark: SparkSession, folder: str, store: str) -> None:
    """The CSV files of all eight sources in one folder, named by source."""
    at_the_same_time([partial(land, spark, f"{folder}/{source}.csv", store, source) for source in SOURCES])


def landed(spark: SparkSession, store: str, source: str, value: int | None = None) -> DataFrame:
    """Rows of one source, of a sliced one only those of one day or week (its folder)."""
    rows = spark.read.schema(_schema(source)).parquet(f"{store}/{source}")
    if source not in SLICED:
        return rows
    return (rows if value is None else rows.filter(F.col(_PART) == value)).drop(_PART)


def landed_values(spark: SparkSession, store: str, source: str) -> DataFrame:
    """The days or weeks of a sliced source, from the names of its folders: one value per folder comes to
    the driver, no row is read."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/{source}/{_PART}=*")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName().partition("=")[2] for status in fs.globStatus(place) or []]
    values = sorted(int(n) for n in names if n.lstrip("-").isdigit())
    column = SLICED[source]
    return spark.createDataFrame([(v,) for v in values], f"{column} int").select(F.col(column).cast("decimal(10,0)"))
