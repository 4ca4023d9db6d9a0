"""Tables whose rows are replaced: each write is a new version folder beside the old one.

A version counts once its job has committed (_SUCCESS), so a writer that dies leaves the former version
in use, no job overwrites the files it is reading, and a reader sees old rows or new ones, never none.
A version's name ends in a random part, so that two writers at the same time never share a folder. The
version before the newest stays for readers that have begun; older ones are deleted."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

_COMMITTED = re.compile(r"^(.*)/(v=(\d+)_\w+)/_SUCCESS$")


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> dict[str, list[tuple[int, str]]]:
    """Committed versions below the folders that match `path`, oldest first: folder -> (number, name)."""
    pattern, fs = _file_system(spark, f"{path}/v=*/_SUCCESS")
    found: dict[str, list[tuple[int, str]]] = {}
    for status in fs.globStatus(pattern) or []:
        match = _COMMITTED.match(status.getPath().toString())
        if match:
            found.setdefault(match[1], []).append((int(match[3]), match[2]))
    return {folder: sorted(versions) for folder, versions in found.items()}


def _only(found: dict[str, list[tuple[int, str]]]) -> list[tuple[int, str]]:
    return next(iter(found.values()), [])


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The newest committed version, or None if there is none."""
    versions = _only(_versions(spark, path))
    return spark.read.schema(schema).parquet(f"{path}/{versions[-1][1]}") if versions else None


def write_next(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    versions = _only(_versions(spark, path))
    number = versions[-1][0] + 1 if versions else 1
    df.write.parquet(f"{path}/v={number:08d}_{uuid.uuid4().hex[:8]}")
    for _, name in versions[:-1]:
        place, fs = _file_system(spark, f"{path}/{name}")
        fs.delete(place, True)


def read_partitions(spark: SparkSession, path: str, depth: int) -> DataFrame | None:
    """The newest committed version of every partition folder, `depth` levels below `path`; None without any."""
    found = _versions(spark, path + "/*" * depth)
    folders = [f"{folder}/{versions[-1][1]}" for folder, versions in found.items()]
    return spark.read.option("basePath", path).parquet(*folders) if folders else None
