"""Session helpers: a local builder, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(cpus: str = "*", name: str = "tillworks") -> SparkSession:
    """Session for tests and the local benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediates, as the cluster names it in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tillworks-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; nothing written there is ever read by another run."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tillworks/{app}/{label}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock, _cleanup_before = Lock(), []


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends. Otherwise they stay until the driver's garbage collector finds
    them, and those of all tables that a query builds lie on the executors' disks at the same time."""
    with _cleanup_lock:
        _cleanup_before.append(spark.conf.get(_CLEANUP, None) if not _cleanup_before else _cleanup_before[0])
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleanup_lock:
            before = _cleanup_before.pop()
            if not _cleanup_before:  # the last of several writes at the same time
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, label: str, *partition_by: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """Write `df` to the scratch folder and read it back: cuts lineage, survives lost executors,
    and gives the optimizer true file sizes for its join choices.

    `derived` columns are expressions over the other columns. They are not written (a record hash does
    not compress and is most of a narrow row) but computed by whoever reads them."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    stored = df.drop(*derived) if derived else df
    with shuffles_removed(spark):
        stored.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(stored.schema).parquet(path)
    return table.withColumns(derived).select(*df.columns) if derived else table


_TASK_ROWS = 500_000  # rows that a task sorts or groups in memory


def needs_dealing(spark: SparkSession, rows: int) -> bool:
    return rows > _TASK_ROWS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """`df` dealt out by `columns`, of a table of so many `rows`: to one task for each half million of them where
    that is more than the session's shuffle partitions, which need not grow with the table, so that a task
    sorts and groups what fits in memory."""
    if needs_dealing(df.sparkSession, rows):
        return df.repartition(-(-rows // _TASK_ROWS), *columns)
    return df.repartition(*columns)


def at_the_same_time(actions: Iterable[Callable[[], Any]], at_once: int = 8) -> list[Any]:
    """Run independent Spark actions at the same time, so that small loads share the cluster
    instead of waiting for each other. Results come in order; the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(action) for action in actions]]
