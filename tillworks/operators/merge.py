"""Re-runnable loads on plain Parquet: replace by batch, upsert, and type-1 dimension merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillworks.operators.numbering import global_row_number
from tillworks.operators.versions import read_partitions, write_next
from tillworks.schema import (
    DIMENSION_COLUMNS,
    DIMENSIONS,
    NATURAL_KEY,
    SURROGATE_KEY,
    SYSTEM_BATCH,
    UNKNOWN_KEY,
    UNKNOWN_TEXT,
    conform,
)
from tillworks.session import materialise


def replace_by_batch(df: DataFrame, path: str, batch: dict[str, str]) -> None:
    """Delete one batch's rows and insert `df`, as one switch: the rows are written beside the old ones,
    and count from the moment that the job has committed.

    `batch` maps the partition columns to this batch's values. Other batches are not touched, a
    rerun gives the same table, and an empty `df` leaves the batch empty."""
    write_next(df.drop(*batch), path + "".join(f"/{column}={value}" for column, value in batch.items()))


def read_batches(spark: SparkSession, path: str, schema: T.StructType, partition_columns: int = 1) -> DataFrame:
    """A table written by `replace_by_batch`, with its declared schema; empty if not yet written. A filter
    on the batch reads its folder only."""
    found = read_partitions(spark, path, partition_columns)
    return spark.createDataFrame([], schema) if found is None else conform(found, schema)


def only_when_running(df: DataFrame, control: DataFrame, batch: str) -> DataFrame:
    """Rows of `df` if the batch is RUNNING, else none: the gate in front of every insert."""
    running = control.filter((F.col("BatchID") == batch) & (F.col("BatchStatus") == "RUNNING"))
    return df.filter(running.agg(F.count("*") > 0).scalar())


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """MERGE that replaces matched rows and inserts the others."""
    return current.join(changes.select(key), key, "left_anti").unionByName(changes)


def seed_missing(current: DataFrame, seeds: DataFrame, key: str, refreshed: list[str]) -> DataFrame:
    """MERGE that inserts absent seeds; for present ones only the `refreshed` columns change."""
    c, s = current.alias("c"), seeds.alias("s")

    def pick(column: str) -> Column:
        ours, theirs = F.col(f"c.{column}"), F.col(f"s.{column}")
        if column in refreshed:
            return F.coalesce(theirs, ours).alias(column)
        return F.when(F.col(f"c.{key}").isNotNull(), ours).otherwise(theirs).alias(column)

    joined = c.join(s, F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")
    return joined.select(*[pick(column) for column in current.columns])


def unknown_member(spark: SparkSession, dimension: str) -> DataFrame:
    """The one row that facts without a match point to."""
    key = SURROGATE_KEY[dimension]
    attributes: dict[str, Column] = {}
    for column, data_type in DIMENSION_COLUMNS[dimension].items():
        if dimension == "dim_campaign" and column in ("StartDay", "EndDay", "CampaignDuration"):
            attributes[column] = F.lit(None)
        elif isinstance(data_type, T.StringType):
            attributes[column] = F.lit(UNKNOWN_TEXT)
        else:
            attributes[column] = F.lit(UNKNOWN_KEY)
    row = spark.range(1).select(
        F.lit(UNKNOWN_KEY).alias(key),
        *[c.alias(n) for n, c in attributes.items()],
        F.lit(True).alias("IsCurrent"),
        F.lit(SYSTEM_BATCH).alias("SourceBatchID"),
        F.current_timestamp().alias("CreatedAt"),
        F.current_timestamp().alias("UpdatedAt"),
        F.lit(UNKNOWN_TEXT).alias("RecordHash"),
    )
    return conform(row, DIMENSIONS[dimension])


def seed_unknown(current: DataFrame, dimension: str) -> DataFrame:
    """Add the unknown member if the dimension does not have it yet."""
    present = current.filter(F.col(SURROGATE_KEY[dimension]) == UNKNOWN_KEY)
    seed = unknown_member(current.sparkSession, dimension).filter(present.agg(F.count("*") == 0).scalar())
    return current.unionByName(seed)


def _one_per_key(source: DataFrame, dimension: str) -> DataFrame:
    """Fail the job if a natural key occurs twice, as a MERGE with two matching rows would. A grouped
    count, combined before the shuffle, in place of a window over each key's rows."""
    natural = NATURAL_KEY[dimension]
    others = [c for c in source.columns if c != natural]
    message = F.raise_error(F.lit(f"{dimension}: several source rows for one {natural}"))
    grouped = source.groupBy(natural).agg(F.count("*").alias("_copies"), *[F.first(c).alias(c) for c in others])
    checked = F.when(F.col("_copies") > 1, message.cast(source.schema[natural].dataType)).otherwise(F.col(natural))
    return grouped.select(checked.alias(natural), *others)


_SAME, _CHANGED, _NEW = "same", "changed", "new"


def merge_dimension(current: DataFrame | None, source: DataFrame, dimension: str, batch: str) -> DataFrame:
    """Type-1 merge: unchanged rows stay, changed rows take the new attributes, new members get
    the next keys in natural-key order, members absent from the source are kept. A dimension that
    does not exist yet (None) starts from its unknown member; one that the source does not change is
    returned as it is (the same DataFrame), so that no new version need be written.

    `source` has the dimension's attributes and RecordHash, one row per natural key. It is read once: one
    full outer join, written with what becomes of each row."""
    key, natural = SURROGATE_KEY[dimension], NATURAL_KEY[dimension]
    attributes = list(DIMENSION_COLUMNS[dimension])
    schema = DIMENSIONS[dimension]
    incoming = _one_per_key(source.select(*attributes, "RecordHash"), dimension).select(
        F.col(natural).alias("_nk"),
        *[F.col(a).alias(f"_{a}") for a in attributes if a != natural],
        F.col("RecordHash").alias("_hash"),
    )
    start = current if current is not None else unknown_member(source.sparkSession, dimension)
    members = start.filter(F.col(key) != UNKNOWN_KEY)
    state = F.when(F.col(key).isNull(), _NEW).when(F.col("RecordHash") != F.col("_hash"), _CHANGED).otherwise(_SAME)
    joined = materialise(members.join(incoming, F.col(natural) == F.col("_nk"), "full").withColumn("_state", state), f"merge-{dimension}")
    found = {r["_state"]: r for r in joined.groupBy("_state").agg(F.max(key).alias("highest")).collect()}
    unknown = seed_unknown(start, dimension).filter(F.col(key) == UNKNOWN_KEY)
    if current is not None and not {_CHANGED, _NEW} & found.keys() and not current.filter(F.col(key) == UNKNOWN_KEY).isEmpty():
        return current

    changed = F.col("_state") == _CHANGED

    def updated(column: str, new: Column) -> Column:
        return F.when(changed, new).otherwise(F.col(column)).alias(column)

    kept = joined.filter(F.col("_state") != _NEW).select(
        key,
        natural,
        *[updated(a, F.col(f"_{a}")) for a in attributes if a != natural],
        updated("IsCurrent", F.lit(True)),
        updated("SourceBatchID", F.lit(batch)),
        "CreatedAt",
        updated("UpdatedAt", F.current_timestamp()),
        updated("RecordHash", F.col("_hash")),
    )
    highest = max((r["highest"] for r in found.values() if r["highest"] is not None), default=0)
    new = joined.filter(F.col("_state") == _NEW).select(
        F.col("_nk").alias(natural), *[F.col(f"_{a}").alias(a) for a in attributes if a != natural], F.col("_hash").alias("RecordHash")
    )
    added = global_row_number(new, natural, name="_n").withColumns(
        {
            key: F.col("_n") + highest,
            "IsCurrent": F.lit(True),
            "SourceBatchID": F.lit(batch),
            "CreatedAt": F.current_timestamp(),
            "UpdatedAt": F.current_timestamp(),
        }
    )
    return conform(unknown, schema).unionByName(conform(kept, schema)).unionByName(conform(added, schema))
