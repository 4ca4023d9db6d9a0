"""Global numbering, ranking and tiling without sending all rows to one task.

A window with no (or a huge) partition sorts everything in a single task. Here rows are range-
partitioned and sorted in parallel; each row keeps its position inside its partition, and only
the per-partition counts (one per shuffle partition) are added up in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.session import materialise

_FEW = 100_000  # rows of two columns that are small enough to broadcast
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row's position in its lower 33 bits


def global_row_number(df: DataFrame, *order: Column | str, name: str = "row_number") -> DataFrame:
    """Add 1..n in the given order. The order should be total: ties are numbered arbitrarily.

    The sorted rows are written once with their partition and position as plain columns, so both
    uses below read the same numbers whatever is recomputed."""
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn(
            "_position",
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        ),
        "numbering",
    )
    # one count per shuffle partition: the only thing that passes through the driver
    counts = sorted(tuple(r) for r in placed.groupBy("_part").count().collect())
    before, offsets = 0, []
    for part, rows in counts:
        offsets.append((part, before))
        before += rows
    starts = df.sparkSession.createDataFrame(offsets, "_part int, _before bigint")
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_before") + F.col("_position") + 1).drop(
        "_part", "_position", "_before"
    )


def global_dense_rank(df: DataFrame, within: str, value: str, name: str) -> DataFrame:
    """DENSE_RANK() OVER (PARTITION BY within ORDER BY value DESC) when a partition may be huge.

    Distinct values are numbered globally, then made relative to the partition's first number."""
    numbered = global_row_number(
        df.select(within, value).distinct(), F.col(within).asc(), F.col(value).desc(), name="_n"
    )
    # one row per value of `within`: few, unless counted otherwise, and then a plain join
    first = materialise(numbered.groupBy(within).agg(F.min("_n").alias("_first")), "first-numbers")
    if first.count() <= _FEW:
        first = F.broadcast(first)
    ranks = numbered.join(first, within).select(
        F.col(within).alias("_within"),
        F.col(value).alias("_value"),
        (F.col("_n") - F.col("_first") + 1).alias(name),
    )
    matched = F.col(within).eqNullSafe(F.col("_within")) & F.col(value).eqNullSafe(F.col("_value"))
    return df.join(ranks, matched, "left").drop("_within", "_value")


def ntile(df: DataFrame, tiles: int, value: Column, tie_break: Column) -> Column:
    """NTILE(tiles) OVER (ORDER BY value, tie_break), as a plain column for rows of `df`.

    (value, tie_break) must be unique and not NULL. Only the last row of every tile but the
    highest one is looked up (tiles - 1 rows); a row's tile is 1 + the cut points before it."""
    keys = df.select(value.alias("_v"), tie_break.alias("_t"))
    rows = df.count()
    size, larger = divmod(rows, tiles)
    last_ranks = [t * size + min(t, larger) for t in range(1, tiles)]
    numbered = global_row_number(keys, "_v", "_t", name="_n")
    found = {r["_n"]: r for r in numbered.filter(F.col("_n").isin(last_ranks)).collect()}
    types = [f.dataType for f in keys.schema]
    tile = F.lit(1)
    for rank in last_ranks:
        if rank in found:  # rank 0 exists only when there are no rows
            v, t = (F.lit(found[rank][i]).cast(types[i]) for i in range(2))
            tile = tile + ((value > v) | ((value == v) & (tie_break > t))).cast("int")
    return tile
