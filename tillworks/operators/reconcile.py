"""Side-by-side one-row aggregates without a cross join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def side_by_side(values: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row with one column per named aggregate, each taken over its own table.

    The aggregates of one DataFrame are taken in one pass over it; each DataFrame yields one row,
    and the rows are stacked and folded by max."""
    tables: dict[int, tuple[DataFrame, list[Column]]] = {}
    for name, (df, aggregate) in values.items():
        tables.setdefault(id(df), (df, []))[1].append(aggregate.alias(name))
    rows = [df.agg(*aggregates) for df, aggregates in tables.values()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(name).alias(name) for name in values])


def counts(tables: dict[str, DataFrame], label: str, count: str = "RowCount") -> DataFrame:
    """One row per table: its label and its number of rows."""
    parts = [
        df.agg(F.count("*").alias(count)).select(F.lit(name).alias(label), count)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
