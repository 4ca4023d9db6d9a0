"""Range join of few intervals against many points, as an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_weeks(intervals: DataFrame, start_day: Column, end_day: Column, name: str = "Week") -> DataFrame:
    """One row per interval and whole week inside [start_day / 7, end_day / 7].

    'week BETWEEN start / 7 AND end / 7' then becomes an equality on the week, which Spark can
    hash, where the range condition alone would compare every pair. An interval shorter than a
    week may hold no whole week and then has no rows."""
    first, last = F.ceil(start_day / 7).cast("int"), F.floor(end_day / 7).cast("int")
    weeks = F.when(first <= last, F.sequence(first, last))
    exploded = intervals.select("*", F.explode(weeks).alias(name))
    return exploded.withColumn(name, F.col(name).cast("decimal(10,0)"))
