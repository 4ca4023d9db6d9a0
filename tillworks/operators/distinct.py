"""Several exact distinct counts beside ordinary aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


_WIDE = 10**18
_LEAST_PARTS = 4  # tasks that a group's members of one count are dealt out to
_PAIRS = 1_000_000  # pairs of a task: few enough to be made distinct in memory


def member(which: int, of: int, column: Column) -> Column:
    """The member as one BIGINT, which hashes fast and spills little. A number that does not fit keeps its
    lower 18 digits, and the rest of it moves `_which` on by that many times the number of counts."""
    narrow = column.try_cast("bigint")
    wide = column.cast("decimal(20,0)")
    lower = F.pmod(wide, F.lit(_WIDE)).cast("decimal(20,0)")
    moved = F.when(narrow.isNull() & column.isNotNull(), ((wide - lower) / F.lit(_WIDE)).cast("int") * of).otherwise(0)
    return F.struct((moved + which).alias("_which"), F.coalesce(narrow, lower.cast("bigint")).alias("_member"))


def with_distinct_counts(
    df: DataFrame, keys: dict[str, Column], aggregates: list[Column], distinct: dict[str, Column], rows: int = 0, groups: int = 0
) -> DataFrame:
    """groupBy(keys).agg(*aggregates) plus COUNT(DISTINCT column) for each of `distinct`.

    One aggregate with several distinct counts repeats every row, with all its sums, once per
    count before the shuffle. Here the ordinary aggregates are combined on the map side as usual,
    and only narrow (keys, which count, member) rows are repeated, made distinct and counted; a
    hot key is spread over its members. Members are whole numbers of at most 20 digits.

    `rows` of a large `df`, where known: pairs are then dealt out to as many tasks as hold them in memory,
    before they are made distinct. Spark's own tasks grow with the table and spill nearly every pair twice.
    `groups` of many, where known: each is then dealt out to a few tasks for each count, at most a quarter as
    many as it has rows on average but at least four. Over all tasks, nearly every pair would be counted by
    itself and shuffled again."""
    totals = df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*aggregates)
    pairs = [member(i, len(distinct), c) for i, c in enumerate(distinct.values())]
    members = (
        df.select(*[c.alias(f"_{k}") for k, c in keys.items()], F.explode(F.array(*pairs)).alias("_pair"))
        .select(*[f"_{k}" for k in keys], "_pair.*")
        .filter(F.col("_member").isNotNull())
    )
    tasks, which = rows * len(distinct) // _PAIRS, F.col("_which")
    if tasks > df.sparkSession.sparkContext.defaultParallelism:
        parts = members.columns
        if groups:
            of = max(_LEAST_PARTS, rows // (_LEAST_PARTS * groups * len(distinct)))
            members = members.withColumn("_which", which * of + F.pmod(F.xxhash64("_member"), F.lit(of)).cast("int"))
            parts, which = [*[f"_{k}" for k in keys], "_which"], F.floor(which / of)
        members = members.repartition(tasks, *parts)
    counted = members.distinct().groupBy(*[f"_{k}" for k in keys]).agg(
        *[F.count_if(F.pmod(which, F.lit(len(distinct))) == i).alias(name) for i, name in enumerate(distinct)]
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = totals.join(counted, same, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in distinct})


def with_distinct_counts_of_small_groups(
    df: DataFrame, keys: dict[str, Column], aggregates: list[Column], distinct: dict[str, Column]
) -> DataFrame:
    """`with_distinct_counts` where there are almost as many groups as rows, so that nothing can be
    combined: the rows are shuffled by the keys once, as they are. There each row becomes one narrow row per
    member, which are made distinct by hash aggregates: sets of members would be kept as objects, sorted, written
    and read again, one for each of the many groups. `aggregates` are sums and counts, which go with the first member."""
    placed = df.withColumns({f"_{k}": c for k, c in keys.items()} | {f"_{n}": c for n, c in distinct.items()})
    groups, of = [f"_{k}" for k in keys], len(distinct)
    pairs = F.explode(F.array(*[member(i, of, F.col(f"_{n}")) for i, n in enumerate(distinct)])).alias("_pair")
    number = F.pmod(F.col("_which"), F.lit(of))
    each = (
        placed.repartition(*groups)
        .select("*", pairs)
        .withColumns({"_which": F.col("_pair._which"), "_member": F.col("_pair._member")})
        .filter(F.col("_member").isNotNull() | (number == 0))
    )
    apart = each.groupBy(*groups, "_which", "_member").agg(*aggregates)
    sums = [f for f in apart.schema if f.name not in (*groups, "_which", "_member")]
    counts = [F.count_if((number == i) & F.col("_member").isNotNull()).alias(n) for i, n in enumerate(distinct)]
    grouped = apart.groupBy(*groups).agg(*[F.sum(F.when(number == 0, F.col(f.name))).cast(f.dataType).alias(f.name) for f in sums], *counts)
    return grouped.withColumnsRenamed(dict(zip(groups, keys, strict=True)))
