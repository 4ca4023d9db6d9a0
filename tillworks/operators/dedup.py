"""Latest-row deduplication that stays parallel when one row has a huge number of copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillworks.session import materialise

_FEW = 100_000  # hashes of 8 bytes: small enough to broadcast


def latest_copy(df: DataFrame, identity: list[str], order: str = "ETLTime") -> DataFrame:
    """One row per identity, the one with the highest `order`, when the identity is the whole
    content of the row (all copies are equal but for their load time).

    ROW_NUMBER() OVER (PARTITION BY hash ORDER BY time DESC) = 1 sends all copies of a row to one
    task; a grouped maximum combines them before the shuffle."""
    return df.groupBy(*identity).agg(F.max(order).alias(order))


def latest_of_few_copies(df: DataFrame, identity: list[str], order: str = "ETLTime") -> DataFrame:
    """`latest_copy` where most rows have no copy. Only an 8-byte hash of each row is shuffled; rows whose
    hash is alone are passed through where they lie, and the others are grouped by their whole content,
    so rows that merely share a hash stay apart."""
    return _latest(*_repeated(df, identity, order), identity, order)


def _repeated(df: DataFrame, identity: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their hashes, and the hashes that occur on several rows, written."""
    marked = df.select(*identity, order, F.xxhash64(*identity).alias("_mark"))
    counted = marked.groupBy("_mark").agg(F.count("*").alias("_n"))
    return marked, materialise(counted.filter("_n > 1").select("_mark"), "repeated-rows")


def _latest(marked: DataFrame, repeated: DataFrame, identity: list[str], order: str) -> DataFrame:
    alone = marked.join(repeated, "_mark", "left_anti").select(*identity, order)
    return alone.unionByName(latest_copy(marked.join(repeated, "_mark", "left_semi"), identity, order))


def latest_in_place(df: DataFrame, identity: list[str], order: str = "ETLTime") -> tuple[DataFrame, bool]:
    """`latest_of_few_copies` of a stored table, and whether it need not be stored again: with at most 100,000
    repeated hashes, only the rows that have them are written, and all others are read from where they lie."""
    marked, repeated = _repeated(df, identity, order)
    copies = repeated.count()
    if copies > _FEW:
        return _latest(marked, repeated, identity, order), False
    if copies == 0:
        return df.select(*identity, order), True
    few = F.broadcast(repeated)
    latest = latest_copy(marked.join(few, "_mark", "left_semi"), identity, order)
    alone = marked.join(few, "_mark", "left_anti").select(*identity, order)
    return alone.unionByName(materialise(latest, "latest-copies")), True


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the one with the highest `order` columns (then the other columns,
    so the choice never depends on row order). Also combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[
        c if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns
    ])
