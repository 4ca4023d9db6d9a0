"""Star key lookup and referential probes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillworks.schema import NATURAL_KEY, SURROGATE_KEY, UNKNOWN_KEY
from tillworks.session import materialise

_BLOCK_BITS, _WORD_BITS = 12, 6  # a block has 4,096 natural keys, in 64 words of 64 bits
_WORDS = 64
_FEW_BLOCKS = 64  # worth packing whatever they hold
_MOST_BLOCKS = 16_384  # of at most 850 bytes: 14 MB to broadcast


def _members(dim: DataFrame, dimension: str) -> DataFrame:
    key = SURROGATE_KEY[dimension]
    return dim.filter(F.col("IsCurrent") & (F.col(key) != UNKNOWN_KEY)).select(
        F.col(NATURAL_KEY[dimension]).alias("_nk"), F.col(key).alias("_key")
    )


def lookup_key(fact: DataFrame, column: str, dim: DataFrame, dimension: str) -> DataFrame:
    """Add the dimension's surrogate key for the natural key in `column`, -1 where there is none.

    A plain left equi-join: Spark broadcasts the two-column side when its file size is below
    spark.sql.autoBroadcastJoinThreshold, and otherwise merges, splitting hot keys at run time."""
    key = SURROGATE_KEY[dimension]
    joined = fact.join(_members(dim, dimension), F.col(column) == F.col("_nk"), "left")
    return joined.withColumn(key, F.coalesce("_key", F.lit(UNKNOWN_KEY))).drop("_nk", "_key")


def _place(natural: Column) -> tuple[Column, Column, Column]:
    """Block of a natural key (a whole number that fits BIGINT), word in the block, and bit in the word."""
    nk = natural.cast("bigint")
    word = F.shiftright(nk, _WORD_BITS).bitwiseAND(F.lit(_WORDS - 1))
    return F.shiftright(nk, _BLOCK_BITS), word.cast("int"), nk.bitwiseAND(F.lit(_WORDS - 1)).cast("int")


def packed_keys(dim: DataFrame, dimension: str) -> DataFrame | None:
    """The dimension's keys, one row per block of 4,096 natural keys: a bit for each one that exists, the
    members before each word of 64, and the key of the first member less one. None where that does not
    give the keys (they do not follow the natural keys without a gap) or where the natural keys lie so far
    apart that it is no smaller, or too many to broadcast."""
    block, word, bit = _place(F.col("_nk"))
    placed = _members(dim, dimension).select(
        block.alias("_block"),
        word.alias("_word"),
        bit.alias("_bit"),
        (F.col("_key") - F.row_number().over(Window.partitionBy(block).orderBy("_nk"))).alias("_first"),
    )
    words = placed.groupBy("_block", "_word").agg(
        F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"), F.min("_first").alias("_first"), F.max("_first").alias("_last"), F.count("*").alias("_n")
    )
    earlier = Window.partitionBy("_block").orderBy("_word").rowsBetween(Window.unboundedPreceding, -1)
    counted = words.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("int"))
    entries = F.map_from_entries(F.collect_list(F.struct("_word", F.struct("_bits", "_before"))))
    by_block = counted.groupBy("_block").agg(
        entries.alias("_entries"), F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"), F.sum(F.bit_count("_bits")).alias("_set")
    )
    numbers = F.sequence(F.lit(0), F.lit(_WORDS - 1))

    def of_words(field: str) -> Column:
        return F.transform(numbers, lambda w: F.coalesce(F.try_element_at("_entries", w)[field], F.lit(0)))

    packed = materialise(
        by_block.select("_block", "_first", "_last", "_n", "_set", of_words("_bits").alias("_bits"), of_words("_before").alias("_before")),
        f"packed-{dimension}",
    )
    as_counted = (F.col("_first") == F.col("_last")) & (F.col("_n") == F.col("_set"))
    blocks, members, in_order = packed.agg(
        F.count("*"), F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.bool_and(as_counted), F.lit(True))
    ).first()
    worth = blocks <= _FEW_BLOCKS or blocks * _WORDS <= members
    return packed.drop("_last", "_n", "_set") if in_order and worth and blocks <= _MOST_BLOCKS else None


def lookup_packed(fact: DataFrame, column: str, packed: DataFrame, dimension: str) -> DataFrame:
    """`lookup_key` by `packed_keys`: a left equi-join on the block. The blocks are bounded in number and are
    broadcast, so that the fact's rows stay where they are."""
    block, word, bit = _place(F.col(column))
    joined = fact.join(F.broadcast(packed), block == F.col("_block"), "left").withColumns(
        {"_bits": F.col("_bits")[word], "_before": F.col("_before")[word], "_bit": bit}
    )
    here = F.expr("shiftright(_bits, _bit) & 1L") == 1
    earlier = F.expr("bit_count(_bits & ~shiftleft(-1L, _bit))")
    found = F.when(here, F.col("_first") + F.col("_before") + earlier + 1)
    return joined.withColumn(SURROGATE_KEY[dimension], F.coalesce(found, F.lit(UNKNOWN_KEY).cast("bigint"))).drop(
        "_block", "_first", "_bits", "_before", "_bit"
    )


def fits_bigint(of: T.DataType) -> bool:
    """Whether values of the type are whole numbers that fit BIGINT."""
    return isinstance(of, T.IntegralType) or isinstance(of, T.DecimalType) and of.scale == 0 and of.precision <= 18


def packed_members(other: DataFrame, key: str) -> DataFrame | None:
    """The keys that exist, one row per block of 4,096 with a bit for each of them. None where they are not whole
    numbers, or lie so far apart, or are so many, that they are not worth broadcasting (as `packed_keys`)."""
    if not fits_bigint(other.schema[key].dataType):
        return None
    block, word, bit = _place(F.col(key))
    placed = other.filter(F.col(key).isNotNull()).select(block.alias("_block"), word.alias("_word"), bit.alias("_bit"))
    words = placed.groupBy("_block", "_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    entries = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))
    by_block = words.groupBy("_block").agg(entries.alias("_entries"), F.sum(F.bit_count("_bits")).alias("_n"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda w: F.coalesce(F.try_element_at("_entries", w), F.lit(0)))
    packed = materialise(by_block.select("_block", "_n", bits.alias("_bits")), f"members-{key}")
    blocks, members = packed.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    worth = blocks <= _FEW_BLOCKS or blocks * _WORDS <= members
    return packed.drop("_n") if worth and blocks <= _MOST_BLOCKS else None


def with_membership(fact: DataFrame, column: str, packed: DataFrame, flag: str) -> DataFrame:
    """Add whether the value of `column` (`fits_bigint`) is one of the `packed_members`, by a left equi-join on the
    block. The blocks are bounded in number and are broadcast, so that the fact's rows stay where they are."""
    block, word, bit = _place(F.col(column))
    joined = fact.join(F.broadcast(packed), block == F.col("_block"), "left")
    placed = joined.withColumns({"_bits": F.col("_bits")[word], "_bit": bit})
    here = F.coalesce(F.expr("shiftright(_bits, _bit) & 1L") == 1, F.lit(False))
    return placed.withColumn(flag, here).drop("_block", "_bits", "_bit")


def probe_keys(fact: DataFrame, links: list[tuple[str, DataFrame, str]], *keep: str) -> tuple[DataFrame, Column]:
    """The fact's key columns (and those to `keep`) joined to the tables they refer to, and the condition
    'some key has no row there'. A link is (column of the fact, other table, its unique key)."""
    probed, misses = fact.select(*keep, *[column for column, _, _ in links]), []
    for i, (column, other, key) in enumerate(links):
        members = other.select(F.col(key).alias(f"_found{i}"))
        probed = probed.join(members, F.col(column) == F.col(f"_found{i}"), "left")
        misses.append(F.col(f"_found{i}").isNull())
    return probed, reduce(lambda a, b: a | b, misses)
