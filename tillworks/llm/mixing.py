"""Mixing sources to target weights.

One aggregate gives the words of each source, water-filling its target, and target / words its
repetition rate. A document is emitted floor(rate) times, plus one hash-seeded Bernoulli copy whose
probability is the fraction. Each source tries `SEEDS` hash seeds and uses the one whose words come
nearest its target, so that small sources do not drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.llm.common import spare, text_of, word_count
from tillworks.operators.numbering import global_row_number
from tillworks.session import materialise

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEEDS = 16


def _identity(doc_id: Column, text: Column, copy: Column) -> Column:
    """What a row draws by: its id, its text, and which of the rows with both alike it is."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(text.cast("binary")), copy.cast("string"))


def _draw(identity: Column, seed: Column) -> Column:
    """Uniform in [0, 1): 32 of the bits of an MD5 of the row's identity; one MD5 serves four seeds."""
    digest = F.md5(F.concat_ws(":", identity, (seed / 4).cast("int")).cast("binary"))
    part = F.substring(digest, (seed % 4) * 8 + 1, F.lit(8))
    return F.conv(part, 16, 10).cast("long") / float(1 << 32)


def source_rates(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source of (doc_id, source, size): source, source_size, target, whole, part, seed.

    Sources in code-point order, null last, weigh `weights` in turn. Targets share all sizes by
    weight; a target above `most` times its source's size stops there, and the excess is shared
    again until none is above. A source without words gets the target 0."""
    sums = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sums")
    turn = F.element_at(F.lit([float(w) for w in weights]), ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    sums = materialise(
        global_row_number(sums, F.col("source").asc_nulls_last(), name="n").select("source", "source_size", turn.alias("weight")),
        "mix-sources",
    )
    level, capped, full = 0.0, -1, F.lit(False)
    while True:  # each round caps one more source at least
        total = sums.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("source_size"))).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if total["capped"] == capped or not total["open"]:
            break
        capped = total["capped"]
        level = (total["all"] - most * (total["held"] or 0)) / total["open"]
        full = most * F.col("source_size") < F.lit(level) * F.col("weight")
    size = F.col("source_size").cast("double")
    target = F.least(most * size, F.lit(level) * F.col("weight"))
    rate = F.when(size > 0, F.least(target / size, F.lit(float(most)))).otherwise(0.0)
    rates = materialise(
        sums.select("source", "source_size", target.alias("target"), F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part")),
        "mix-rates",
    )
    trial = sized.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    drawn = [F.sum(F.when(_draw(F.col("identity"), F.lit(k)) < F.col("part"), F.col("size")).otherwise(0)).alias(f"d{k}") for k in range(SEEDS)]
    trial = trial.groupBy("of").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("whole").alias("whole"), F.first("part").alias("part"), *drawn)
    off = [F.struct(F.abs(F.col("whole") * F.col("source_size") + F.col(f"d{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(SEEDS)]
    return materialise(
        trial.select(F.col("of").alias("source"), "source_size", "target", "whole", "part", F.least(*off)["seed"].alias("seed")),
        "mix-seeds",
    )


def _copies(identity: Column, rate: str = "") -> Column:
    field = lambda name: F.col(f"{rate}.{name}" if rate else name)
    return (field("whole") + (_draw(identity, field("seed")) < field("part")).cast("int")).cast("int")


def _with_copy_number(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with the number of each row among those of the same id and text. Where none are alike, which
    one grouping of ids and digests tells, that is 0; otherwise the rows are written with their place, and
    only those alike are sorted and numbered, spread by their place as well."""
    row, key = spare([*docs.columns, name], "row"), spare([*docs.columns, name], "key")
    keyed = docs.withColumn(key, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text_of().cast("binary"))))
    alike = materialise(keyed.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key), "mix-alike")
    if alike.isEmpty():
        return docs.withColumn(name, F.lit(0).cast("long"))
    written = materialise(keyed.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    numbered = materialise(global_row_number(written.select(key, row).join(alike, key, "left_semi"), key, row, name="n"), "mix-numbers")
    first = numbered.groupBy(key).agg(F.min("n").alias("first"))
    number = numbered.join(first, key).select(row, (F.col("n") - F.col("first")).alias(name))
    return written.join(number, row, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long"))).select(*docs.columns, name)


def _sized(docs: DataFrame, copy: str) -> DataFrame:
    identity = _identity(F.col("doc_id"), text_of(), F.col(copy))
    return materialise(docs.select("doc_id", "source", word_count(text_of()).alias("size"), identity.alias("identity")), "mix-sizes")


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken (words, repeats counted), copies.

    Null or empty text has size 0; null sources form one source, the last. Rows draw by id, text and, where
    both are repeated, by their number, so null or repeated ids and equal rows draw for themselves. An empty
    table gives an empty result."""
    narrow = docs.select("doc_id", "source", "text")
    sized = _sized(_with_copy_number(narrow, "copy"), "copy")
    rates = source_rates(sized, weights, most).withColumnRenamed("source", "of")
    return (
        sized.join(rates, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", _copies(F.col("identity")))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """`docs` with each row repeated as `mix_plan` says, dropped at 0; all columns as they are. An empty
    table gives an empty result."""
    copy, rate, count = spare(docs.columns, "copy"), spare(docs.columns, "rate"), spare(docs.columns, "count")
    numbered = _with_copy_number(docs, copy)
    rates = source_rates(_sized(numbered, copy), weights, most)
    side = rates.select(F.struct(*rates.columns).alias(rate))
    copies = _copies(_identity(F.col("doc_id"), text_of(), F.col(copy)), rate)
    return (
        numbered.join(side, F.col("source").eqNullSafe(F.col(f"{rate}.source")))
        .withColumn(count, F.explode(F.array_repeat(F.lit(0), copies)))
        .select(*docs.columns)
    )
