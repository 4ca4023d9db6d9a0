"""Sharding by vector bin packing over bytes, tokens and rows.

Groups are equal texts. Groups above 1/FINE of a shard in any measure are placed one by one (there
are at most 3 * shards * FINE of these) and smaller ones in BUNDLES hashed bundles; a group stays whole
unless its bytes are more than a shard's, and only then is split into pieces of 1/COARSE of a shard. So
the greedy placement sees a number of items that does not depend on the input: largest first, each where
the dot product with the residual capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillworks.llm.common import text_of, word_count
from tillworks.operators.numbering import global_row_number
from tillworks.session import materialise

FINE, COARSE, BUNDLES = 250, 32, 4096
#: Bytes come first, as their balance is the law that is promised.
MEASURE_WEIGHTS = {"bytes": 4.0, "tokens": 1.0, "rows": 1.0}


def place(items: np.ndarray, shards: int, weights: np.ndarray) -> np.ndarray:
    """The shard of each item (rows of measures, bytes first): largest first, ties by position.

    Of the shards with room for the item's bytes, the one where the dot product of the item with the
    residual capacity is highest (ties: the lowest); if none has room, the one with most room."""
    total = items.sum(axis=0)
    scaled = items / np.where(total > 0, total / shards, 1) * np.sqrt(weights)
    residual = np.tile(np.sqrt(weights) * (total > 0), (shards, 1))
    out = np.zeros(len(items), "i4")
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        room = residual[:, 0] >= scaled[i, 0]
        fit = np.where(room, residual @ scaled[i], -np.inf) if room.any() else residual[:, 0]
        out[i] = at = int(np.argmax(fit))
        residual[at] -= scaled[i]
    return out


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes (null: none) plus 16. Equal texts stay together unless their
    group has more bytes than a shard. Slots number a shard's rows by doc_id from 0 (null ids
    first, repeated ids in any order), for any number of rows. An empty table gives an empty result."""
    spark = docs.sparkSession
    text = text_of()
    rows = materialise(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("bytes"),
            word_count(text).alias("tokens"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.md5(text.cast("binary")).alias("group"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard-rows",
    )
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    measures = list(MEASURE_WEIGHTS)
    shares = {m: F.col(m) * shards / F.lit(float(total[m] or 1)) for m in measures}
    pieces = F.when(shares["bytes"] > 1, F.ceil(shares["bytes"] * COARSE)).otherwise(1)
    large = materialise(
        rows.groupBy("group").agg(*sums).filter(F.greatest(*shares.values()) * FINE > 1)
        .select(F.col("group").alias("large"), pieces.cast("int").alias("pieces")),
        "shard-large",
    )
    piece = F.pmod(F.xxhash64("uid"), F.col("pieces")).cast("string")
    bundle = F.pmod(F.xxhash64("group"), F.lit(BUNDLES)).cast("string")
    # at most 3 * shards * FINE rows, as each has that part of a total
    keyed = rows.join(F.broadcast(large), F.col("group") == F.col("large"), "left").withColumn(
        "item", F.when(F.col("large").isNull(), bundle).otherwise(F.concat_ws(":", "group", piece))
    )
    items = sorted(tuple(r) for r in keyed.groupBy("item").agg(*sums).collect())
    vectors = np.array([i[1:] for i in items], float).reshape(-1, len(measures))
    where = place(vectors, shards, np.array(list(MEASURE_WEIGHTS.values())))
    placed = spark.createDataFrame([(i[0], int(s)) for i, s in zip(items, where, strict=True)], "item string, shard int")
    # as many rows as items
    dealt = keyed.join(F.broadcast(placed), "item").select("shard", "doc_id", "uid", "bytes", "crc")
    numbered = global_row_number(dealt, "shard", F.col("doc_id").asc_nulls_first(), "uid", name="n")
    starts = numbered.groupBy("shard").agg(F.min("n").alias("start"))  # one row a shard
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id",
        F.col("bytes").alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("n") - F.col("start")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
