"""Exact dedup by two-pass Bloom filtering.

Pass 1 hashes every row to two buckets of a bit table and finds the buckets that two or more rows
hit. Pass 2 tests each row against these: a row with a bucket that is hit once is alone and passes
straight through; only possibly repeated rows are shuffled and grouped by their SHA-256.

The table has 16 bits a row up to `MAX_BITS`. Beyond that more rows are shuffled, as narrow
(digest, id) rows; the result is exact at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillworks.llm.common import spare, text_of
from tillworks.session import materialise

_SEGMENT = 1 << 16  # buckets of one segment; its bitmap has 8 KB
MAX_BITS = 1 << 29  # the broadcast bitmaps have 64 MB at most


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch and segment: the buckets hit once and those hit more often, as sorted offsets."""
    for batch in batches:
        hits = np.concatenate([batch.column(i).to_numpy() for i in (0, 1)])
        if not len(hits):
            continue
        buckets, counts = np.unique(hits, return_counts=True)
        segments = buckets // _SEGMENT
        offsets = (buckets % _SEGMENT).astype("<u2")
        starts = np.flatnonzero(np.diff(segments, prepend=-1))
        once, more = [], []
        for lo, hi in zip(starts, [*starts[1:], len(buckets)], strict=True):
            single = counts[lo:hi] == 1
            once.append(offsets[lo:hi][single].tobytes())
            more.append(offsets[lo:hi][~single].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(segments[starts].astype("i4")), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
            names=["segment", "once", "more"],
        )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment, so one segment's counts are held at a time."""
    now, counts = None, np.zeros(_SEGMENT, "u1")

    def done():
        return pa.RecordBatch.from_pydict(
            {"segment": pa.array([now], pa.int32()), "bits": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())}
        )

    for batch in batches:
        for segment, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment != now:
                if now is not None:
                    yield done()
                now, counts = segment, np.zeros(_SEGMENT, "u1")
            hit = np.frombuffer(once, "<u2")
            counts[hit] = np.minimum(counts[hit] + 1, 2)
            counts[np.frombuffer(more, "<u2")] = 2
    if now is not None:
        yield done()


def _hashed(docs: DataFrame, *keep: str, sha: str) -> DataFrame:
    return docs.select(*keep, F.sha2(text_of().cast("binary"), 256).alias(sha))


def _buckets(sha: str, bits: int) -> tuple[Column, Column]:
    """Two different buckets, from the first 28 of the digest's 64 digits."""
    one, two = (F.conv(F.substring(sha, at, 14), 16, 10).cast("long") % bits for at in (1, 15))
    return one, F.when(one == two, (two + 1) % bits).otherwise(two)


def _flagged(hashed: DataFrame, bitmaps: DataFrame, bits: int, sha: str, flag: str) -> DataFrame:
    """Add `flag`: two or more rows hit both buckets of the row, so its text may be repeated."""
    seen = F.lit(True)
    out = hashed
    for i, bucket in enumerate(_buckets(sha, bits)):
        segment, bitmap = spare(out.columns, f"s{i}"), spare(out.columns, f"m{i}")
        # the bitmaps have MAX_BITS / 8 bytes at most
        side = F.broadcast(bitmaps.select(F.col("segment").alias(segment), F.col("bits").alias(bitmap)))
        out = out.join(side, (bucket / _SEGMENT).cast("int") == F.col(segment))
        at = (bucket % _SEGMENT).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
        seen = seen & (F.getbit(byte.cast("int"), 7 - at % 8) == 1)
    return out.select(*hashed.columns, seen.alias(flag))


def _repeated_buckets(hashed: DataFrame, rows: int, max_bits: int) -> tuple[DataFrame, int]:
    bits = min(max_bits, 1 << max(16, (16 * rows - 1).bit_length()))
    one, two = _buckets("sha", bits)
    bitmaps = (
        hashed.select(one.alias("b0"), two.alias("b1"))
        .mapInArrow(_partial_counts, "segment int, once binary, more binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(_bitmaps, "segment int, bits binary")
    )
    return materialise(bitmaps, "dedup-bitmaps"), bits


def exact_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group; the row with the largest doc_id stays (a null id is the smallest).
    Rows that repeat both text and doc_id are in one group too, and exactly one of them is kept.
    Null text counts as empty. An empty table gives an empty result; other columns are ignored."""
    hashed = materialise(
        _hashed(docs, "doc_id", sha="sha").withColumn("uid", F.monotonically_increasing_id()), "dedup-rows"
    )
    tested = _flagged(hashed, *_repeated_buckets(hashed, hashed.count(), max_bits), "sha", "again")
    groups = materialise(
        tested.filter("again")
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "uid")).alias("best"))
        .filter("n > 1"),
        "dedup-groups",
    )
    # only these rows are shuffled; a hot group's rows are dealt again by adaptive execution
    repeated = tested.filter("again").join(groups, "sha", "left")
    single = tested.filter("not again").withColumns(
        {c: F.lit(None).cast(groups.schema[c].dataType) for c in ("n", "best")}
    )
    alone = F.col("n").isNull()
    return repeated.unionByName(single).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.when(alone, 1).otherwise(F.col("n")).cast("long").alias("group_size"),
        (alone | (F.col("uid") == F.col("best.uid"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one row of each group of equal texts, by the rules of `exact_groups`.

    All columns are kept, whatever their names. Of rows that repeat text and doc_id, the one with
    the smallest values in the other columns stays."""
    sha, again = spare(docs.columns, "sha"), spare(docs.columns, "again")
    rows = docs.withColumn(sha, F.sha2(text_of().cast("binary"), 256))
    hashed = materialise(rows.select("doc_id", F.col(sha).alias("sha")), "dedup-rows")
    bitmaps, bits = _repeated_buckets(hashed, hashed.count(), max_bits)
    best = materialise(
        _flagged(hashed, bitmaps, bits, "sha", "again")
        .filter("again")
        .groupBy("sha")
        .agg(F.max(F.struct(F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("sha").alias("k"), F.col("best.doc_id").alias("id")),
        "dedup-groups",
    )
    flagged = _flagged(rows, bitmaps, bits, sha, again)
    maybe = flagged.filter(F.col(again)).select(F.struct(*docs.columns).alias("row"), F.col(sha).alias("sha"))
    joined = maybe.join(best, F.col("sha") == F.col("k"), "left")
    alone = joined.filter("k is null").select("row.*")
    winners = joined.filter("k is not null and row.doc_id <=> id").groupBy("sha").agg(F.min("row").alias("row")).select("row.*")
    return flagged.filter(~F.col(again)).select(*docs.columns).unionAll(alone).unionAll(winners)
