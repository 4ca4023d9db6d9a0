"""Target-distribution importance resampling by bit-sliced sums.

A document's features (words and pairs of neighbouring words) are hashed into buckets. Its bucket
counts become bit planes: plane p has one bit a bucket, that of the count's binary digit p. The buckets'
gains, whole numbers, become signed bit planes likewise. The sum of count x gain over all buckets is
then exact: AND of a count plane and a gain plane, number of ones, times a power of two.

Texts are read once: a task writes its documents' planes and, as its last row, its counts per bucket,
so that the counts of the corpus are sums of one array a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tillworks.llm.common import text_of
from tillworks.operators.numbering import global_row_number
from tillworks.session import materialise

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
_SCALE = 1000  # gains and draws are thousandths, rounded down
#: Bytes of words: digits, lower-case letters and all but ASCII; A-Z count as a-z, all else as blank.
_FOLDED = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b > 0x7F else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLDED).split()


def feature_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    """The bucket of every word and of every two neighbours joined by one blank, repeats included."""
    single = list(map(zlib.crc32, words))
    opened = map(zlib.crc32, repeat(b" "), single[:-1])  # a CRC goes on from that of the bytes before
    pairs = list(map(zlib.crc32, words[1:], opened))
    return np.array(single + pairs, np.int64) % buckets


def _plane_bytes(buckets: int) -> int:
    return -(-buckets // 64) * 8


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Rows of 64-bit words: row p holds binary digit p of all values (not negative), least first."""
    digits = max(1, int(values.max(initial=0)).bit_length())
    planes = np.zeros((digits, _plane_bytes(len(values))), np.uint8)
    for p in range(digits):
        packed = np.packbits((values >> p & 1).astype(np.uint8), bitorder="little")
        planes[p, : len(packed)] = packed
    return planes.view("<u8")


def signed_planes(gains: np.ndarray) -> np.ndarray:
    """Planes of the gains above zero, and of those below, negated: shape (2, digits, words)."""
    both = [bit_planes(np.maximum(gains, 0)), bit_planes(np.maximum(-gains, 0))]
    digits = max(map(len, both))
    return np.stack([np.pad(b, ((0, digits - len(b)), (0, 0))) for b in both])


def sliced_sum(counts: np.ndarray, gains: np.ndarray) -> int:
    """The sum of count x gain over all buckets, from their planes."""
    total = 0
    for p, plane in enumerate(counts):
        ones = np.bitwise_count(plane & gains).sum(axis=-1, dtype=np.int64)
        total += sum(int(a - b) << (p + q) for q, (a, b) in enumerate(ones.T))
    return total


_SLICED = pa.schema(
    {"doc_id": pa.int64(), "n_words": pa.int64(), "n_features": pa.int64(), "planes": pa.binary(), "totals": pa.list_(pa.int64())}
)
_SLICED_DDL = "doc_id long, n_words long, n_features long, planes binary, totals array<long>"


def _slicer(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, press = None, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = words_of(text)
                    found = feature_buckets(words, buckets)
                    counts = np.bincount(found, minlength=buckets)
                    totals = counts if totals is None else totals + counts
                    rows.append((doc, len(words), len(found), press.compress(bit_planes(counts).tobytes()), None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SLICED, strict=True)], schema=_SLICED)
        if totals is not None:
            last = [[None], [None], [None], [None], [totals.tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(last, _SLICED, strict=True)], schema=_SLICED)

    return run


def sliced(docs: DataFrame, doc_id: Column, buckets: int, label: str) -> DataFrame:
    """Written rows: one a document with its planes, and one a task with only its `totals`."""
    rows = docs.select(doc_id.cast("long").alias("doc_id"), text_of().alias("text"))
    return materialise(rows.mapInArrow(_slicer(buckets), _SLICED_DDL), label)


def _bucket_counts(rows: DataFrame, name: str) -> DataFrame:
    each = rows.filter(F.col("totals").isNotNull()).select(F.posexplode("totals").alias("bucket", "n"))
    return each.groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(rows: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Per bucket floor(1000 ln of the smoothed share in the target over that in the corpus). `buckets`
    whole numbers come to the driver, whatever the size of the input."""
    both = (
        rows.sparkSession.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(_bucket_counts(rows, "s"), "bucket", "left")
        .join(_bucket_counts(target, "t"), "bucket", "left")
        .na.fill(0, ["s", "t"])
    )
    sums = materialise(both, "importance-buckets")
    of = sums.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    one = F.lit(1.0)
    ratio = (F.col("t") + one) * F.lit(float(of["s"] + buckets)) / ((F.col("s") + one) * F.lit(float(of["t"] + buckets)))
    gains = sums.select("bucket", F.floor(_SCALE * F.log(ratio)).alias("gain")).orderBy("bucket").collect()
    return np.array([g["gain"] for g in gains], np.int64)


_WEIGHED = pa.schema({"doc_id": pa.int64(), "n_words": pa.int64(), "n_features": pa.int64(), "weight": pa.int64()})


def _weigher(gains: np.ndarray) -> Callable:
    signed = signed_planes(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            doc_ids, words, features, planes = batch.columns
            weights = []
            for n, data in zip(features.to_pylist(), planes, strict=True):
                counts = np.frombuffer(press.decompress(data.as_buffer()), "<u8").reshape(-1, signed.shape[-1])
                weights.append(sliced_sum(counts, signed) // n if n else 0)
            yield pa.RecordBatch.from_arrays([doc_ids, words, features, pa.array(weights, pa.int64())], schema=_WEIGHED)

    return run


def _draw(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id's hash; a null id draws as the text null."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(_SCALE)) * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))


def importance(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_features, weight, score, rank.

    weight is the floored mean gain of the features, 0 without any; score adds noise from the doc_id.
    Of the documents with `least_words` words or more, floor(percent of them) with the highest scores
    are drawn and numbered 1, 2, 3 ..; rank is null for all others. Ties go to the smaller doc_id, null
    last; repeated doc_ids draw alike, and among their ties the fewer features win. Null text counts as
    empty. An empty target counts 0 in all buckets; an empty `docs` gives an empty result. Only doc_id
    and text are read, of `target` only text."""
    rows = sliced(docs, F.col("doc_id"), buckets, "importance-planes")
    wanted = sliced(target, F.lit(None), buckets, "importance-target")
    gains = bucket_gains(rows, wanted, buckets)
    weighed = rows.filter(F.col("totals").isNull()).drop("totals").mapInArrow(_weigher(gains), "doc_id long, n_words long, n_features long, weight long")
    scored = materialise(weighed.withColumn("score", F.col("weight") + _draw(F.col("doc_id"), seed)), "importance-scores")
    enough = F.col("n_words") >= least_words
    drawn = scored.filter(enough).count() * percent // 100
    order = [enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = global_row_number(scored, *order, name="n")
    rank = F.when(enough & (F.col("n") <= drawn), F.col("n"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
