"""Token-ID files: documents as separately compressed zstandard frames that share a dictionary.

File layout, little-endian: MAGIC; the dictionary's SHA-256 (32 bytes); the number of documents (u8);
the index, documents + 1 entries of (ids before, byte offset) (u8, u8); then one frame a document
over its u4 ids. A short document is read with two index entries and one frame. The dictionary lies
beside the files, named by its hash, and is trained on a bounded sample of id arrays.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from tillworks.llm.common import bounded_sample, text_of
from tillworks.session import materialise, scratch_path

MAGIC = b"TWIDS\0\1\0"
END_ID = 0
#: The dictionary's only: size, and the sample it is trained on.
DICTIONARY_BYTES, SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 65_536, 512, 6_000
FILE_BYTES = 32 << 20  # a file is closed after the document that passes this
_CACHE = 300_000  # segments whose ids a worker remembers, twice
_TOGETHER = 400  # new segments of one text
_MARKS = ".,;:!?"
#: White space as in the tokenizer's own pattern.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Cuts where the pattern always cuts too: before the last blank of a run, around other white space, and
#: before a mark that follows a letter or digit.
_SEGMENTS = re.compile(
    f" ?[^{_WHITE}{_MARKS}]+(?:(?<![^\\W_])[{_MARKS}][^{_WHITE}]*)?| ?[{_MARKS}][^{_WHITE}]*|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]"
)


class Encoder:
    """Ids of texts as little-endian bytes. Segments that the tokenizer never joins are encoded by
    the tokenizers library and remembered in two generations; when the younger is full it becomes
    the older, so frequent segments stay. A text is the concatenation of its segments; a text with a
    special token's string goes through the library in whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the library cuts these out before anything else, so that white space beside them ends a text
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        (self.line_end,) = self.tokenizer.encode("\n").ids
        (blank,) = self.tokenizer.encode(" ").tokens  # how the vocabulary writes a blank
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(blank)]] = True

    def _recall(self, segments: set[str]) -> None:
        """Keep those of the older generation."""
        again = segments.difference(self.known).intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))

    def _encode(self, new: set[str]) -> None:
        """Many segments as one text: those that begin with a blank side by side, as only their first token
        begins with one; others on lines, as a line end between words is a token by itself."""
        blank, lined, white = [], [], []
        for s in new:
            (white if s[-1].isspace() else blank if s[0] == " " else lined).append(s)
        for segments, between in ((blank, ""), (lined, "\n")):
            for at in range(0, len(segments), _TOGETHER):
                part = segments[at : at + _TOGETHER]
                (found,) = self.tokenizer.encode_batch_fast([between.join(part)], add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                data = ids.tobytes()
                if between:
                    ends = np.flatnonzero(ids == self.line_end) * 4
                    starts, ends = [0, *(ends + 4).tolist()], [*ends.tolist(), len(data)]
                else:
                    starts = (np.flatnonzero(self.begins[ids]) * 4).tolist()
                    ends = [*starts[1:], len(data)]
                if len(starts) != len(part):
                    raise ValueError("this tokenizer joins words")
                self.known.update(zip(part, [data[a:b] for a, b in zip(starts, ends, strict=True)], strict=True))
        for s, e in zip(white, self.tokenizer.encode_batch_fast(white, add_special_tokens=False), strict=True):
            self.known[s] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _CACHE:
            self.known, self.older = {}, self.known
        special = [self.added is not None and self.added.search(t) is not None for t in texts]
        segments = [[] if s else _SEGMENTS.findall(t) for t, s in zip(texts, special, strict=True)]
        missing = set().union(*segments)
        self._recall(missing)
        self._encode(missing.difference(self.known))
        known = self.known.__getitem__
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if s else b"".join(map(known, found))
            for t, s, found in zip(texts, special, segments, strict=True)
        ]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One a worker, for all of its tasks."""
    return Encoder(path)


def train_dictionary(samples: list[bytes]) -> bytes:
    """The shared dictionary; without enough samples to train on, their plain content."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if len(content) >= 8 else None


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _put(folder: str, name: str, parts: list[bytes]) -> None:
    store, base = _open(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{name}") as out:
        for part in parts:
            out.write(part)


def _small_batches(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about `size` bytes, so that what a task holds is bounded."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _writer(folder: str, tokenizer_path: str, dictionary: bytes) -> Callable:
    digest = hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        press = zstandard.ZstdCompressor(dict_data=_dictionary(dictionary))
        end = struct.pack("<I", END_ID)
        ids, frames, counts, part, number, held = [], [], [], None, 0, 0

        def close() -> pa.RecordBatch:
            # a name of its own for every attempt: only files that a finished task lists are read
            name = f"ids-{part:06d}-{number:04d}-{uuid.uuid4().hex}.bin"
            at = len(MAGIC) + 40 + 16 * (len(frames) + 1)
            index = np.zeros((len(frames) + 1, 2), "<u8")
            index[1:, 0] = np.cumsum(counts)
            index[0, 1] = at
            index[1:, 1] = at + np.cumsum([len(f) for f in frames])
            _put(folder, name, [MAGIC, digest, struct.pack("<Q", len(frames)), index.tobytes(), *frames])
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "name": [name], "n_ids": pa.array([sum(counts)], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64()))}
            )

        for batch in _small_batches(batches):
            texts = batch.column(1).to_pylist()
            part = batch.column(2)[0].as_py()
            for doc, data in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids.append(doc)
                frames.append(press.compress(data + end))
                counts.append(len(data) // 4 + 1)
                held += len(frames[-1])
                if held > FILE_BYTES:
                    yield close()
                    ids, frames, counts, number, held = [], [], [], number + 1, 0
        if ids:
            yield close()

    return write


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Write all documents' ids below `folder` in ascending doc_id order (null ids first, repeated
    ids in any order); return the file list: part, number, name, n_ids, doc_ids, base (ids before).

    Null text counts as empty: its frame holds the end id only. An empty table writes no file."""
    dictionary = train_dictionary(Encoder(tokenizer_path).encode(bounded_sample(docs, SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS)))
    _put(folder, f"{hashlib.sha256(dictionary).hexdigest()}.zdict", [dictionary])
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("i"), text_of().alias("t"))
        .repartitionByRange("i")
        .sortWithinPartitions("i")
        .withColumn("p", F.spark_partition_id())
    )
    schema = "part int, number int, name string, n_ids long, doc_ids array<long>"
    files = materialise(ordered.mapInArrow(_writer(folder, tokenizer_path, dictionary), schema), "id-files")
    # what stands before each partition: one row a shuffle partition passes through the driver
    before, starts = 0, []
    for part, n in sorted(tuple(r) for r in files.groupBy("part").agg(F.sum("n_ids")).collect()):
        starts.append((part, before))
        before += n
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside"))
    found = files.join(offsets, ["part", "number"]).join(files.sparkSession.createDataFrame(starts, "part int, start long"), "part")
    return found.withColumn("base", F.col("start") + F.col("inside")).drop("start", "inside")


class IdFile:
    """Random access to one file: `read(k)` decompresses document k only."""

    def __init__(self, folder: str, name: str):
        store, base = _open(folder)
        self.source = store.open_input_file(f"{base}/{name}")
        head = self.source.read_at(len(MAGIC) + 40, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{name} is not a token-id file")
        digest = head[len(MAGIC) : len(MAGIC) + 32]
        with store.open_input_stream(f"{base}/{digest.hex()}.zdict") as given:
            dictionary = given.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"the dictionary of {name} has changed")
        (self.documents,) = struct.unpack("<Q", head[-8:])
        self.index = np.frombuffer(self.source.read_at(16 * (self.documents + 1), len(head)), "<u8").reshape(-1, 2)
        self.press = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def read(self, k: int) -> bytes:
        (_, at), (_, end) = self.index[k : k + 2].tolist()
        return self.press.decompress(self.source.read_at(end - at, at))

    def close(self) -> None:
        self.source.close()


def _reader(folder: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base, doc_ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file = IdFile(folder, name)
                for at in range(0, file.documents, 2_000):
                    part = range(at, min(at + 2_000, file.documents))
                    data = [file.read(k) for k in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[part.start : part.stop], pa.int64()),
                            pa.array([base + int(file.index[k, 0]) for k in part], pa.int64()),
                            pa.array([len(x) // 4 for x in data], pa.int64()),
                            pa.array([zlib.crc32(x) for x in data], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                file.close()

    return read


def read_digests(files: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens (with the end id), ids_crc32. A task for
    each file, while there are no more than a few tasks a core: the list of files is short, so its own
    size must not decide."""
    tasks = min(files.count(), 16 * files.sparkSession.sparkContext.defaultParallelism)
    listed = files.select("name", "base", "doc_ids").repartition(max(tasks, 1))
    return listed.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_id_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the files to the shared folder and read every document back."""
    folder = scratch_path(docs.sparkSession, "ids")
    return read_digests(write_ids(docs, folder, tokenizer_path), folder)
