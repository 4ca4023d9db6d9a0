"""Byte-level BPE over rank files, by recursive queries of DuckDB inside the tasks.

A worker keeps one DuckDB connection with two tables: the vocabulary, and every pair of tokens whose
bytes together are a token again. New words of a batch become rows (word, position, token), one a byte;
the recursive query joins neighbours with the pairs and contracts in every word the leftmost pair of the
least rank, until no word has one. Decoding joins ids with the vocabulary and puts the pieces together
by an ordered aggregate.

A long match would take as many rounds as it has bytes. It is cut into parts, the parts are encoded as words, and neighbours are joined in a tree: the last tokens of one part and the first of
the next are encoded again as one word. If the outer tokens of that window come out unchanged, the joined
sequence is the encoding, because BPE sequences are valid exactly when every two neighbours are, which
holds for vocabularies whose every entry encodes to itself (checked before the first long match; without
it, long matches are not cut). Otherwise the window grows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tillworks.llm.common import text_of

PART = 48  # bytes
_RUN = regex.compile(r"(.)\1{47,}", regex.DOTALL)  # one character, repeated
_WINDOW = 8  # tokens on each side of a cut, doubled until it fits
_CACHE = 120_000  # words whose ids a worker remembers, twice
_BATCH_BYTES = 4 << 20
_BLOCK = 200_000  # matches, or ids, of one document that are held at once

# g = word << 32 | position; positions of a word are gapless, so its neighbour is g + 1
_PLACE = "& 4294967295"
_LEFTMOST = f"""
WITH RECURSIVE step(n, g, tok) AS (
  SELECT 0, g, tok FROM start
  UNION ALL
  (WITH best AS (
     SELECT x.g >> 32 AS word, min((p.id::BIGINT << 32) + (x.g {_PLACE})) AS k
     FROM step x JOIN step y ON y.g = x.g + 1 JOIN pairs p ON p.both = (x.tok::BIGINT << 32) + y.tok
     GROUP BY x.g >> 32)
   SELECT n + 1,
     CASE WHEN (s.g {_PLACE}) > (k {_PLACE}) THEN s.g - 1 ELSE s.g END,
     CASE WHEN (s.g {_PLACE}) = (k {_PLACE}) THEN (k >> 32)::INT ELSE s.tok END
   FROM step s JOIN best ON s.g >> 32 = best.word WHERE (s.g {_PLACE}) <> (k {_PLACE}) + 1)
)"""
# all pairs of a word's least rank in one round, every other one where they overlap: for long runs
_EVERY = f"""
WITH RECURSIVE step(n, g, tok) AS (
  SELECT 0, g, tok FROM start
  UNION ALL
  (WITH found AS (
     SELECT x.g, p.id FROM step x JOIN step y ON y.g = x.g + 1 JOIN pairs p ON p.both = (x.tok::BIGINT << 32) + y.tok),
   least AS (SELECT g >> 32 AS word, min(id) AS id FROM found GROUP BY g >> 32),
   chained AS (
     SELECT f.g, f.id, f.g - row_number() OVER (ORDER BY f.g) AS run
     FROM found f JOIN least l ON l.word = f.g >> 32 AND l.id = f.id),
   chosen AS (
     SELECT g, id FROM (SELECT g, id, row_number() OVER (PARTITION BY run ORDER BY g) AS k FROM chained) WHERE k % 2 = 1),
   marked AS (
     SELECT s.n, s.g, coalesce(a.id, s.tok) AS tok, b.g IS NOT NULL AS gone
     FROM step s JOIN least l ON l.word = s.g >> 32
     LEFT JOIN chosen a ON a.g = s.g LEFT JOIN chosen b ON b.g = s.g - 1)
   SELECT n + 1, g - moved::BIGINT, tok
   FROM (SELECT *, sum(gone::INT) OVER (PARTITION BY g >> 32 ORDER BY g ROWS UNBOUNDED PRECEDING) AS moved FROM marked) WHERE NOT gone)
)"""
_LAST = """,
last AS (SELECT g >> 32 AS word, max(n) AS n FROM step GROUP BY 1)
SELECT (step.g >> 32)::INT AS word, tok FROM step JOIN last ON last.word = step.g >> 32 AND last.n = step.n ORDER BY step.g"""
_DECODE = """
SELECT block, array_to_string(list(piece ORDER BY place), '') AS text
FROM encoded JOIN vocabulary USING (id) GROUP BY block ORDER BY block"""


def _parts(word: bytes) -> list[bytes]:
    """Runs of one character in whole (they take few rounds, and cuts would fall out of step), and the
    rest in parts of bounded size."""
    text, out, at = word.decode(), [], 0
    for run in [*_RUN.finditer(text), None]:
        rest = text[at : run.start() if run else None].encode()
        out += [rest[i : i + PART] for i in range(0, len(rest), PART)]
        if run:
            out.append(run.group().encode())
            at = run.end()
    return out


class Coder:
    """Encodes and decodes with the ranks of one file and the pattern that cuts texts into words."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # a task's share of memory is small and no local disk is shared: one thread, no spilling
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        # pieces as text with one character a byte
        table = pa.table({"id": pa.array(ranks.values(), pa.int32()), "piece": [p.decode("latin-1") for p in ranks]})
        self.db.register("given", table)
        self.db.execute("CREATE TABLE vocabulary AS SELECT id, piece FROM given ORDER BY id")
        self.db.unregister("given")
        self.db.execute("""
            CREATE TABLE pairs AS
            SELECT (l.id::BIGINT << 32) + r.id AS both, x.id
            FROM (SELECT id, piece, unnest(range(1, length(piece))) AS k FROM vocabulary) x
            JOIN vocabulary l ON l.piece = substr(x.piece, 1, k) JOIN vocabulary r ON r.piece = substr(x.piece, k + 1)""")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        """The ids of every word as little-endian 32-bit integers."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tokens = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        self.db.register("start", pa.table({"g": (word << 32) + place, "tok": tokens}))
        found = self.db.sql(query + _LAST).to_arrow_table()
        self.db.unregister("start")
        ends = np.searchsorted(found["word"].to_numpy(), np.arange(len(words)), "right") * 4
        ids, ends = found["tok"].to_numpy().astype("<u4").tobytes(), ends.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    @cached_property
    def closed(self) -> bool:
        """Every entry encodes to itself."""
        ids = list(self.pieces)
        found = self._contract([self.pieces[i] for i in ids], _LEFTMOST)
        return all(f == i.to_bytes(4, "little") for i, f in zip(ids, found, strict=True))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word (not empty)."""
        if all(len(w) <= PART for w in words):
            return self._contract(words, _LEFTMOST)
        if not self.closed:
            return [ids for w in words for ids in self._contract([w], _LEFTMOST)]
        parts = [_parts(w) for w in words]
        flat = [p for found in parts for p in found]
        ids = iter(self._in_blocks(flat))
        coded = [[np.frombuffer(next(ids), "<u4") for _ in found] for found in parts]
        while any(len(c) > 1 for c in coded):
            pairs = [(w, at) for w, c in enumerate(coded) for at in range(0, len(c) - 1, 2)]
            joined = iter(self._joined([tuple(coded[w][at : at + 2]) for w, at in pairs]))
            coded = [[next(joined) if at + 1 < len(c) else c[at] for at in range(0, len(c), 2)] for c in coded]
        return [c[0].tobytes() for c in coded]

    def _in_blocks(self, words: list[bytes]) -> list[bytes]:
        """Words in blocks of bounded bytes; those longer than two parts by whole rounds."""
        out = [b""] * len(words)
        for query, chosen in (
            (_LEFTMOST, [i for i, w in enumerate(words) if len(w) <= 2 * PART]),
            (_EVERY, [i for i, w in enumerate(words) if len(w) > 2 * PART]),
        ):
            block, held = [], 0
            for i in [*chosen, None]:
                if i is None or held + len(words[i]) > 100_000:
                    for j, ids in zip(block, self._contract([words[j] for j in block], query), strict=True):
                        out[j] = ids
                    block, held = [], 0
                if i is not None:
                    block.append(i)
                    held += len(words[i])
        return out

    def _joined(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The encodings of the bytes of two neighbouring encodings each."""
        out: list[np.ndarray | None] = [None] * len(pairs)
        size, left = _WINDOW, range(len(pairs))
        while left:
            windows = [np.concatenate([pairs[i][0][-size:], pairs[i][1][:size]]) for i in left]
            raw = [b"".join(map(self.pieces.__getitem__, w.tolist())) for w in windows]
            failed = []
            for i, window, ids in zip(left, windows, self._in_blocks(raw), strict=True):
                (a, b), new = pairs[i], np.frombuffer(ids, "<u4")
                if (len(a) > size and new[0] != window[0]) or (len(b) > size and new[-1] != window[-1]):
                    failed.append(i)
                else:
                    out[i] = np.concatenate([a[:-size], new, b[size:]])
            size, left = size * 2, failed
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of the words. Short ones are remembered in two generations: when the younger is full
        it becomes the older, so that frequent words stay."""
        if len(self.known) > _CACHE:
            self.known, self.older = {}, self.known
        new = words.difference(self.known)
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        new = list(new - again)
        raw = [w.encode() for w in new]
        if all(len(r) <= PART for r in raw):
            self.known.update(zip(new, self.encode_words(raw), strict=True))
            return self.known
        short, long = [], []
        for word, r in zip(new, raw, strict=True):
            (short if len(r) <= PART else long).append((word, r))
        self.known.update(zip([w for w, _ in short], self.encode_words([r for _, r in short]), strict=True))
        return self.known | dict(zip([w for w, _ in long], self.encode_words([r for _, r in long]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian 32-bit integers."""
        out = []
        long = [len(t) > _BLOCK for t in texts]
        found = [[] if far else self.pattern.findall(t) for t, far in zip(texts, long, strict=True)]
        ids_of = self._learn(set().union(*found))
        for text, far, words in zip(texts, long, found, strict=True):
            if far:
                matches, parts = (m.group() for m in self.pattern.finditer(text)), []
                while block := list(islice(matches, _BLOCK)):
                    parts.append(b"".join(map(self._learn(set(block)).__getitem__, block)))
                out.append(b"".join(parts))
            else:
                out.append(b"".join(map(ids_of.__getitem__, words)))
        return out

    def decode(self, encoded: list[bytes]) -> Iterator[list[bytes]]:
        """The bytes of each encoded text, in blocks of bounded size."""
        ids = [np.frombuffer(e, "<u4") for e in encoded]
        blocks = [(d, i[at : at + _BLOCK]) for d, i in enumerate(ids) for at in range(0, len(i), _BLOCK)]
        out: list[list[bytes]] = [[] for _ in encoded]
        at = 0
        while at < len(blocks):
            end, held = at, 0
            while end < len(blocks) and held < _BLOCK:
                held += len(blocks[end][1])
                end += 1
            part = blocks[at:end]
            table = pa.table(
                {
                    "block": np.repeat(np.arange(len(part)), [len(i) for _, i in part]),
                    "place": np.arange(held),
                    "id": np.concatenate([i for _, i in part]).astype(np.int32),
                }
            )
            self.db.register("encoded", table)
            texts = self.db.sql(_DECODE).to_arrow_table()["text"].to_pylist()
            self.db.unregister("encoded")
            for (d, _), text in zip(part, texts, strict=True):
                out[d].append(text.encode("latin-1"))
            at = end
        yield from out


@lru_cache(1)
def coder(path: str, pattern: str) -> Coder:
    """One a worker, for all of its tasks."""
    return Coder(path, pattern)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(1, int(batch.num_rows * _BATCH_BYTES / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _encoder(path: str, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for batch in _slices(batches):
            ids = [np.frombuffer(e, "<u4").astype(np.int32) for e in code.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every row. Null text counts as empty, and empty text has no ids; special
    tokens' strings are ordinary text. Repeated rows are encoded alike, null doc_ids stay; an empty
    table gives an empty result. Only doc_id and text are read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_encoder(path, pattern), "doc_id long, ids array<int>")


def _decoder(path: str, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for batch in _slices(batches):
            ids = [b"" if e is None else np.array(e, "<u4").tobytes() for e in batch.column(1).to_pylist()]
            raw = [b"".join(parts) for parts in code.decode(ids)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "content"])

    return run


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and content, the bytes of the ids, of every row of (doc_id, ids); null ids count as none."""
    return rows.select("doc_id", "ids").mapInArrow(_decoder(path, pattern), "doc_id long, content binary")


def _digester(path: str, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for batch in _slices(batches):
            ids = code.encode(batch.column(1).to_pylist())
            sums = []
            for parts in code.decode(ids):
                digest = hashlib.sha256()
                for part in parts:
                    digest.update(part)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(e) // 4 for e in ids], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in ids]),
                    pa.array(sums),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 (what the ids decode to). Encodes and decodes in one task, so that ids don't pass
    through Spark; nulls and empty tables as for `encoded`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_digester(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
