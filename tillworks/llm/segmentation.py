"""SentencePiece encoding and decoding: Gumbel top-k segmentations without replacement.

The paths of a text's lattice are searched best first by perturbed log-probability. A region of the
search is a suffix of a path, the edges excluded before it, and any beginning; its mass is known from
the lattice's forward sums, so its best perturbed score is one truncated Gumbel draw. Taking the best
region gives the next distinct segmentation, whose positions split what is left into new regions. The
first k paths are a sample without replacement; the next best score is the threshold of the
inclusion scores. All draws hash the row key, the sample and the position.

Lattices of segments (see `unigram`) are remembered by a worker as flat arrays of bounded bytes. The free
parts of all texts of a batch are drawn together, one edge of each segment at a time, and the searches of
all texts take their next path in the same round. Segments of more than `_LONG` characters, for which a
step of all segments would be a step of one, are gone through in plain arrays.
"""

from __future__ import annotations

import heapq
import math
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillworks.llm.common import text_of
from tillworks.llm.token_files import _small_batches
from tillworks.llm.unigram import UNIT, Vocabulary

_CACHE_BYTES = 240 << 20  # of lattices and their segments, that a worker remembers
_NEW = 250_000  # characters of new segments that are built together
_LONG = 256  # characters
_BATCH_BYTES = 1 << 20  # of text, drawn together
_BETWEEN = "\uffff"


def _uniform(key: np.ndarray) -> np.ndarray:
    """(0, 1) from 64-bit keys, by the SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        z = key + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(12)).astype("f8") + 0.5) * 2.0**-52


def _keys(base, purpose: int, position: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (np.asarray(base, "u8") ^ np.uint64(purpose * 0xD6E8FEB86659FD93 & (1 << 64) - 1)) + np.asarray(position).astype("u8") * np.uint64(0xA0761D6478BD642F)


class Lattices:
    """Lattices of the segments seen: rows are positions, holding the edges that end there with the
    probability that a random path through the position uses them."""

    def __init__(self, vocabulary: Vocabulary, temperature: float):
        self.vocabulary, self.temperature = vocabulary, temperature
        self.clear()

    def clear(self) -> None:
        self.first_row: dict[str, int] = {}  # a segment's row for position 0
        self.row_start = array("q", [0])
        self.key, self.chance, self.start, self.piece = array("d"), array("d"), array("i"), array("i")
        self.held = 0  # bytes of segments, with what a dictionary entry takes

    def bytes(self) -> int:
        return self.held + 8 * len(self.row_start) + 24 * len(self.key)

    def add(self, new: list[str]) -> None:
        """The lattices of new segments, in blocks of bounded size."""
        block, size = [], 0
        for segment in new:
            if len(segment) > _LONG:
                self._add_long(segment)
                continue
            block.append(segment)
            size += len(segment)
            if size > _NEW:
                self._add(block)
                block, size = [], 0
        if block:
            self._add(block)

    def _edges(self, text: str, rows: int, given: np.ndarray) -> tuple[np.ndarray, ...]:
        """(end, start, piece, score) of all edges by end; rows of `given` have none. A character that is
        no piece of its own is an unknown edge, the last of its row."""
        start, end, piece = self.vocabulary.trie.matches(text)
        single = np.zeros(rows, bool)
        single[end[end - start == 1]] = True
        single[given] = True
        alone = np.flatnonzero(~single)
        end, start = np.concatenate([end, alone]), np.concatenate([start, alone - 1])
        piece = np.concatenate([piece, np.full(len(alone), -1)])
        score = np.where(piece >= 0, self.vocabulary.score_of[piece], self.vocabulary.unknown_score) * (self.temperature / UNIT)
        order = np.argsort(end, kind="stable")  # short ones first
        return end[order], start[order], piece[order], score[order]

    def _keep(self, segments: list[str], begin: np.ndarray, row_start, key, chance, start, piece) -> None:
        first = len(self.row_start) - 1
        self.first_row.update(zip(segments, (begin + first).tolist(), strict=True))
        self.held += sum(200 + 4 * len(s) for s in segments)
        before = len(self.key)
        self.key.frombytes(key.tobytes())
        self.chance.frombytes(chance.tobytes())
        self.start.frombytes(start.astype("i4").tobytes())
        self.piece.frombytes(piece.astype("i4").tobytes())
        self.row_start.frombytes((row_start + before).astype("i8").tobytes())

    def _add(self, new: list[str]) -> None:
        """In one pass over all segments joined by a character of no piece: position p of a segment that
        begins at b there is row b + p."""
        lengths = np.array([len(s) for s in new], "i8")
        begin = np.concatenate([[0], np.cumsum(lengths + 1)])
        rows = int(begin[-1])
        begin_of = np.repeat(begin[:-1], lengths + 1)
        end, start, piece, score = self._edges(_BETWEEN.join(new), rows, begin[:-1])
        row_start = np.searchsorted(end, np.arange(rows + 1))
        chance, key = np.empty(len(end)), np.empty(len(end))
        forward = np.zeros(rows)
        depth = (end - begin_of[end]).astype("u2")  # sorted by digits
        by_depth = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.diff(depth[by_depth].astype("i4"), prepend=-1))
        first = len(self.row_start) - 1
        for lo, hi in zip(cuts, [*cuts[1:], len(by_depth)], strict=True):  # all rows of one position
            at = by_depth[lo:hi]
            heads = np.flatnonzero(np.diff(end[at], prepend=-1))
            counts = np.diff(np.r_[heads, len(at)])
            logs = forward[start[at]] + score[at]
            top = np.maximum.reduceat(logs, heads)
            share = np.exp(logs - np.repeat(top, counts))
            total = np.add.reduceat(share, heads)
            forward[end[at[heads]]] = top + np.log(total)
            share /= np.repeat(total, counts)
            chance[at] = share
            upto = np.cumsum(share)
            upto -= np.repeat(upto[heads] - share[heads], counts)
            upto[np.r_[heads[1:], len(at)] - 1] = 1.0
            key[at] = first + end[at] + np.minimum(upto, 1.0)
        self._keep(new, begin[:-1], row_start[1:], key, chance, start - begin_of[start], piece)

    def _add_long(self, segment: str) -> None:
        """The same for one long segment, position by position in plain numbers."""
        rows = len(segment) + 1
        end, start, piece, score = self._edges(segment, rows, np.zeros(1, "i8"))
        row_start = np.searchsorted(end, np.arange(rows + 1))
        first = len(self.row_start) - 1
        forward, chance, key = [0.0] * rows, [], []
        begins, scores, bounds = start.tolist(), score.tolist(), row_start.tolist()
        for row in range(1, rows):
            lo, hi = bounds[row], bounds[row + 1]
            logs = [forward[begins[e]] + scores[e] for e in range(lo, hi)]
            top = max(logs)
            shares = [math.exp(x - top) for x in logs]
            total = sum(shares)
            forward[row] = top + math.log(total)
            upto = 0.0
            for share in shares:
                share /= total
                upto += share
                chance.append(share)
                key.append(first + row + min(upto, 1.0))
            key[-1] = first + row + 1.0
        self._keep([segment], np.zeros(1, "i8"), row_start[1:], np.array(key), np.array(chance), start, piece)

    def rows_of(self, segments: list[str]) -> np.ndarray:
        known = self.first_row
        rows = np.fromiter(map(known.get, segments, repeat(-1)), "i8", len(segments))
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            new = [segments[i] for i in missing]
            self.add(list(dict.fromkeys(new)))
            rows[missing] = [known[s] for s in new]
        return rows


def _upto(key, edge: np.ndarray, last: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The first edge from `edge` to `last` whose key is above the target, or the last one. Rows hold
    few edges, so stepping through them touches less memory than a search over all rows."""
    on = np.flatnonzero((key[edge] <= target) & (edge < last))
    while len(on):
        edge[on] += 1
        on = on[(key[edge[on]] <= target[on]) & (edge[on] < last[on])]
    return edge


def _draw_long(views, row0: int, at: int, base, sample: int, offset: int) -> list[int]:
    """As `_draw`, for one long segment."""
    key, row_start, start = views["lattice"].key, views["lattice"].row_start, views["lattice"].start
    chances = _uniform(_keys(base, sample, offset + np.arange(at + 1))).tolist()
    edges = []
    while at > 0:
        row = row0 + at
        edge, last, target = row_start[row], row_start[row + 1] - 1, row + chances[at]
        while edge < last and key[edge] <= target:
            edge += 1
        edges.append(edge)
        at = start[edge]
    return edges


def _draw(views, row0: np.ndarray, at: np.ndarray, base: np.ndarray, sample: int, offset: np.ndarray):
    """Free paths, drawn backwards from position `at` of segments whose rows begin at `row0`.

    Returns the edges of all segments, backward within each, and where each segment's begin."""
    key, row_start, start = views["key"], views["row_start"], views["start"]
    count = np.zeros(len(row0), "i8")
    far = np.flatnonzero(at > _LONG).tolist()
    alone = {i: _draw_long(views, int(row0[i]), int(at[i]), base[i], sample, int(offset[i])) for i in far}
    for i, edges in alone.items():
        count[i] = len(edges)
    who = np.flatnonzero((at > 0) & (at <= _LONG))
    at = at[who]
    steps = []
    while len(who):
        row = row0[who] + at
        u = _uniform(_keys(base[who], sample, offset[who] + at))
        edge = _upto(key, row_start[row], row_start[row + 1] - 1, row + u)
        count[who] += 1
        steps.append((who, edge))
        at = start[edge].astype("i8")
        more = at > 0
        who, at = who[more], at[more]
    first = np.concatenate([[0], np.cumsum(count)])
    edges = np.empty(first[-1], "i8")
    for n, (who, edge) in enumerate(steps):
        edges[first[who] + n] = edge
    for i, long in alone.items():
        edges[first[i] : first[i + 1]] = long
    return edges, first


class _Text:
    """The search of one text: its distinct paths so far and the regions of what is left."""

    __slots__ = ("found", "heap", "number")

    def __init__(self):
        self.found: list[tuple] = []  # (path, owner, log probability, perturbed)
        self.heap: list[tuple] = []
        self.number = 0


class Sampler:
    """Up to k distinct segmentations of each text with (ids, log_prob, perturbed, log_inclusion)."""

    def __init__(self, path: str, k: int, temperature: float, seed: int):
        self.vocabulary = Vocabulary(path)
        self.lattices = Lattices(self.vocabulary, temperature)
        self.k, self.seed = k, seed

    def sample(self, keys: list[str], texts: list[str]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        of, ids, bounds, scores = self.sample_flat(keys, texts)
        out: list[list[tuple]] = [[] for _ in texts]
        for n, (d, score) in enumerate(zip(of, scores, strict=True)):
            out[d].append((ids[bounds[n] : bounds[n + 1]], *score))
        return out

    def sample_flat(self, keys: list[str], texts: list[str]):
        """The same as flat arrays: the text of each segmentation, all ids, where each one's begin, and
        (log_prob, perturbed, log_inclusion) of each."""
        if self.lattices.bytes() > _CACHE_BYTES:
            self.lattices.clear()
        cut = [self.vocabulary.cut_finely(t)[::-1] for t in texts]  # paths are built from the end
        segments = [s for c in cut for s in c]
        first = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype("i8")
        row0 = self.lattices.rows_of(segments)
        sizes = np.fromiter(map(len, segments), "i8", len(segments))
        of = np.repeat(np.arange(len(texts)), np.diff(first))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        offset = upto[first[1:]][of] - upto[1:]  # positions count within the text
        base = np.array([xxhash.xxh64_intdigest(k.encode(), self.seed) for k in keys], "u8")
        lattice = self.lattices
        views = {
            "key": np.frombuffer(lattice.key),
            "chance": np.frombuffer(lattice.chance),
            "row_start": np.frombuffer(lattice.row_start, "i8"),
            "start": np.frombuffer(lattice.start, "i4"),
            "piece": np.frombuffer(lattice.piece, "i4"),
            "lattice": lattice,
        }
        free = [_draw(views, row0, sizes, base[of], j + 1, offset) for j in range(self.k)]
        owners = [np.repeat(np.arange(len(segments)), np.diff(where)) for _, where in free]
        found = [_Text() for _ in texts]
        full = np.flatnonzero(np.diff(first)).tolist()  # texts with segments
        if self.k and full:
            edges, where = free[0]
            paths = [edges[where[first[d]] : where[first[d + 1]]] for d in full]
            mine = [owners[0][where[first[d]] : where[first[d + 1]]] for d in full]
            best = -np.log(-np.log(_uniform(_keys(base[full], 999, np.zeros(len(full), "u8")))))
            self._take(views, row0, sizes, base, found, full, paths, mine, best.tolist(), [0] * len(full), [()] * len(full), 0)
        for j in range(1, self.k):
            self._round(views, row0, sizes, offset, base, first, free[j], owners[j], found, [d for d in full if found[d].heap], j)
        out, scores, paths, mine = [], [], [], []
        for d, text in enumerate(found):
            if first[d] == first[d + 1] and self.k:
                text.found.append((np.zeros(0, "i8"), np.zeros(0, "i8"), 0.0, 0.0))
            threshold = -text.heap[0][0] if text.heap else -math.inf
            for path, owner, log_prob, g in text.found:
                spread = log_prob - threshold
                # P(perturbed score above the threshold) = 1 - exp(-exp(log_prob - threshold))
                inclusion = 0.0 if spread > 36 else math.log(-math.expm1(-math.exp(spread))) if spread > -700 else spread
                out.append(d)
                scores.append((log_prob, g, inclusion))
                paths.append(path[::-1])
                mine.append(owner[::-1])
        ids, bounds = _ids(self.vocabulary, segments, views, paths, mine)
        return out, ids, bounds, scores

    def _take(self, views, row0, sizes, base, found, docs, paths, owners, best, from_at, excluded, who) -> None:
        """Add a path to each text, and the regions of what is left of it from `from_at` on: at each
        position the taken edge is excluded. The chance of an only edge is 1, which leaves nothing."""
        chance, row_start = views["chance"], views["row_start"]
        lengths = np.array([len(p) for p in paths])
        ends = np.cumsum(lengths)
        begins = ends - lengths
        every = np.concatenate(paths)
        p = chance[every]
        logs = np.log(p)
        chosen = np.empty(len(p))  # log-probability of what was chosen before each position
        totals = []
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):  # text by text: sums must not depend on the batch
            np.cumsum(logs[b:e], out=chosen[b:e])
            totals.append(float(chosen[e - 1]))
        chosen -= logs
        left = 1.0 - p
        for n, skip in enumerate(excluded):
            if skip:
                at = int(begins[n]) + from_at[n]
                row = _row_of(views, row0, sizes, paths[n], owners[n], from_at[n])
                left[at] -= sum(float(chance[e]) for e in skip)
                # rounding must not make a region of nothing, where all edges are excluded
                if row_start[row + 1] - row_start[row] <= len(skip) + 1:
                    left[at] = 0.0
        place = np.arange(len(p)) - np.repeat(begins, lengths)
        u = _uniform(_keys(np.repeat(base[docs], lengths), 1000 + who, place))
        with np.errstate(divide="ignore"):
            gumbel = chosen + np.log(np.maximum(left, 0.0) / -np.log(u))
        for n, d in enumerate(docs):
            text, path = found[d], paths[n]
            text.found.append((path, owners[n], totals[n], best[n]))
            mine = gumbel[begins[n] + from_at[n] : ends[n]]
            top = min(self.k + 1, len(mine))
            # of one path's regions no more than k + 1 can ever be taken; the cut below keeps their order
            for i in np.argpartition(-mine, top - 1)[:top].tolist() if len(mine) > top else range(len(mine)):
                g = float(mine[i])
                if g > -math.inf:
                    text.number += 1
                    skip = (int(path[from_at[n] + i]),) + (excluded[n] if i == 0 else ())
                    high, low = max(-best[n], -g), min(-best[n], -g)
                    heapq.heappush(text.heap, (high + math.log1p(math.exp(low - high)), text.number, who, from_at[n] + i, skip))

    def _round(self, views, row0, sizes, offset, base, first, free, owner_of, found, docs, j) -> None:
        """The next path of each text: its best region's path, another edge there, and free before it."""
        if not docs:
            return
        chance, row_start, start = views["chance"], views["row_start"], views["start"]
        popped = [heapq.heappop(found[d].heap) for d in docs]
        rows, taken, segment = [], [], []
        for d, (_, _, who, at, _) in zip(docs, popped, strict=True):
            path, owner = found[d].found[who][:2]
            segment.append(int(owner[at]))
            rows.append(_row_of(views, row0, sizes, path, owner, at))
        segment = np.array(segment)
        end = np.array(rows) - row0[segment]
        u = _uniform(_keys(base[docs], 2000 + j, end + offset[segment])).tolist()
        for row, chosen, (*_, skip) in zip(rows, u, popped, strict=True):
            edges = [e for e in range(int(row_start[row]), int(row_start[row + 1])) if e not in skip]
            weights = [float(chance[e]) for e in edges]
            chosen *= sum(weights)
            upto = 0.0
            for edge, weight in zip(edges, weights, strict=True):
                upto += weight
                if chosen < upto:
                    break
            taken.append(edge)
        inside, where = _draw(views, row0[segment], start[np.array(taken)].astype("i8"), base[docs], j + 1, offset[segment])
        edges, begin = free
        paths, owners = [], []
        for n, (d, (_, _, who, at, _)) in enumerate(zip(docs, popped, strict=True)):
            path, owner = found[d].found[who][:2]
            between = inside[where[n] : where[n + 1]]
            rest = slice(begin[segment[n] + 1], begin[first[d + 1]])
            paths.append(np.concatenate([path[:at], [taken[n]], between, edges[rest]]))
            owners.append(np.concatenate([owner[:at], np.full(1 + len(between), segment[n]), owner_of[rest]]))
        best = [-score for score, *_ in popped]
        self._take(views, row0, sizes, base, found, docs, paths, owners, best, [p[3] for p in popped], [p[4] for p in popped], j)


def _row_of(views, row0, sizes, path, owner, at: int) -> int:
    """The row where the path's edge number `at` ends."""
    inside = at > 0 and owner[at - 1] == owner[at]
    return int(row0[owner[at]] + (views["start"][path[at - 1]] if inside else sizes[owner[at]]))


@lru_cache(1)
def _sampler(path: str, k: int, temperature: float, seed: int) -> Sampler:
    """One a worker, for all of its tasks."""
    return Sampler(path, k, temperature, seed)


def _ids(vocabulary: Vocabulary, segments, views, paths, owners) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all paths, and where each path's begin; unknown characters give the ids of their bytes."""
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype("i8")
    if not bounds[-1]:
        return np.zeros(0, "i4"), bounds
    path, owner = np.concatenate(paths), np.concatenate(owners)
    ids = views["piece"][path]
    at = np.flatnonzero(ids < 0)
    if not len(at):
        return ids, bounds
    unknown = [segments[o][f].encode() for o, f in zip(owner[at].tolist(), views["start"][path[at]].tolist(), strict=True)]
    times = np.ones(len(ids), "i8")
    times[at] = [len(b) for b in unknown]
    out = np.repeat(ids, times)
    out[out < 0] = np.asarray(vocabulary.byte_ids, "i4")[np.frombuffer(b"".join(unknown), "u1")]
    return out, np.concatenate([[0], np.cumsum(times)])[bounds]


_SCHEMA = "rank int, ids array<int>, n_pieces int, ids_crc32 long, log_prob double, perturbed double, log_inclusion double, round_trip boolean"


def _encode(path: str, k: int, temperature: float, seed: int) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(path, k, temperature, seed)
        for batch in _small_batches(batches, _BATCH_BYTES):
            texts = batch.column(1).to_pylist()
            keys = batch.column(2).to_pylist()
            of, ids, bounds, scores = sampler.sample_flat(keys, texts)
            if not of:
                continue
            ids, ends = ids.astype("<i4"), bounds.tolist()
            each = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            rank = np.arange(len(of)) - np.searchsorted(of, of)
            log_prob, perturbed, inclusion = zip(*scores, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    pa.array(rank, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(bounds.astype("i4")), pa.array(ids, pa.int32())),
                    pa.array(np.diff(bounds), pa.int32()),
                    pa.array([zlib.crc32(x) for x in each], pa.int64()),
                    pa.array(log_prob, pa.float64()),
                    pa.array(perturbed, pa.float64()),
                    pa.array(inclusion, pa.float64()),
                    pa.array([sampler.vocabulary.is_text_of(x.tolist(), texts[d]) for d, x in zip(of, each, strict=True)], pa.bool_()),
                ],
                names=["doc_id", "rank", "ids", "n_pieces", "ids_crc32", "log_prob", "perturbed", "log_inclusion", "round_trip"],
            )

    return encode


def sampled_segmentations(docs: DataFrame, model_path: str, k: int = 2, temperature: float = 1.0, seed: int = 42) -> DataFrame:
    """Up to k distinct segmentations per row of `docs`, best perturbed score first.

    Columns: doc_id, rank (from 0), ids, n_pieces, ids_crc32 (over little-endian 32-bit ids), log_prob,
    perturbed, log_inclusion, round_trip (the ids decode to the text, U+2581 as a blank). The row key
    is doc_id, so repeated rows draw alike and a null id draws like one fixed key. Null or empty text
    has the one empty segmentation. An empty table gives an empty result."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select("doc_id", text_of().alias("t"), key.alias("k"))
    return rows.mapInArrow(_encode(model_path, k, temperature, seed), f"doc_id {kind}, {_SCHEMA}")


def decoded(encoded: DataFrame, model_path: str) -> DataFrame:
    """`encoded` with the column `text` decoded from `ids`; a null list gives the empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_path)
        for batch in batches:
            texts = [vocabulary.decode(x or []) for x in batch.column(batch.schema.get_field_index("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    rows = encoded.drop("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(decode, f"{fields}, text string")
