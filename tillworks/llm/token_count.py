"""Token counts by a count-only Viterbi.

Aho-Corasick finds all pieces in a segment; dynamic programming carries, for each position, the best
score and the piece count of the path that reached it first. Ties go to the longest last piece, as
the tokenizer's strict comparison does. No path is kept. Counts of segments are remembered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillworks.llm.common import text_of
from tillworks.llm.unigram import Vocabulary

_CACHE = 400_000  # segments whose count a worker remembers


class Counter:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, int] = {}

    def of_segment(self, segment: str) -> int:
        """Pieces on the best path; unknown characters count their UTF-8 bytes."""
        n = len(segment)
        best, count = [0] * (n + 1), [0] * (n + 1)
        reached, single = [False] * (n + 1), [False] * (n + 1)
        reached[0] = True
        unknown, scores = self.vocabulary.unknown_score, self.vocabulary.scores

        def finish(end: int) -> None:
            """A character that is no piece by itself may also be unknown; that comes last."""
            if not single[end]:
                score = best[end - 1] + unknown
                if not reached[end] or score > best[end]:
                    best[end], count[end] = score, count[end - 1] + len(segment[end - 1].encode())
                    reached[end] = True

        done = 0
        for last, (size, piece) in self.vocabulary.matcher.iter(segment):
            end = last + 1
            while done < end - 1:
                done += 1
                finish(done)
            start = end - size
            single[end] |= size == 1
            score = best[start] + scores[piece]
            if not reached[end] or score > best[end]:  # longest first, so ties keep the longest
                best[end], count[end], reached[end] = score, count[start] + 1, True
        while done < n:
            done += 1
            finish(done)
        return count[n]

    def of_text(self, text: str) -> int:
        segments = self.vocabulary.cut(text)
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for s in {*segments}.difference(known):
            known[s] = self.of_segment(s)
        return sum([known[s] for s in segments])


@lru_cache(1)
def _counter(path: str) -> Counter:
    """One a worker, for all of its tasks."""
    return Counter(path)


def _count(path: str) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            counts = [counter.of_text(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return count


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens under the unigram reading of the model file.

    Null or empty text has 0 tokens; repeated rows count alike; an empty table gives an empty
    result; other columns are ignored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("t"))
    return rows.mapInArrow(_count(model_path), f"doc_id {kind}, n_tokens long")
