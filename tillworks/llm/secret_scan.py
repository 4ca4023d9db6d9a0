"""Secret scans: fixed patterns, and zstandard novelty primed with an identifier dictionary.

A candidate is a run of at least 8 characters, or the block of a private key. It is in sensitive
context if a sensitive word stands before or after it, in its paragraph or at most 200 characters
off. Its novelty is the number of bytes by which the compressed surroundings grow when the candidate
is appended, for each of its characters, with the corpus's identifiers as dictionary. What the
surroundings and identifiers can't predict is reported.
"""

from __future__ import annotations

import builtins
import hashlib
import keyword
import re
import sys
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tillworks.llm.common import bounded_sample, text_of

KINDS = ("assign", "access", "hex", "novel")
#: Fixed patterns; the sign class of `assign` and the least lengths are part of them.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: What makes a paragraph sensitive.
_CONTEXT = re.compile(
    r"password|passwd|passphrase|pwd|secret|token|api[_ -]?key|credential|private[_ -]?key|access[_ -]?key|"
    r"auth(?:orization|_key|_token)|bearer|client[_ -]?id|encryption[_ -]?key|signing[_ -]?key|aws_|ssh-rsa",
    re.I | re.A,
)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~!@$^*#%&?.-]{8,}")
_INNER = re.compile(r"[0-9]|[A-Za-z][^A-Za-z0-9]+[A-Za-z]")
_ASSIGNED = re.compile(r"[A-Za-z0-9_]*=+")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n")
#: A private key's block, to its end line or as far as lines (or their escapes in JSON) look like one.
#: No body goes past five dashes, so blocks that never end take linear time.
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:[A-Za-z0-9+/=:,.\s\\]+|-(?!----))*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----|[A-Za-z0-9+/=\s\\]*)")
_PEM_LINE = re.compile(r"-----[A-Z0-9 ]+-----|\\[nr]|\s+")
_AROUND = 200  # characters of the surroundings, on either side
_PIECE = 64  # characters judged at once: in longer ones zstandard fits its codes to the piece
_SHORT = 12  # below that many characters a candidate needs more kinds
NOVELTY = 0.92  # compressed bytes for each character; words and identifiers need less than 0.85
LEAST_KINDS = 2  # of lower-case, upper-case letters and digits
#: The dictionary's only: the sample of documents, and of each so many characters from a hashed offset.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS, DICTIONARY_BYTES = 512, 4_000, 32_768


def identifier_dictionary(texts: list[str]) -> bytes:
    """A dictionary with entropy tables, trained on lines of the corpus and on names of common code:
    words and identifiers become cheap, so only what is neither stays incompressible."""
    names = sorted({*dir(builtins), *sys.stdlib_module_names, *keyword.kwlist, *dir(str), *dir(dict)})
    code = [" ".join(names[at : at + 8]).encode() for at in range(0, len(names), 8)]
    texts = [_PEM.sub("", t) for t in texts]
    # what looks like a secret and is in one text only is no identifier of the corpus
    once = Counter(w for t in texts for w in {m[0] for m in _CANDIDATE.finditer(t) if _mixed(m[0])})
    texts = [_CANDIDATE.sub(lambda m: "" if once.get(m[0]) == 1 else m[0], t) for t in texts]
    lines = [line.encode() for t in texts for line in t.split("\n") if line]
    return zstandard.train_dictionary(DICTIONARY_BYTES, [*code, *lines]).as_bytes()


def _trimmed(text: str, start: int, end: int, stops: list[int]) -> tuple[int, int]:
    """The candidate without the sensitive name that it is assigned to, and without full stops."""
    for stop in stops[bisect_right(stops, start) : bisect_right(stops, end)]:
        assigned = _ASSIGNED.match(text, stop, end)
        if assigned:
            start = assigned.end()
    while end > start and text[end - 1] in ".?":
        end -= 1
    return start, end


def _mixed(word: str) -> bool:
    """Whether it has as many kinds of characters as a secret; short ones need three, with signs as
    a kind, and a digit or a sign between letters."""
    kinds = any("a" <= c <= "z" for c in word) + any("A" <= c <= "Z" for c in word) + any("0" <= c <= "9" for c in word)
    if len(word) >= _SHORT or kinds < LEAST_KINDS:
        return kinds >= LEAST_KINDS
    return kinds + (not word.isalnum()) > LEAST_KINDS and _INNER.search(word) is not None


class Scanner:
    def __init__(self, dictionary: bytes):
        self.press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))

    def novelty(self, text: str, start: int, end: int) -> float:
        """Added bytes for each character; of long strings the mean over their pieces."""
        pieces = -(-(end - start) // _PIECE)
        cuts = [start + (end - start) * i // pieces for i in range(pieces + 1)]
        return sum(map(self._added, [text] * pieces, cuts, cuts[1:])) / (end - start)

    def _added(self, text: str, start: int, end: int) -> int:
        around = (text[max(0, start - _AROUND) : start] + "\n" + text[end : end + _AROUND]).encode()
        more = around + b" " + text[start:end].encode()
        return len(self.press.compress(more)) - len(self.press.compress(around))

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end): leftmost non-overlapping per kind, failing matches dropped."""
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        return sorted(found)

    def novel(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Incompressible candidates in sensitive contexts that no base span overlaps."""
        near = [(m.start(), m.end()) for m in _CONTEXT.finditer(text)]
        if not near:
            return []
        found: list[tuple[int, int, int]] = []
        blocks = [(m.start(), m.end()) for m in _PEM.finditer(text)] if "-----BEGIN " in text else []
        for start, end in blocks:
            body = _PEM_LINE.sub("", text[start:end])
            # what a base span of its first line leaves
            start = max([start, *(e for s, _, e in base if s < end and start < e < end)])
            if body and self.novelty(body, 0, len(body)) >= NOVELTY:
                found.append((start, 3, end))
        taken = sorted([(s, e) for s, _, e in base] + blocks)
        ends = list(accumulate((e for _, e in taken), max))  # so far, as base spans of two kinds may overlap
        begins, starts, stops = [s for s, _ in taken], [s for s, _ in near], [e for _, e in near]
        breaks = [m.start() for m in _PARAGRAPH.finditer(text)]
        for m in _CANDIDATE.finditer(text):
            start, end = _trimmed(text, m.start(), m.end(), stops)
            if end - start < 8 or not _mixed(text[start:end]):
                continue
            at = bisect_left(begins, end) - 1  # the last that begins before the end
            if at >= 0 and ends[at] > start:
                continue
            before, after = bisect_right(stops, start) - 1, bisect_left(starts, end)
            if not (
                (before >= 0 and (start - stops[before] <= _AROUND or bisect_left(breaks, start) == bisect_left(breaks, stops[before])))
                or (after < len(starts) and (starts[after] - end <= _AROUND or bisect_left(breaks, end) == bisect_left(breaks, starts[after])))
            ):
                continue
            if self.novelty(text, start, end) >= NOVELTY:
                found.append((start, 3, end))
        return found

    def scan(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        base = self.base(text)
        return base, sorted(base + self.novel(text, base))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(dictionary: bytes) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(dictionary)
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
            counts = [[sum(k == kind for _, k, _ in base) for base, _ in rows] for kind in range(3)]
            digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([_joined(s) for _, s in rows], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return scan


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and kind; kind `novel` is the
    novelty's. Null or empty text has none: the digest is that of the empty string. Repeated rows
    are judged alike; an empty table gives an empty result."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    dictionary = identifier_dictionary(bounded_sample(docs, SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS))
    rows = docs.select("doc_id", text_of().alias("t"))
    return rows.mapInArrow(_scan(dictionary), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
