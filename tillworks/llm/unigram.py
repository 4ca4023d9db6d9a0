"""A unigram vocabulary from a SentencePiece model file, and the lattice of its matches.

The public model is a BPE one, whose scores are merge ranks. Its pieces are read as a unigram
vocabulary with Zipf scores, -ln(rank + 2), in whole 1/1024ths: sums of these are exact in the
library's 32-bit floats (below 16,384), so best paths and ties can be compared bit by bit.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np

UNIT = 1024  # scores are whole multiples of 1/UNIT
_NORMAL, _USER, _UNUSED, _BYTE = 1, 4, 5, 6  # piece types of the file format
_UNK_PENALTY = 10  # the tokenizer's: below the smallest score
SPACE = "▁"
_MARKS = ".,;:!?"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int, object, bytes]]:
    """(number, wire type, value, raw bytes) of each field of a protocol-buffer message."""
    at = 0
    while at < len(data):
        begin = at
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[wire]
            value, at = data[at : at + size], at + size
        yield number, wire, value, data[begin:at]


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


class Trie:
    """Pieces as a trie in flat arrays, walked from all positions of a text at once."""

    def __init__(self, pieces: dict[str, int]):
        child: dict[tuple[int, str], int] = {}
        piece = [-1]
        for text, i in pieces.items():
            node = 0
            for c in text:
                node = child.setdefault((node, c), len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = i
        keys = np.array([node << 21 | ord(c) for node, c in child], "i8")
        order = np.argsort(keys)
        self.keys, self.children = keys[order], np.array(list(child.values()), "i8")[order]
        self.piece = np.array(piece, "i8")
        self.first = np.zeros(1 << 16, "i8")  # children of the root, for most characters
        for (node, c), to in child.items():
            if node == 0 and ord(c) < 1 << 16:
                self.first[ord(c)] = to

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces in the text, short ones first."""
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype("i8")
        starts, ends, pieces = [np.zeros(0, "i8")], [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        at, node, depth = np.arange(len(codes)), np.zeros(len(codes), "i8"), 0
        while len(at):
            if depth == 0 and int(codes.max()) < len(self.first):
                node = self.first[codes]
                at = np.flatnonzero(node)
                node = node[at]
            else:
                wanted = node << 21 | codes[at + depth]
                found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                there = np.flatnonzero(self.keys[found] == wanted)
                at, node = at[there], self.children[found[there]]
            depth += 1
            piece = self.piece[node]
            whole = np.flatnonzero(piece >= 0)
            starts.append(at[whole])
            ends.append(at[whole] + depth)
            pieces.append(piece[whole])
            if len(at) and at[-1] + depth >= len(codes):
                more = np.flatnonzero(at + depth < len(codes))
                at, node = at[more], node[more]
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces)


class Vocabulary:
    """Pieces by id, their scores in 1/UNIT, and the automaton that finds them."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = file.read()
        self.pieces: list[str] = []
        self.scores: list[int] = []
        self.bytes_of: list[bytes] = []  # what an id decodes to, blanks as SPACE
        self.byte_ids = [0] * 256
        self.unknown = 0
        normal = []
        self._found: list[int] = []  # ids of pieces that match text
        for number, _, value, _ in _fields(self.model):
            if number != 1:
                continue
            piece, score, kind = "", 0.0, _NORMAL
            for n, _, v, _ in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            i = len(self.pieces)
            self.pieces.append(piece)
            self.scores.append(zipf(score))
            self.bytes_of.append(piece.encode() if kind in (_NORMAL, _USER) else b"")
            if kind == _BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of[i] = bytes([int(piece[1:-1], 16)])
            elif kind == 2:
                self.unknown = i
            if kind == _NORMAL:
                normal.append(self.scores[i])
            if kind in (_NORMAL, _USER):
                self._found.append(i)
        self.sizes = np.array([len(p) for p in self.pieces], "i8")
        self.score_of = np.array(self.scores, "i8")
        self.unknown_score = min(normal) - _UNK_PENALTY * UNIT
        held = set("".join(p for p, b in zip(self.pieces, self.bytes_of, strict=True) if b))
        if "\uffff" in held:
            raise ValueError("no character is left to stand between segments")
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that go on after a blank can't be cut there")
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in held)
        real = [p for p, b in zip(self.pieces, self.bytes_of, strict=True) if b and p.encode() == b]
        # a mark goes on the piece before it only after these characters; after others the text is cut
        before = {p[i - 1] for p in real for i in range(1, len(p)) if p[i] in _MARKS} | {SPACE, *_MARKS}
        marks, joined = re.escape(_MARKS), "".join(map(re.escape, sorted(before)))
        self.parts = re.compile(
            f"{SPACE}*[^{SPACE}{alone}{marks}]+(?:(?<=[{joined}])[{marks}][^{SPACE}{alone}]*)?|{SPACE}*[{marks}][^{SPACE}{alone}]*|{SPACE}+"
            + (f"|[{alone}]" if alone else "")
        )
        # blanks only begin pieces, and characters of no piece stand alone: segments share no piece
        self.segments = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        """Finds pieces with their sizes and ids."""
        found = ahocorasick.Automaton()
        for i in self._found:
            found.add_word(self.pieces[i], (len(self.pieces[i]), i))
        found.make_automaton()
        return found

    @cached_property
    def trie(self) -> Trie:
        return Trie({self.pieces[i]: i for i in self._found})

    def cut(self, text: str) -> list[str]:
        """The segments of a text after the tokenizer's normalisation: a blank in front, blanks as SPACE."""
        return self.segments.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def cut_finely(self, text: str) -> list[str]:
        """As `cut`, and before marks that follow a character which no piece joins to a mark."""
        return self.parts.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def edges(self, segment: str) -> list[list[tuple[int, int, int]]]:
        """For each end position, (start, id, score) of the pieces that end there, longest first;
        a character that is no piece of its own gives an unknown edge, the last."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(segment) + 1)]
        scores = self.scores
        for last, (size, i) in self.matcher.iter(segment):
            found[last + 1].append((last + 1 - size, i, scores[i]))
        for end in range(1, len(segment) + 1):
            if not found[end] or found[end][-1][0] != end - 1:
                found[end].append((end - 1, -1, self.unknown_score))
        return found

    def expand(self, segment: str, path: list[tuple[int, int, int]]) -> list[int]:
        """Ids of a path of (start, end, id): unknown characters become their bytes."""
        out = []
        for start, end, i in path:
            out += [i] if i >= 0 else [self.byte_ids[b] for b in segment[start:end].encode()]
        return out

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, bytes as UTF-8, SPACE as a blank, without the blank in front."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")

    def is_text_of(self, ids: list[int], text: str) -> bool:
        """The ids decode to the text."""
        return b"".join(map(self.bytes_of.__getitem__, ids)) == ((SPACE + text.replace(" ", SPACE)).encode() if text else b"")

    def as_unigram_model(self) -> bytes:
        """The same vocabulary as a unigram model file, for the library."""
        out = []
        for number, _, value, raw in _fields(self.model):
            if number == 1:
                parts = []
                for n, _, v, r in _fields(value):
                    parts.append(b"\x15" + struct.pack("<f", zipf(struct.unpack("<f", v)[0]) / UNIT) if n == 2 else r)
                value = b"".join(parts)
                raw = b"\x0a" + _number(len(value)) + value
            elif number == 2:
                value = b"".join(r for n, _, _, r in _fields(value) if n != 3) + b"\x18\x01"
                raw = b"\x12" + _number(len(value)) + value
            out.append(raw)
        return b"".join(out)


def zipf(score: float) -> int:
    """The score in 1/UNIT of a piece with merge rank -score."""
    return round(-UNIT * math.log(max(-score, 0.0) + 2))
