"""Operators 11 to 13 against plain versions of their definitions, and their results for odd input."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.test_operators import ODD, documents, empty, odd
from tillworks.llm import bpe, importance, merkle
from tillworks.llm.queries import QUERIES, RANKS

PATTERN = public_tokenizers.PATTERN


def five(spark, rows):
    """Rows of the columns that a leaf covers."""
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def odd_documents(spark, extra: str = "leaf"):
    return odd(spark, extra).withColumn("lang", F.when(F.col("doc_id") > 3, "de"))


# 11 --------------------------------------------------------------------------------------------
def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    found = []
    for level in levels[:-1]:
        start = at - at % 3
        found.append(("".join(level[start:at]), "".join(level[at + 1 : start + 3])))
        at //= 3
    return found


def plain_audit(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) by the definition."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([leaf for *_, leaf, _ in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for at, (_, _, leaf, row) in enumerate(sorted(sources[source], key=lambda x: x[:3])):
            proof = siblings(trees[source], at) + siblings(top, place)
            node, text = leaf, row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                node = plain_leaf((*row[:4], None if text is None else text.replace("\n", "")))
            for before, after in proof:
                node = sha(before + node + after)
            digest = sha("".join(b + a for b, a in proof))
            out.append((row[0], leaf, trees[source][-1][0], top[-1][0], digest, node, node == top[-1][0]))
    return out


def audit(docs):
    return merkle.audited(docs, merkle.without_line_ends(docs))


def test_merkle_query(spark):
    rows = [tuple(r) for r in documents(spark).select(*merkle.FIELDS).collect()]
    got = Counter(tuple(r) for r in QUERIES["op11_merkle"](spark, SMALL).collect())
    assert got == Counter(plain_audit(rows))
    assert {True, False} == {r[-1] for r in got}


@pytest.mark.parametrize("sizes", [(1,), (27, 28, 3, 1), (800, 26, 81, 82, 730)])
def test_trees_of_every_height(spark, sizes):
    """Sizes at and beside powers of three, so stored levels end on, before and after a tree's root; ids in mixed order."""
    draw = random.Random(str(sizes))
    rows = [(draw.randrange(10**9), f"s{k}" if k else None, None, i, f"a\nb{i}" if i % 3 else None) for k, n in enumerate(sizes) for i in range(n)]
    draw.shuffle(rows)
    assert Counter(tuple(r) for r in audit(five(spark, rows)).collect()) == Counter(plain_audit(rows))


def test_many_sources(spark):
    rows = [(i, f"sø{i % 90:03d}", "x", 1, f"t\n{i}") for i in range(200)]
    assert Counter(tuple(r) for r in audit(five(spark, rows)).collect()) == Counter(plain_audit(rows))


def test_only_every_third_level_is_written(spark):
    nodes = spark.range(1000).select(F.lit(0).cast("long").alias("tree"), F.col("id").alias("pos"), F.lit(1000).cast("long").alias("stored"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    manifest = merkle.build(nodes, 1000)
    assert [level.agg(F.sum(F.size("nodes"))).first()[0] for level in manifest.levels] == [1000, 38, 2]
    assert max(r[0] for level in manifest.levels for r in level.select(F.size("nodes")).collect()) <= 27
    assert manifest.roots.first()["subroot"] == levels_of([sha(str(i)) for i in range(1000)])[-1][0]


def test_merkle_odd_rows(spark):
    for extra in ("tree",):
        docs = odd_documents(spark, extra)
        rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
        assert Counter(tuple(r) for r in audit(docs).collect()) == Counter(plain_audit(rows))


def test_null_and_empty_differ():
    assert plain_leaf((1, None, None, None, None)) != plain_leaf((1, None, None, None, "")) != plain_leaf((1, None, None, None, "-"))


def test_without_tampering_all_is_verified(spark):
    assert {r["verified"] for r in merkle.audited(documents(spark)).collect()} == {True}


# 12 --------------------------------------------------------------------------------------------
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text: str | None) -> tuple[int, list[str]]:
    words = WORDS.findall((text or "").translate(LOWER))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def plain_importance(docs: list[tuple], target: list[str | None], buckets: int = 10_000) -> list[tuple]:
    def bucket(feature: str) -> int:
        return zlib.crc32(feature.encode()) % buckets

    found = [(i, *plain_features(t)) for i, t in docs]
    s = Counter(bucket(f) for _, _, features in found for f in features)
    t = Counter(bucket(f) for text in target for f in plain_features(text)[1])
    every, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, features in found:
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(sha(f"7:{'null' if i is None else i}")[:8], 16)
        rows.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(enough[: 25 * len(enough) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in rows]


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_importance_query(spark):
    target = [r[0] for r in pairs(spark.read.parquet(f"{SMALL}/benchmark.parquet"), "text")]
    got = Counter(tuple(r) for r in QUERIES["op12_importance"](spark, SMALL).collect())
    assert got == Counter(plain_importance(pairs(documents(spark), "doc_id", "text"), target))
    assert sum(r[4] is not None for r in got) > 20


def test_sums_over_planes_are_exact():
    draw = np.random.default_rng(3)
    for buckets in (1, 63, 64, 65, 10_000):
        for most in (1, 7, 2**22):
            counts, gains = draw.integers(0, most + 1, buckets), draw.integers(-9000, 9000, buckets)
            assert importance.sliced_sum(importance.bit_planes(counts), importance.signed_planes(gains)) == int((counts * gains).sum())
        assert importance.sliced_sum(importance.bit_planes(counts), importance.signed_planes(np.zeros(buckets, np.int64))) == 0


def test_importance_odd_rows(spark):
    target = spark.createDataFrame([("one Two three",), (None,), ("",)], "text string")
    for extra in ("weight",):
        docs = odd(spark, extra)
        got = Counter(tuple(r) for r in importance.importance(docs, target).collect())
        assert got == Counter(plain_importance(pairs(docs, "doc_id", "text"), ["one Two three", None, ""]))


def test_importance_empty_target_and_few_buckets(spark):
    docs, none = documents(spark), spark.createDataFrame([], "text string")
    got = Counter(tuple(r) for r in importance.importance(docs, none, buckets=70).collect())
    assert got == Counter(plain_importance(pairs(docs, "doc_id", "text"), [], 70))


# 13 --------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def code():
    return bpe.coder(RANKS, PATTERN)


def ids_of(library, text: str) -> bytes:
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def agree(code, library, texts: list[str]) -> None:
    got = code.encode(texts)
    assert got == [ids_of(library, t) for t in texts]
    assert [b"".join(parts) for parts in code.decode(got)] == [t.encode() for t in texts]


def test_bpe_query(spark, library):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_byte_bpe"](spark, SMALL).collect()}
    for i, text in pairs(documents(spark), "doc_id", "text"):
        ids = ids_of(library, text or "")
        assert got[i] == (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), sha(text or ""))


def test_made_texts(code, library):
    draw = random.Random(2)
    agree(code, library, ["", " ", "\n\n\n x", "<|endoftext|>", "it's I'll \x1c\x85　 12٣ é\U0001f600\x00"])
    agree(code, library, ["".join(draw.choice("ab  ▁the\n\téé😀ing\x01=-'s") for _ in range(draw.randint(0, 300))) for _ in range(1_000)])


@pytest.mark.parametrize("unit", ["=", "a", " ", "\n", "é", "的", "😀", "ab", "-=", "abc", "0", "ÿ"])
def test_long_runs(code, library, unit):
    agree(code, library, [unit * n for n in (47, 48, 49, 95, 97, 193, 1_000, 3_001)] + [f" {unit * 999}x", f"={unit * 500}"])


def test_texts_without_blanks(code, library):
    draw = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    agree(code, library, ["".join(draw.choice(letters) for _ in range(30_000))])
    agree(code, library, ["".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(10_000))])
    agree(code, library, ["".join(draw.choice("ab") for _ in range(10_000)), "=" * 100_000])


def test_every_entry_is_a_word_of_one_token(code):
    assert code.closed


def test_a_vocabulary_with_an_entry_that_is_never_reached(tmp_path):
    """Long words are then not cut; the leftmost pair of the least rank goes first all the same."""
    entries = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abcd"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(e) + b" %d" % i for i, e in enumerate(entries)))
    coder = bpe.Coder(str(path), r"\S+|\s+")
    assert not coder.closed
    text = "abcd" * 40
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks={e: i for i, e in enumerate(entries)}, special_tokens={})
    assert coder.encode([text]) == [ids_of(own, text)]


def test_blocks_and_forgotten_words(library, monkeypatch):
    monkeypatch.setattr(bpe, "_BLOCK", 7)
    monkeypatch.setattr(bpe, "_CACHE", 3)
    draw = random.Random(5)
    texts = [" ".join(draw.choice(("one", "two", "three", "fours", "fives")) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    agree(bpe.Coder(RANKS, PATTERN), library, texts)


def test_encode_and_decode_tables(spark, library):
    docs = odd(spark, "ids")
    encoded = bpe.encoded(docs, RANKS, PATTERN)
    want = Counter((r["doc_id"], ids_of(library, r["text"] or "")) for r in docs.collect())
    assert Counter((r["doc_id"], np.array(r["ids"], "<u4").tobytes()) for r in encoded.collect()) == want
    decoded = bpe.decoded(encoded, RANKS, PATTERN)
    assert Counter((r["doc_id"], bytes(r["content"])) for r in decoded.collect()) == Counter((r["doc_id"], (r["text"] or "").encode()) for r in docs.collect())


# all -------------------------------------------------------------------------------------------
def test_empty_tables(spark):
    docs = empty(spark).withColumn("lang", F.lit("x"))
    assert audit(docs).collect() == []
    assert importance.importance(docs, spark.createDataFrame([], "text string")).collect() == []
    assert bpe.digests(docs, RANKS, PATTERN).collect() == []
    assert bpe.encoded(docs, RANKS, PATTERN).collect() == []


def test_every_row_once(spark):
    docs = odd_documents(spark, "n_tokens")
    for rows in (audit(docs), bpe.digests(docs, RANKS, PATTERN)):
        assert Counter(r["doc_id"] for r in rows.collect()) == Counter(r[0] for r in ODD)
