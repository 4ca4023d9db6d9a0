"""SimHash near-dedup by a binary trie self-join.

Fingerprints are the leaves of a binary trie. Pairs of nodes are traversed together from the root,
their differing bits add up, and a pair is pruned once they exceed the error budget. The upper part
of the trie is dealt out by Spark: of `blocks` equal parts of the fingerprint, `blocks - budget` are
the same in any linked pair, so each choice of these parts is one trie whose upper levels allow no
error, and its subtrees are units of work. A unit above `UNIT` leaves is split into pairs of nodes
over its most balanced bits, until none is. Inside a task the pairs of all units are traversed level
by level in numpy. Units give spanning edges only, and components are joined up in Spark by star
contraction, so neither pairs nor components pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillworks.llm.common import spare, text_of
from tillworks.session import materialise

BITS = 64
BUDGET = 3
SHINGLE = 3
UNIT = 1 << 16  # leaves of a unit that needs no further split
_SPLIT_BITS = 4
_LEAST_PER_SUBTREE = 64
_FRONTIER = 1 << 16  # node pairs traversed at once


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = 42) -> int:
    """Bits set in over half of the shingles' XXH64; 0 if there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(len(words) - size + 1, 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], "<u8")
    votes = np.zeros(BITS, "i8")
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].view("u1").reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="i4")
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *others, texts = batch.columns
        prints = np.array([fingerprint(t.as_py()) for t in texts], "u8").view("i8")
        yield pa.RecordBatch.from_arrays([*others, pa.array(prints, pa.int64())], names=[*["id", "row"][: len(others)], "fp"])


def fingerprints(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id as id, fp) of each row: the fingerprint as a signed 64-bit number; with the column
    `row`, a long, (id, row, fp)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    others = [F.col("doc_id").alias("id"), *([F.col(row).alias("row")] if row else [])]
    shape = f"id {kind}, row long, fp long" if row else f"id {kind}, fp long"
    return docs.select(*others, text_of().cast("binary").alias("t")).mapInArrow(_fingerprints, shape)


def linked(unit: np.ndarray, kind: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (positions u, v) of the pairs within `budget` in each unit.

    Rows are sorted by (unit, kind, fp). Kind 0 rows form one trie that is joined with itself;
    kinds 1 and 2 are two tries that are joined with each other.

    A trie joined with itself gives, for each inner node, the pair of its children, one bit apart.
    The deepest pairs come first. A pair of nodes whose leaves all have one label already is pruned
    too: it can't join anything, so a ball of near copies does not cost all its pairs."""
    n = len(fp)
    if not n:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    ones = np.zeros((BITS, n + 1), "i4")  # ones before each position, from the highest bit on
    for level in range(BITS):
        np.cumsum((fp >> np.uint64(BITS - 1 - level)) & np.uint64(1), out=ones[level, 1:])
    new = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (kind[1:] != kind[:-1])])
    stop = np.r_[new[1:], n]
    label = np.arange(n)
    a, b = new[kind[new] == 0], stop[kind[new] == 0]
    levels = []
    for level in range(BITS):  # down the tries that are joined with themselves
        more = b - a > 1
        a, b = a[more], b[more]
        m = b - (ones[level, b] - ones[level, a])
        both = (a < m) & (m < b)
        levels.append((a[both], m[both], m[both], b[both]))
        a, b = np.concatenate([a, m]), np.concatenate([m, b])
    for level in range(BITS - 1, -1, -1):
        _traverse(ones, fp, label, level + 1, *levels[level], 1, budget)
    cross = np.flatnonzero((kind[new[:-1]] == 1) & (kind[new[1:]] == 2) & (unit[new[:-1]] == unit[new[1:]]))
    _traverse(ones, fp, label, 0, new[cross], stop[cross], new[cross + 1], stop[cross + 1], 0, budget)
    found = np.flatnonzero(label != np.arange(n))
    return found, label[found]


def _traverse(ones, fp, label, level, a, b, c, d, errors: int, budget: int) -> None:
    """Go down from the pairs of nodes with leaves a..b-1 and c..d-1, and join what links."""
    stack = [(level, a, b, c, d, np.full(len(a), errors, "i4"))]
    while stack:
        level, a, b, c, d, errors = stack.pop()
        if len(a) > _FRONTIER:
            for at in range(0, len(a), _FRONTIER):
                cut = slice(at, at + _FRONTIER)
                stack.append((level, a[cut], b[cut], c[cut], d[cut], errors[cut]))
            continue
        if not len(a):
            continue
        # leaves a..b-1 have one label if no label changes among them
        changes = np.cumsum(np.r_[False, label[1:] != label[:-1]]) if len(a) > 16 else None
        if changes is not None:
            open_ = (changes[b - 1] != changes[a]) | (changes[d - 1] != changes[c]) | (label[a] != label[c])
            a, b, c, d, errors = (x[open_] for x in (a, b, c, d, errors))
        alone = (b - a == 1) & (d - c == 1)
        if alone.any():
            u, v = a[alone], c[alone]
            near = np.bitwise_count(fp[u] ^ fp[v]) <= budget
            _join(label, u[near], v[near])
            a, b, c, d, errors = (x[~alone] for x in (a, b, c, d, errors))
        if not len(a) or level == BITS:
            continue
        before = ones[level]
        m, k = b - (before[b] - before[a]), d - (before[d] - before[c])  # where the ones begin
        parts = [(a, m, c, k, errors), (m, b, k, d, errors), (a, m, k, d, errors + 1), (m, b, c, k, errors + 1)]
        a, b, c, d, errors = (np.concatenate(x) for x in zip(*parts, strict=True))
        keep = (a < b) & (c < d) & (errors <= budget)
        stack.append((level + 1, a[keep], b[keep], c[keep], d[keep], errors[keep]))


def _join(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Give the ends of each edge, and all that they stand for, their smallest label."""
    while len(u):
        p, q = label[u], label[v]
        differ = p != q
        u, v, p, q = u[differ], v[differ], p[differ], q[differ]
        if not len(u):
            return
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label != (up := label[label])).any():
            label[:] = up


def _unit_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; whole units are joined as they fill up."""
    held: list[np.ndarray] = []
    most = 1 << 17  # rows joined at once, or one unit

    def joined(rows: list[np.ndarray]) -> pa.RecordBatch:
        unit, kind, fp = rows
        fp = fp.view("u8")
        order = np.lexsort((fp, kind, unit))
        unit, kind, fp = unit[order], kind[order], fp[order]
        u, v = linked(unit, kind, fp, BUDGET)
        return pa.RecordBatch.from_arrays([pa.array(fp[x].view("i8"), pa.int64()) for x in (u, v)], names=["u", "v"])

    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
        if len(held[0]):
            ends = int(np.searchsorted(held[0], held[0][-1]))  # the last unit may go on
            if ends and len(held[0]) > most:
                yield joined([x[:ends] for x in held])
                held = [x[ends:].copy() for x in held]
    if held and len(held[0]):
        yield joined(held)


def _units(prints: DataFrame, rows: int, budget: int) -> DataFrame:
    """(unit, kind, fp): each distinct fingerprint once for each choice of error-free parts."""
    for blocks in range(budget + 1, 9):  # more parts give smaller subtrees, and more of them
        if rows >> (BITS * (blocks - budget) // blocks) < _LEAST_PER_SUBTREE:
            break
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - budget):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)]))
    return prints.select("fp", each.alias("e")).select(F.xxhash64("e.i", "e.part").alias("unit"), F.lit(0).alias("kind"), "fp")


def _split(units: DataFrame, budget: int, most: int) -> DataFrame:
    """Replace units of over `most` leaves by pairs of their nodes, until there are none."""
    small = []
    while True:
        sizes = units.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
        large = materialise(sizes.filter(F.col("n") > most).select(F.col("unit").alias("large")), "trie-large")
        if large.isEmpty():
            break
        both = units.join(large, F.col("unit") == F.col("large"), "left")
        small.append(both.filter("large is null").drop("large"))
        hot = materialise(both.filter("large is not null").drop("large"), "trie-hot")
        ones = [F.sum(F.shiftright("fp", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(BITS)]
        # of each side, the fewer of zeros and ones: bits that cut the sides evenly come first
        sides = hot.groupBy("unit", "kind").agg(F.count(F.lit(1)).alias("n"), *ones)
        fewer = [F.sum(F.least(F.col(f"b{i}"), F.col("n") - F.col(f"b{i}"))).alias(f"b{i}") for i in range(BITS)]
        ranked = F.sort_array(F.array(*[F.struct(F.col(f"b{i}").alias("few"), F.lit(i).alias("bit")) for i in range(BITS)]), asc=False)
        cut = materialise(
            sides.groupBy("unit").agg(*fewer).select(F.col("unit").alias("of"), F.transform(F.slice(ranked, 1, _SPLIT_BITS), lambda r: r["bit"]).alias("at")),
            "trie-cut",
        )
        node = F.aggregate(F.col("at"), F.lit(0).cast("long"), lambda s, bit: s * 2 + F.call_function("shiftright", F.col("fp"), bit).bitwiseAND(F.lit(1)))
        masks = [m for m in range(1 << _SPLIT_BITS) if m.bit_count() <= budget]
        split = hot.join(cut, F.col("unit") == F.col("of")).withColumn("x", node)
        split = split.withColumn("m", F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))).withColumn("y", F.col("x").bitwiseXOR(F.col("m")))
        first = F.when(F.col("kind") == 0, F.col("x") <= F.col("y")).otherwise(F.col("kind") == 1)
        units = materialise(
            split.select(
                F.xxhash64("unit", F.when(first, F.col("x")).otherwise(F.col("y")), F.when(first, F.col("y")).otherwise(F.col("x"))).alias("unit"),
                F.when((F.col("kind") == 0) & (F.col("m") == 0), 0).otherwise(F.when(first, 1).otherwise(2)).alias("kind"),
                "fp",
            ),
            "trie-units",
        )
    for part in small:
        units = units.unionByName(part)
    return units


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest node reachable, for each node of `edges` (u, v), which may repeat.

    Large-star and small-star contraction; each round is written to the shared folder. A hub's
    neighbours are only reduced to their minimum, and its joins are split by adaptive execution."""
    edges = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w"), "star-min")
        # large star: neighbours above u go to the least of u and its neighbours
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(large.filter("u <> v").distinct(), "star-large")
        # small star: u and its neighbours below go to the least of these
        least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"), "star-min")
        below = edges.join(least, F.col("u") == F.col("w"))
        small = below.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(below.select("u", F.col("m").alias("v")))
        edges = materialise(small.filter("u <> v").distinct(), "star-small")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen


def near_groups(docs: DataFrame, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Fingerprints within `budget` bits link; component_id is the smallest doc_id reachable (nulls
    only count if there is no other). Null or empty text has fingerprint zero and links like any
    other. Equal fingerprints are one leaf, so copies are not paired. An empty table gives an empty
    result; other columns are ignored."""
    return _labelled(fingerprints(docs), budget, unit).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labelled(rows: DataFrame, budget: int, unit: int) -> DataFrame:
    """`rows` (with id and fp) with root, the least fingerprint reachable, and component_id."""
    rows = materialise(rows, "simhash-rows")
    prints = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    units = _split(materialise(_units(prints.select("fp"), prints.count(), budget), "trie-units"), budget, unit)
    edges = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_unit_edges, "u long, v long")
    roots = components(edges)
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "simhash-roots")
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of"), "simhash-least")
    labels = materialise(rooted.join(least, F.col("root") == F.col("of")).select(F.col("fp").alias("print"), "root", "component_id"), "simhash-labels")
    return rows.join(labels, F.col("fp") == F.col("print")).drop("print")


def drop_near_copies(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """`docs` with one row of each component, the one with the smallest doc_id; all columns stay.

    Components are told apart by their root fingerprint, so rows without a doc_id, or with the same
    one, in several components do not touch each other; null ids only count if a component has no
    other. Of a component's rows that repeat its smallest doc_id, the one with the smallest other
    values stays."""
    row, of, same = (spare(docs.columns, n) for n in ("row", "of", "same"))
    written = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    labelled = _labelled(fingerprints(written, row), budget, UNIT)
    least = materialise(labelled.filter(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("root").alias("of"), F.col("row").alias("stays")), "simhash-stay")
    counts = least.groupBy("of").agg(F.count(F.lit(1)).alias("n")).select(F.col("of").alias("counted"), "n")
    side = least.join(counts, F.col("of") == F.col("counted")).select(F.col("stays").alias(spare([*docs.columns, row], "stays")), F.col("of").alias(of), F.col("n").alias(same))
    kept = written.join(side, F.col(row) == F.col(side.columns[0]))
    one = kept.filter(F.col(same) == 1).select(*docs.columns)
    many = kept.filter(F.col(same) > 1).groupBy(of).agg(F.min(F.struct(*docs.columns)).alias("kept")).select("kept.*")
    return one.unionAll(many)
