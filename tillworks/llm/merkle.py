"""Merkle manifest of a table: checkpoint and recompute.

Every row is a leaf. Leaves of one source form a tree in which `ARITY` consecutive nodes make one of
the next level; the roots of the sources are the leaves of one more tree. Only every `STRIDE`-th level
is written, packed as aligned subtrees of at most ARITY ** STRIDE stored nodes. A proof takes, from the
top down, one stored subtree after another, regenerates the levels between two stored ones inside that
row, emits the siblings and lets the regenerated nodes go.

Positions come from a range partition and a parallel sort, so that a source that holds most rows is
spread like any other; every group has at most ARITY ** STRIDE nodes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.operators.numbering import global_row_number
from tillworks.session import materialise

ARITY, STRIDE = 3, 3
SPAN = ARITY**STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<before: string, after: string>>"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values' texts, each with its length in UTF-8 bytes before it; null is `-`."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def _join(digests: Column) -> Column:
    return F.array_join(digests, "")


def _parents(nodes: Column) -> Column:
    """One level up: every ARITY consecutive digests become one, the last run may have fewer."""
    runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.sha2(_join(F.slice(nodes, i * ARITY + 1, ARITY)), 256))


def _steps(stored: Column) -> Column:
    """Levels from a stored level of so many nodes to the next stored one, or to the tree's root."""
    return F.lit(STRIDE) - sum((stored <= ARITY**j).cast("int") for j in range(STRIDE))


def _regenerated(groups: DataFrame) -> DataFrame:
    """Add level0 .. level<STRIDE> of each subtree; beyond the root the levels repeat it."""
    df = groups.withColumn("steps", _steps(F.col("stored"))).withColumn("level0", F.col("nodes.digest"))
    for j in range(STRIDE):
        df = df.withColumn(f"level{j + 1}", F.when(F.col("steps") > j, _parents(F.col(f"level{j}"))).otherwise(F.col(f"level{j}")))
    return df


@dataclass(frozen=True)
class Manifest:
    """Stored levels, lowest first: one row per aligned subtree (tree, grp, stored, nodes), where `stored`
    is the number of nodes that the tree has on that level; and the trees' roots (tree, subroot)."""

    levels: list[DataFrame]
    roots: DataFrame


def build(nodes: DataFrame, most: int) -> Manifest:
    """`nodes` has tree, pos (gapless from 0 in its tree), stored (nodes of its tree), digest and any
    further columns, which stay with the lowest level; the largest tree has `most` nodes."""
    levels, roots, more = [], [], [c for c in nodes.columns if c not in ("tree", "pos", "stored", "digest")]
    while True:
        packed = nodes.groupBy("tree", F.floor(F.col("pos") / SPAN).alias("grp")).agg(
            F.first("stored").alias("stored"),
            F.array_sort(F.collect_list(F.struct("pos", "digest", *more))).alias("nodes"),  # SPAN at most
        )
        levels.append(materialise(packed, f"merkle-{len(levels) * STRIDE}"))
        done = _regenerated(levels[-1])
        top = F.element_at(f"level{STRIDE}", 1)
        roots.append(done.filter(F.col("stored") <= SPAN).select("tree", top.alias("subroot")))
        if most <= SPAN:
            break
        nodes, more = (
            done.filter(F.col("stored") > SPAN).select(
                "tree", F.col("grp").alias("pos"), F.ceil(F.col("stored") / SPAN).alias("stored"), top.alias("digest")
            ),
            [],
        )
        most = -(-most // SPAN)
    found = roots[0]
    for r in roots[1:]:
        found = found.unionByName(r)
    return Manifest(levels, materialise(found, "merkle-roots"))


def _siblings(groups: DataFrame) -> DataFrame:
    """One row per stored node of each subtree, with the siblings of its path inside the subtree put
    before those of `proof`. Columns of `groups` but its nodes and levels stay."""
    df = _regenerated(groups)
    levels = [f"level{j}" for j in range(STRIDE + 1)]
    keep = [c for c in df.columns if c not in ("nodes", "steps", "proof", "grp", *levels)]
    df = df.select(*keep, "steps", "proof", *levels[:-1], F.posexplode("nodes").alias("at", "node"))
    path = []
    for j, level in enumerate(levels[:-1]):
        own = F.floor(F.col("at") / ARITY**j).cast("int")
        start = own - own % ARITY
        pair = F.struct(
            _join(F.slice(level, start + 1, own - start)).alias("before"),
            _join(F.slice(level, own + 2, start + ARITY - 1 - own)).alias("after"),
        )
        path.append(F.when(F.col("steps") > j, F.array(pair)).otherwise(F.array().cast(_PROOF)))
    return df.select(*keep, "node.*", F.concat(*path, F.col("proof")).alias("proof"))


def proofs(manifest: Manifest, above: DataFrame) -> DataFrame:
    """One row per leaf: tree, pos, digest, its further columns, those of `above`, and proof, the siblings
    level by level (joined digests before and after the own node). `above` has one row per tree: tree,
    proof (what follows the tree's root; may be empty) and further columns."""
    more = [c for c in above.columns if c not in ("tree", "proof")]
    below = None
    for k in range(len(manifest.levels) - 1, -1, -1):
        groups = manifest.levels[k]
        joined = groups.filter(F.col("stored") <= SPAN).join(above, "tree")
        if below is not None:
            joined = joined.unionByName(groups.filter(F.col("stored") > SPAN).join(below, ["tree", "grp"]))
        below = _siblings(joined)
        if k:
            below = materialise(below.select("tree", F.col("pos").alias("grp"), "proof", *more), f"merkle-proofs-{k * STRIDE}")
    return below


def folded(start: Column, proof: Column) -> Column:
    """The root that a digest and its siblings give."""
    return F.aggregate(proof, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings from the leaf's level to the root, left to right."""
    return F.sha2(_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"]))), 256)


def audited(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    `changed` is the leaf that is audited in place of the true one; null (or None) leaves the true one.
    Leaves ascend by doc_id in their source, null first; rows with one doc_id by their digests, and
    equal rows have equal leaves. Null sources form one source, the first. Null values and empty
    texts differ (`-` and `0:`). A tree of one leaf has an empty proof. An empty table gives an empty
    result. Only FIELDS are read; further columns do not matter."""
    leaf = leaf_digest([F.col(f) for f in FIELDS])
    other = F.lit(None).cast("string") if changed is None else changed
    leaves = materialise(docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("digest"), other.alias("changed")), "merkle-leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("changed")]
    numbered = global_row_number(leaves, *order, name="n")
    sources = materialise(numbered.groupBy("source").agg(F.min("n").alias("first"), F.count("*").alias("stored")), "merkle-sources")
    trees = materialise(
        global_row_number(sources, F.col("source").asc_nulls_first(), name="t").select(
            F.col("source").alias("of"), "first", "stored", (F.col("t") - 1).alias("tree")
        ),
        "merkle-trees",
    )
    size = trees.agg(F.count("*").alias("trees"), F.max("stored").alias("most")).first()
    if not size["trees"]:
        shape = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], shape)
    rows = numbered.join(trees, F.col("source").eqNullSafe(F.col("of")))
    manifest = build(rows.select("tree", (F.col("n") - F.col("first")).alias("pos"), "stored", "digest", "doc_id", "changed"), size["most"])
    upper = build(
        manifest.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(size["trees"]).alias("stored"), F.col("subroot").alias("digest")),
        size["trees"],
    )
    root = upper.roots.first()["subroot"]
    start = upper.roots.select("tree", F.array().cast(_PROOF).alias("proof"))
    above = proofs(upper, start).select(F.col("pos").alias("tree"), "proof", F.col("digest").alias("subroot"))
    found = proofs(manifest, above).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("changed", "digest"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_ends(docs: DataFrame) -> Column:
    """A tampered leaf: the text without line feeds, where 2 divides the CRC-32 of the doc_id's decimals."""
    values = [F.translate(F.col(f), "\n", "") if f == "text" else F.col(f) for f in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0, leaf_digest(values))
