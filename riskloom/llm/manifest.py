"""Merkle manifest of a dataset, with the proof of every row, by butterfly exchange.

Every row is a leaf. The leaves of a group (a source) ascend by id; while several nodes
remain, every ``FANOUT`` consecutive ones (the last run may be shorter, even one) become
the digest of their digests. What remains is the group's root, and the roots of all groups,
ordered by group, become the root of the dataset in the same way.

Leaves are dealt into blocks, aligned subtrees of ``FANOUT ** BLOCK_LEVELS`` leaves that one
task builds. Above the blocks there is no tree that goes up and comes down again. In round r
the blocks at the same place of ``FANOUT`` neighbouring subtrees swap the roots of these
subtrees, and every one of them hashes the common ancestor for itself. So each block gets its
upper siblings on the way, a group of an exchange never has more than ``FANOUT`` rows, and
after log(blocks) rounds every block holds the root. Where the last subtree lacks a place,
its blocks stand in for the missing ones. Groups are then exchanged in the same way.

A hot group only has more blocks. The place of a row in its group is found without a window
over the group: rows are range-partitioned by (group, id, leaf) and written with their place
in the partition; how many rows of a group earlier partitions hold is a sum over partitions.

Defined cases: a null field counts as ``-``; a null group comes first; null ids come first in
their group; equal ids are ordered by leaf digest, and rows that are equal in all five fields
are interchangeable, but each is a leaf. A group of one row has that leaf as its root; a
dataset of one group has the group's root as its root; an empty table has an empty manifest.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import scratch

FANOUT = 16
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SIDES = "array<struct<left: string, right: string>>"
_PROVEN = (
    "doc_id bigint, source string, leaf string, subroot string, root string, "
    f"proof_sha256 string, folded_root string, verified boolean, proof {_SIDES}"
)


def leaf(*, text: Column | None = None) -> Column:
    """Digest of a row of documents; ``text`` takes the place of its text."""

    def field(name: str) -> Column:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        told = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(told, F.lit("-"))

    return F.sha2(F.concat(*map(field, FIELDS)), 256)


def folded(digest: Column, proof: Column) -> Column:
    """Root that a leaf digest and the siblings of its proof lead to."""
    return F.aggregate(
        proof, digest, lambda d, side: F.sha2(F.concat(side["left"], d, side["right"]), 256)
    )


def manifest(
    documents: DataFrame,
    claimed: Column | None = None,
    *,
    proofs: bool = False,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per document: its leaf, its source's root, the root, and what its proof gives.

    ``claimed`` is the leaf digest that somebody presents for a row (the row's own unless
    given); ``folded_root`` is recomputed from it and the siblings, ``verified`` says whether
    that is the root. ``proof_sha256`` digests the siblings, lowest level first; with
    ``proofs`` they are returned as well, as left and right neighbours per level.
    """
    own = leaf()
    leaves = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        _group_key(F.col("source").cast("string")).alias("group"),
        own.alias("leaf"),
        (own if claimed is None else claimed).alias("claim"),
    )
    placed = _numbered(leaves, ["group"], ["doc_id", "leaf"], "leaves")
    placed = placed.withColumn("block", F.floor(F.col("index") / FANOUT**block_levels))

    def build(own_leaves: pa.Table) -> pa.Table:
        return _block_root(own_leaves, block_levels)

    roots = placed.groupBy("group", "block").applyInArrow(
        build, "group string, block bigint, parts bigint, digest string"
    )
    blocks = _exchanged(scratch.staged(roots, "block-roots"), ["group"])
    blocks = scratch.staged(blocks, "block-proofs")
    tops = blocks.where("block = 0").select("group", "digest")
    groups = _numbered(tops.withColumn("all", F.lit(0)), ["all"], ["group"], "groups")
    groups = groups.select(
        "all", "group", F.col("index").alias("block"), F.col("total").alias("parts"), "digest"
    )
    groups = _exchanged(groups, ["all"]).select(
        "group", F.col("digest").alias("root"), F.col("proof").alias("group_proof")
    )
    upper = blocks.join(groups, "group").select(
        "group",
        "block",
        F.col("digest").alias("subroot"),
        "root",
        F.concat("proof", "group_proof").alias("proof"),
    )

    def prove(own_leaves: pa.Table, above: pa.Table) -> pa.Table:
        return _proven(own_leaves, above, proofs, block_levels)

    found = (
        placed.groupBy("group", "block")
        .cogroup(upper.groupBy("group", "block"))
        .applyInArrow(prove, _PROVEN)
    )
    return found if proofs else found.drop("proof")


def _group_key(source: Column) -> Column:
    """Never null, and in the order of sources with null first."""
    return F.coalesce(F.concat(F.lit("1"), source), F.lit("0"))


def _numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``index``, the place in the group from 0 on, and ``total``, its rows.

    A row's place in its partition is its ``_at``; it is written down, so that whatever is
    computed from it reads the same, also after an executor is lost.
    """
    placed = scratch.staged(
        rows.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    ).withColumn("_part", F.shiftright("_at", 33))
    stretches = placed.groupBy(*group, "_part").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        *group,
        "_part",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("total"),
    )
    return (
        placed.join(stretches, [*group, "_part"])
        .withColumn("index", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_at", "_part", "_first", "_before")
    )


# ---- Above the blocks -----------------------------------------------------------------


def _exchanged(parts: DataFrame, group: list[str]) -> DataFrame:
    """Adds ``proof``, and makes ``digest`` the root of the group, for every part of it.

    ``parts`` are numbered ``block`` of ``parts`` in their group and hold the root of their
    own subtree as ``digest``. One number, the most parts of a group, tells the rounds.
    """
    most = parts.agg(F.max("parts")).first()[0] or 0
    parts = parts.withColumn("proof", F.array().cast(_SIDES))
    span = 1
    while span < most:
        parts = _swapped(parts, group, span)
        span *= FANOUT
    return parts


def _swapped(parts: DataFrame, group: list[str], span: int) -> DataFrame:
    """One round: a part learns the roots of the subtrees of ``span`` parts beside its own."""
    subtree, place = F.floor(F.col("block") / span), F.col("block") % span
    members = F.least(F.lit(span).cast("bigint"), F.col("parts") - subtree * span)
    named = [c for c in parts.columns if c not in ("digest", "proof")]
    active = parts.where(F.col("parts") > span)
    sent = active.select(
        *named,
        "digest",
        "proof",
        subtree.alias("subtree"),
        place.alias("place"),
        # The places this part answers at: its own, and those an incomplete subtree lacks.
        F.explode(F.sequence(place, F.lit(span - 1).cast("bigint"), members)).alias("lane"),
    )
    sent = sent.withColumn("proof", F.when(F.col("lane") == F.col("place"), F.col("proof")))
    meeting = Window.partitionBy(*group, F.floor(F.col("subtree") / FANOUT), "lane")
    met = F.collect_list(F.struct("subtree", "digest")).over(meeting)
    heard = sent.withColumn("met", F.array_sort(met)).where("lane = place")

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("met", keep), lambda m: m["digest"]), "")

    side = F.struct(
        joined(lambda m: m["subtree"] < F.col("subtree")).alias("left"),
        joined(lambda m: m["subtree"] > F.col("subtree")).alias("right"),
    )
    heard = heard.select(
        *named,
        F.sha2(F.array_join("met.digest", ""), 256).alias("digest"),
        F.array_append("proof", side).alias("proof"),
    )
    return heard.unionByName(parts.where(F.col("parts") <= span).select(heard.columns))


# ---- Inside a block -------------------------------------------------------------------


def _digest(nodes: bytes) -> bytes:
    return sha256(nodes).hexdigest().encode()


def _levels(digests: list[bytes], total: int, most: int) -> list[list[bytes]]:
    """Nodes of a block, level by level; a group that has become one node is done."""
    levels, above = [digests], 1
    for _ in range(most):
        if total <= above:
            break
        below = levels[-1]
        levels.append(
            [_digest(b"".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)]
        )
        above *= FANOUT
    return levels


def _ordered(leaves: pa.Table) -> pa.Table:
    return leaves.sort_by("index")


def _encoded(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _block_root(leaves: pa.Table, most: int) -> pa.Table:
    leaves = _ordered(leaves)
    total = leaves["total"][0].as_py()
    return pa.table(
        {
            "group": leaves["group"].slice(0, 1).cast(pa.string()),
            "block": leaves["block"].slice(0, 1),
            "parts": pa.array([-(-total // FANOUT**most)], pa.int64()),
            "digest": [_levels(_encoded(leaves["leaf"]), total, most)[-1][0].decode()],
        }
    )


def _sides(nodes: list[bytes], at: int) -> tuple[bytes, bytes]:
    first = at - at % FANOUT
    return b"".join(nodes[first:at]), b"".join(nodes[at + 1 : first + FANOUT])


def _proven(leaves: pa.Table, above: pa.Table, proofs: bool, most: int) -> pa.Table:
    leaves = _ordered(leaves)
    digests = _encoded(leaves["leaf"])
    levels = _levels(digests, leaves["total"][0].as_py(), most)
    outer = [(s["left"].encode(), s["right"].encode()) for s in above["proof"][0].as_py()]
    # Sides from each level of the block up to the root, per node, from the top down.
    paths = [outer]
    for nodes in reversed(levels[1:-1]):
        paths = [[_sides(nodes, i), *paths[i // FANOUT]] for i in range(len(nodes))]
    root = above["root"][0].as_py()
    digest_of_proof, roots, told = [], [], []
    for i, claim in enumerate(_encoded(leaves["claim"])):
        path = paths[i // FANOUT]
        if len(levels) > 1:
            path = [_sides(digests, i), *path]
        digest_of_proof.append(sha256(b"".join(map(b"".join, path))).hexdigest())
        for left, right in path:
            claim = _digest(left + claim + right)
        roots.append(claim.decode())
        if proofs:
            told.append([{"left": x.decode(), "right": y.decode()} for x, y in path])
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    n = len(roots)
    return pa.table(
        {
            "doc_id": leaves["doc_id"],
            "source": leaves["source"].cast(pa.string()),
            "leaf": leaves["leaf"].cast(pa.string()),
            "subroot": pa.repeat(pa.scalar(above["subroot"][0].as_py(), pa.string()), n),
            "root": pa.repeat(pa.scalar(root, pa.string()), n),
            "proof_sha256": pa.array(digest_of_proof, pa.string()),
            "folded_root": pa.array(roots, pa.string()),
            "verified": pa.array([r == root for r in roots], pa.bool_()),
            "proof": pa.array(told if proofs else [None] * n, kind),
        }
    )
