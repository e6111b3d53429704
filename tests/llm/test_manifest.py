"""The Merkle manifest against a tree built in one place."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from riskloom.llm import manifest
from tests.llm import data


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    told = [row[k] for k in manifest.FIELDS]
    texts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in told]
    return digest(*texts)


def tree(nodes):
    """Root, and for every node its siblings as (left, right) per level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, where):
            first = at - at % 16
            path.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        where = [at // 16 for at in where]
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        order = (row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row))
        groups[row["source"]].append((*order, row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        inner[name] = tree([x[2] for x in groups[name]])
    root, outer = tree([inner[n][0] for n in names])
    out = []
    for name, above in zip(names, outer):
        for (*_, own, row), path in zip(groups[name], inner[name][1]):
            path = path + above
            claim = own
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                claim = leaf_of(row | {"text": lowered(row["text"])})
            for left, right in path:
                claim = digest(left, claim, right)
            proof = digest(*[left + right for left, right in path])
            out.append(
                (row["doc_id"], own, inner[name][0], root, proof, claim, claim == root)
            )
    return sorted(out, key=str)


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def found(spark, rows, **options):
    schema = data.DOCUMENTS + ", block bigint, `group` string, digest int"
    frame = spark.createDataFrame(
        [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) + (1, "x", 2) for r in rows],
        schema,
    ).repartition(7)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(tampered, manifest.leaf(text=lower))
    return manifest.manifest(frame, F.coalesce(claimed, manifest.leaf()), **options)


def row(doc_id, text, source, lang="en", n_chars=3):
    return {"doc_id": doc_id, "text": text, "lang": lang, "source": source, "n_chars": n_chars}


def test_edge_rows_equal_one_tree(spark):
    rng = random.Random(3)
    rows = [row(i, t, "s", None, None) for i, t in data.edge_rows(rng)]
    rows += [row(i, f"Text {i} É", f"s{i % 40}") for i in range(1000, 1300)]
    rows += [row(-5, "Alone", None), row(-4, "x", ""), row(None, None, None), row(7, "B", "ünï")]
    got = [tuple(r) for r in found(spark, rows).drop("source").collect()]
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_several_rounds_with_incomplete_subtrees(spark, levels):
    # Small blocks, so that a few thousand leaves take as many rounds as billions would.
    sizes = {"hot": 16 * 16 * 16 + 16 * 17 + 1, "one": 1, "two": 2, "full": 256, "over": 257}
    rows = [row(i, f"T{i}", s) for s, n in sizes.items() for i in range(n)]
    frame = found(spark, rows, block_levels=levels).drop("source")
    assert sorted([tuple(r) for r in frame.collect()], key=str) == brute(rows)


def test_one_row_and_no_rows(spark):
    assert found(spark, []).count() == 0
    alone = found(spark, [row(1, "a", "s")], proofs=True).collect()
    assert [(r.leaf == r.root == r.subroot, r.proof, r.verified) for r in alone] == [
        (True, [], True)
    ]


def test_proofs_fold_to_the_root(spark):
    rows = [row(i, f"Text {i}", f"s{i % 3}") for i in range(200)]
    frame = found(spark, rows, proofs=True)
    folded = frame.where(manifest.folded(F.col("leaf"), F.col("proof")) == F.col("root"))
    assert folded.count() == 200
    changed = frame.where("not verified").count()
    assert changed == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)) > 0
