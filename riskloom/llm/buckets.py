"""Links inside the buckets of a banding, without the pairs of a bucket.

Work goes in rounds. In a round a node asks ``ASKS`` of its buckets, every asked bucket whose
nodes are in several classes names a centre, and a node takes the centres that it meets in
most of the buckets it asked: at most ``CENTRES`` pairs a node and round, however large the
buckets are. Pairs are verified on the runs of both nodes, and classes grow by the components
of the links.

The first round asks the largest buckets, and their centre is the node that meets most others
over all of its buckets, such as the text that copies were made from. Later rounds draw
buckets and centres by hash, small buckets first: a bucket's place in the draw is its size
times a random number, the same for all its nodes. A bucket of n nodes is left alone after about
log2(n) rounds: one of two nodes has nothing more to say. Texts with a common part meet under the
few bands of that part in one large bucket; those that are alike beyond it also meet in small
buckets, and find each other there. Rounds end when one adds fewer links than ``LEAST_YIELD``
of the nodes, as finding the rest exactly then costs less than another round.

What the rounds did not draw is then found exactly (``rest``), by prefixes (Chaudhuri et al.
2006, Bayardo et al. 2007): with all runs in one order, rare ones first, two sides that have
0.8 in common share a run among those that begin within the first 0.2 of either side's weight.
Runs of a single class come first of all and lead to no pair, so a node with more than 0.2 of
them is compared with nothing. All pairs of nodes of different classes that share a run of
their prefixes are verified; nothing limits their number.

A hot centre is not one task: its runs are laid beside ``SALTS`` slices of its nodes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import links, scratch

SIMILARITY = 0.8
ASKS = 8
CENTRES = 4
LEAST_YIELD = 0.01
SALTS = 32
# Sums of weights in another order differ in their last digits.
_TOLERANCE = 1e-6


def sets_alike(x: str, y: str) -> Column:
    """Whether two arrays of distinct values have a Jaccard similarity of 0.8 or more."""
    common = F.size(F.array_intersect(x, y))
    return common >= SIMILARITY * (F.size(x) + F.size(y) - common)


def _similar_sets(both: DataFrame) -> DataFrame:
    return both.where(sets_alike("x", "y")).select("a", "b")


def beside(pairs: DataFrame, runs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` with their ``runs`` as ``x`` and ``y``.

    ``b`` may be one node in very many pairs.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    right = salted.select("b", "salt").distinct().join(
        runs.select(F.col("node").alias("b"), F.col("runs").alias("y")), "b"
    )
    left = runs.select(F.col("node").alias("a"), F.col("runs").alias("x"))
    return salted.join(left, "a").join(right, ["b", "salt"])


def alike(pairs: DataFrame, runs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose runs, arrays of distinct values, are similar to 0.8 or more."""
    return _similar_sets(beside(pairs, runs))


def _paired(nodes: DataFrame, round_no: int) -> DataFrame:
    """Pairs of nodes ``a`` with centres ``b`` of other classes, at most CENTRES a node."""
    if round_no == 0:
        place, left = "CAST(-x.n AS double)", "true"
        draw = F.struct(-F.col("crowd"), F.xxhash64("node"))
    else:
        place = f"x.n * pmod(xxhash64(x.key, {round_no}), 1048576D)"
        left = f"x.n > {2 ** (round_no - 1)}"
        draw = F.struct(F.xxhash64("own", F.lit(round_no)), F.lit(0))
    places = f"transform(filter(keys, x -> {left}), x -> struct({place} AS place, x.key))"
    first = f"slice(array_sort({places}), 1, {ASKS})"
    asked = nodes.select(
        "node", "own", draw.alias("draw"), F.explode(F.expr(first)).alias("ask")
    ).select("node", "own", "draw", "ask.key")
    centres = asked.groupBy("key").agg(
        F.min("own").alias("low"),
        F.max("own").alias("high"),
        F.min(F.struct("draw", "own", "node")).alias("centre"),
    )
    centres = centres.where("low <> high").select(
        "key", F.col("centre.own").alias("centre_own"), F.col("centre.node").alias("centre")
    )
    met = asked.join(centres, "key").where("own <> centre_own")
    met = met.groupBy("node", "centre").agg(F.count("*").alias("n"))
    best = F.sort_array(F.collect_list(F.struct("n", "centre")), asc=False)
    best = met.groupBy("node").agg(F.slice(best, 1, CENTRES).alias("best"))
    return best.select(F.col("node").alias("a"), F.explode("best.centre").alias("b"))


SETS = "transform(runs, x -> struct(x AS run, 1D AS weight))"


def rest(
    runs: DataFrame,
    labels: DataFrame | None,
    elements: str = SETS,
    verified: Callable[[DataFrame], DataFrame] = _similar_sets,
) -> DataFrame:
    """All similar pairs ``a, b`` of nodes of different classes.

    ``elements`` gives the runs of a node as an array of ``run, weight``. Similarity must not
    be above the common share, the sum of the lesser of both sides' parts of their weight, as
    is true of sets and of ``near_dup.probability_jaccard``.

    Where two sides first share a run, the parts u and v of their weight before it are not
    common. The similarity is then at most (1 - u) (1 - v) / (1 - u v), with equality for
    sets without further differences: each term is at most x y / (y + v x), which is concave
    and homogeneous, so that the sum is at most its value at the sums 1 - u and 1 - v. Sides
    whose runs weigh 1 are sets; what is left of the smaller one must hold all that they need
    in common. Every similar pair passes at the run that it shares first.
    """
    own = F.col("node")
    if labels is not None:
        runs_of = runs.join(labels, "node", "left")
        own = F.coalesce("component", "node")
    else:
        runs_of = runs
    # One node can have several texts, so that a row is told by its runs as well.
    told = runs_of.select(
        "node", own.alias("own"), F.xxhash64("runs").alias("text"), F.expr(elements).alias("e")
    )
    total = F.aggregate("e", F.lit(0.0), lambda sum_, e: sum_ + e.weight)
    # Summed in a step of its own: beside the explode, Spark would carry the whole array to
    # every element and sum it up there.
    told = told.select("node", "own", "text", total.alias("total"), F.size("e").alias("size"), "e")
    # Without the _outer, Spark would build the array once more to see whether it is empty.
    parts = told.select("node", "own", "text", "total", "size", F.explode_outer("e").alias("e"))
    parts = parts.select("node", "own", "text", "total", "size", "e.run", "e.weight")
    common = parts.groupBy("run").agg(
        F.count("*").alias("n"), F.min("own").alias("low"), F.max("own").alias("high")
    )
    common = common.where("low <> high").select("run", "n")
    side = Window.partitionBy("node", "text")
    earlier = side.orderBy("n", "run").rowsBetween(Window.unboundedPreceding, -1)
    alone = F.col("total") - F.sum("weight").over(side)
    begins = alone + F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    prefix = parts.join(common, "run").withColumn("begins", begins)
    prefix = prefix.where(F.col("begins") <= (1 - SIMILARITY + _TOLERANCE) * F.col("total"))
    # The size of a set; none where runs weigh more than 1.
    size = F.expr("CASE WHEN total = size THEN total END").alias("size")
    part = (F.col("begins") / F.col("total")).alias("part")
    prefix = scratch.staged(prefix.select("run", "node", "own", size, part).distinct(), "prefixes")
    met = prefix.groupBy("run").agg(F.min("own").alias("low"), F.max("own").alias("high"))
    prefix = prefix.join(met.where("low <> high").select("run"), "run", "left_semi")
    left = prefix.toDF("run", "a", "own_a", "size_a", "u")
    right = prefix.toDF("run", "b", "own_b", "size_b", "v")
    pairs = left.join(right, "run").where("a < b AND own_a <> own_b")
    least = SIMILARITY - _TOLERANCE
    pairs = pairs.where(f"(1 - u) * (1 - v) >= {least}D * (1 - u * v)")
    needed = f"{least / (1 + least)}D * (size_a + size_b)"
    left_over = "least(size_a * (1 - u), size_b * (1 - v))"
    pairs = pairs.where(f"coalesce({left_over} >= {needed} - {_TOLERANCE}D, true)")
    pairs = pairs.select("a", "b").distinct()
    return scratch.staged(verified(beside(scratch.staged(pairs, "rest"), runs)), "rest-links")


def joined(labels: DataFrame | None, found: DataFrame) -> DataFrame | None:
    """``node, component`` after the links ``a, b`` that were found; None without any."""
    return _joined(labels, found)[0]


def _joined(labels: DataFrame | None, found: DataFrame) -> tuple[DataFrame | None, int]:
    """The labels after the links that were found, and the number of the links."""
    if labels is not None:
        # Links between classes, so that what has grown together counts as one node.
        of_a, of_b = labels.toDF("a", "own_a"), labels.toDF("b", "own_b")
        found = found.join(of_a, "a", "left").join(of_b, "b", "left").select(
            F.coalesce("own_a", "a").alias("a"), F.coalesce("own_b", "b").alias("b")
        )
    found = scratch.staged(found, "links")
    n = found.count()
    if not n:
        return labels, n
    grown = links.components(found)
    if labels is None:
        return grown, n
    kept = labels.join(grown.toDF("component", "to"), "component", "left")
    kept = kept.select("node", F.coalesce("to", "component").alias("component"))
    fresh = grown.join(labels.select("node"), "node", "left_anti")
    return scratch.staged(kept.unionByName(fresh), "labels"), n


def classes(
    members: DataFrame,
    runs: DataFrame,
    likely: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
    verified: Callable[[DataFrame], DataFrame] = _similar_sets,
    elements: str = SETS,
) -> DataFrame | None:
    """``node, component`` of the nodes that have a link to another one; None without links.

    ``members`` has ``key, node``, a few keys a node. ``component`` is the least node of a
    class. ``likely`` may leave out pairs ``a, b`` before they are verified; ``verified`` keeps
    the similar ones of ``a, b, x, y``, where ``x`` and ``y`` are the runs. Both tables are read more than
    once: staged ones. After the rounds ``rest`` finds what they left.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # A node is one row with its keys from here on.
    nodes = members.join(sizes, "key").groupBy("node").agg(
        F.collect_set(F.struct("key", "n")).alias("keys"), F.sum("n").alias("crowd")
    )
    nodes = scratch.staged(nodes, "nodes")
    least = LEAST_YIELD * nodes.count()
    labels, round_no, n = None, 0, least
    while n and n >= least:
        if labels is None:
            named = nodes.withColumn("own", F.col("node"))
        else:
            named = nodes.join(labels, "node", "left")
            named = named.withColumn("own", F.coalesce("component", "node"))
        pairs = scratch.staged(likely(_paired(named, round_no)), "pairs")
        found = verified(beside(pairs, runs))
        round_no += 1
        labels, n = _joined(labels, found)
        scratch.release(members.sparkSession)
    return joined(labels, rest(runs, labels, elements, verified))
