"""Near duplicates by ProbMinHash (Ertl 2020), banding, and exact verification.

Elements are the distinct runs of five words of a text; one that is seen n times weighs
1 + ln(n). Each
element is a Poisson process whose rate is its weight; an arrival goes to a random one of
128 registers, which keeps the element that arrived first. An element stops as soon as its
next arrival is later than the last filled register of its text. Two texts agree in a
register with the probability Jaccard similarity of their weights, which is the Jaccard
similarity of their sets where no run repeats.

Registers are banded 32 x 4: texts of similarity 0.8 miss all bands with a chance of
5e-8. Equal word sequences are one node from the start. Within the buckets nodes are
compared with a few centres a round (``buckets``), where pairs whose registers rule out 0.8
are left; what the rounds left is found exactly, by prefixes. All are verified by the exact value of the similarity
that is sketched. The runs of texts that share a bucket are written once, and texts are not
read again. Classes are the connected components of the
verified links.

Defined cases: null text reads as empty; texts without words are alike only if equal byte
for byte; texts of one to four words have one run, all their words; rows of one ``doc_id``
share a class; rows without ``doc_id`` are matched to copies of the same words only;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import arrays, buckets, scratch, worker

SHINGLE_WORDS = 5
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
# The estimate of a pair at 0.8 has a deviation of 0.035; this is eight of them below.
LEAST_ESTIMATE = 0.5

_SIGNATURE = "doc_id bigint, d1 bigint, d2 bigint, bands array<bigint>"
_RUNS = "node bigint, runs struct<values: array<bigint>, times: array<int>>"
_ELEMENTS = (
    "transform(runs.values, (v, i) -> "
    "struct(v AS run, coalesce(1D + ln(get(runs.times, i)), 1D) AS weight))"
)
# Sums of logarithms in another order differ in their last digits.
_TOLERANCE = 1e-9


def prob_min_hash(
    owner: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, registers: int
) -> np.ndarray:
    """Matrix texts x registers of the elements that arrived first; 0 where there is none.

    ``owner`` is the text of every element, ``value`` its hash. ``registers`` is a power
    of two.
    """
    first = np.full(texts * registers, np.inf)
    holder = np.zeros(texts * registers, dtype=np.uint64)
    time = np.zeros(len(value))
    step = 0
    while len(value):
        step += 1
        with np.errstate(over="ignore"):
            random = arrays.mixed(value + np.uint64(step * 0xD1342543DE82EF95 % (1 << 64)))
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weight
        slot = owner * registers + (random & np.uint64(registers - 1)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        holder[slot[won]] = value[won]
        last = first.reshape(texts, registers).max(axis=1)
        going = time < last[owner]
        owner, value, weight, time = owner[going], value[going], weight[going], time[going]
    return holder.reshape(texts, registers)


def _weight(times: np.ndarray) -> np.ndarray:
    """Weight of a run that is seen so many times."""
    return 1 + np.log(times)


def packed(registers: np.ndarray) -> np.ndarray:
    """A band key per four registers: 16 bits of each."""
    short = (registers & np.uint64(0xFFFF)).reshape(len(registers), -1, ROWS)
    shift = np.arange(ROWS, dtype=np.uint64) * np.uint64(16)
    return np.bitwise_or.reduce(short << shift, axis=2)


def _digests(words: arrays.Words, data, offsets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the word sequence of every text, or of its bytes if it has no words."""
    counts = np.diff(words.bounds)
    place = arrays.ragged(np.zeros(len(counts), dtype=np.int64), counts).astype(np.uint64)
    out = []
    for salt in (1, 2):
        with np.errstate(over="ignore"):
            terms = arrays.mixed(words.hashes ^ arrays.mixed(place * np.uint64(2) + np.uint64(salt)))
        total = np.concatenate(([np.uint64(0)], np.cumsum(terms)))
        sums = total[words.bounds[1:]] - total[words.bounds[:-1]]
        out.append(arrays.mixed(sums ^ counts.astype(np.uint64)))
    for i in np.flatnonzero(counts == 0):
        raw = hashlib.sha256(data[offsets[i] : offsets[i + 1]].tobytes()).digest()
        out[0][i], out[1][i] = np.frombuffer(raw[:16], dtype=np.uint64)
    return out[0], out[1]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker.clear()
    for batch in batches:
        for at, to in arrays.chunks(batch.column(1)):
            part = batch.slice(at, to - at)
            data, offsets = arrays.text_buffer(part.column(1))
            words = arrays.words_of(data, offsets)
            values, bounds = arrays.shingles(words, SHINGLE_WORDS)
            owner, value, times = arrays.distinct_runs(values, bounds)
            sketch = prob_min_hash(owner, value, _weight(times), to - at, REGISTERS)
            keys = packed(sketch).view(np.int64)
            having = np.diff(words.bounds) > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(having) * BANDS)).astype(np.int32)),
                pa.array(keys[having].ravel()),
            )
            d1, d2 = _digests(words, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), arrays.signed(d1), arrays.signed(d2), lists],
                names=["doc_id", "d1", "d2", "bands"],
            )


def signatures(documents: DataFrame) -> DataFrame:
    """Digest and band keys of every row of ``doc_id, text``."""
    slim = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(_signed, _SIGNATURE)


def _agreement(a: str, b: str) -> F.Column:
    """Share of equal registers of two signatures."""
    lanes = " + ".join(
        f"if((shiftright(x ^ y, {16 * i}) & 65535) = 0, 1, 0)" for i in range(ROWS)
    )
    equal = f"aggregate(zip_with({a}, {b}, (x, y) -> {lanes}), 0, (n, e) -> n + e)"
    return F.expr(f"{equal} / {REGISTERS}D")


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct runs of every text; rows that repeat in a batch are given once.

    ``times`` is empty where no run repeats.
    """
    worker.clear()
    for batch in batches:
        for at, to in arrays.chunks(batch.column(1)):
            part = batch.slice(at, to - at)
            data, offsets = arrays.text_buffer(part.column(1))
            words = arrays.words_of(data, offsets)
            digests = zip(*(d.tolist() for d in _digests(words, data, offsets)), strict=True)
            ids = part.column(0).to_pylist()
            once = {key: i for i, key in enumerate(zip(ids, digests, strict=True))}
            values, bounds = arrays.shingles(words, SHINGLE_WORDS)
            runs, times = [], []
            for i in once.values():
                own, seen = np.unique(values[bounds[i] : bounds[i + 1]], return_counts=True)
                runs.append(own)
                times.append(seen if (seen > 1).any() else seen[:0])
            flat = np.concatenate([np.empty(0, dtype=np.uint64), *runs])
            seen = np.concatenate([np.empty(0, dtype=np.int64), *times]).astype(np.int32)
            lists = pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(_ends(runs), arrays.signed(flat)),
                    pa.ListArray.from_arrays(_ends(times), pa.array(seen)),
                ],
                names=["values", "times"],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in once], pa.int64()), lists], names=["node", "runs"]
            )


def _ends(lists: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32))


def _runs_table(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """``node, runs`` of the asked nodes. Their texts are shuffled here and nowhere else."""
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text")
    )
    # One way at every size: the ids grow with the documents and are never broadcast.
    asked = texts.join(nodes.hint("merge"), "node", "left_semi")
    return scratch.staged(asked.mapInArrow(_runs_of, _RUNS), "runs")


def _likely(sketches: DataFrame):
    """Leaves out pairs whose registers rule out a similarity of 0.8."""
    left = sketches.select(F.col("node").alias("a"), F.col("bands").alias("bands_a"))
    right = sketches.select(F.col("node").alias("b"), F.col("bands").alias("bands_b"))

    def likely(pairs: DataFrame) -> DataFrame:
        both = pairs.join(left, "a").join(right, "b")
        return both.where(_agreement("bands_a", "bands_b") >= LEAST_ESTIMATE).select("a", "b")

    return likely


def probability_jaccard(
    left: np.ndarray, left_weight: np.ndarray, right: np.ndarray, right_weight: np.ndarray
) -> float:
    """Sum over the common elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i).

    The larger of the two terms is x_j / x_i for the elements whose x_j / y_j is above that
    of i, so that sums up to each element in this order give all denominators. Elements are
    distinct on either side.
    """
    _, at, to = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    x, y = left_weight[at], right_weight[to]
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    above = left_weight.sum() - np.cumsum(x)
    below = right_weight.sum() - y.sum() + np.cumsum(y)
    return float((1 / (above / x + below / y)).sum())


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves out pairs with repeated runs that are not similar. Other pairs come verified."""
    worker.clear()
    for batch in batches:
        keep = np.ones(len(batch), dtype=bool)
        sides = [batch.column(2), batch.column(3)]
        for i in np.flatnonzero(sides[0].is_valid().to_numpy(zero_copy_only=False)):
            parts = []
            for side in sides:
                own = side.field("values")[int(i)].values.to_numpy()
                times = side.field("times")[int(i)].values.to_numpy()
                parts += [own, _weight(times) if len(times) else np.ones(len(own))]
            keep[i] = probability_jaccard(*parts) >= buckets.SIMILARITY - _TOLERANCE
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
            pa.array(keep)
        )


def _weighted_alike(both: DataFrame) -> DataFrame:
    """The pairs among ``a, b, x, y`` whose weighted runs have a similarity of 0.8 or more.

    Where no run of a pair repeats, that is the similarity of sets, which needs no Python.
    """
    repeats = (F.size("x.times") > 0) | (F.size("y.times") > 0)
    similar = buckets.sets_alike("x.values", "y.values")
    rows = both.where(repeats | similar).select(
        "a", "b", F.when(repeats, F.col("x")).alias("x"), F.when(repeats, F.col("y")).alias("y")
    )
    return rows.mapInArrow(_weighed, "a bigint, b bigint")


def classes(documents: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, the class it belongs to and whether it stays.

    ``class_id`` is the least ``doc_id`` of the class; the first row of that document
    stays (``kept``).
    """
    rows = scratch.staged(signatures(documents), "signatures")
    heads = rows.groupBy("d1", "d2").agg(
        F.coalesce(F.min("doc_id"), F.col("d1")).alias("node"),
        F.max("doc_id").isNotNull().alias("named"),
        F.any_value("bands").alias("bands"),
    )
    heads = scratch.staged(heads, "heads")
    members = (
        heads.where("named")
        .select("node", F.posexplode("bands").alias("band", "key"))
        .select(F.xxhash64("band", "key").alias("key"), "node")
    )
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # Not broadcast where it is small: the keys of a corpus are not bounded.
    members = scratch.staged(members.join(shared.hint("merge"), "key", "left_semi"), "members")
    nodes = scratch.staged(members.select("node").distinct(), "nodes")
    sketches = heads.where("named").select("node", "bands").join(nodes, "node", "left_semi")
    sketches = scratch.staged(sketches, "sketches")
    labels = buckets.classes(
        members, _runs_table(nodes, documents), _likely(sketches), _weighted_alike, _ELEMENTS
    )
    out = rows.select("doc_id", "d1", "d2").join(heads.select("d1", "d2", "node"), ["d1", "d2"])
    if labels is not None:
        out = out.join(labels, "node", "left")
        out = out.withColumn("class_id", F.coalesce("component", "node"))
    else:
        out = out.withColumn("class_id", F.col("node"))
    return out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def distinct_documents(documents: DataFrame) -> DataFrame:
    """The documents without near duplicates: of each class its least ``doc_id`` stays.

    Repeated rows of a document that stays are reduced to one. Rows without ``doc_id``
    cannot be told apart and all stay.
    """
    found = classes(documents).where("kept").select("doc_id").distinct()
    named = documents.where("doc_id is not null").join(found, "doc_id", "left_semi")
    columns = [c for c in documents.columns if c != "doc_id"]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in columns]
    first = Window.partitionBy("doc_id").orderBy(*order)
    place = "_" * max(map(len, documents.columns)) + "row"  # no column has this name
    named = named.withColumn(place, F.row_number().over(first))
    named = named.where(F.col(place) == 1).drop(place)
    return named.unionByName(documents.where("doc_id is null"))
