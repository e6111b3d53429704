"""Document fingerprints: bottom-k sketches of shingle hashes.

A shingle is a run of five words; the places before a text count as empty words, so a text
of n words has n shingles and short texts have some too. The sketch of a set of shingles
is its 128 smallest 48-bit hashes, as big-endian bytes in ascending order. The sketch of a
union is the 128 smallest of both sketches, so parts may be sketched apart and merged.

Two sketches estimate the resemblance (Jaccard similarity) of their sets: the share of the
smallest values of the union that both hold. A sketch of fewer than 128 values is the whole
set and counts exactly; otherwise its largest value gives the number of distinct shingles.
Both give the containment of one set in the other.

Defined cases: null and empty texts, and texts without words, have the empty sketch; two
empty sketches resemble each other by 1, an empty and another one by 0; equal texts have
equal sketches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from riskloom.llm import arrays

K = 128
SHINGLE_WORDS = 5
BYTES = 6  # of a hash in a sketch; two shingles of a text share one with a chance of 4e-15
_BIG = np.dtype(">u8")


def _packed(values: np.ndarray) -> bytes:
    return values.astype(_BIG).view(np.uint8).reshape(-1, 8)[:, 8 - BYTES :].tobytes()


def _shingle_hashes(words: arrays.Words) -> np.ndarray:
    """A shingle per word: the word and the four before it in the same text."""
    padding = SHINGLE_WORDS - 1
    heads = np.repeat(words.bounds[:-1], padding)
    runs = arrays.run_hashes(np.insert(words.hashes, heads, np.uint64(0)), SHINGLE_WORDS)
    texts = len(words.bounds) - 1
    counts = np.diff(words.bounds)
    return runs[arrays.ragged(words.bounds[:-1] + padding * np.arange(texts), counts)]


def sketches(column: pa.Array, k: int = K) -> list[bytes]:
    """The sketch of every text of a column."""
    out = []
    for at, to in arrays.chunks(column):
        words = arrays.words_of(*arrays.text_buffer(column.slice(at, to - at)))
        hashes = _shingle_hashes(words) >> np.uint64(64 - 8 * BYTES)
        for low, high in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            out.append(_packed(np.unique(hashes[low:high])[:k]))
    return out


def values_of(sketch: bytes | None) -> np.ndarray:
    told = np.frombuffer(sketch or b"", dtype=np.uint8).reshape(-1, BYTES)
    whole = np.zeros((len(told), 8), dtype=np.uint8)
    whole[:, 8 - BYTES :] = told
    return whole.reshape(-1).view(_BIG).astype(np.uint64)


def merged(sketches_: list[bytes], k: int = K) -> bytes:
    """The sketch of the union."""
    values = [values_of(s) for s in sketches_]
    together = np.unique(np.concatenate(values)) if values else np.empty(0, np.uint64)
    return _packed(together[:k])


def resemblance(a: bytes | None, b: bytes | None, k: int = K) -> float:
    if a == b:
        return 1.0
    x, y = values_of(a), values_of(b)
    union = np.union1d(x, y)[:k]
    common = np.intersect1d(x, y, assume_unique=True)
    # Only what is among the smallest of the union is known of both sets.
    return float((common <= union[-1]).sum() / len(union))


def distinct_shingles(sketch: bytes | None, k: int = K) -> float:
    values = values_of(sketch)
    if len(values) < k:
        return float(len(values))
    return (k - 1) / ((float(values[-1]) + 1) / 2.0 ** (8 * BYTES))


def containment(a: bytes | None, b: bytes | None, k: int = K) -> float:
    """Estimated share of the shingles of a that b has."""
    own = distinct_shingles(a, k)
    if not own:
        return 1.0
    j = resemblance(a, b, k)
    return min(1.0, j / (1 + j) * (own + distinct_shingles(b, k)) / own)


@F.arrow_udf(BinaryType())
def sketch(texts: pa.Array) -> pa.Array:
    """The sketch of every text, as a column."""
    return pa.array(sketches(texts), pa.binary())


_LIKENESS = StructType(
    [
        StructField("sketch", BinaryType()),
        StructField("near_first", DoubleType()),
        StructField("near_second", DoubleType()),
        StructField("contained", DoubleType()),
        StructField("distinct", DoubleType()),
    ]
)


@F.arrow_udf(_LIKENESS)
def likeness(first: pa.Array, texts: pa.Array, second: pa.Array) -> pa.Array:
    """Each text's sketch, and what two sketches tell when one is compared with the others.

    ``near_first`` is the resemblance of the first sketch and the text's, ``near_second`` of
    the first and the second; ``contained`` is the share of the text's shingles that the first
    has, ``distinct`` the number of shingles behind the first. All in one pass, so that a
    task has one Python worker, and texts do not come back from it.
    """
    found = sketches(texts)
    one, two = first.to_pylist(), second.to_pylist()
    told = {
        "near_first": [resemblance(a, b) for a, b in zip(one, found, strict=True)],
        "near_second": [resemblance(a, b) for a, b in zip(one, two, strict=True)],
        "contained": [containment(b, a) for a, b in zip(one, found, strict=True)],
        "distinct": [distinct_shingles(a) for a in one],
    }
    columns = [pa.array(values, pa.float64()) for values in told.values()]
    return pa.StructArray.from_arrays([pa.array(found, pa.binary()), *columns], ["sketch", *told])


def merged_by(frame: DataFrame, by: list[str], name: str = "sketch") -> DataFrame:
    """One sketch per group. Only the smallest values of each task are shuffled."""
    cut = f"substring(`{name}`, i * {BYTES} + 1, {BYTES})"
    one = F.expr(f"transform(sequence(0, {K - 1}), i -> {cut})")
    values = frame.select(*by, F.explode(F.filter(one, lambda v: F.length(v) == BYTES)).alias("_v"))
    values = values.groupBy(*by, "_v").agg(F.lit(1).alias("_n"))
    first = Window.partitionBy(*by).orderBy("_v")
    least = values.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= K)
    lists = least.groupBy(*by).agg(F.array_sort(F.collect_list(F.hex("_v"))).alias("_v"))
    return lists.select(*by, F.unhex(F.array_join("_v", "")).alias(name))


def with_next(
    spark: SparkSession, documents: DataFrame, carried: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, text`` and the carried columns, and the same of the next document.

    Next is by descending id, and after the last document comes the first; its columns are
    named ``next_text`` and so on. Rows of one id follow each other by a hash of the text,
    then by the text; rows without id come last, in the same order. The table is cut into as
    many ranges as Spark has shuffle partitions, an id that has the rows of several ranges,
    and the rows without id, by that hash. The first document of a range is also given to the
    range before it, so that no order over the whole table is needed.
    """
    slim = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *carried,
    )
    slim = slim.withColumn("_hash", F.xxhash64("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = _ranges(slim, parts).withColumn("_tail", F.lit(0))
    # One row per range: where its first document is. Ranges follow by part, then piece.
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("id"), F.col("_hash").alias("hash")))
    heads = named.groupBy("_part", "_piece").agg(first.alias("head"))
    heads = heads.orderBy(F.desc("_part"), "_piece").collect()
    table = spark.createDataFrame(
        [
            (None if h.head.id is None else ~h.head.id, h.head.hash, before._part, before._piece)
            for before, h in zip([*heads[-1:], *heads[:-1]], heads, strict=True)
        ],
        "head bigint, hash bigint, _part double, _piece int",
    )
    at_head = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("_hash") == F.col("hash"))
    tails = slim.join(F.broadcast(table), at_head)
    tails = tails.groupBy("_part", "_piece").agg(F.min(F.struct("text", *carried)).alias("_next"))
    tails = tails.select("_part", "_piece", "_next.*", F.lit(1).alias("_tail"))
    order = Window.partitionBy("_part", "_piece").orderBy(
        "_tail", F.col("doc_id").desc_nulls_last(), "_hash", "text"
    )
    rows = named.unionByName(tails, allowMissingColumns=True)
    for name in ("text", *carried):
        rows = rows.withColumn(f"next_{name}", F.lead(name).over(order))
    told = [c for name in ("text", *carried) for c in (name, f"next_{name}")]
    return rows.where("_tail = 0").select("doc_id", *told)


def _ranges(slim: DataFrame, parts: int) -> DataFrame:
    """Adds ``_part``, ascending by id, and ``_piece`` inside it: about ``parts`` ranges."""
    from pyspark.ml.feature import Bucketizer

    shares = [i / parts for i in range(1, parts)]
    quantiles = slim.approxQuantile("doc_id", shares, 0.1 / parts) if shares else []
    cuts = sorted(set(quantiles)) or [0.0]
    splits = [-float("inf"), *cuts, float("inf")]
    rows = slim.withColumn("_id", F.col("doc_id").cast("double"))
    cut = Bucketizer(splits=splits, inputCol="_id", outputCol="_part", handleInvalid="keep")
    without = F.col("doc_id").isNull()
    rows = cut.transform(rows).withColumn(
        "_part", F.when(without, -1.0).otherwise(F.col("_part"))
    )
    # An id that several quantiles fall on has that many ranges, the rows without id their share.
    often = {float(v): n for v in cuts if (n := quantiles.count(v)) > 1}
    counts = slim.agg(F.count("*").alias("rows"), F.count_if(without).alias("nulls")).first()
    pieces = F.when(without, -(-parts * counts.nulls // max(counts.rows, 1)))
    if often:
        table = F.create_map(*[F.lit(x) for pair in often.items() for x in pair])
        pieces = pieces.when(F.col("_id").isin(*often), table[F.col("_id")])
    place = F.col("_hash") / float(1 << 64) + 0.5
    piece = F.least(F.floor(place * pieces), pieces - 1) + 1
    return rows.withColumn("_piece", F.coalesce(piece, F.lit(0)).cast("int")).drop("_id")
