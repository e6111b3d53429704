"""Benchmark decontamination: a positional inverted index and phrase intersection.

``build_index`` turns documents into index segments, one row per few megabytes of text.
A segment holds, for every indexed term, the sorted positions of its postings, and the
place of every document in the segment's position space. Documents keep a gap between
them, so no phrase reaches over two of them. Segments are written to the shared folder.

``phrases`` looks up word sequences: within a segment the postings of the rarest term of
each phrase are the first candidates; the postings of its other terms, rarest first, are
intersected after taking off their distance in the phrase. ``proximity`` accepts the
terms of a phrase in any order within ``slop`` words of its rarest term.

The test set is a stated query set and is worked off in blocks of ``block_windows``
phrases, which bounds what is sent to the executors. Terms are 64-bit hashes of words.

Defined cases: null and empty texts have no words; repeated rows are judged each for
itself; a null ``doc_id`` is kept; items without words are never found, items of the same
text are all reported, a null ``item_id`` hits words but is not listed; further columns
of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import arrays, scratch

WINDOW = 13
# Bytes of text per segment, and phrases looked up per pass over the index.
SEGMENT_BYTES = 4 << 20
BLOCK_WINDOWS = 100_000
# Terms that an index may be restricted to; a larger test set gets the index of all terms.
MOST_TERMS = 2_000_000

_SEGMENT = (
    "segment string, doc_ids array<bigint>, n_words array<int>, doc_starts binary, "
    "terms binary, counts binary, positions binary"
)
_PHRASE = "window_id bigint, length int, terms array<bigint>, items array<string>"
_HITS = (
    "segment string, ordinal int, doc_id bigint, n_words bigint, "
    "spans array<struct<first: bigint, last: bigint>>, items array<string>"
)


def _segments(gap: int, vocabulary):
    """Index segments of the documents of one task."""
    known = None if vocabulary is None else np.sort(vocabulary.value)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, to in arrays.chunks(batch.column(1), SEGMENT_BYTES):
                part = batch.slice(at, to - at)
                yield _segment(part, f"{task}-{number}", gap, known)
                number += 1

    return index


def _segment(part: pa.RecordBatch, name: str, gap: int, known) -> pa.RecordBatch:
    words = arrays.words_of(*arrays.text_buffer(part.column(1)))
    counts = np.diff(words.bounds)
    doc_starts = words.bounds[:-1] + gap * np.arange(len(counts))
    positions = arrays.ragged(doc_starts, counts).astype(np.int32)
    hashes = words.hashes
    if known is not None:
        # A table over 22 bits sorts out most words before the exact search.
        table = np.zeros(1 << 22, dtype=bool)
        table[(known >> np.uint64(42)).astype(np.int64)] = True
        maybe = table[(hashes >> np.uint64(42)).astype(np.int64)]
        hashes, positions = hashes[maybe], positions[maybe]
        term = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        same = known[term] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
        hashes, positions, term = hashes[same], positions[same], term[same]
        order = np.argsort(
            term.astype(np.uint16 if len(known) < 1 << 16 else np.int64), kind="stable"
        )
    else:
        order = np.argsort(hashes, kind="stable")
    hashes, positions = hashes[order], positions[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name]),
            pa.array([part.column(0).cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
            pa.array([counts.tolist()], pa.list_(pa.int32())),
            pa.array([doc_starts.astype(np.int32).tobytes()], pa.binary()),
            pa.array([hashes[first].tobytes()], pa.binary()),
            pa.array([np.diff(np.append(first, len(hashes))).astype(np.int32).tobytes()]),
            pa.array([positions.tobytes()], pa.binary()),
        ],
        names=[field.split()[0] for field in _SEGMENT.split(", ")],
    )


class Segment:
    """One index segment, ready for look-ups."""

    def __init__(self, row: dict):
        self.name = row["segment"]
        self.doc_ids = row["doc_ids"]
        self.n_words = row["n_words"]
        self.doc_starts = np.frombuffer(row["doc_starts"], dtype=np.int32)
        self.terms = np.frombuffer(row["terms"], dtype=np.uint64)
        self.counts = np.frombuffer(row["counts"], dtype=np.int32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], dtype=np.int32).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        term_of = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts)
        self.keys = (term_of << 32) | self.positions

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """Place of every term in the segment, -1 where it has none."""
        if not len(self.terms):
            return np.full(terms.shape, -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (term << 32) | position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (position >= 0) & (self.keys[at] == key)

    def near(self, term: np.ndarray, position: np.ndarray, slop: int) -> np.ndarray:
        """Whether the term has a posting within slop words of the position."""
        low = (term << 32) | np.maximum(position - slop, 0)
        at = np.minimum(np.searchsorted(self.keys, low), len(self.keys) - 1)
        return (self.keys[at] >= low) & (self.keys[at] <= ((term << 32) | (position + slop)))

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, position, side="right") - 1


def find(segment: Segment, terms: np.ndarray, lengths: np.ndarray, slop: int | None = None):
    """Matches of phrases in a segment: phrase number and position.

    ``terms`` is a matrix with a phrase per row. Without ``slop`` the words must follow
    each other, and the position is that of the first; with it they may stand in any
    order, and the position is that of the rarest term.
    """
    width = terms.shape[1]
    inside = np.arange(width)[None, :] < lengths[:, None]
    place = np.where(inside, segment.lookup(terms), 0)
    alive = np.flatnonzero((place >= 0).all(axis=1) & (lengths > 0))
    none = np.empty(0, dtype=np.int64)
    if not len(alive):
        return none, none
    place, lengths = place[alive], lengths[alive]
    counts = np.where(inside[alive], segment.counts[place], np.iinfo(np.int64).max)
    by_rarity = np.argsort(counts, axis=1, kind="stable")
    rarest = by_rarity[:, 0]
    row = np.arange(len(alive))
    term = place[row, rarest]
    sizes = segment.counts[term]
    found = np.repeat(row, sizes)
    position = segment.positions[arrays.ragged(segment.first[term], sizes)]
    if slop is None:
        position = position - np.repeat(rarest, sizes)
    for step in range(1, width):
        column = by_rarity[found, step]
        asked = column < lengths[found]
        term = place[found, column]
        if slop is None:
            ok = segment.has(term, position + column)
        else:
            ok = segment.near(term, position, slop)
        keep = ok | ~asked
        found, position = found[keep], position[keep]
        if not len(found):
            return none, none
    if slop is None:
        keep = position >= 0
        found, position = found[keep], position[keep]
    return alive[found], position


def _spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Unions of [start, end) intervals."""
    order = np.argsort(starts, kind="stable")
    out: list[tuple[int, int]] = []
    for s, e in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _search(block, all_documents: bool, slop: int | None):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, lengths, items = block.value
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                yield _hits(segment, terms, lengths, items, all_documents, slop)

    return search


def _hits(segment, terms, lengths, items, all_documents, slop) -> pa.RecordBatch:
    phrase, position = find(segment, terms, lengths, slop)
    document = segment.document(position)
    order = np.argsort(document, kind="stable")
    phrase, position, document = phrase[order], position[order], document[order]
    having, first = np.unique(document, return_index=True)
    of = dict(zip(having.tolist(), zip(first, [*first[1:], len(document)]), strict=True))
    rows = []
    for ordinal in range(len(segment.doc_ids)) if all_documents else having.tolist():
        spans, names = [], []
        if ordinal in of:
            a, b = of[ordinal]
            start = position[a:b] - segment.doc_starts[ordinal]
            spans = _spans(start, start + (lengths[phrase[a:b]] if slop is None else 1))
            names = sorted({x for p in np.unique(phrase[a:b]) for x in items[p]})
        rows.append(
            {
                "segment": segment.name,
                "ordinal": ordinal,
                "doc_id": segment.doc_ids[ordinal],
                "n_words": segment.n_words[ordinal],
                "spans": [{"first": s, "last": e - 1} for s, e in spans],
                "items": names,
            }
        )
    return pa.RecordBatch.from_pylist(rows, schema=_HITS_ARROW)


_HITS_ARROW = pa.schema(
    [
        ("segment", pa.string()),
        ("ordinal", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct phrases of the test items: their term hashes and the items that hold them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = arrays.words_of(*arrays.text_buffer(batch.column(1)))
            names, terms = [], []
            signed = words.hashes.view(np.int64)
            for i, name in enumerate(batch.column(0).to_pylist()):
                own = signed[words.bounds[i] : words.bounds[i + 1]].tolist()
                for at in range(max(1, len(own) - size + 1) if own else 0):
                    names.append(name)
                    terms.append(own[at : at + size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(terms, pa.list_(pa.int64()))],
                names=["item_id", "terms"],
            )

    slim = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return (
        slim.mapInArrow(cut, "item_id string, terms array<bigint>")
        .groupBy("terms")
        .agg(F.collect_set("item_id").alias("items"))
    )


def build_index(documents: DataFrame, vocabulary=None, gap: int = WINDOW) -> DataFrame:
    """The positional index of ``doc_id, text``, written to the shared folder.

    ``vocabulary`` is a broadcast array of the only terms to index; None indexes all.
    """
    slim = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    segments = slim.mapInArrow(_segments(gap, vocabulary), _SEGMENT)
    return scratch.staged(segments, "postings")


def _blocks(phrases: DataFrame, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """The phrases in blocks that are small enough to be sent to every executor."""
    total = phrases.count()
    parts = max(1, -(-total // max(1, most // 2)))
    for part in range(parts):
        rows = phrases
        if parts > 1:
            rows = phrases.where(F.pmod(F.xxhash64("terms"), F.lit(parts)) == part)
        rows = rows.collect()  # about most / 2 phrases of the stated query set
        width = max((len(r["terms"]) for r in rows), default=1)
        terms = np.zeros((len(rows), width), dtype=np.int64)
        for i, row in enumerate(rows):
            terms[i, : len(row["terms"])] = row["terms"]
        lengths = np.array([len(r["terms"]) for r in rows], dtype=np.int64)
        yield terms.view(np.uint64), lengths, [sorted(r["items"]) for r in rows]


def matches(
    spark: SparkSession,
    index: DataFrame,
    phrases: DataFrame,
    *,
    slop: int | None = None,
    all_documents: bool = True,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Documents with the words that phrases cover and the items the phrases belong to.

    A row per indexed document (``all_documents``) or per document with a match:
    ``segment, ordinal, doc_id, n_words, spans, items``; spans are word positions, merged.
    """
    found = None
    blocks = 0
    for block in _blocks(phrases, block_windows):
        sent = spark.sparkContext.broadcast(block)
        search = _search(sent, all_documents and found is None, slop)
        part = index.mapInArrow(search, _HITS)
        found = part if found is None else found.unionByName(part)
        blocks += 1
    if blocks == 1:
        return found
    merged = found.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.withColumn("spans", F.expr(_UNION_OF_SPANS))


# Folds sorted spans into their union.
_UNION_OF_SPANS = """
aggregate(spans, cast(array() as array<struct<first: bigint, last: bigint>>),
  (done, s) -> CASE
    WHEN size(done) > 0 AND s.first <= element_at(done, -1).last + 1 THEN concat(
      slice(done, 1, size(done) - 1),
      array(named_struct('first', element_at(done, -1).first,
                         'last', greatest(s.last, element_at(done, -1).last))))
    ELSE concat(done, array(s)) END)
"""


def contamination(
    documents: DataFrame, items: DataFrame, *, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """Per document the words that lie in a benchmark window, and whether that is too much.

    Columns: doc_id, n_words, n_hit, n_items, items, contaminated.
    """
    spark = documents.sparkSession
    phrases = scratch.staged(windows(items), "phrases")
    terms = phrases.select(F.explode("terms").alias("term")).distinct()
    vocabulary = None
    known = terms.limit(MOST_TERMS + 1).toPandas()["term"].to_numpy(dtype=np.int64)
    if len(known) <= MOST_TERMS:
        vocabulary = spark.sparkContext.broadcast(known.view(np.uint64))
    index = build_index(documents, vocabulary)
    found = matches(spark, index, phrases, block_windows=block_windows)
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        "items",
    ).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def clean_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated; columns stay as they are.

    Rows of one ``doc_id`` go if one of them is contaminated. Rows without ``doc_id``
    cannot be told apart and stay.
    """
    found = contamination(documents, items)
    bad = found.where("contaminated and doc_id is not null").select("doc_id").distinct()
    return documents.join(bad, "doc_id", "left_anti").select(*_as_they_are(documents))


def _as_they_are(documents: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in documents.columns]
