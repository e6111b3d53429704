"""Text quality by votes of the nearest labelled texts in a latent-semantic space.

The terms of a text are its triples of neighbouring character classes (lower case, upper
case, digit, each punctuation mark, space, ...), hashed to ``TERMS`` columns, its words and
its letter triples, hashed to ``WORDS`` and ``LETTERS`` columns, and what these cannot show:
words that repeat the word before them, and the length class of short texts. Root
frequencies are weighted by inverse document frequency; a truncated singular value
decomposition of the labelled sample gives the latent space. The labelled vectors (at most
``MOST_LABELLED``, a documented bound) are broadcast. For every document the cosines with
all of them are computed exactly, in blocks; its ``NEIGHBOURS`` nearest vote with their
labels, weighted by a power of the cosine.

Projections and cosines are products of whole numbers small enough that every sum of them
is exact, in any order: a text has one score, whatever block or task it is scored in.

Defined cases: null and empty texts are texts of no words, whose neighbours are short
texts; of equally near neighbours the one with the lower id votes; without labelled rows
every score is 0.5; repeated rows get a row each; an id that is labelled and occurs several
times is fitted with the least of its texts; a null ``doc_id`` is in fold 0; further columns
are ignored, but a column of the score's name is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskloom.llm import arrays, labelled, worker

MOST_LABELLED = 4096
TERMS, WORDS, LETTERS = 1024, 512, 512
HASHED = TERMS + WORDS + LETTERS
LENGTHS = 6  # classes of texts of under 32 words
FEATURES = HASHED + 1 + LENGTHS
# Words and letters are many and rare, character classes few: the share of the former.
WORD_SHARE = 0.5
LATENT = 48
NEIGHBOURS = 25
SHARPNESS = 8
BLOCK_DOCUMENTS = 256
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_FINE = 1 << 20

_CLASSES = 38
_CLASS = np.full(256, 0, dtype=np.int64)  # controls
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[32], _CLASS[10], _CLASS[128:] = 4, 5, 1
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_MARKS] = 6 + np.arange(len(_MARKS))

_LETTER = np.arange(256, dtype=np.int64)
_LETTER[65:91] += 32


def _triples(kind: np.ndarray, kinds: int) -> np.ndarray:
    return arrays.mixed(((kind[:-2] * kinds + kind[1:-1]) * kinds + kind[2:]).astype(np.uint64))


def _root_shares(owner: np.ndarray, hashes: np.ndarray, texts: int, columns: int) -> np.ndarray:
    """Roots of the shares that each hashed column has among the terms of a text."""
    cell = owner * columns + (hashes % np.uint64(columns)).astype(np.int64)
    counts = np.bincount(cell, minlength=texts * columns).reshape(texts, columns)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def features(column: pa.Array) -> np.ndarray:
    """Root frequencies of the terms of every text; bounded work space per block."""
    out = np.zeros((len(column), FEATURES), dtype=np.float32)
    for at, to in arrays.chunks(column):
        data, offsets = arrays.text_buffer(column.slice(at, to - at))
        n = to - at
        if len(data) > 2:
            owner = np.repeat(np.arange(n), np.diff(offsets))
            own = owner[:-2] == owner[2:]
            owner = owner[:-2][own]
            kind, letter = _CLASS[data], _LETTER[data]
            out[at:to, :TERMS] = _root_shares(owner, _triples(kind, _CLASSES)[own], n, TERMS)
            letters = _root_shares(owner, _triples(letter, 256)[own], n, LETTERS)
            out[at:to, TERMS + WORDS : HASHED] = WORD_SHARE * letters
        words = arrays.words_of(data, offsets)
        size = np.diff(words.bounds)
        owner = np.repeat(np.arange(n), size)
        out[at:to, TERMS : TERMS + WORDS] = WORD_SHARE * _root_shares(owner, words.hashes, n, WORDS)
        again = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
        repeats = np.bincount(owner[1:][again], minlength=n)
        out[at:to, HASHED] = np.sqrt(repeats / np.maximum(size, 1))
        length = np.floor(np.log2(size + 1)).astype(np.int64)
        short = np.flatnonzero(length < LENGTHS)
        out[at + short, HASHED + 1 + length[short]] = 1.0
    return out


class Space:
    """Latent space of a labelled sample, and its labelled vectors."""

    def __init__(self, sample: np.ndarray, labels: np.ndarray, latent: int = LATENT):
        present = (sample > 0).sum(axis=0)
        self.weight = np.log((1 + len(sample)) / (1 + present)).astype(np.float32) + 1
        weighted = sample * self.weight
        rank = max(1, min(latent, *sample.shape))
        # Randomised range finder with power steps, then a small exact decomposition.
        start = np.random.default_rng(7).standard_normal((sample.shape[1], rank + 8))
        basis = weighted.astype(np.float64) @ start
        for _ in range(4):
            basis, _ = np.linalg.qr(basis)
            basis = weighted @ (weighted.T @ basis)
        basis, _ = np.linalg.qr(basis)
        _, _, right = np.linalg.svd(basis.T @ weighted, full_matrices=False)
        self.axes = np.rint(right[:rank].T.astype(np.float64) * _FINE)
        self.vectors = self.project(sample)
        self.labels = labels.astype(np.float64)

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Unit vectors, in whole numbers of 1 / ``_FINE``.

        Sums stay below 2 ** 53, so that floating point adds them exactly.
        """
        weighted = np.rint(rows * self.weight * np.float64(_FINE))
        vectors = np.rint(weighted @ self.axes / _FINE)
        length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return np.rint(vectors / np.maximum(length, 1) * _FINE)

    def votes(self, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        near = min(neighbours, len(self.labels))
        order = 1 << len(self.labels).bit_length()
        place = order - 1 - np.arange(len(self.labels))
        out = np.empty(len(rows))
        for at in range(0, len(rows), BLOCK_DOCUMENTS):
            cosine = self.project(rows[at : at + BLOCK_DOCUMENTS]) @ self.vectors.T
            # Cosine, then the earlier label, as one number; a vote adds up in this order.
            ranked = cosine.astype(np.int64) * order + place
            ranked = -np.sort(np.partition(-ranked, near - 1, axis=1)[:, :near], axis=1)
            weight = np.maximum((ranked // order) / float(_FINE) ** 2, 1e-6) ** SHARPNESS
            vote = self.labels[order - 1 - ranked % order]
            out[at : at + BLOCK_DOCUMENTS] = (weight * vote).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker.clear()
    for batch in batches:
        rows = features(batch.column(1))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), FEATURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), lists.cast(pa.list_(pa.float32()))], names=["label", "features"]
        )


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Space | None:
    """The space of at most ``most`` labelled documents outside the held-out fold."""
    training = labelled.fold("doc_id", FOLDS) != HELD_OUT
    chosen = labelled.sample(labels, "quality", training, most)
    rows = labelled.with_texts(chosen, documents).orderBy("doc_id").select("label", "text")
    table = rows.mapInArrow(_described, "label double, features array<float>").toArrow()
    if not table.num_rows:
        return None
    matrix = table["features"].combine_chunks().flatten().to_numpy()
    matrix = matrix.reshape(table.num_rows, FEATURES)
    return Space(matrix, table["label"].to_numpy())


def scored(documents: DataFrame, space: Space | None, name: str = "score") -> DataFrame:
    """The documents with a score in a new column; other columns as they are."""
    if name.lower() in (c.lower() for c in documents.columns):
        raise ValueError(f"documents already have a column {name!r}")
    if space is None:
        return documents.withColumn(name, F.lit(0.5))
    at = documents.columns.index("text")
    sent = documents.sparkSession.sparkContext.broadcast(space)
    names = [*documents.columns, name]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.clear()
        for batch in batches:
            column, votes = batch.column(at), []
            for begin in range(0, len(column), 4 * BLOCK_DOCUMENTS):
                votes.append(sent.value.votes(features(column.slice(begin, 4 * BLOCK_DOCUMENTS))))
            found = pa.array(np.concatenate(votes) if votes else np.empty(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=names)

    schema = StructType([*documents.schema.fields, StructField(name, DoubleType())])
    return documents.mapInArrow(score, schema)


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    slim = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = scored(slim, fit(documents, labels))
    return found.select(
        "doc_id",
        (labelled.fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
