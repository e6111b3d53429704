"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly.

A bag holds the byte n-grams (3 to 6, with word borders) of a few neighbouring words; its
embedding is the mean of its n-grams' vectors, and a linear softmax over it gives the class.
Vectors and softmax are trained together in numpy (as in fastText's supervised model) with
adaptive steps. An unseen misspelling shares most n-grams, hence vectors, with the word.

Insults are few words of a long text, so a text is as toxic as its most toxic bag: training
begins with bags of whole texts and goes on with each text's highest bag; a score is the
highest over all bags of the whole text. A last step fits slope and offset of the logit.

The sample is at most ``MOST_LABELLED`` rows, half per class, of at most ``LONGEST_LABELLED``
bytes each; both are documented bounds, and no more than their product goes to the driver,
where numpy trains. For scoring, embeddings and softmax are folded into one weight per n-gram
bucket (256 KB), which is broadcast. Weights are whole numbers there, so that sums of them do
not depend on their order: a text has one score, whatever batch or task it is scored in.

Defined cases: null and empty texts have no bag and the lowest score; without labelled
rows of both classes every score is 0.5; repeated rows get a row each; an id that is labelled
and occurs several times is fitted with the least of its texts; a null ``doc_id`` is in fold
0; further columns are ignored, but a column of the score's name is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskloom.llm import arrays, labelled

MOST_LABELLED = 2048
LONGEST_LABELLED = 1 << 16
SIZES = (3, 4, 5, 6)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
BAG_WORDS = 2
WHOLE_EPOCHS, BAG_EPOCHS, BATCH, STEP = 4, 12, 64, 0.5
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
_FINE = 1 << 20

_CODE = np.zeros(256, dtype=np.uint32)  # 0 is the border of a word
_CODE[48:58] = np.arange(2, 12)
_CODE[97:123] = _CODE[65:91] = np.arange(12, 38)
_CODE[128:] = np.arange(128, 256)


class Grams(NamedTuple):
    """N-grams of texts, word by word."""

    codes: np.ndarray  # bytes of the words with borders
    starts: np.ndarray  # of the words, without border
    ends: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]

    def buckets(self, size: int) -> np.ndarray:
        """Bucket of the n-gram that starts at every byte; only those in words count."""
        n = max(0, len(self.codes) - size + 1)
        total = np.full(n, size, dtype=np.uint32)
        for i in range(size):
            total = total * np.uint32(0x01000193) + self.codes[i : i + n]
        total ^= total >> np.uint32(15)
        total *= np.uint32(0x2C1B3C6D)
        return total >> np.uint32(32 - BUCKET_BITS)

    def counts(self, size: int) -> np.ndarray:
        return np.maximum(self.ends - self.starts + 3 - size, 0)


def grams(data: np.ndarray, offsets: np.ndarray) -> Grams:
    # A border before every text and after the last keeps n-grams within their text.
    data = np.append(np.insert(data, offsets[:-1], 0), np.zeros(1, dtype=np.uint8))
    offsets = offsets + np.arange(len(offsets))
    starts, ends = arrays.spans_of(data, offsets)
    return Grams(_CODE[data], starts, ends, np.searchsorted(starts, offsets))


def _word_sums(found: Grams, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word the sum of its n-grams' weights, and their number."""
    exact = np.int64 if weights.dtype.kind == "i" else np.float64
    sums = np.zeros(len(found.starts), dtype=exact)
    number = np.zeros(len(found.starts), dtype=np.int64)
    for size in SIZES:
        counts = found.counts(size)
        running = np.zeros(len(found.codes) + 1, dtype=exact)
        values = weights[found.buckets(size)]
        np.cumsum(values, out=running[1 : len(values) + 1])
        begin = found.starts - 1
        end = np.minimum(begin + counts, len(values))
        sums += np.where(counts > 0, running[end] - running[begin], 0)
        number += counts
    return sums, number


def highest_bags(found: Grams, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the highest mean weight of its bags, and the first word of that bag.

    Texts without words get minus infinity and -1.
    """
    sums, number = _word_sums(found, weights)
    total = np.concatenate((np.zeros(1, dtype=sums.dtype), np.cumsum(sums)))
    count = np.concatenate(([0], np.cumsum(number)))
    n_words = np.diff(found.bounds)
    best = np.full(len(n_words), -np.inf)
    first = np.full(len(n_words), -1, dtype=np.int64)
    having = np.flatnonzero(n_words)
    if not len(having):
        return best, first
    last = np.repeat(found.bounds[1:], n_words)  # end of the word's text
    at = np.arange(len(sums))
    to = np.minimum(at + BAG_WORDS, last)
    mean = (total[to] - total[at]) / np.maximum(count[to] - count[at], 1)
    # The last words of a text open shorter bags; only a text of so few words needs them.
    whole = (at + BAG_WORDS <= last) | (at == np.repeat(found.bounds[:-1], n_words))
    mean = np.where(whole, mean, -np.inf)
    best[having] = np.maximum.reduceat(mean, found.bounds[:-1][having])
    hit = np.flatnonzero(mean == np.repeat(best, n_words))
    owner = np.repeat(np.arange(len(n_words)), n_words)[hit]
    first[owner[::-1]] = hit[::-1]
    return best, first


def _summed(group: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    """Sums of rows per group."""
    return np.stack(
        [np.bincount(group, weights=rows[:, i], minlength=groups) for i in range(rows.shape[1])],
        axis=1,
    )


class Model:
    """Embeddings and softmax, trained together."""

    def __init__(self, seed: int = 11):
        random = np.random.default_rng(seed)
        self.embedding = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
        self.softmax = random.uniform(-0.1, 0.1, (DIMENSIONS, 2))
        self._embedding_sq = np.full(BUCKETS, 1e-6)
        self._softmax_sq = np.full(2, 1e-6)
        self.slope, self.offset = 1.0, 0.0

    @property
    def weights(self) -> np.ndarray:
        """Both folded: the logit that each bucket adds to a bag's mean."""
        return self.embedding @ (self.softmax[:, 1] - self.softmax[:, 0])

    def step(self, buckets: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> None:
        """One adaptive gradient step on bags; owner says the bag of each bucket."""
        n = len(labels)
        size = np.maximum(np.bincount(owner, minlength=n), 1)[:, None]
        bag = _summed(owner, self.embedding[buckets], n) / size
        logits = bag @ self.softmax
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        error = chance - np.stack([1 - labels, labels], axis=1)
        softmax_gradient = bag.T @ error / n
        total = _summed(buckets, ((error @ self.softmax.T) / size)[owner], BUCKETS)
        self._embedding_sq += (total**2).mean(axis=1)
        self.embedding -= STEP * total / np.sqrt(self._embedding_sq)[:, None]
        self._softmax_sq += (softmax_gradient**2).mean(axis=0)
        self.softmax -= STEP * softmax_gradient / np.sqrt(self._softmax_sq)

    def train(self, found: Grams, labels: np.ndarray, seed: int = 5) -> None:
        having = np.flatnonzero(np.diff(found.bounds))
        random = np.random.default_rng(seed)
        for epoch in range(WHOLE_EPOCHS + BAG_EPOCHS):
            first = None
            if epoch >= WHOLE_EPOCHS:
                _, first = highest_bags(found, self.weights)
            order = random.permutation(having)
            for at in range(0, len(order), BATCH):
                texts = order[at : at + BATCH]
                if first is None:
                    low, high = found.bounds[texts], found.bounds[texts + 1]
                else:
                    low = first[texts]
                    high = np.minimum(low + BAG_WORDS, found.bounds[texts + 1])
                buckets, owner = _bags(found, low, high)
                self.step(buckets, owner, labels[texts])
        best, _ = highest_bags(found, self.weights)
        self._calibrate(best[having], labels[having])

    def _calibrate(self, logit: np.ndarray, labels: np.ndarray) -> None:
        """Slope and offset of the logistic curve through the highest bags' logits."""
        scale = max(float(np.std(logit)), 1e-9)
        x = np.stack([logit / scale, np.ones(len(logit))], axis=1)
        beta = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            curve = x.T @ (x * (p * (1 - p))[:, None]) + 0.02 * np.eye(2)
            change = np.linalg.solve(curve, x.T @ (labels - p) - 0.02 * beta)
            beta += change
            if np.abs(change).max() < 1e-8:
                break
        self.slope, self.offset = max(beta[0] / scale, 1e-9), beta[1]


def _bags(found: Grams, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of words low[i]:high[i], and the bag i of each."""
    words = arrays.ragged(low, high - low)
    bag = np.repeat(np.arange(len(low)), high - low)
    buckets, owner = [], []
    for size in SIZES:
        counts = found.counts(size)[words]
        at = arrays.ragged(found.starts[words] - 1, counts)
        total = np.full(len(at), size, dtype=np.uint32)
        for i in range(size):
            total = total * np.uint32(0x01000193) + found.codes[at + i]
        total ^= total >> np.uint32(15)
        total *= np.uint32(0x2C1B3C6D)
        buckets.append(total >> np.uint32(32 - BUCKET_BITS))
        owner.append(np.repeat(bag, counts))
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owner)


class Scorer(NamedTuple):
    """What the executors need of a model."""

    weights: np.ndarray  # whole numbers of 1 / _FINE
    slope: float
    offset: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.empty(len(column))
        for at, to in arrays.chunks(column):
            best, _ = highest_bags(
                grams(*arrays.text_buffer(column.slice(at, to - at))), self.weights
            )
            logit = self.slope * (best / _FINE) + self.offset
            out[at:to] = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        return out


def train(texts: pa.Array, labels: np.ndarray) -> Scorer | None:
    """A scorer from labelled texts; None without texts of both classes."""
    if len(np.unique(labels >= 0.5)) < 2:
        return None
    model = Model()
    model.train(grams(*arrays.text_buffer(texts)), labels.astype(np.float64))
    weights = np.clip(np.rint(model.weights * _FINE), -(1 << 30), 1 << 30).astype(np.int32)
    return Scorer(weights, model.slope, model.offset)


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Scorer | None:
    """A scorer from at most ``most`` labelled rows outside the held-out fold."""
    training = labelled.fold("doc_id", FOLDS) != HELD_OUT
    chosen = labelled.sample(labels, "toxic", training, most, per_class=True)
    texts = labelled.with_texts(chosen, documents)
    texts = texts.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST_LABELLED)
    table = texts.orderBy("doc_id").toArrow()
    if not table.num_rows:
        return None
    return train(table["text"].combine_chunks(), table["label"].to_numpy())


def scored(documents: DataFrame, scorer: Scorer | None, name: str = "score") -> DataFrame:
    """The documents with a score in a new column; other columns as they are."""
    if name.lower() in (c.lower() for c in documents.columns):
        raise ValueError(f"documents already have a column {name!r}")
    if scorer is None:
        return documents.withColumn(name, F.lit(0.5))
    at = documents.columns.index("text")
    sent = documents.sparkSession.sparkContext.broadcast(scorer)
    names = [*documents.columns, name]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(sent.value.scores(batch.column(at)))
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
