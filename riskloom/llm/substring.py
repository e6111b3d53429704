"""Repeated passages by paragraph MinHash: banding, verification, components.

A passage is copied into the middle of other lines, so lines alone are no paragraphs that
would meet. A paragraph here is a stretch of a line between content-defined cuts: of every
13 neighbouring positions the one with the least hash of its two words is a cut (winnowing,
Schleimer et al. 2003), and so is every new line. The cuts inside a passage depend on its
words only: of any 51 words in a line that occur twice, the first cut is one of the words 1
to 13 and the last one of 38 to 50, so whole paragraphs with at least 51 - 2 * 13 = 25
words together, the ``MIN_WORDS`` of a passage, are in common whatever the words are. A
paragraph of fewer than five words is known by the five words from its cut on, at the end
of a line by the last five of the line.

Every paragraph in a line of five words or more gets a MinHash signature of its runs of five words,
banded 2 x 2. Colliding paragraphs are joined to the first and to the preceding one in their
bucket first; all other pairs of them that may be similar are found by prefixes (``buckets.rest``).
They are verified: equal word sequences by a 64-bit digest beside the equal bucket, others by the
exact Jaccard similarity of their runs, 0.8 or more. Components of the verified pairs are the clusters; the first paragraph
(least doc_id, then place) of a cluster stays, the others are copies.

Edited copies are looked for among whole lines, the natural paragraphs, as one changed word
inside a cut paragraph leaves less than 0.8 of it. Lines of five words or more are banded
16 x 3: a pair at 0.8 shares no bucket with a chance of 1e-5. In a bucket lines are verified
against a few centres a round, and what the rounds left by prefixes (``buckets``). Copies of a line go whole and are no part of other clusters;
the first line of a class stays, and what is a copy inside of it is still found. Neighbouring
paragraphs that all have a counterpart make a passage; one of fewer than ``MIN_WORDS``
words is left alone, as common short lines are no copied passages.

Equal paragraphs are one node of the graph. A hot paragraph is reduced to one row per map
batch before the shuffle; the others of the batch are known as its copies at once.

Defined cases: null and empty texts have no paragraphs; repeated rows and copies of whole
documents are copies of their first occurrence, rows that repeat a ``doc_id`` are the same document;
rows without ``doc_id`` are skipped and keep their text; further columns are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import arrays, buckets, links, scratch, worker

SHINGLE_WORDS = 5
CUT_WINDOW = 13
BANDS, ROWS = 2, 2
LINE_BANDS, LINE_ROWS = 16, 3
MIN_WORDS = 25


def _line_starts(data: np.ndarray, words: arrays.Words) -> np.ndarray:
    """Whether a word is the first of its line or text."""
    breaks = np.cumsum(data == 10)
    line = breaks[words.starts]
    first = np.ones(len(line), dtype=bool)
    first[1:] = line[1:] != line[:-1]
    heads = words.bounds[:-1]
    first[heads[heads < len(first)]] = True
    return first


def paragraphs(data: np.ndarray, words: arrays.Words) -> np.ndarray:
    """First word of every paragraph, and the number of words at the end."""
    n = len(words.hashes)
    if not n:
        return np.zeros(1, dtype=np.int64)
    cut = _line_starts(data, words)
    pair = words.hashes.copy()
    with np.errstate(over="ignore"):
        pair[1:] = arrays.mixed(words.hashes[1:] + words.hashes[:-1] * np.uint64(3))
    # 34 bits of hash above, the place below: the least value also says where it is.
    key = np.where(cut, np.uint64(0), (pair >> np.uint64(30)) << np.uint64(30))
    key = key | np.arange(n, dtype=np.uint64)
    least, width = key, 1
    while width * 2 <= CUT_WINDOW and len(least) > width:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    rest = CUT_WINDOW - width
    if rest and len(least) > rest:
        least = np.minimum(least[:-rest], least[rest:])
    place = (least & np.uint64((1 << 30) - 1)).astype(np.int64)
    cut[place] = True
    return np.append(np.flatnonzero(cut), n)


def whole_lines(data: np.ndarray, words: arrays.Words) -> np.ndarray:
    """First word of every line, and the number of words at the end."""
    return np.append(np.flatnonzero(_line_starts(data, words)), len(words.hashes))


def _min_hashes(runs: np.ndarray, at: np.ndarray, count: int) -> list[np.ndarray]:
    """Minima of ``count`` hash functions over runs[at[i]:at[i + 1]]."""
    out = []
    for i in range(count):
        with np.errstate(over="ignore"):
            out.append(np.minimum.reduceat(arrays.mixed(runs ^ np.uint64(i + 1)), at))
    return out


class _Described:
    """Paragraphs of five words or more of some texts: place, size, digest, band keys."""

    def __init__(self, data, offsets, bands=BANDS, rows=ROWS, split=paragraphs):
        words = arrays.words_of(data, offsets)
        at = split(data, words)
        first, end = at[:-1], at[1:]
        lines = np.flatnonzero(_line_starts(data, words))
        line = np.searchsorted(lines, first, side="right") - 1
        # A short paragraph is told by its words and those after it, else before it.
        high = np.maximum(end, first + SHINGLE_WORDS)
        high = np.minimum(high, np.append(lines, len(words.hashes))[line + 1])
        low = np.minimum(first, high - SHINGLE_WORDS)
        told = low >= lines[line]
        first, end, low, high = first[told], end[told], low[told], high[told]
        self.line = lines[line[told]]
        self.size = end - first
        self.text = np.searchsorted(words.bounds, first, side="right") - 1
        self.first = first - words.bounds[self.text]
        self.line = self.line - words.bounds[self.text]
        self.per = high - low - SHINGLE_WORDS + 1
        runs = arrays.run_hashes(words.hashes, SHINGLE_WORDS)
        self.runs = runs[arrays.ragged(low, self.per)]
        self.begin = np.cumsum(self.per) - self.per
        self.digest = self.keys = None
        if len(first):
            place = arrays.ragged(np.zeros(len(first), dtype=np.int64), self.per)
            with np.errstate(over="ignore"):
                mixed = arrays.mixed(self.runs ^ arrays.mixed(place.astype(np.uint64)))
            sums = np.add.reduceat(mixed, self.begin)
            self.digest = arrays.mixed(sums ^ self.per.astype(np.uint64))
            minima = _min_hashes(self.runs, self.begin, bands * rows)
            self.keys = [
                arrays.combined(minima[i * rows : (i + 1) * rows]) ^ np.uint64(i)
                for i in range(bands)
            ]


_KEYED = "key bigint, doc_id bigint, first int, size int, line int, node bigint, copy boolean"
_KEYED_NAMES = [x.split()[0] for x in _KEYED.split(", ")]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per paragraph and band. Later copies within a batch are marked ``copy`` and
    get the digest as their key only once: the bucket is told by the first of them.

    Equal paragraphs meet in the bucket of the first band. In the others, where ``copy`` is
    null, only different nodes do.
    """
    worker.clear()
    for batch in batches:
        for at, to in arrays.chunks(batch.column(1)):
            part = batch.slice(at, to - at)
            ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found = _Described(*arrays.text_buffer(part.column(1)))
            if not len(found.first):
                continue
            doc = ids[found.text]
            order = np.argsort(found.digest, kind="stable")
            node = found.digest[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = node[1:] != node[:-1]
            heads, copies = order[new], order[~new]
            twice = np.zeros(len(order), dtype=bool)  # has copies in the batch
            twice[:-1] = ~new[1:]
            for which, key, copy in [
                *((heads, k[heads], None if i else twice[new]) for i, k in enumerate(found.keys)),
                # A copy has nothing to look for; a key of its own spreads it.
                (copies, arrays.mixed(found.digest[copies] + copies.astype(np.uint64)), True),
            ]:
                if len(which):
                    yield pa.RecordBatch.from_arrays(
                        [
                            arrays.signed(key),
                            pa.array(doc[which]),
                            pa.array(found.first[which].astype(np.int32)),
                            pa.array(found.size[which].astype(np.int32)),
                            pa.array(found.line[which].astype(np.int32)),
                            arrays.signed(found.digest[which]),
                            pa.nulls(len(which), pa.bool_())
                            if copy is None
                            else pa.array(np.broadcast_to(copy, len(which))),
                        ],
                        names=_KEYED_NAMES,
                    )


def _collisions(documents: DataFrame) -> DataFrame:
    """Paragraphs that share a bucket with another; ``key`` is that of a bucket with
    different nodes, else null.

    Nothing is ordered within a bucket here, so that Spark sorts by one number.
    """
    keyed = _slim(documents).mapInArrow(_keyed, _KEYED)
    bucket = Window.partitionBy("key")
    seen = keyed.select(
        "*",
        F.min("node").over(bucket).alias("low"),
        F.max("node").over(bucket).alias("high"),
        F.count("*").over(bucket).alias("n"),
    )
    several = F.when(F.col("low") != F.col("high"), F.col("key"))
    met = seen.where("if(copy is null, low <> high, copy or n > 1)")
    return met.select("doc_id", "first", "size", "line", "node", several.alias("key"))


def _runs_of(split):
    """The runs of words of the wanted paragraphs of each text."""

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.clear()
        for batch in batches:
            for at, to in arrays.chunks(batch.column(0)):
                part = batch.slice(at, to - at)
                found = _Described(*arrays.text_buffer(part.column(0)), bands=0, split=split)
                lists = part.column(1)
                text = np.repeat(np.arange(to - at), lists.value_lengths().to_numpy())
                first, node = (
                    lists.flatten().field(name).to_numpy().astype(np.int64)
                    for name in ("first", "node")
                )
                # Paragraphs come by text and place.
                places, wanted = found.text << 32 | found.first, text << 32 | first
                i = np.searchsorted(places, wanted)
                there = np.append(places, -1)[i] == wanted
                node, i = node[there], i[there]
                bounds = np.concatenate(([0], np.cumsum(found.per[i])))
                values = found.runs[arrays.ragged(found.begin[i], found.per[i])]
                owner, value, _ = arrays.distinct_runs(values, bounds)
                ends = np.searchsorted(owner, np.arange(len(i) + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(ends), arrays.signed(value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), runs], names=["node", "runs"]
                )

    return runs_of


def _slim(documents: DataFrame) -> DataFrame:
    return documents.where("doc_id is not null").select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    )


def _runs_table(
    asked: DataFrame, met: DataFrame, documents: DataFrame, split=paragraphs
) -> DataFrame:
    """``node, runs`` of the asked nodes, read at their first place in ``met``."""
    places = met.groupBy("node").agg(F.min(F.struct("doc_id", "first")).alias("at"))
    wanted = (
        places.join(asked, "node")
        .groupBy(F.col("at.doc_id").alias("doc_id"))
        .agg(F.collect_list(F.struct("node", F.col("at.first").alias("first"))).alias("wanted"))
    )
    runs = _slim(documents).join(wanted, "doc_id").select("text", "wanted")
    runs = runs.mapInArrow(_runs_of(split), "node bigint, runs array<bigint>")
    return scratch.staged(runs.dropDuplicates(["node"]), "runs")


def _beside(met: DataFrame) -> DataFrame:
    """What stands in a bucket of different nodes, with the first node of the bucket and the
    one before."""
    ordered = Window.partitionBy("key").orderBy("node")
    return met.where("key is not null").select(
        "doc_id",
        "first",
        "node",
        F.first("node").over(ordered).alias("head"),
        F.lag("node").over(ordered).alias("before"),
    )


def _near(met: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Similar pairs among ``_beside``, their components, and the pairs they left."""
    pairs = met.select(
        "node", F.explode(F.array_distinct(F.array("head", "before"))).alias("other")
    )
    pairs = pairs.where("node <> other").select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    )
    pairs = scratch.staged(pairs.distinct(), "pairs")
    # The first of a bucket is the head of the others, so this is every node that shares one.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    runs = _runs_table(asked, met, documents)
    near = scratch.staged(buckets.alike(pairs, runs), "near")
    labels = None if near.isEmpty() else links.components(near)
    return near, labels, buckets.rest(runs, labels)


def _verified(met: DataFrame, documents: DataFrame) -> DataFrame:
    """Pairs of different word sequences whose runs have a similarity of 0.8 or more."""
    near, _, rest = _near(met, documents)
    return near.unionByName(rest)


_LINES = "doc_id bigint, first int, size int, node bigint, keys array<bigint>"


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line. The first of equal ones of a batch has the keys of its buckets."""
    worker.clear()
    for batch in batches:
        for at, to in arrays.chunks(batch.column(1)):
            part = batch.slice(at, to - at)
            ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = arrays.text_buffer(part.column(1))
            found = _Described(*texts, LINE_BANDS, LINE_ROWS, whole_lines)
            if len(found.first):
                own = np.zeros(len(found.first), dtype=bool)
                own[np.unique(found.digest, return_index=True)[1]] = True
                keys = np.stack([key[own] for key in found.keys], axis=1)
                ends = np.concatenate(([0], np.cumsum(own) * LINE_BANDS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[found.text]),
                        pa.array(found.first.astype(np.int32)),
                        pa.array(found.size.astype(np.int32)),
                        arrays.signed(found.digest),
                        pa.ListArray.from_arrays(pa.array(ends), arrays.signed(keys.ravel())),
                    ],
                    names=["doc_id", "first", "size", "node", "keys"],
                )


def near_lines(documents: DataFrame) -> DataFrame | None:
    """Lines that are alike, but not all equal: doc_id, first, size, cluster; or None."""
    rows = scratch.staged(_slim(documents).mapInArrow(_line_rows, _LINES), "line-rows")
    keys = rows.select(F.explode("keys").alias("key"), "node")
    bucket = Window.partitionBy("key")
    keys = keys.select(
        "*", F.min("node").over(bucket).alias("low"), F.max("node").over(bucket).alias("high")
    )
    met = keys.where("low <> high").select("key", "node").distinct()
    met = scratch.staged(met, "line-buckets")
    if met.isEmpty():
        return None
    places = rows.select("doc_id", "first", "size", "node")
    places = places.join(met.select("node").distinct(), "node", "left_semi").distinct()
    places = scratch.staged(places.select("doc_id", "first", "size", "node"), "line-places")
    scratch.remove(rows)
    runs = _runs_table(places.select("node").distinct(), places, documents, whole_lines)
    labels = buckets.classes(met, runs)
    scratch.release(documents.sparkSession)
    if labels is None:
        return None
    labels = labels.withColumnRenamed("component", "cluster")
    return places.join(labels, "node").select("doc_id", "first", "size", "cluster")


def _with_heads(members: DataFrame, name: str) -> DataFrame:
    """Members of clusters of two or more, with ``copy`` and ``origin``."""
    heads = members.groupBy("cluster").agg(
        F.min(F.struct("doc_id", "first")).alias("head"), F.count("*").alias("n")
    )
    # Written first, so that the join below has an exchange of its own on either side and
    # adaptive execution can split a cluster of very many copies.
    heads = scratch.staged(heads.where("n > 1").select("cluster", "head"), name)
    return members.join(heads, "cluster").select(
        *members.columns,
        (F.struct("doc_id", "first") != F.col("head")).alias("copy"),
        F.col("head.doc_id").alias("origin"),
    )


def clusters(documents: DataFrame) -> DataFrame:
    """Paragraphs that occur more than once: doc_id, first, size, cluster, copy.

    ``first`` and ``size`` count words of the document; ``copy`` is false for the first
    paragraph of the cluster, ``origin`` is its ``doc_id``.
    """
    met = scratch.staged(_collisions(documents), "collisions")
    _, labels, rest = _near(_beside(met), documents)
    labels = buckets.joined(labels, rest)
    scratch.release(documents.sparkSession)
    members = met.withColumn("cluster", F.col("node"))
    if labels is not None:
        members = met.join(labels, "node", "left").withColumn(
            "cluster", F.coalesce("component", "node")
        )
    members = members.select("doc_id", "first", "size", "line", "cluster")
    columns = ["doc_id", "first", "size", "cluster", "copy", "origin"]
    lines = near_lines(documents)
    if lines is None:
        members = scratch.staged(members.distinct(), "paragraphs")
        scratch.remove(met)
        return _with_heads(members, "heads").select(*columns)
    lines = scratch.staged(_with_heads(lines, "line-heads"), "lines")
    # What lies in a copied line goes with it and is nobody's first occurrence.
    gone = lines.where("copy").select("doc_id", F.col("first").alias("line"))
    members = members.join(gone, ["doc_id", "line"], "left_anti")
    # A paragraph may be met in several buckets. Its rows lie together after this join.
    members = scratch.staged(members.distinct(), "paragraphs")
    scratch.remove(met)
    found = scratch.staged(_with_heads(members, "heads"), "members")
    # A first line stands for its paragraphs, unless one of them is itself a copy.
    mixed = found.where("copy").select("doc_id", F.col("line").alias("first")).distinct()
    stay = lines.where("not copy").join(mixed, ["doc_id", "first"], "left_anti")
    found = found.join(
        stay.select("doc_id", F.col("first").alias("line")), ["doc_id", "line"], "left_anti"
    )
    whole = lines.where("copy").select(*columns).union(stay.select(*columns))
    return found.select(*columns).union(whole)


def passages(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that occur elsewhere, as stretches of neighbouring repeated paragraphs.

    ``doc_id, first_word, last_word, n_words, removed, origin``: ``removed`` is false
    for the first occurrence, ``origin`` the document that holds it. A stretch counts if it
    has ``min_words`` words from its first paragraph to the end of its last.
    """
    place = Window.partitionBy("doc_id").orderBy("first")
    end = F.col("first") + F.col("size")
    gap = F.col("first") - F.lag(end).over(place)
    found = clusters(documents).select(
        "*",
        F.when(gap < SHINGLE_WORDS, 0).otherwise(1).alias("new"),
        F.lag("copy").over(place).alias("copy_before"),
    )
    turn = F.when((F.col("new") == 1) | (F.col("copy_before") != F.col("copy")), 1).otherwise(0)
    found = found.select(
        "*", F.sum("new").over(place).alias("stretch"), F.sum(turn).over(place).alias("part")
    )
    # A part is in one stretch, so that stretches are measured over their few parts.
    parts = found.groupBy("doc_id", "stretch", "part", F.col("copy").alias("removed")).agg(
        F.min("first").alias("first_word"),
        F.max(F.col("first") + F.col("size") - 1).alias("last_word"),
        F.sum("size").alias("n_words"),
        F.min_by("origin", "first").alias("origin"),
    )
    whole = Window.partitionBy("doc_id", "stretch")
    total = F.max("last_word").over(whole) + 1 - F.min("first_word").over(whole)
    parts = parts.withColumn("stretch_words", total).where(F.col("stretch_words") >= min_words)
    return parts.drop("stretch", "part", "stretch_words")


_SPANS = "__spans"  # beside the documents' own columns


def _cut_text(data: np.ndarray, starts: np.ndarray, spans: list[dict]) -> str:
    done, kept = 0, []
    for span in sorted(spans, key=lambda s: s["first_word"]):
        if span["first_word"] < len(starts):
            kept.append(data[done : starts[span["first_word"]]].tobytes())
            end = span["last_word"] + 1
            done = int(starts[end]) if end < len(starts) else len(data)
    return b"".join([*kept, data[done:].tobytes()]).decode()


def _cutter(names: list[str]):
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.clear()
        for batch in batches:
            columns = batch.columns[:-1]
            spans = batch.columns[-1].to_pylist()
            touched = [i for i, s in enumerate(spans) if s]
            if touched:
                texts = columns[text_at].to_pylist()
                chars = columns[chars_at].to_pylist() if chars_at is not None else None
                for i in touched:
                    data, offsets = arrays.text_buffer(columns[text_at].slice(i, 1))
                    words = arrays.words_of(data, offsets)
                    texts[i] = _cut_text(data, words.starts, spans[i])
                    if chars is not None:
                        chars[i] = len(texts[i])
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if chars is not None:
                    columns[chars_at] = pa.array(chars, columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the copies of repeated passages; columns stay as they are.

    A removed passage reaches to the next word that stays. ``n_chars``, if there is one,
    is counted anew where the text changed. Documents that lose all words stay, empty.
    """
    gone = passages(documents, min_words).where("removed")
    gone = gone.groupBy(F.col("doc_id").alias(f"{_SPANS}_id")).agg(
        F.collect_list(F.struct("first_word", "last_word")).alias(_SPANS)
    )
    both = documents.join(gone, documents["doc_id"] == gone[f"{_SPANS}_id"], "left")
    both = both.drop(f"{_SPANS}_id")
    return both.mapInArrow(_cutter(documents.columns), documents.schema)
