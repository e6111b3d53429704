"""How the sources of each language differ from each other, and by which terms.

A document's sparse vector counts its terms exactly (``_vectors``); vectors are summed per
(lang, source), first inside a batch, then before and after the one shuffle of (lang, source,
term). A language keeps the terms that at least ``MIN_DOCUMENTS`` of its documents hold; the
vocabulary has no other limit than the largest integer. It is a table with a row per term,
not an array on the driver that is sent to every executor, as it grows with the corpus.

Shares are ``p = 1 + floor(10**9 * (count + 1) / (N + V))``, ``N`` the kept occurrences of
the group and ``V`` the kept terms of its language, and a term's divergence from share q is
``floor((p - q)**2 / q)``. All of it is integers. Terms that neither of two sources holds
have equal divergences, so a pair is ``V`` times that, plus what the terms of the two sparse
vectors add. Pairs are evaluated for tiles of about ``TILE`` sources and slices of about
``SLICE`` terms, one task each: a task's memory does not depend on the size of a source, and
a source with a third of all rows has its terms in all slices.

Defined cases: null text, lang or source count as empty; a source without kept terms has the
shares of zero counts and is an item like others; a language without kept terms has pairs of
value 0 and no term rows; a language with one source has no pairs. Ties are ranked by item in
the order of UTF-8 bytes. An empty table gives an empty result; other columns are ignored,
whatever their names. Sums stay inside 64 bits for up to 10**9 kept terms a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import arrays, scratch

MIN_DOCUMENTS = 3
TOP_TERMS = 200
TILE = 64
SLICE = 1 << 14
# Bytes of text whose vectors are summed before they leave the task's Python worker.
CHUNK = 3 << 20
# What stands between two terms.
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_SHARE = 1_000_000_000
# First step of the ranking of a group's terms, so that no group is ranked by one task.
_SALTS = 64

_SUMS = "lang string, source string, term string, n bigint, docs bigint"


# ---- Document vectors and their sums --------------------------------------------------


def _vectors(texts: pa.Array) -> pa.Table:
    """``doc, term, n``: the sparse vector of every text, by its place in the array."""
    low = pc.ascii_lower(texts.cast(pa.large_string()))  # A-Z only
    split = pc.split_pattern_regex(low, pattern=_BETWEEN)
    every = pa.table({"doc": pc.list_parent_indices(split), "term": pc.list_flatten(split)})
    every = every.filter(pc.not_equal(every["term"], ""))
    return every.group_by(["doc", "term"]).aggregate([([], "count_all")]).rename_columns(
        ["doc", "term", "n"]
    )


def _summed(batch: pa.RecordBatch) -> pa.Table:
    """Sums of the vectors per (lang, source), and a row without term per (lang, source)."""
    vectors = _vectors(batch.column("text"))
    lang, source = (batch.column(c).cast(pa.large_string()) for c in ("lang", "source"))
    sums = pa.table(
        {
            "lang": lang.take(vectors["doc"]),
            "source": source.take(vectors["doc"]),
            "term": vectors["term"],
            "n": vectors["n"],
        }
    )
    sums = sums.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
    groups = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"]).aggregate([])
    zero = pa.array(np.zeros(len(groups), dtype=np.int64))
    bare = pa.table(
        {
            "lang": groups["lang"],
            "source": groups["source"],
            "term": pa.array([""] * len(groups), pa.large_string()),
            "n": zero,
            "docs": zero,
        }
    )
    names = bare.schema.names
    told = sums.select(["lang", "source", "term", "n_sum", "n_count"]).rename_columns(names)
    return pa.concat_tables([told, bare]).cast(
        pa.schema([(c, pa.string() if i < 3 else pa.int64()) for i, c in enumerate(names)])
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to in arrays.chunks(batch.column("text"), CHUNK):
            yield from _summed(batch.slice(at, to - at)).to_batches()


def group_vectors(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Sparse vectors of all groups over the kept terms: ``lang, source, term, n``.

    Besides: ``lang_n``, the term's count in the language, and ``leads``, true in one row of
    every (lang, term). Every group has one row more, with the empty term and no count.
    """
    told = [
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")
    ]
    sums = documents.select(*told).mapInArrow(_counted, _SUMS)
    sums = sums.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    term = Window.partitionBy("lang", "term")
    return (
        sums.withColumn("lang_n", F.sum("n").over(term))
        .withColumn("lang_docs", F.sum("docs").over(term))
        .withColumn("leads", F.col("source") == F.min("source").over(term))
        .where((F.col("term") == "") | (F.col("lang_docs") >= min_documents))
        .drop("docs", "lang_docs")
    )


def _share(count: str, total: str) -> str:
    """Exact for counts beyond 64 bits divided by the factor, hence the decimals."""
    return (
        f"CAST(1 + CAST(CAST({_SHARE} AS DECIMAL(20,0)) * ({count} + 1) AS DECIMAL(38,0))"
        f" div greatest({total} + vocabulary, 1) AS BIGINT)"
    )


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


# ---- The audit ------------------------------------------------------------------------


def audit(
    documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """``lang, source, part, item, value, rank``, both parts of every group.

    Part ``pair``: the group's divergence from each other source of its language. Part
    ``term``: the terms it holds more than its language does, the first ``top_terms``.
    """
    vectors = scratch.staged(group_vectors(documents, min_documents), "group-vectors")
    real = vectors.where("term <> ''")
    langs = vectors.groupBy("lang").agg(
        F.count_if((F.col("term") != "") & F.col("leads")).alias("vocabulary"),
        F.sum("n").alias("lang_total"),
        F.count_if(F.col("term") == "").alias("sources"),
    )
    groups = vectors.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # Written, so that the optimizer knows how small they are and joins accordingly.
    groups = scratch.staged(groups.join(langs, "lang"), "groups")
    told = real.join(groups, ["lang", "source"])
    window = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = _terms(told, top_terms).unionByName(_pairs(told, groups))
    return ranked.withColumn("rank", F.row_number().over(window))


def _terms(told: DataFrame, most: int) -> DataFrame:
    shares = told.selectExpr(
        "lang",
        "source",
        "term AS item",
        f"{_share('n', 'total')} AS p",
        f"{_share('lang_n', 'lang_total')} AS q",
    ).where("p > q")
    valued = shares.selectExpr(
        "lang",
        "source",
        "'term' AS part",
        "item",
        f"{_divergence('p', 'q')} AS value",
        f"pmod(hash(item), {_SALTS}) AS salt",
    )
    some = Window.partitionBy("lang", "source", "salt").orderBy(F.desc("value"), "item")
    some = valued.withColumn("place", F.row_number().over(some)).where(F.col("place") <= most)
    whole = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = some.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= most)
    return first.select("lang", "source", "part", "item", "value")


def _parts(count: str, size: int) -> Column:
    return F.greatest(F.ceil(F.col(count) / size), F.lit(1).cast("bigint"))


def _pairs(told: DataFrame, groups: DataFrame) -> DataFrame:
    """Each group against every other source of its language."""

    def placed(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("tiles", _parts("sources", TILE))
            .withColumn("slices", _parts("vocabulary", SLICE))
            .withColumn("tile", F.expr("pmod(xxhash64(source), tiles)"))
            .withColumn("zero", F.expr(_share("0", "total")))
        )

    named = ["lang", "source", "tile", "tiles", "vocabulary", "zero", "slice", "term", "p"]
    terms = placed(told).withColumn("p", F.expr(_share("n", "total")))
    terms = terms.withColumn("slice", F.expr("pmod(xxhash64(term), slices)")).select(named)
    # A source is known in every slice, also in those where it has no term.
    known = placed(groups).withColumn("slice", F.expr("explode(sequence(0L, slices - 1))"))
    known = known.withColumn("term", F.lit("")).withColumn("p", F.col("zero")).select(named)
    met = terms.unionByName(known)
    met = met.withColumn("other", F.expr("explode(sequence(0L, tiles - 1))"))
    met = met.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))
    found = (
        met.drop("other", "tiles")
        .groupBy("lang", "a", "b", "slice")
        .applyInArrow(_evaluated, "lang string, source string, item string, value bigint")
    )
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return found.withColumn("part", F.lit("pair"))


def _floored(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _evaluated(rows: pa.Table) -> pa.Table:
    """What one slice of terms adds to the pairs of the sources of two tiles."""
    marks = rows.filter(pc.equal(rows["term"], ""))
    names = marks["source"].to_pylist()
    zero = marks["zero"].to_numpy()
    tile = marks["tile"].to_numpy()
    place = {name: i for i, name in enumerate(names)}

    real = rows.filter(pc.not_equal(rows["term"], ""))
    coded = real["term"].combine_chunks().dictionary_encode()
    term = coded.indices.to_numpy().astype(np.int64)
    owner = np.array([place[s] for s in real["source"].to_pylist()], dtype=np.int64)
    share = real["p"].to_numpy()
    order = np.argsort(owner, kind="stable")
    term, owner, share = term[order], owner[order], share[order]
    bounds = np.searchsorted(owner, np.arange(len(names) + 1))

    def per_source(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[bounds[1:]] - total[bounds[:-1]]

    first = rows["slice"][0].as_py() == 0
    vocabulary = rows["vocabulary"][0].as_py()
    sizes = np.diff(bounds)
    sources, items, values = [], [], []
    for j, name in enumerate(names):
        own = slice(bounds[j], bounds[j + 1])
        q = np.full(len(coded.dictionary), zero[j], dtype=np.int64)
        q[term[own]] = share[own]
        shared = np.zeros(len(q), dtype=bool)
        shared[term[own]] = True
        both = shared[term]
        # Terms of the other source; then the target's terms that the other does not have.
        found = per_source(_floored(share, q[term]))
        alone = np.array([_floored(z, share[own]).sum() for z in zero], dtype=np.int64)
        alone -= per_source(np.where(both, _floored(zero[owner], q[term]), 0))
        seen = sizes + sizes[j] - per_source(both.astype(np.int64))
        nowhere = _floored(zero, zero[j])
        value = found + alone - seen * nowhere + (vocabulary * nowhere if first else 0)
        a, b = rows["a"][0].as_py(), rows["b"][0].as_py()
        wanted = np.arange(len(names)) != j
        if a != b:
            wanted &= tile != tile[j]
        for i in np.flatnonzero(wanted):
            sources.append(names[i])
            items.append(name)
            values.append(int(value[i]))
    return pa.table(
        {
            "lang": pa.repeat(pa.scalar(rows["lang"][0].as_py(), pa.string()), len(values)),
            "source": pa.array(sources, pa.string()),
            "item": pa.array(items, pa.string()),
            "value": pa.array(values, pa.int64()),
        }
    )
