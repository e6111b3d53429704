"""Benchmark decontamination against brute force."""

import random

import numpy as np
import pytest

from riskloom.llm import arrays, decontaminate, queries
from tests.llm import data

WINDOW = decontaminate.WINDOW


def tables(spark):
    rng = random.Random(21)
    items = [(str(i), data.prose(rng, n)) for i, n in enumerate((3, 13, 14, 40, 1, 25))]
    items += [("5", items[3][1]), ("same", items[3][1]), ("null", None), (None, items[5][1])]
    items += [("empty", ""), ("marks", "..!")]
    rows = data.edge_rows(rng)
    for i in range(60):
        own = data.prose(rng, rng.randrange(5, 200)).split(" ")
        if i % 2:
            source = rng.choice([t for _, t in items if t]).split(" ")
            cut = source[rng.randrange(len(source)) :]
            own[(at := rng.randrange(len(own))) : at] = cut
        rows.append((i, " ".join(own).upper() if i % 5 == 0 else " ".join(own)))
    rows.append((60, items[3][1]))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    return rows, items, benchmark.selectExpr("*", "'x' AS spans", "1 AS doc_id")


def brute(rows, items):
    windows = {}
    for name, text in items:
        own = data.words(text)
        for k in range(max(1, len(own) - WINDOW + 1) if own else 0):
            windows.setdefault(tuple(own[k : k + WINDOW]), set()).add(name)
    out = []
    for doc_id, text in rows:
        own, hit, names = data.words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if (found := windows.get(tuple(own[k : k + size]))) is not None:
                    names |= found - {None}
                    hit.update(range(k, k + size))
        bad = bool(hit) and 20 * len(hit) >= len(own)
        out.append((doc_id, len(own), len(hit), len(names), tuple(sorted(names)), bad))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [100_000, 6])
def test_contamination_equals_brute_force(spark, block):
    rows, items, benchmark = tables(spark)
    found = decontaminate.contamination(
        data.documents(spark, rows), benchmark, block_windows=block
    )
    got = [
        (r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated)
        for r in found.collect()
    ]
    assert sorted(got, key=str) == brute(rows, items)
    assert sum(r[-1] for r in got) > 10


def test_empty_tables(spark):
    rows, _, benchmark = tables(spark)
    documents = data.documents(spark, rows)
    assert decontaminate.contamination(documents.limit(0), benchmark).count() == 0
    found = decontaminate.contamination(documents, benchmark.limit(0)).collect()
    assert len(found) == len(rows) and not any(r.contaminated for r in found)


def test_clean_documents_stay(spark):
    rows, items, benchmark = tables(spark)
    frame = data.documents(spark, rows)
    kept = decontaminate.clean_documents(frame, benchmark)
    assert kept.columns == frame.columns
    expected = [r[0] for r in brute(rows, items) if not r[-1]]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, expected))


def test_index_of_all_terms_finds_phrases_and_proximity(spark):
    rows = [(1, "the red fox ran over a hill"), (2, "over the hill ran a red fox"), (3, "red red hill")]
    index = decontaminate.build_index(data.documents(spark, rows))
    asked = spark.createDataFrame(
        [("p", "red fox ran"), ("q", "hill red"), ("r", "none here")], "item_id string, text string"
    )
    phrases = decontaminate.windows(asked)

    def found(**options):
        rows = decontaminate.matches(spark, index, phrases, all_documents=False, **options)
        return {(r.doc_id, x) for r in rows.collect() for x in r["items"]}

    assert found() == {(1, "p")}
    assert found(slop=3) == {(1, "p"), (2, "p"), (3, "q"), (2, "q")}


def test_a_phrase_does_not_reach_over_two_documents(spark):
    rows = [(1, "alpha beta"), (2, "gamma delta")]
    asked = spark.createDataFrame([("p", "beta gamma")], "item_id string, text string")
    found = decontaminate.contamination(data.documents(spark, rows), asked).collect()
    assert not any(r.n_hit for r in found)


def test_repeated_words_in_a_phrase():
    words = np.array([3, 3, 5, 3, 3, 3], dtype=np.uint64)
    order = np.argsort(words, kind="stable")
    segment = decontaminate.Segment(
        {
            "segment": "s",
            "doc_ids": [1],
            "n_words": [6],
            "doc_starts": np.zeros(1, np.int32).tobytes(),
            "terms": np.array([3, 5], np.uint64).tobytes(),
            "counts": np.array([5, 1], np.int32).tobytes(),
            "positions": order.astype(np.int32).tobytes(),
        }
    )
    phrase, at = decontaminate.find(
        segment, np.array([[3, 3, 3], [5, 3, 0]], np.uint64), np.array([3, 2])
    )
    assert sorted(zip(phrase.tolist(), at.tolist())) == [(0, 3), (1, 2)]
    assert len(arrays.ragged(np.array([5, 1]), np.array([0, 2]))) == 2


def test_query_digest_of_no_items(spark):
    import hashlib

    path = "/root/testdata/sf0.001"
    row = queries.op8_benchmark_decontamination(spark, path).where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
