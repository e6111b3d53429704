"""Near duplicates, repeated passages and components against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import arrays, buckets, links, near_dup, substring
from tests.llm import data


def brute_components(nodes, pairs):
    own = {n: n for n in nodes}

    def root(n):
        while own[n] != n:
            n = own[n]
        return n

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        own[high] = low
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(60)]  # a chain
    pairs += [(1000, 1000 + i) for i in range(200)]  # a hub
    pairs += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(160)]
    rng.shuffle(pairs)
    frame = spark.createDataFrame([*pairs, (5, None), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.component for r in links.components(frame).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert found == brute_components(nodes, pairs)
    assert links.components(frame.limit(0)).count() == 0


def runs(text):
    own = data.words(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else {("raw", text or "")}


def weights(text):
    own = data.words(text)
    if not own:
        return {("raw", text or ""): 1.0}
    seen = Counter(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))
    return {run: 1 + math.log(n) for run, n in seen.items()}


def probability_similarity(x, y):
    """By the definition, with the elements of equal weights on both sides counted once."""
    both = [run for run in x if run in y]
    if not both or sum(min(x[r] / sum(x.values()), y[r] / sum(y.values())) for r in both) < 0.7:
        return 0.0
    kinds = Counter((x.get(r, 0.0), y.get(r, 0.0)) for r in {*x, *y})
    return sum(
        n / sum(m * max(u / a, v / b) for (u, v), m in kinds.items())
        for (a, b), n in kinds.items()
        if a and b
    )


def near_rows():
    rng = random.Random(8)
    rows = data.edge_rows(rng)
    doc_id = 0
    for group in range(12):
        text = data.prose(rng, rng.choice([6, 30, 120, 400]))
        for _ in range(rng.choice([1, 2, 9, 25])):
            own = text.split(" ")
            for _ in range(rng.randrange(0, max(1, len(own) // 25) + 1)):
                own[rng.randrange(len(own))] = "".join(rng.choices("abcdef", k=6))
            rows.append((doc_id, " ".join(own)))
            doc_id += 1
    for _ in range(20):  # one half of the runs is seen often, in one text more than in the other
        line, rest = data.prose(rng, 30).replace("\n", " "), data.prose(rng, 40)
        for times in rng.choice([(2, 2), (1, 3), (6, 60), (1, 400), (30, 31)]):
            rows.append((doc_id, " ".join([line] * times + [rest])))
            doc_id += 1
    rng.shuffle(rows)
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_rows()
    found = near_dup.classes(data.documents(spark, rows)).collect()
    assert len(found) == len(rows)
    bags = {i: weights(t) for i, t in rows if i is not None}
    ids = sorted(bags)
    pairs = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and probability_similarity(bags[a], bags[b]) >= 0.8 - 1e-9
    ]
    expected = brute_components(ids, pairs)
    assert {r.doc_id: r.class_id for r in found if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id == r.class_id) for r in found if r.doc_id is not None)
    assert expected[901] == 900  # null reads as empty
    assert len(set(expected.values())) < len(ids) - 20


def test_distinct_documents_keep_one_of_each_class(spark):
    rows = near_rows()
    frame = data.documents(spark, rows)
    kept = near_dup.distinct_documents(frame)
    assert kept.columns == frame.columns
    classes = near_dup.classes(frame).where("doc_id is not null").select("class_id").distinct()
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(r[0] for r in classes.collect())
    assert ids.count(None) == sum(i is None for i, _ in rows)


def test_prob_min_hash_estimates_weighted_similarity():
    rng = np.random.default_rng(3)
    elements = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    x, y = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    x[200:], y[:80] = 0, 0
    owner = np.repeat([0, 1], [200, 220])
    value = np.concatenate([elements[:200], elements[80:]])
    weight = np.concatenate([x[:200], y[80:]])
    sketch = near_dup.prob_min_hash(owner, value, weight, 2, 4096)
    both = [i for i in range(300) if x[i] and y[i]]
    expected = sum(
        1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(300)) for i in both
    )
    assert abs((sketch[0] == sketch[1]).mean() - expected) < 0.04


def test_probability_similarity_is_exact():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x = {int(k): float(rng.integers(1, 5)) for k in rng.integers(1, 60, 40)}
        y = {int(k): float(rng.integers(1, 5)) for k in rng.integers(1, 60, 40)}
        expected = sum(
            1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y})
            for i in x
            if i in y
        )
        sides = [(np.array([*s]), np.array([*s.values()])) for s in (x, y)]
        assert abs(near_dup.probability_jaccard(*sides[0], *sides[1]) - expected) < 1e-12


def test_a_column_of_any_name(spark):
    frame = data.documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "u v w x y z")])
    frame = frame.withColumn("_row", frame["doc_id"]).withColumn("__row", frame["doc_id"])
    kept = near_dup.distinct_documents(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


@pytest.mark.parametrize("empty", ["documents", "null ids"])
def test_nothing_to_compare(spark, empty):
    frame = data.documents(spark, [(None, "a b c d e f g")])
    if empty == "documents":
        frame = frame.limit(0)
    assert near_dup.classes(frame).count() == frame.count()
    assert near_dup.distinct_documents(frame).count() == frame.count()
    assert substring.passages(frame).count() == 0
    assert substring.without_repeats(frame).count() == frame.count()


def passage_rows():
    rng = random.Random(6)
    passages = [data.prose(rng, n).replace("\n", " ") for n in (55, 70, 140)]
    rows = data.edge_rows(rng)
    for i in range(60):
        own = data.prose(rng, rng.randrange(60, 300)).split(" ")
        if i % 3:
            at = rng.randrange(len(own))
            own[at:at] = passages[i % 2 + i % 5 % 2].split(" ")
        rows.append((i, " ".join(own)))
    return rows


def repeated(rows, size=50):
    """Documents with a run of words that another document has."""
    holders = defaultdict(set)
    for i, text in rows:
        own = data.words(text)
        for k in range(len(own) - size + 1):
            holders[tuple(own[k : k + size])].add(i)
    return {i for ids in holders.values() if len(ids) > 1 for i in ids} - {None}


def test_every_repeated_passage_is_found(spark):
    rows = passage_rows()
    found = substring.passages(data.documents(spark, rows)).collect()
    clean = {i for i, _ in rows if i is not None and i < 60 and i % 3 == 0}
    flagged = {r.doc_id for r in found}
    assert repeated(rows) <= flagged
    assert not clean & flagged
    texts = {i: data.words(t) for i, t in rows if i is not None}
    for r in found:
        assert r.n_words <= r.last_word - r.first_word + 1
        assert r.last_word < len(texts[r.doc_id])
        assert r.removed or r.origin == r.doc_id or r.doc_id in flagged


def test_copies_of_passages_are_cut_and_the_rest_stays(spark):
    rows = passage_rows()
    frame = data.documents(spark, rows)
    out = substring.without_repeats(frame)
    assert out.columns == frame.columns
    result = out.collect()
    assert len(result) == len(rows)
    before = {i: t for i, t in rows if i is not None}
    for r in result:
        if r.doc_id is None:
            continue
        if r.doc_id < 60 and r.doc_id % 3 == 0:
            assert r.text == before[r.doc_id]
        if before[r.doc_id] is not None:
            assert r.n_chars == len(r.text)
            left, had = Counter(data.words(r.text)), Counter(data.words(before[r.doc_id]))
            assert not left - had
    assert not repeated([(r.doc_id, r.text) for r in result])
    assert sorted(str(r.text) for r in result if r.doc_id is None) == sorted(
        str(t) for i, t in rows if i is None
    )


def test_cuts_do_not_depend_on_what_stands_around():
    import pyarrow as pa

    from riskloom.llm import arrays

    rng = random.Random(12)
    passage = data.prose(rng, 50).replace("\n", " ")
    for _ in range(200):
        pieces = []
        for _ in range(2):
            text = f"{data.prose(rng, rng.randrange(80))} {passage} {data.prose(rng, 60)}"
            found = substring._Described(*arrays.text_buffer(pa.array([text])))
            pieces.append(set(found.digest.tolist()))
        assert pieces[0] & pieces[1]


def test_every_passage_of_51_words_is_found(spark):
    rng = random.Random(51)
    rows, hidden = [], {}
    for i in range(600):
        passage = data.prose(rng, 51).replace("\n", " ")
        for doc_id in (2 * i, 2 * i + 1):
            before, after = (data.prose(rng, 40).replace("\n", " ") for _ in range(2))
            rows.append((doc_id, f"{before} {passage} {after}"))
            hidden[doc_id] = i
    found = substring.passages(data.documents(spark, rows)).collect()
    assert {r.doc_id for r in found} == set(hidden)
    assert {r.doc_id for r in found if r.removed} == {2 * i + 1 for i in range(600)}
    for r in found:
        # A common word beside the passage may lengthen it, but not by much.
        assert 25 <= r.last_word - r.first_word + 1 and 35 <= r.first_word
        assert r.last_word < 96


def edited_lines():
    """Lines with edited copies, and lines that mostly share a long opening."""
    rng = random.Random(77)
    lines, opening = [], data.prose(rng, 22).replace("\n", " ")
    for _ in range(150):
        own = data.prose(rng, rng.randrange(30, 90)).replace("\n", " ")
        for _ in range(rng.choice([2, 3, 6])):
            words = own.split(" ")
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = "".join(rng.choices("abcdef", k=6))
            lines.append(" ".join(words))
    for i in range(120):  # alike in pairs only, under common buckets
        if i % 2 == 0:
            rest = data.prose(rng, 12).replace("\n", " ")
        lines.append(f"{opening} {rest} " + "".join(rng.choices("ghijk", k=8)))
    rng.shuffle(lines)
    return [(i, f"{data.prose(rng, 8)}\n{line}\n{data.prose(rng, 8)}") for i, line in enumerate(lines)]


def test_edited_lines_equal_brute_force(spark):
    rows = edited_lines()
    frame = data.documents(spark, rows)
    sets = {i: runs(t.split("\n")[1]) for i, t in rows}
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    edited = [(a, b) for a, b in pairs if sets[a] != sets[b]]
    own = brute_components(sets, pairs)
    found = {r.doc_id: r.cluster for r in substring.near_lines(frame).collect()}
    missed = [p for p in edited if p[0] not in found or found[p[0]] != found.get(p[1])]
    assert len(edited) > 300 and len(missed) <= 0.01 * len(edited)
    for a in found:
        for b in found:
            assert found[a] != found[b] or own[a] == own[b]
    removed = {r.doc_id: r.n_words for r in substring.passages(frame).where("removed").collect()}
    lengths = {i: len(data.words(t.split("\n")[1])) for i, t in rows}
    for i in found:
        if own[i] != i:
            assert removed[i] >= lengths[i]


def test_pairs_hidden_in_a_bucket_of_distant_texts(spark):
    """Alike in pairs only, all with one long part in common that fills large buckets."""
    rng = random.Random(31)
    common, rows = data.prose(rng, 200).replace("\n", " "), []
    for _ in range(200):
        own = data.prose(rng, 130).replace("\n", " ").split(" ")
        for _ in range(2):
            copy = list(own)
            copy[rng.randrange(len(copy))] = "".join(rng.choices("ghijk", k=8))
            rows.append((len(rows), f"{common} " + " ".join(copy)))
    found = {r.doc_id: r.class_id for r in near_dup.classes(data.documents(spark, rows)).collect()}
    assert found == {i: i - i % 2 for i in found}


def test_times_seen_are_weights(spark):
    """Equal sets of runs are one class only where their halves are seen about as often."""
    rng = random.Random(19)
    rows = []
    for _ in range(40):
        x, y = (data.prose(rng, 20).replace("\n", " ") + " " for _ in range(2))
        for often in ((1000, 2), (2, 1000), (30, 2), (900, 2)):
            rows.append((len(rows), x * often[0] + y * often[1]))
        rows.append((len(rows), x * 2 + y * 1000 + "end"))
    bags = {i: weights(t) for i, t in rows}
    of_sets, pairs = 0, []
    for a in bags:
        for b in bags:
            if a < b:
                of_sets += len({*bags[a]} & {*bags[b]}) >= 0.8 * len({*bags[a]} | {*bags[b]})
                if probability_similarity(bags[a], bags[b]) >= 0.8 - 1e-9:
                    pairs.append((a, b))
    assert 80 <= len(pairs) < of_sets / 2
    found = {r.doc_id: r.class_id for r in near_dup.classes(data.documents(spark, rows)).collect()}
    assert found == brute_components(bags, pairs)


def test_no_pair_of_one_large_bucket_is_left(spark):
    """Alike in pairs only, and all in one bucket and no other, where rounds soon are quiet."""
    rng = random.Random(17)
    sets = {}
    for i in range(0, 300, 2):
        own = rng.sample(range(10**6), rng.choice([10, 21, 50]))
        edits = len(own) // 10
        sets[i] = own + list(range(10**6, 10**6 + 2))  # two runs that all have
        sets[i + 1] = own[edits:] + sets[i][-2:]
    runs = spark.createDataFrame(
        [(n, sorted(set(own))) for n, own in sets.items()], "node bigint, runs array<bigint>"
    ).localCheckpoint()
    members = runs.select("node").selectExpr("1L AS key", "node")
    alike = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})
    ]
    assert len(alike) >= 150
    found = {r.node: r.component for r in buckets.classes(members, runs).collect()}
    assert found == brute_components({n for p in alike for n in p}, alike)
    links_found = buckets.rest(runs, None).collect()
    assert sorted((r.a, r.b) for r in links_found) == sorted(alike)


def test_the_rest_of_weighted_pairs_equals_brute_force(spark):
    rng = random.Random(23)
    rows = []
    for i in range(0, 160, 2):
        own = {v: rng.choice([1, 1, 1, 2, 9]) for v in rng.sample(range(400), 30)}
        rows.append((i, own))
        changed = dict(own)
        for v in rng.sample(sorted(own), rng.randrange(0, 5)):
            changed[v] = rng.choice([1, 2, 5])
        changed.pop(rng.choice(sorted(changed)))
        rows.append((i + 1, changed))
    table = [
        (n, (sorted(own), [own[v] for v in sorted(own)] if max(own.values()) > 1 else []))
        for n, own in rows
    ]
    runs = spark.createDataFrame(
        table, "node bigint, runs struct<values: array<bigint>, times: array<int>>"
    ).localCheckpoint()
    weight = {n: {v: 1 + math.log(t) for v, t in own.items()} for n, own in rows}
    alike = sorted(
        (a, b)
        for a in weight
        for b in weight
        if a < b and probability_similarity(weight[a], weight[b]) >= 0.8
    )
    assert len(alike) > 20
    found = buckets.rest(runs, None, near_dup._ELEMENTS, near_dup._weighted_alike)
    assert sorted((r.a, r.b) for r in found.collect()) == alike


def test_the_rest_of_texts_with_very_many_runs(spark):
    """Every run was once given all runs of its text, which no machine holds here."""
    own = list(range(100_000))
    table = [(0, (own, [])), (1, (own[9_000:], [])), (2, (own[30_000:], [2] * 70_000))]
    runs = spark.createDataFrame(
        table, "node bigint, runs struct<values: array<bigint>, times: array<int>>"
    ).localCheckpoint()
    found = buckets.rest(runs, None, near_dup._ELEMENTS, near_dup._weighted_alike)
    assert [(r.a, r.b) for r in found.collect()] == [(0, 1)]


@pytest.mark.parametrize("weighted", [False, True])
def test_distant_texts_of_one_template_are_no_candidates(spark, monkeypatch, weighted):
    """85 of 100 runs in common is a similarity of 0.74, and every pair was verified."""
    sets = {n: list(range(85)) + list(range(1000 * (n + 1), 1000 * (n + 1) + 15)) for n in range(200)}
    sets[200] = sets[7][:-2]  # and one copy
    if weighted:
        kind, elements = "struct<values: array<bigint>, times: array<int>>", near_dup._ELEMENTS
        table = [(n, (own, [3] * len(own))) for n, own in sets.items()]
        verified = near_dup._weighted_alike
    else:
        kind, elements, table = "array<bigint>", buckets.SETS, list(sets.items())
        verified = buckets._similar_sets
    runs = spark.createDataFrame(table, f"node bigint, runs {kind}").localCheckpoint()
    counts, staged = {}, buckets.scratch.staged

    def counted(frame, name):
        out = staged(frame, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(buckets.scratch, "staged", counted)
    found = buckets.rest(runs, None, elements, verified)
    assert [(r.a, r.b) for r in found.collect()] == [(7, 200)]
    assert counts["rest"] <= 2 * len(sets)


def test_paragraphs_that_are_neither_first_nor_next_are_compared(spark):
    """A bucket lists c between a and b, and its head is another: only the rest meets a and b."""
    rng = random.Random(29)
    words = [data.prose(rng, 1).strip(".").lower() + str(i) for i in range(13)]
    texts = [" ".join(words), " ".join(words[:-1]), "p q r s t u v", "k l m n o p q"]
    frame = data.documents(spark, list(enumerate(texts)))
    nodes = {}
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        told = substring._Described(raw, np.array([0, len(raw)]), split=substring.whole_lines)
        nodes[i] = int(told.digest.view(np.int64)[0])
    neighbours = {0: 2, 1: 3, 2: 3, 3: 2}
    met = spark.createDataFrame(
        [(i, 0, 13, 0, nodes[i], nodes[j], nodes[j]) for i, j in neighbours.items()],
        "doc_id bigint, first int, size int, line int, node bigint, head bigint, before bigint",
    ).localCheckpoint()
    split = substring._runs_table
    try:  # whole lines, so that the two long texts are one paragraph each
        substring._runs_table = lambda *args: split(*args, substring.whole_lines)
        found = {frozenset((r.a, r.b)) for r in substring._verified(met, frame).collect()}
    finally:
        substring._runs_table = split
    assert found == {frozenset((nodes[0], nodes[1]))}


def test_runs_of_wanted_paragraphs(spark):
    """Each wanted paragraph has the distinct runs of its words, and places without one none."""
    rng = random.Random(31)
    texts = [None, data.prose(rng, 120), "a b c a b c a b c a b c", "", data.prose(rng, 60)]
    told = substring._Described(
        *arrays.text_buffer(pa.array(texts, pa.string())), split=substring.whole_lines
    )
    wanted, expected = [[] for _ in texts], {}
    for i, (t, f) in enumerate(zip(told.text.tolist(), told.first.tolist(), strict=True)):
        wanted[t].append({"node": 100 + i, "first": f})
        own = told.runs[told.begin[i] : told.begin[i] + told.per[i]]
        expected[100 + i] = set(own.view(np.int64).tolist())
    wanted[0].append({"node": 7, "first": 0})
    wanted[4].append({"node": 8, "first": 10**6})
    kind = pa.list_(pa.struct([("node", pa.int64()), ("first", pa.int32())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), pa.array(wanted, kind)], names=["text", "wanted"]
    )
    found = pa.Table.from_batches(substring._runs_of(substring.whole_lines)(iter([batch])))
    rows = found.to_pylist()
    assert {r["node"]: set(r["runs"]) for r in rows} == expected
    assert all(len(r["runs"]) == len(set(r["runs"])) for r in rows)


def test_a_staged_table_is_removed(spark):
    one, two = (substring.scratch.staged(spark.range(n), "small") for n in (5, 7))
    substring.scratch.remove(one)
    assert two.count() == 7
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        one.count()


def test_buckets_of_paragraphs_are_not_ordered(spark):
    """Large sorts are by the bucket alone, and a paragraph is put to its bucket once."""
    frame = data.documents(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None)])
    plan = substring._collisions(frame)._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"Sort \[(.*?)\], false", plan)
    assert len(sorts) == 1 and "," not in sorts[0]


def test_a_copied_paragraph_is_met_once(spark):
    text = "a b c d e f g"
    frame = data.documents(spark, [(i, text) for i in range(4)]).repartition(3)
    met = substring._collisions(frame).collect()
    assert {r.doc_id for r in met} == set(range(4)) and all(r.key is None for r in met)
    assert len(met) == len({(r.doc_id, r.first) for r in met})
