"""Quality and toxicity: held-out accuracy on the given tables, and edge rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import labelled, quality, toxicity
from tests.llm import data

SF_DIR = "/root/testdata/sf0.01"


def area(score, label):
    """Area under the ROC curve; ties count half."""
    ahead = score[label == 1][:, None] - score[label == 0][None, :]
    return ((ahead > 0) + 0.5 * (ahead == 0)).mean()


def held_out(spark, operator, label):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scores = operator.scores(documents, labels)
    assert scores.columns == ["doc_id", "held_out", "score", "predicted"]
    assert scores.count() == documents.count()
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    return np.array([r.score for r in rows]), np.array([r[label] for r in rows])


def test_held_out_quality(spark):
    score, label = held_out(spark, quality, "quality")
    assert area(score, label) > 0.97
    assert (score[label == 1] >= quality.THRESHOLD).mean() > 0.98


def test_held_out_toxicity(spark):
    score, label = held_out(spark, toxicity, "toxic")
    assert area(score, label) > 0.9
    assert (score[label == 0] >= toxicity.THRESHOLD).mean() < 0.03


def test_folds_follow_the_checksum_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(50).select("id", labelled.fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_samples_are_bounded_and_leave_the_held_out_fold(spark):
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 4 = 0 AS INT) AS toxic")
    training = labelled.fold("doc_id", 3) != 1
    chosen = labelled.sample(labels, "toxic", training, 40, per_class=True).collect()
    assert sum(r.label for r in chosen) == 20 and len(chosen) == 40
    frame = spark.createDataFrame([(r.doc_id,) for r in chosen], "doc_id bigint")
    assert frame.where(~training).count() == 0


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_edge_rows(spark, operator):
    rng = random.Random(17)
    rows = data.edge_rows(rng) + [(i, data.prose(rng, 30) + " scoundrel" * (i % 2)) for i in range(80)]
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(80)] + [(None, 1, 1), (3, None, None), (902, 0, 0), (5, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    ).withColumn("text", F.lit("x")).withColumn("label", F.lit(9))
    frame = data.documents(spark, rows)
    found = operator.scores(frame, labels).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.score >= operator.THRESHOLD) for r in found)
    repeated = [r.score for r in found if r.doc_id == 903]
    assert len(repeated) == 2 and len(set(repeated)) == 1
    assert operator.scores(frame.limit(0), labels).count() == 0
    without = operator.scores(frame, labels.limit(0)).collect()
    assert {r.score for r in without} == {0.5}


def test_features_do_not_depend_on_the_block(monkeypatch):
    rng = random.Random(3)
    texts = pa.array([t for _, t in data.edge_rows(rng)], pa.string())
    whole = quality.features(texts)
    one_by_one = np.concatenate([quality.features(texts.slice(i, 1)) for i in range(len(texts))])
    assert np.allclose(whole, one_by_one)


def test_scores_do_not_depend_on_order_or_neighbours(spark):
    """The same documents dealt in other ways, and equal texts in one pass."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    again = documents.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text").limit(300)
    documents = documents.unionByName(again)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for operator, fitted in ((quality, quality.fit), (toxicity, toxicity.fit)):
        model = fitted(documents, labels)
        one = operator.scored(documents.coalesce(1), model).collect()
        other = operator.scored(documents.orderBy(F.hash("text"), "doc_id"), model).collect()
        scores = {r.doc_id: r.score for r in one}
        assert scores == {r.doc_id: r.score for r in other}
        texts = {}
        for r in one:
            assert texts.setdefault(r.text, r.score) == r.score


def test_ties_go_to_the_earlier_label():
    sample = np.tile(np.random.default_rng(2).random(quality.FEATURES), (9, 1)).astype(np.float32)
    space = quality.Space(sample, np.array([1, 1, 0, 0, 0, 0, 0, 0, 0]))
    assert space.votes(sample[:1], 2)[0] == 1 and space.votes(sample[:1], 4)[0] == 0.5


def test_vectors_see_words_and_letters():
    text = "The quick brown fox, 12 of them."
    changed = "".join("z" if c.islower() else "Q" if c.isupper() else c for c in text)
    one, other = quality.features(pa.array([text, changed]))
    assert np.array_equal(one[: quality.TERMS], other[: quality.TERMS])  # classes only
    assert not np.array_equal(one, other)
    labels = np.arange(40) % 2
    rng = random.Random(4)
    rows = [data.prose(rng, 20) + (" zebra" if k else " camel") for k in labels]
    space = quality.Space(quality.features(pa.array(rows)), labels, latent=30)
    projected = space.project(np.stack([one, other]))
    assert not np.array_equal(projected[0], projected[1])


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_a_clashing_score_column_is_named(spark, operator):
    frame = spark.createDataFrame([(1, "x", 2)], "doc_id bigint, text string, Score int")
    with pytest.raises(ValueError, match="score"):
        operator.scored(frame, None)


def test_votes_are_those_of_the_nearest():
    random_ = np.random.default_rng(5)
    sample = random_.random((60, quality.FEATURES)).astype(np.float32)
    labels = random_.integers(0, 2, 60)
    space = quality.Space(sample, labels, latent=12)
    asked = random_.random((300, quality.FEATURES)).astype(np.float32)
    cosine = space.project(asked) @ space.vectors.T / float(quality._FINE) ** 2
    expected = []
    for row in cosine:
        near = np.argsort(-row, kind="stable")[:7]
        weight = np.maximum(row[near], 1e-6).astype(float) ** quality.SHARPNESS
        expected.append((weight * labels[near]).sum() / weight.sum())
    assert np.allclose(space.votes(asked, 7), expected, atol=1e-5)


def test_bags_are_means_of_their_grams():
    text = "abc defg zz " + "ümläut"
    found = toxicity.grams(*_buffer([text, "", "x"]))
    weights = np.random.default_rng(1).random(toxicity.BUCKETS)
    best, first = toxicity.highest_bags(found, weights)
    means = []
    for at in range(3):
        buckets, _ = toxicity._bags(found, np.array([at]), np.array([at + toxicity.BAG_WORDS]))
        means.append(weights[buckets].mean())
    assert best[0] == pytest.approx(max(means)) and first[0] == int(np.argmax(means))
    assert best[1] == -np.inf and first[1] == -1
    buckets, _ = toxicity._bags(found, np.array([4]), np.array([5]))
    assert best[2] == pytest.approx(weights[buckets].mean())


def test_unseen_misspellings_share_the_vectors():
    rng = random.Random(23)
    texts, labels = [], []
    for i in range(240):
        own = data.prose(rng, rng.randrange(20, 200)).split(" ")
        if i % 2:
            own[rng.randrange(len(own))] = rng.choice(["blockhead", "nincompoop"])
        texts.append(" ".join(own))
        labels.append(i % 2)
    scorer = toxicity.train(pa.array(texts), np.array(labels, dtype=float))
    clean = data.prose(rng, 300)
    bad = [clean + " " + w for w in ("blockheads", "bl0ckhead", "nincompooop", "blokhead")]
    scores = scorer.scores(pa.array([clean, *bad]))
    assert scores[0] < 0.05 and (scores[1:] > 10 * scores[0]).all()


def _buffer(texts):
    from riskloom.llm import arrays

    return arrays.text_buffer(pa.array(texts, pa.string()))
