"""Every stage of the pipeline, and the whole, on a small folder of tables."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import quality, scratch
from tests.llm import data
from tests.llm.test_pairs import repeated, runs


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts, junk, copies, shared passages and benchmark leaks, with labels."""
    rng = random.Random(41)
    root = str(tmp_path_factory.mktemp("tables"))
    passage = data.prose(rng, 60).replace("\n", " ")
    leak = data.prose(rng, 30).replace("\n", " ")
    rows, kinds = [], {}
    for i in range(200):
        own, kind = data.prose(rng, rng.randrange(60, 200)), "clean"
        if i % 5 == 1:
            own, kind = " ".join(w + "%%%" for w in own.split()), "junk"
        elif i % 10 == 2:
            own, kind = rows[0][1] + f" end{i}", "copy"
        elif i % 10 == 3:
            own, kind = f"{own} {passage} {data.prose(rng, 40)}", "passage"
        elif i % 20 == 4:
            own, kind = f"{own} {leak}", "leak"
        rows.append((i, own))
        kinds[i] = kind
    rows += [(r[0], r[1]) for r in data.edge_rows(rng)]
    data.documents(spark, rows).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(kinds[i] != "junk"), 0) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet"
    )
    spark.createDataFrame([("b", leak), (None, None)], "item_id string, text string").write.parquet(
        f"{root}/benchmark.parquet"
    )
    return root, dict(rows[:200]), kinds


def test_stages_take_effect_and_keep_clean_documents(spark, folder):
    root, texts, kinds = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.staged(stage(spark, docs, root), "stage")
        assert docs.columns == columns
        left[name] = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None and r.doc_id < 200}
    clean = {i for i, k in kinds.items() if k == "clean"}
    by_quality, by_copies, by_passages, by_leaks = left.values()
    assert set(by_quality) == {i for i in texts if kinds[i] != "junk"}
    copies = {i for i, k in kinds.items() if k == "copy"}
    assert set(by_quality) - set(by_copies) == copies and 0 in by_copies
    assert set(by_passages) == set(by_copies)
    assert not repeated(list(by_passages.items()))
    assert all(by_passages[i] == texts[i] for i in clean)
    assert set(by_passages) - set(by_leaks) == {
        i for i, t in by_passages.items() if kinds[i] == "leak" and len(runs(t)) > 60
    } or set(by_passages) - set(by_leaks) <= {i for i, k in kinds.items() if k == "leak"}
    assert clean <= set(by_leaks)


def test_run_ends_in_ids_of_what_is_left(spark, folder):
    root, texts, kinds = folder
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, root).collect()}
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    clean = [i for i, k in kinds.items() if k == "clean"]
    assert set(clean) <= set(found)
    for i in clean[:20]:
        assert found[i].n_tokens == len(reference.encode(texts[i], add_special_tokens=False).ids)


def test_stages_take_empty_tables(spark, folder):
    root = folder[0]
    none = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, root).count() == 0


def test_a_score_column_of_the_documents_stays(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    kept = corpus_pipeline.good_quality(spark, docs, folder[0])
    assert kept.select("score").distinct().collect()[0][0] == "7"
    labels = spark.read.parquet(f"{folder[0]}/labels.parquet").limit(0)
    assert quality.scored(docs, quality.fit(docs, labels), "s").where(F.col("s") != 0.5).count() == 0
