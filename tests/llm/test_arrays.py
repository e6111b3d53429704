import random

import numpy as np
import pyarrow as pa

from riskloom.llm import arrays
from tests.llm import data


def _texts(seed=1):
    rng = random.Random(seed)
    texts = [t for _, t in data.edge_rows(rng)]
    alphabet = list("abAZ09 _.-\n") + ["é", "ß", "日", " ", "🙂"]
    return texts + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(300)]


def test_words_are_those_of_the_pattern():
    texts = _texts()
    buffer, offsets = arrays.text_buffer(pa.array(texts, pa.string()))
    found = arrays.words_of(buffer, offsets)
    hashes = {}
    for i, text in enumerate(texts):
        own = slice(found.bounds[i], found.bounds[i + 1])
        spelled = [
            buffer[s:e].tobytes().decode().translate(data._LOWER)
            for s, e in zip(found.starts[own], found.ends[own])
        ]
        assert spelled == data.words(text)
        for word, value in zip(spelled, found.hashes[own].tolist()):
            assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = pa.array(_texts(2), pa.string())
    whole = arrays.words_of(*arrays.text_buffer(texts)).hashes
    monkeypatch.setattr(arrays, "BLOCK", 64)
    assert (arrays.words_of(*arrays.text_buffer(texts)).hashes == whole).all()


def test_a_sliced_column_is_read_right():
    texts = pa.array(["a b", None, "c", "", "d e f"], pa.string())
    found = arrays.words_of(*arrays.text_buffer(texts.slice(1, 4)))
    assert np.diff(found.bounds).tolist() == [0, 1, 0, 3]


def test_shingles():
    texts = ["a b c d e f", "a b c d e", "a b", "", "b c d e f"]
    values, bounds = arrays.shingles(
        arrays.words_of(*arrays.text_buffer(pa.array(texts))), 5
    )
    own = [values[bounds[i] : bounds[i + 1]].tolist() for i in range(5)]
    assert list(map(len, own)) == [2, 1, 1, 0, 1]
    assert own[0] == [own[1][0], own[4][0]]


def test_chunks_cover_all_rows():
    texts = pa.array(["x" * n for n in (3, 0, 50, 2, 2, 2, 90)])
    ranges = list(arrays.chunks(texts, 6))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(7))
