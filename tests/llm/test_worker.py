"""What Python workers keep between tasks."""

import weakref

import pyarrow as pa

from riskloom.llm import near_dup, worker


def test_a_worker_keeps_one_thing():
    class Ring:
        def __init__(self):
            self.own = self

    made = worker.kept("ring", Ring)
    assert worker.kept("ring", Ring) is made
    gone = weakref.ref(made)
    del made
    empty = pa.RecordBatch.from_arrays(
        [pa.array([], pa.int64()), pa.array([], pa.string())], names=["doc_id", "text"]
    )
    assert not [b for b in near_dup._signed(iter([empty])) if len(b)]
    assert gone() is None
