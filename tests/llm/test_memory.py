"""What workers hold does not grow with the batch, and goes back at the end of a task."""

import tracemalloc

import numpy as np
import pyarrow as pa

from rollbook.llm import jaccard, substring, toxicity
from rollbook.llm.hashing import SECTION_BYTES, SLICE_BYTES, column_bytes, sliced, word_hashes


class _Shown:
    """In place of a frame: gives the function that would run in the tasks."""

    def mapInArrow(self, function, schema):
        return function


class _Value:
    def __init__(self, value):
        self.value = value


def _texts(n: int, words: int, vocabulary: int = 5000) -> list[str]:
    rng = np.random.default_rng(5)
    return [" ".join(f"word{w}" for w in rng.integers(0, vocabulary, words)) for _ in range(n)]


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _batch(texts: list) -> pa.RecordBatch:
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string()), ids], ["doc_id", "text", "th"])


def test_word_hashes_by_sections():
    texts = [*_texts(20, 2000), "", "x" * (2 * SECTION_BYTES + 7), *_texts(1, 30), "ab", "cd"]
    data, offsets = column_bytes(pa.array(texts))
    h, starts, ends, at = word_hashes(data, offsets)
    of = {}
    for i in range(len(starts)):
        of.setdefault(data[starts[i] : ends[i]].tobytes(), set()).add(int(h[i]))
    assert sum(len(t.split()) for t in texts) == len(h) == at[-1]
    assert all(len(hashes) == 1 for hashes in of.values())
    for word, (found,) in of.items():  # as each word alone is hashed
        alone = np.frombuffer(word, np.uint8)
        assert int(word_hashes(alone, np.array([0, len(alone)]))[0][0]) == found


def test_word_hashes_need_little_beside_the_text():
    data, offsets = column_bytes(pa.array(_texts(200, 2000)))
    assert len(data) > 3_000_000
    assert _peak(lambda: word_hashes(data, offsets)) < 20 * len(data)


def test_training_needs_little_beside_the_texts():
    texts = _texts(200, 3000, 3000)
    labels = np.arange(200) % 2
    peak = _peak(lambda: toxicity.fit(texts, labels, epochs=2))
    assert peak < 20 * sum(map(len, texts))


def test_sliced():
    texts = [*_texts(2000, 200), None, "", "y" * (SLICE_BYTES + 1), None]
    batch = _batch(texts)
    parts = list(sliced([batch, batch.slice(0, 0)], 1))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert len(parts) > 2
    assert all(p.num_rows == 1 or len(column_bytes(p.column(1))[0]) <= SLICE_BYTES for p in parts)


def test_tasks_hand_on_small_batches_and_give_memory_back(monkeypatch):
    bits = 20
    given = []
    for module in (substring, jaccard):
        monkeypatch.setattr(module, "give_back_memory", lambda: given.append(1), raising=False)
    full = bytearray(b"\xff" * (1 << bits - 3))
    none = bytearray(1 << bits - 6)
    batch = _batch(_texts(2000, 300))
    n_slices = len(list(sliced([batch], 1)))
    assert n_slices > 2
    often = np.zeros(1 << jaccard.COUNT_BITS, np.int64)
    for function in (
        substring._pieces(_Shown(), 13, 5, _Value((full, none)), bits, False),
        jaccard._prefixes(_Shown(), 4, 85, _Value((full, often)), bits),
    ):
        out = list(function([batch]))
        assert len(out) == n_slices
        ids = np.concatenate([b.column(b.schema.get_field_index("doc_id")).to_numpy() for b in out])
        assert (np.diff(ids) >= 0).all() and set(ids.tolist()) == set(range(2000))
    assert len(given) == 2
