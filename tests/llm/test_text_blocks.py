import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import text_blocks as tb


def texts(n=300):
    rng = random.Random(1)
    words = ["Abc", "éÉ", "日本", "x", "", " ", "\t", "\x0b", "a\x1cb", "Word."]
    return [None if rng.random() < 0.05 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("lower", [None, "ascii", "utf8"])
def test_blocks_hold_every_text_and_its_words(kind, lower):
    """Blocks that begin inside a batch split like any other."""
    every = texts()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(every))), pa.array(every, kind)], names=["id", "text"])
    seen = []
    for block in tb.text_blocks(iter([batch, batch.slice(50, 0), batch.slice(37, 100)]), "text", 200):
        own = block.column("text").to_pylist()
        assert len(own) == 1 or sum(len(t.encode()) for t in own) <= 200
        words = tb.split_words(block.column("text"), lower)
        vocab = words.vocab.to_numpy(zero_copy_only=False)
        for i, t in enumerate(own):
            want = (t.encode().lower() if lower == "ascii" else t.lower().encode() if lower else t.encode()).split()
            assert [vocab[j].encode() for j in words.ids[words.starts[i]:words.starts[i + 1]]] == want
        seen += list(zip(block.column("id").to_pylist(), own, strict=True))
    want = [(i, t or "") for i, t in enumerate(every)]
    assert seen == want + want[37:137]


def test_window_hashes_depend_on_order_and_length():
    h = tb.mix64(np.arange(10, dtype=np.uint64))
    assert len(tb.window_hashes(h, 5)) == 6 and len(tb.window_hashes(h, 11)) == 0
    assert tb.window_hashes(h[:2], 2)[0] != tb.window_hashes(h[1::-1], 2)[0]
    assert tb.sums_by_text(np.array([1.0, 2, 3]), np.array([0, 0, 2, 3])).tolist() == [0, 3, 3]


def test_memory_goes_back_after_the_last_result(monkeypatch):
    calls = []
    monkeypatch.setattr(tb, "release_memory", lambda **k: calls.append("released"))
    assert [calls.append(x) or x for x in tb.giving_back(iter([1, 2]))] == [1, 2]
    assert calls == [1, 2, "released"]
