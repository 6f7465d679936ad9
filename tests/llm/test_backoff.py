import math
import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tessera.llm import backoff

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("block", T.StringType()), T.StructField("bucket", T.StringType())])


def brute(rows, alpha=0.4, least=2):
    docs = [(t or "").encode().split() for _, t in rows]
    one, two = Counter(w for d in docs for w in d), Counter(p for d in docs for p in zip(d, d[1:]))
    n = sum(one.values())
    out = []
    for (i, _), d in zip(rows, docs, strict=True):
        s = math.log(one[d[0]] / n) if d else 0.0
        for v, w in zip(d, d[1:]):
            s += math.log(two[v, w] / one[v]) if two[v, w] >= least else math.log(alpha * one[w] / n)
        out.append((i, len(d), round(s, 6)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(150):
        words = [vocab[min(int(rng.paretovariate(0.6)), 2999)] for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.4:
            words[2:2] = ["very", "common", "pair"] * 3
        rows.append((i, " ".join(words)))
    return rows + [(None, "w1 w2"), (None, None), (500, None), (501, ""), (502, " \t\n"), (503, "one"), (3, rows[3][1]), (504, "w1 w2 é日 " * 20_000)]


@pytest.mark.parametrize("hot_words,hot_pairs,per_bucket", [(1 << 14, 1 << 11, 10 ** 7), (64, 16, 4000), (2, 1, 1000)])
def test_scores_equal_brute_force(spark, monkeypatch, hot_words, hot_pairs, per_bucket):
    monkeypatch.setattr(backoff, "HOT_WORDS", hot_words)
    monkeypatch.setattr(backoff, "HOT_PAIRS", hot_pairs)
    monkeypatch.setattr(backoff, "PAIRS_AT_ONCE", per_bucket // 9)
    monkeypatch.setattr(backoff, "MIN_BUCKETS", 3)
    rows = corpus(hot_words)
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA).repartition(5)
    got = sorted(((r.doc_id, r.n_words, round(r.log_score, 6)) for r in backoff.score_documents(df, words_per_bucket=per_bucket).collect()), key=str)
    want = brute(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-5)


def test_equal_blocks_and_empty_tables(spark):
    rows = [(None, "a b c a b")] * 7
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA).repartition(7)
    got = sorted((r.doc_id, r.n_words, round(r.log_score, 6)) for r in backoff.score_documents(df).collect())
    assert got == brute(rows)
    assert backoff.score_documents(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None, "c", "c")], SCHEMA)
    assert [tuple(r) for r in backoff.score_documents(none).collect()] == [(1, 0, 0.0)]


@pytest.mark.parametrize("step", ["word_counts", "explode_pairs"])
def test_a_block_s_arrays_go_before_the_next_is_read(step):
    """Between blocks a task holds what it hands over only (before: all arrays of the last block, 50 bytes a word and more)."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(30_000)}" for _ in range(500)) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(400), pa.int64()), "text": texts})
    docs = SimpleNamespace(mapInArrow=lambda run, schema: run([batch]))
    hot = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0)))
    tracemalloc.start()
    try:
        made = backoff.word_counts(docs, 16) if step == "word_counts" else backoff.explode_pairs(docs, 16, hot)
        first = next(made)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert first.num_rows >= 16 and held < 2_000_000


def test_rows_to_the_contexts_don_t_grow_with_the_blocks(monkeypatch):
    """A bucket of words sends one row to each bucket of contexts (before: one for every block of texts, so rows grew as the cube of the input)."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(60)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(60), pa.int64()), "text": texts})
    docs = SimpleNamespace(mapInArrow=lambda run, schema: run([batch]))
    hot = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0)
    sent = {}
    for size in (1 << 20, 500):
        monkeypatch.setattr(backoff, "BLOCK_BYTES", size)
        words = Counter()
        for rows in backoff.word_counts(docs, 3):
            for r in rows.to_pylist():
                if r["bucket"] >= 0:
                    words.update(dict(zip(np.frombuffer(r["a"], np.uint64).tolist(), np.frombuffer(r["b"], np.int64).tolist())))
        counts = np.array(sorted(words), np.uint64), np.array([words[w] for w in sorted(words)])
        entries = [SimpleNamespace(**r) for rows in backoff.explode_pairs(docs, 3, SimpleNamespace(value=hot)) for r in rows.to_pylist() if r["bucket"] == 1]
        frames = list(backoff._score_targets(counts, entries, hot, math.log(0.4), math.log(3600), 2, 3))
        rows = [r for f in frames for r in f.itertuples(index=False)]
        sent[size] = len(entries), sum(r.kind == 1 for r in rows)
    assert sent[1 << 20][0] == 1 and sent[500][0] > 20
    assert sent[500][1] == sent[1 << 20][1] <= 3


def test_entries_are_the_same_whether_or_not_a_number_holds_them():
    rng = np.random.default_rng(8)
    v, w, doc = rng.integers(0, 5, 300), rng.integers(0, 4, 300), rng.integers(0, 6, 300)
    short, long = backoff._entries(v, w, doc, 5, 6), backoff._entries(v, w, doc, 1 << 31, 6)
    assert all(np.array_equal(a, b) for a, b in zip(short, long)) and short[3].sum() == 300
