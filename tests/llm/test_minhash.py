import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tessera.llm import minhash

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("range", T.StringType()), T.StructField("fingerprint", T.StringType())])


def plain_sets(text):
    words = text.encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def jaccard(a, b):
    a, b = plain_sets(a), plain_sets(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("alpha beta gamma delta Épée zeta eta theta iota".split()) + str(rng.randint(0, 9))
                      for _ in range(rng.randint(0, 90))) for _ in range(n)]
    return texts + ["", " \n", "a b", "A\tB", "one two three four five", "long words here " * 9000]


def test_shingles_are_distinct_word_runs():
    texts = corpus()
    x, starts = minhash.shingles(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        assert len(np.unique(x[starts[i]:starts[i + 1]])) == len(plain_sets(t))
    k = texts.index("a b")
    assert x[starts[k]] == x[starts[k + 1]]


@pytest.mark.parametrize("per_range", [7, 1000])
def test_edited_fingerprints(spark, per_range):
    texts = corpus()
    rows = [(i * 3, t, "c", "c") for i, t in enumerate(texts)] + [(5, None, "c", "c"), (6, texts[2], "c", "c"), (6, texts[2], "c", "c"),
                                                                (None, "x y z", "c", "c"), (None, None, "c", "c")]
    got = minhash.edited_fingerprints(spark.createDataFrame(rows, SCHEMA), rows_per_range=per_range).collect()
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        cut = len(t) // 3
        e = t[:len(t) - cut] + nxt[:cut]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    by_sha = {w[2]: (order[k][1], order[(k + 1) % len(order)][1]) for k, w in enumerate(want)}
    errors = []
    for r in got:
        t, nxt = by_sha[r.edited_sha256]
        errors += [abs(r.near_edited - jaccard(t, minhash.edited(t, nxt))), abs(r.near_next - jaccard(t, nxt))]
    assert np.mean(errors) < 0.03 and max(errors) < 0.2
    prints = {}
    for r, in [(r,) for r in got if r.doc_id in (6,)]:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(prints[6]) == 1


def test_small_tables(spark):
    df = spark.createDataFrame([(4, "a b c d e f g h i", "c", "c")], SCHEMA)
    r, = minhash.edited_fingerprints(df).collect()
    assert r.near_next == 1 and r.n_chars == 17
    assert minhash.edited_fingerprints(df.limit(0)).count() == 0
    only_null = spark.createDataFrame([(None, "b", "c", "c"), (None, "a", "c", "c")], SCHEMA)
    assert minhash.edited_fingerprints(only_null).count() == 2


def test_near_duplicates(spark):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(300)]
    rows, texts = [], {}
    for i in range(40):
        w = list(base)
        w[rng.randrange(300)] = f"edit{i}"
        texts[i] = " ".join(w)
    texts |= {100 + i: " ".join(f"u{rng.randint(0, 10 ** 6)}" for _ in range(100)) for i in range(20)}
    texts |= {200: texts[100], 201: texts[100], 300: "", 301: ""}
    rows = [(i, t, "c", "c") for i, t in texts.items()] + [(None, base[0], "c", "c"), (302, None, "c", "c")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in got:
        assert r.jaccard is None or abs(r.jaccard - jaccard(texts[r.id_a], texts[r.id_b])) < 1e-12
    linked = {r.id_b for r in got if r.jaccard is not None}
    assert linked >= set(range(1, 40)) and not linked & set(range(100, 303))
    assert {(r.id_a, r.id_b) for r in got if r.jaccard is None} == {(100, 200), (100, 201)}
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("blocks", [(512, 256), (3, 4)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, blocks):
    """Chains of edits, a group of edited copies, texts that share a band but aren't similar, and an id with two texts."""
    monkeypatch.setattr(minhash, "CLASSES_PER_BLOCK", blocks[0], raising=False)
    monkeypatch.setattr(minhash, "SETS_PER_BLOCK", blocks[1], raising=False)
    rng = random.Random(5)
    texts = {}
    for chain in range(12):  # the first is not similar to the last
        words = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(200)]
        for step in range(5):
            texts[chain * 10 + step] = " ".join(words)
            for k in rng.sample(range(0, 200, 5), 3):
                words[k] = f"e{chain} {step} {k}".replace(" ", "x")
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(150)]
    for i in range(40):
        words = list(base)
        for k in rng.sample(range(0, 150, 5), 2):
            words[k] = f"c{i}x{k}"
        texts[300 + i] = " ".join(words)
    passage = [f"p{rng.randint(0, 10 ** 6)}" for _ in range(100)]
    for i in range(30):
        texts[400 + i] = " ".join([f"q{rng.randint(0, 10 ** 6)}" for _ in range(60)] + passage)
    rows = [*texts.items(), (0, texts[300] + " more words at the end of it"), (900, texts[10]), (901, texts[310]), (901, None)]
    want = set()
    for i, (d, t) in enumerate(rows):
        for e, u in rows[:i]:
            x = jaccard(t or "", u or "")
            if d != e and t and u and 0.8 <= x < 1:
                want.add((min(d, e), max(d, e), round(x, 12)))
    copies = {900: 10, 901: 310}  # not the representatives of their classes
    want = {w for w in want if w[0] not in copies and w[1] not in copies}
    got = minhash.near_duplicates(spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)).collect()
    assert {(r.id_a, r.id_b) for r in got if r.jaccard is None} == {(v, k) for k, v in copies.items()}
    links = [(r.id_a, r.id_b, round(r.jaccard, 12)) for r in got if r.jaccard is not None]
    assert len(links) == len(set(links)) and set(links) == want
    assert all((c, c + 1) in {w[:2] for w in want} and (c, c + 4) not in {w[:2] for w in want} for c in range(0, 120, 10))
