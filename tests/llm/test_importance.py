import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tessera.llm import importance as im

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                      + [T.StructField(c, T.StringType()) for c in ("id", "weight", "score", "eligible", "rank", "n_words")])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, n=3):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(rows, targets, percent=5, min_words=20, buckets=10_000, n=3):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, n)[1])

    s, t = counts(x for _, x in rows), counts(targets)
    s_all, t_all = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(buckets)]
    out = []
    for i, x in rows:
        words, fs = features(x, n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs)
        h = None if i is None else int(sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, i is not None and len(words) >= min_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def run(spark, rows, targets, **kw):
    df = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], SCHEMA)
    goal = spark.createDataFrame([(t,) for t in targets], "text string")
    got = im.resample(df, goal, **kw)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, got.collect()), key=str)


def some_rows(n, seed):
    rng = random.Random(seed)
    vocab = ["The", "cat", "É日本", "x1", "ünter", "ZEBRA", "a" * 90, "0", "don't", "semi;colon", "\x7fdel", "😀"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 25, 60])))) for i in range(n)]
    rows += [rows[0], rows[5], rows[5], (None, rows[7][1]), (None, None), (n, None), (n + 1, ""), (n + 2, " .,; "), (n + 3, "the cat sat. " * 20_000)]
    rng.shuffle(rows)
    return rows, [rows[i][1] for i in range(5)] + [None, "the cat"]


def test_equals_brute_force(spark):
    rows, targets = some_rows(80, 1)
    assert run(spark, rows, targets, percent=40) == brute(rows, targets, 40)
    assert run(spark, rows, targets, percent=10, min_words=2, buckets=7, n=2) == brute(rows, targets, 10, 2, 7, 2)


def test_empty_tables(spark):
    rows, _ = some_rows(30, 2)
    assert run(spark, rows, [], percent=50) == brute(rows, [], 50)
    assert run(spark, [], ["x y"]) == []


@pytest.mark.parametrize("seed", range(5))
def test_hashes_of_a_block_are_crc32(seed):
    rng = random.Random(seed)
    alphabet = "aB9 .é日😀\x00\x7f\n" + "z" * 3
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 200]))) for _ in range(40)]
    array = pa.array(["skipped", *texts])[1:]
    hashes, owner = im.feature_hashes(im.words_of(array), 3)
    got = Counter(zip(owner.tolist(), hashes.tolist()))
    assert got == Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in features(t)[1])


def test_table_and_matrix_of_equal_lengths():
    assert im.TABLE[1] == 0x77073096 and len(im.TABLE) == 256
    w = im.words_of(pa.array(["one two three four " + "long" * 50]))
    state = im.extend(np.full(5, 0xFFFFFFFF, np.uint32), np.arange(5), w) ^ np.uint32(0xFFFFFFFF)
    assert state.tolist() == [zlib.crc32(x.encode()) for x in ["one", "two", "three", "four", "long" * 50]]
