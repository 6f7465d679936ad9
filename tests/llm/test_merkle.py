import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import merkle

SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_chars")]
                      + [T.StructField(c, T.StringType()) for c in ("text", "lang", "source", "leaf", "rank", "tree")])
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h("".join(part(row[f]) for f in FIELDS))


def climb(digests, arity):
    """All levels from the digests up to the one that remains."""
    levels = [digests]
    while len(levels[-1]) > 1:
        d = levels[-1]
        levels.append([h("".join(d[i:i + arity])) for i in range(0, len(d), arity)])
    return levels


def proof_of(levels, i, arity):
    out = []
    for d in levels[:-1]:
        start = i // arity * arity
        out.append(("".join(d[start:i]), "".join(d[i + 1:start + arity])))
        i //= arity
    return out


def brute(rows, arity):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    built = {}
    for lang in order:
        own = sorted(trees[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        built[lang] = own, climb([leaf_of(r) for r in own], arity)
    top = climb([built[lang][1][-1][0] for lang in order], arity)
    out = []
    for j, lang in enumerate(order):
        own, levels = built[lang]
        for i, r in enumerate(own):
            path = proof_of(levels, i, arity) + proof_of(top, j, arity)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            now = leaf_of(r | {"n_chars": r["n_chars"] + 1} if hit and r["n_chars"] is not None else r)
            for left, right in path:
                now = h(left + now + right)
            out.append((r["doc_id"], leaf_of(r), levels[-1][0], top[-1][0], h("".join(a + b for a, b in path)), now, now == top[-1][0]))
    return sorted(out, key=str)


def run(df, arity, height):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.proofs(df, FIELDS, "lang", "doc_id", {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))},
                        arity, height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.get(f.name, "clash") for f in SCHEMA) for r in rows], SCHEMA)


def some_rows(n, seed):
    rng = random.Random(seed)
    langs = ["en"] * 8 + ["", "é", "z", None, "ü" * 3]
    rows = [{"doc_id": i * 3, "n_chars": rng.choice([None, i]), "text": rng.choice([None, "", "x é日" * rng.randint(0, 9)]),
             "lang": rng.choice(langs), "source": rng.choice([None, "s"])} for i in range(n)]
    rows += [dict(rows[0])] * 3 + [rows[1] | {"text": "other"}] + [rows[2] | {"doc_id": None}] * 2
    rows.append({"doc_id": 7 * 10 ** 6, "n_chars": 5, "text": "long " * 40_000, "lang": "alone", "source": "s"})
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("arity", "height"), [(2, 10), (2, 2), (3, 2), (5, 1)])
def test_proofs_equal_brute_force(spark, arity, height):
    rows = some_rows(150, arity * height)
    assert run(frame(spark, rows), arity, height) == brute(rows, arity)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_small_trees(spark, n):
    rows = [{"doc_id": i, "n_chars": 1, "text": "t", "lang": None, "source": None} for i in range(n)]
    assert run(frame(spark, rows), 2, 2) == brute(rows, 2)


def test_empty_table(spark):
    assert run(frame(spark, []), 2, 10) == []


def test_nodes_have_the_intervals_of_their_leaves(spark):
    rows = [{"doc_id": i, "n_chars": 1, "text": str(i), "lang": "a", "source": None} for i in range(37)]
    trees, top = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", height=2)
    levels = climb([leaf_of(r) for r in rows], 2)
    want = {(lv, i << lv, min((i + 1) << lv, 37), d) for lv, ds in enumerate(levels) for i, d in enumerate(ds)}
    got = trees.nodes().select("level", "lo", "hi", "digest").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert [r.digest for r in top.roots.collect()] == [levels[-1][0]]


def test_a_changed_leaf_is_told_from_its_siblings():
    base = merkle.Level(*(merkle.np.arange(5) + i for i in (0, 1)), [h(str(i)) for i in range(5)])
    levels = merkle.levels_of(base, 3, 2)
    for i, (left, right) in enumerate(merkle.siblings(levels)):
        assert merkle.fold(base.digests[i], left, right) == levels[-1].digests[0]
        assert merkle.fold(h("no"), left, right) != levels[-1].digests[0]
