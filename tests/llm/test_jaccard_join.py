import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import jaccard_join as jj
from tessera.llm.components import connected_components

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("node", T.StringType()), T.StructField("n", T.StringType())])


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n_words=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]

    def text(n):
        return [rng.choice(vocab) for _ in range(n)]

    passage, texts = text(60), []
    for _ in range(25):
        base = text(rng.randint(3, n_words * 2))
        for _ in range(rng.choice([1, 1, 2, 6])):  # chains of edits around the threshold
            texts.append(" ".join(base))
            if base:
                for _ in range(rng.randint(0, max(1, len(base) // 40))):
                    base[rng.randrange(len(base))] = rng.choice(vocab)
                if rng.random() < 0.3:
                    base = base + text(rng.randint(0, len(base) // 5))
    texts += [" ".join(text(rng.randint(5, 30)) + passage + text(rng.randint(0, 12))) for _ in range(30)]
    texts += [texts[0]] * 5 + ["", " \t", "a b c", "A B\nc", "one", "ONE", "é É"]
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(jj, "ENTRIES_PER_BUCKET", 300)
    monkeypatch.setattr(jj, "SHINGLES_PER_BLOCK", 60)
    rows = corpus(seed) + [(None, "a b c"), (None, None), (20_000, None), (20_001, "long words go on " * 8000)]
    rows += [(rows[3][0], rows[3][1]), (rows[4][0], rows[9][1])]  # a repeated row, and an id with two texts
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def test_without_helpful_groups_the_links_are_the_same(spark, monkeypatch):
    """Steps 3 and 4 find every link on their own: with bands that never agree and no frequent shingles."""
    rows = corpus(7)
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    monkeypatch.setattr(jj, "group_classes", lambda classes, docs: tuple(
        classes.sparkSession.createDataFrame([], f"{a} long, {b} long") for a, b in (("node", "group"), ("a", "b"))))
    monkeypatch.setattr(jj, "frequent_shingles", lambda described: np.zeros(0, np.uint64))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def test_needed_is_the_least_over_all_sizes():
    for n in range(1, 121):
        sizes = np.arange(-(-4 * n // 5), 5 * n // 4 + 1)
        each = -(-4 * (n + sizes) // 9) - np.maximum(-(-4 * n // 5), -(-4 * sizes // 5)) + 1
        for i in range(len(sizes)):
            least = np.minimum.accumulate(each[i:])
            got = jj._needed(np.full(len(least), n), np.full(len(least), sizes[i]), sizes[i:])
            assert (got == least).all(), (n, sizes[i])


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jj.jaccard_components(df).count() == 0
    df = spark.createDataFrame([(3, None, "c", "c"), (None, "", "c", "c")], SCHEMA)
    assert sorted(map(tuple, jj.jaccard_components(df).collect()), key=str) == [(3, 0, 3), (None, 0, None)]


def test_an_id_with_two_texts(spark):
    rng = random.Random(8)

    def words(n):
        return [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]

    def edited(text, k):
        return [*text[:k], "edit", *text[k + 1:]]

    a, b, c, e = words(100), words(100), words(100), words(80)
    near_b = [*b[:30], "o", *b[31:60], "p", *b[61:]]  # similar to b by 86 of 106 shingles
    rows = [(1, a), (2, edited(a, 50)), (5, a), (5, b), (6, near_b), (5, c), (9, e), (9, edited(e, 40)), (9, b), (9, c), (9, c), (10, ""), (10, " ")]
    rows = [(i, t if isinstance(t, str) else " ".join(t)) for i, t in rows]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)
    kept = sorted((r.doc_id, r.text) for r in jj.one_per_component(df).collect())
    first_e = min(rows[6][1], rows[7][1])
    assert kept == sorted([rows[0], rows[3], rows[5], (9, first_e), rows[11], rows[12]])


def test_links_of_a_text_under_the_id_of_a_grouped_one(spark, monkeypatch):
    """One text of an id is in a group, the other in none, and its only link is left to the matrix."""
    rng = random.Random(3)
    a, b = ([f"w{rng.randint(0, 10 ** 6)}" for _ in range(100)] for _ in range(2))
    rows = [(1, " ".join(a)), (2, " ".join([*a, "more"])), (1, " ".join(b)), (7, " ".join([*b, "more"]))]
    real = jj.group_classes

    def only_a(classes, docs):
        ids = {jj._node(jj._sets(jj.pa.array([t], jj.pa.large_string()))[0]) for _, t in rows[:2]}
        groups, links = real(classes, docs)
        return groups.where(jj.F.col("node").isin(list(ids))), links.where(jj.F.col("a").isin(list(ids)))

    monkeypatch.setattr(jj, "group_classes", only_a)
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(900):
        w = list(base)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((i + 10, " ".join(w)))
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    assert {r.component_id for r in jj.jaccard_components(df).collect()} == {10}


def test_rows_grow_with_near_copies_that_mostly_do_not_link(spark, monkeypatch):
    """Copies of one text with two words changed: few pairs link, and no step lists the pairs."""
    base = [f"w{i}" for i in range(60)]
    made = {}
    shared, blocks = jj.shared_counts, jj.in_blocks

    def counted(name, real):
        def run(*args):
            df = jj.cut_lineage(real(*args))
            made[name] = made.get(name, 0) + df.count()
            return df
        return run

    monkeypatch.setattr(jj, "shared_counts", counted("shared", shared))
    monkeypatch.setattr(jj, "in_blocks", counted("blocks", blocks))
    totals = []
    for n in (200, 400, 800):
        rng, rows = random.Random(n), []
        for i in range(n):
            w = list(base)
            for at in rng.sample(range(60), 2):
                w[at] = f"x{i}y{at}"
            rows.append((i, " ".join(w)))
        made.clear()
        df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
        if n < 800:
            assert got == brute(rows)
        totals.append(sum(made.values()))
    assert totals[1] <= 2.5 * totals[0] and totals[2] <= 2.5 * totals[1], totals


@pytest.mark.parametrize("cells", [0, 50, 1 << 24])
def test_matches_connect_what_all_links_connect(monkeypatch, cells):
    monkeypatch.setattr(jj, "DENSE_CELLS", cells)
    monkeypatch.setattr(jj, "ASKED_AT_ONCE", 7)
    rng = random.Random(cells)
    sets = {}
    for i in range(120):
        own = set(range(40)) if i % 2 else set(range(60, 90))
        for _ in range(rng.randint(0, 5)):
            own.discard(rng.choice(sorted(own)))
            own.add(rng.randint(1000, 1030))
        sets[i * 7 - 300] = jj.np.array(sorted(own), jj.np.uint64)
    names = sorted(sets)
    members, asked = names[:80], names[50:]
    links = [(a, b) for a in asked for b in members if a != b
             and 9 * len(set(sets[a].tolist()) & set(sets[b].tolist())) >= 4 * (len(sets[a]) + len(sets[b]))]
    got = jj.matches({n: sets[n] for n in members}, {n: sets[n] for n in asked})
    assert set(got) <= set(links) and len(got) < len(names)

    def parts(edges):
        label = {n: n for n in names}
        for _ in names:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert parts(got) == parts(links)


def test_large_buckets_are_counted_in_parts(monkeypatch):
    """The same numbers of shared shingles, whatever number of entries is sorted at once."""
    rng = np.random.default_rng(5)
    bucket = []
    for block in range(6):
        tokens = (rng.integers(0, 300, 400).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        info = np.array([(100 * block + i, 12, 100 * block + i, 1, 12, 12, 0) for i in range(20)], np.int64)
        bucket.append(SimpleNamespace(bucket=0, tokens=tokens.tobytes(), info=info.tobytes(),
                                      owner=(rng.integers(0, 20, 400) * 2).astype(np.uint32).tobytes()))

    def total():
        out = Counter()
        for found in jj._shared(list(bucket)):
            out.update({r[:3]: r[3] for r in found.itertuples(index=False, name=None)})
        return out

    whole, sizes, part = total(), [], jj._shared_part
    monkeypatch.setattr(jj, "ENTRIES_AT_ONCE", 300)
    monkeypatch.setattr(jj, "_shared_part", lambda t, *a: sizes.append(len(t)) or part(t, *a))
    assert total() == whole and len(whole) > 1000
    assert sum(sizes) == 2400 and max(sizes) < 600


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 90)] + [(200, 100 + rng.randrange(100)) for _ in range(60)] + [(500, 501), (7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    for a, b in links:
        if a != b:
            assert got[a] == got[b]
    assert got[90] == 0 and got[500] == 500 and 7 in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
