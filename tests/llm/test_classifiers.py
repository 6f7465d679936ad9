import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tessera.llm import boosting, labelled, quality, toxicity

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("y", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()),
                       T.StructField("quality", T.IntegerType())])


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    good = ["house", "river", "walks", "green", "paper", "seven", "window", "stone"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(good) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        low = i % 5 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["zorgling", "zorgpest", "idiot"])
        text = " ".join(words)
        if low:
            text = " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "clash", "clash"))
        labels.append((i, int(bad), int(not low)))
    return docs, labels


ODD = [(None, "zorgling you", "s", "y"), (10_000, None, "s", "y"), (10_001, "", "s", "y"), (3, "again", "s", "y"),
       (3, "again", "s", "y"), (10_002, "river stone " * 60_000, "s", "y")]


@pytest.mark.parametrize("label,fit", [("toxic", toxicity.fit_toxicity), ("quality", quality.fit_quality)])
def test_classifier_learns_and_scores_every_row(spark, label, fit):
    docs, labels = corpus()
    df = spark.createDataFrame(docs + ODD, DOCS)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None), (8, 0, 1)], LABELS)
    model = fit(df, lab.where("doc_id % 3 <> 0 or doc_id is null"), label)
    got = labelled.score_texts(df, model, ["doc_id", "text", "score", "y"]).collect()
    assert len(got) == len(docs) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    want = {r[0]: r[1 if label == "toxic" else 2] for r in labels}
    held = [(want[r.doc_id], r.score) for r in got if r.doc_id in want and r.doc_id % 3 == 0 and r.text != "again"]
    assert np.mean([(s >= 0.5) == y for y, s in held]) > 0.97
    assert len({r.score for r in got if r.text == "again"}) == 1
    assert {r.text for r in got if r.doc_id == 10_000} == {None}
    empties = [r.score for r in got if not r.text]
    assert empties[0] == empties[1]


@pytest.mark.parametrize("label,fit", [("toxic", toxicity.fit_toxicity), ("quality", quality.fit_quality)])
def test_without_labels_or_rows(spark, label, fit):
    df = spark.createDataFrame([(1, "a b", "s", "y")], DOCS)
    model = fit(df, spark.createDataFrame([], LABELS), label)
    assert labelled.score_texts(df, model, ["doc_id"]).collect()[0].score == pytest.approx(0, abs=1e-3)
    one = fit(df, spark.createDataFrame([(1, 1, 1)], LABELS), label)
    assert labelled.score_texts(df, one, ["doc_id"]).collect()[0].score > 0.99
    assert labelled.score_texts(df.limit(0), one, ["doc_id"]).count() == 0


def test_quality_fit_gives_its_memory_back(spark, monkeypatch):
    docs, labels = corpus(40)
    calls = []
    monkeypatch.setattr(quality, "release_memory", lambda: calls.append("released"))
    monkeypatch.setattr(quality, "train", lambda *a, f=quality.train: calls.append("trained") or f(*a))
    quality.fit_quality(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert calls == ["trained", "released"]


def test_fold_is_crc32_of_the_id_as_text(spark):
    got = {r.id: r.f for r in spark.range(50).select("id", labelled.fold("id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}


def test_class_sample_is_bounded_and_weighted(spark):
    lab = spark.createDataFrame([(i, int(i < 30), 0) for i in range(100)], LABELS)
    got = labelled.class_sample(lab, "toxic", 10).collect()
    assert sorted(r.y for r in got) == [0.0] * 10 + [1.0] * 10
    assert {r.y: r.w for r in got} == {0.0: 7.0, 1.0: 3.0}


def test_isotonic_is_the_best_monotone_fit():
    raw = np.array([0.0, 1, 2, 3, 4])
    iso = boosting.Isotonic().fit(raw, np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert np.allclose(iso(np.array([0, 1.5, 3.5])), [0, 0.5, 1])


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.BoostedTrees(n_trees=40).fit(x, y, np.ones(2000))
    assert ((trees.raw(x) > 0) == y).mean() > 0.95


def test_toxicity_features_by_hand():
    lex = toxicity.Lexicon({"zorg": 2.0}, {4: {"mean": 1.5}})
    x = toxicity.features(pa.array(["You are a ZORG!", "meanly z0rg far far far far far far you", ""], pa.large_string()), lex)
    assert x.shape == (3, toxicity.N_FEATURES) and not x[2].any()
    assert x[0, 0] == np.log1p(1) and x[0, 1] == 0.5 and x[0, 9] == np.log1p(1) and x[0, 11] == 0.25
    assert x[1, 2] == np.log1p(1) and x[1, 7] == 1 and x[1, 9] == 0 and x[1, 14] == 1 / 9


def test_quality_score_equals_plain_forward_pass():
    rng = np.random.default_rng(0)
    model = quality.QualityModel(rng.normal(size=quality.N_ROWS), 0.3)
    texts = ["", "ab ab ab cd", "x", "été été! déjà " * 50, "a\nb\tc"]
    b = quality.bags(pa.array(texts, pa.large_string()))
    for i, s in enumerate(model.score(pa.array(texts, pa.large_string()))):
        ids, n = quality.bag_of(b, i)
        z = (model.log_odds[ids] * n).sum() / n.sum() + 0.3
        assert s == pytest.approx(1 / (1 + np.exp(-z)))
    ids, n = quality.bag_of(b, 1)
    assert n[ids == quality.REPEATED] == [2]
