import random

import pytest
from pyspark.sql import types as T

import corpus_pipeline as cp
from tessera.llm import secrets
from tessera.llm.token_counts import tokenizer_path
from tessera.llm.word_tokens import _tokenizer

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])
SECRET = 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"'


def tables(spark, folder, docs, labels):
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in docs], DOCS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return str(folder)


def corpus():
    rng = random.Random(3)
    words = ["house", "river", "walks", "green", "paper", "seven", "window", "stone", "light", "table"]

    def clean(n=60):
        return [rng.choice(words) + rng.choice(["", "s", "ed"]) for _ in range(n)]

    docs, labels = [], []
    for i in range(300):
        w = clean()
        toxic, low = i % 6 == 1, i % 6 == 2
        if toxic:
            w[5] = "zorgling"
        if low:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(not low), int(toxic)))
    base = clean(100)
    docs += [(1000, " ".join(base)), (1001, " ".join(base)), (1002, " ".join(base[:99] + ["changed"])), (1003, " ".join(base[:40] + [SECRET] + base[40:90]))]
    docs += [(None, "river stone green walks paper"), (1004, None), (1005, ""), (1006, "house river " * 5000), (1000, " ".join(base))]
    return docs, labels


def test_stages_by_their_own_rules(spark, tmp_path):
    docs, labels = corpus()
    folder = tables(spark, tmp_path, docs, labels)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = now.columns, [now.collect()]
    for name, stage in cp.STAGES:
        now = stage(spark, now, folder)
        if name != "packing":
            assert now.columns == columns
        now.write.mode("overwrite").parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        seen.append(now.collect())
    label = {i: (q, t) for i, q, t in labels}
    ids = [sorted((r.doc_id for r in rows), key=str) for rows in seen]
    assert [i for i in ids[1] if i in label] == sorted((i for i, (_, t) in label.items() if not t), key=str)
    assert [i for i in ids[2] if i in label] == sorted((i for i, (q, t) in label.items() if q and not t), key=str)
    assert set(ids[1]) >= {1000, 1001, 1002, 1003, 1006}
    kept = ids[3]
    assert kept.count(1000) == 1 and not {1001, 1002} & set(kept) and {1003, 1006} <= set(kept)
    assert set(ids[2]) - set(kept) <= {1001, 1002} and (None in kept) == (None in ids[2])
    assert sum("9b0b3c6a" in (r.text or "") for r in seen[3]) == 1
    assert not any(secrets.base_spans(r.text or "") for r in seen[4]) and sum("[SECRET]" in (r.text or "") for r in seen[4]) == 1
    texts = {(r.doc_id, r.text) for r in seen[3]}
    assert sum((r.doc_id, r.text) not in texts for r in seen[4]) == 1
    tok = _tokenizer(tokenizer_path("word_bpe_49k.json"))
    want = sorted((r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in seen[4] if r.doc_id is not None)
    got = {}
    for r in seen[5]:
        if r.doc_id is not None:
            got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert sorted(got.items()) == want


def test_run_equals_the_stages(spark, tmp_path):
    docs, labels = corpus()
    folder = tables(spark, tmp_path, docs, labels)
    rows = {(r.doc_id, r.piece, r.ids_crc32) for r in cp.run(spark, folder).collect()}
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES:
        now = stage(spark, now, folder)
    assert rows == {(r.doc_id, r.piece, r.ids_crc32) for r in now.collect()}


@pytest.mark.parametrize("docs", [[], [(None, None)]])
def test_empty_tables(spark, tmp_path, docs):
    folder = tables(spark, tmp_path, docs, [])
    assert cp.run(spark, folder).count() == 0  # without labels nothing passes for good quality


@pytest.mark.parametrize("name", ["toxicity", "quality", "secrets", "packing"])
def test_texts_worked_on_alone_come_in_small_batches(spark, tmp_path, name):
    """A task's memory goes by the batch, so these are smaller than those that are searched for shared shingles."""
    docs, labels = corpus()[:2]
    folder = tables(spark, tmp_path, docs, labels)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        dict(cp.STAGES)[name](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == cp.TEXT_ROWS < cp.BATCH_ROWS
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
