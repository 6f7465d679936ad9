"""Operators and stages on inputs whose other columns have internal names, a map among them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import jaccard_join, labelled, secrets

NAMES = ["text to score", "text to scan", "no text", "row", "id", "node", "known", "of", "goes", "label", "own", "n", "place", "key"]


@pytest.fixture
def frame(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *(T.StructField(c, T.StringType()) for c in NAMES), T.StructField("a map", T.MapType(T.StringType(), T.LongType()))])
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words), (2, words), (1, words), (3, "password = hunter2hunter2"), (None, None), (4, "")]
    return spark.createDataFrame([(*r, *["clash"] * len(NAMES), {"x": 1}) for r in rows], schema)


def test_scores(frame):
    class Length:
        def score(self, texts):
            return [float(len(t.as_py())) for t in texts]

    got = labelled.score_texts(frame, Length(), frame.columns).collect()
    assert sorted(r.score for r in got) == sorted(len(r.text or "") for r in got)


def test_secrets_and_marked_texts(frame):
    model = secrets.fit_secrets(frame.limit(0))
    got = secrets.scan_secrets(frame, model, frame.columns, mark="[SECRET]").select(*frame.columns, "n_assign").collect()
    assert len(got) == 6 and sum(r.n_assign for r in got) == 1
    assert {r.text for r in got if r.doc_id == 3} == {"[SECRET]"} or any("[SECRET]" in (r.text or "") for r in got)


def test_one_per_component(frame):
    got = jaccard_join.one_per_component(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id for r in got.select(F.col("doc_id")).collect()), key=str) == [1, 3, 4, None]
