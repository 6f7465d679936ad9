import random

import pytest
from pyspark.sql import types as T

from tessera.llm import token_counts as tc

MODEL = tc.tokenizer_path("piece_bpe_32k.model")
ALPHABETS = ["ab ", "aaaa", "the cat  \n\t", "日本語 é ", "😀x ", "0123456789", "▁ a", "ungkeit "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_spliced_ids_equal_whole_encoding(alphabet):
    sp = tc._processor(MODEL)
    rng = random.Random(alphabet)
    for _ in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200)))
        for chunk, overlap in ((7, 1), (16, 4), (50, 3), (300, 8)):
            assert tc.encode_spliced(sp, text, chunk, overlap).tolist() == sp.encode(text), (text, chunk, overlap)


def test_counts_rows_nulls_and_long_texts(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("n_tokens", T.StringType()), T.StructField("id", T.LongType())])
    long = "Der Hund <s> und </s> die Katze é日 😀 " * 4000
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, long), (4, "x" * 70_000)]
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], schema)
    sp = tc._processor(MODEL)
    got = sorted((tuple(r) for r in tc.count_tokens(df, MODEL, chunk_chars=1000, overlap_chars=8).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096)
                   for i, t in rows), key=str)
    assert got == want
    assert tc.count_tokens(df.limit(0), MODEL).count() == 0
