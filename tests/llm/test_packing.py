import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tessera.llm import packing, word_tokens
from tessera.llm.token_counts import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
TRICKY = ["", " ", "It's the cat's <|endoftext|>. <|ENDOFTEXT|>!", "ΟΔΟΣ ΟΔΟΣ, Σ", "H̱ ẖ. É É!", "a b, c",
          "\"Hello\". 'x'. we'll, they'VE!", "12.5, 3rd.", "İstanbul İ.", "́ ́a\ń", "日本, 😀!? x.y.z...",
          "<|startoftext|>,<|endoftext|>.", "don't.'t", "x" * 3000 + ".", "\x00a \x1c b\x85c", "ǅ ß. ﬁ, Å"]


def test_block_ids_equal_library():
    rng = random.Random(1)
    texts = TRICKY + [" ".join(rng.choice(TRICKY) for _ in range(5)) for _ in range(50)]
    texts += ["".join(rng.choice("aAé '.,<|>\ń0Σ") for _ in range(60)) for _ in range(300)]
    assert word_tokens.word_mode(PATH) == "cores"
    ids, starts = word_tokens.encode_block(PATH, pa.array(texts, pa.large_string()))
    tok = word_tokens._tokenizer(PATH)
    for i, t in enumerate(texts):
        assert ids[starts[i]:starts[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_other_tokenizers_encode_whole_texts():
    path = tokenizer_path("byte_bpe_50k.json")
    assert word_tokens.word_mode(path) == "texts"
    ids, starts = word_tokens.encode_block(path, pa.array(["a  b", ""], pa.large_string()))
    assert ids.tolist() == word_tokens._tokenizer(path).encode("a  b").ids and starts.tolist() == [0, len(ids), len(ids)]


def test_best_fit_matches_plain_search():
    rng = random.Random(3)
    for open_bins in (1, 3, 50):
        fit, bins, nxt = packing.BestFit(100, open_bins), {}, 0
        for _ in range(2000):
            n = rng.randint(1, 100)
            best = min((f for f in bins.values() if f >= n), default=None)
            bin_id, at = fit.place(n)
            if best is None:
                assert bin_id == nxt and at == 0
                nxt += 1
                left = 100 - n
                if left and len(bins) == open_bins:
                    full = min(bins.values())
                    if full > left:
                        continue
                    closed = fit_closed(bins, fit)
                    bins.pop(closed)
            else:
                assert bins[bin_id] == best and at == 100 - best
                left = bins.pop(bin_id) - n
            if left:
                bins[bin_id] = left
            assert len(bins) == fit.n_open <= open_bins


def fit_closed(bins, fit):
    still = {b for f in fit.free for b in f}
    return next(b for b in bins if b not in still)


def test_pack_documents_is_gapless_and_whole(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("length", T.StringType()), T.StructField("id", T.StringType())])
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["cat", "Dog,", "é日"]) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    rows += [(7, "cat"), (7, "cat"), (None, "dog"), (300, None), (301, ""), (302, "cat " * 500)]
    df = spark.createDataFrame([(*r, "clash", "x") for r in rows], schema)
    out = packing.pack_documents(df, PATH, size=64, keep_ids=True, per_partition=50).collect()
    assert len({r.sequence_id >> 36 for r in out}) > 1
    tok = word_tokens._tokenizer(PATH)
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(i, k, at, ids[at:at + 64]) for k, at in enumerate(range(0, len(ids), 64))]
    assert sorted(((r.doc_id, r.piece, r.start, list(r.ids)) for r in out), key=str) == sorted(want, key=str)
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in out)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-sum(r.length for r in out) // 64) + 8
    assert packing.pack_documents(df.limit(0), PATH).count() == 0
