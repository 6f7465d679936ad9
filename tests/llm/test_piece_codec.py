import random
import zlib

import numpy as np
from pyspark.sql import types as T

from tessera.llm import piece_codec as pc
from tessera.llm.token_counts import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
PIECES = ["the", "The", "ungkeit", "é", "日本", "😀", " ", "  ", "   ", "\n", "\t", "0x0A", "<0x0A>", "<s>", "a", "aa", "aaa", "123", "'", "!!", "▁", "ö"]


def texts(n=400, seed=1):
    rng = random.Random(seed)
    return ["", " ", "  ", "a", " a", "a "] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_whole_texts_have_parity():
    sp = pc._reference(MODEL)
    for t, ids in zip(texts(), pc.encode_texts(MODEL, texts()), strict=True):
        if t:
            assert ids == sp.encode(t), repr(t)


def test_encode_and_decode(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("ids", T.StringType()), T.StructField("id", T.StringType())])
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (6000, "a"), (5000, "der Hund ungkeit 日本 " * 30_000)]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], schema)
    out = pc.encode_pieces(df, MODEL, keep_ids=True)
    sp = pc._reference(MODEL)
    got = sorted(((r.doc_id, list(r.ids)) for r in out.collect()), key=str)
    assert got == sorted(((i, sp.encode(t or "")) for i, t in rows), key=str)
    by_id = {r.doc_id: r for r in out.collect()}
    for i, t in rows:
        r = by_id[i]
        assert r.parity and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
        assert r.round_trip == ("▁" not in (t or ""))
    back = {r.doc_id: r.text for r in pc.decode_pieces(out, MODEL).collect()}
    for i, t in rows:
        assert back[i] == (t or "").replace("▁", " ")
    assert pc.encode_pieces(df.limit(0), MODEL).count() == 0
    assert pc.decode_pieces(out.limit(0), MODEL).count() == 0


def test_unigram_models_are_rebuilt(tmp_path):
    """A hand-made unigram model with byte fallback."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.unk_id = 1, True, 0
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = True, False
    m.normalizer_spec.name = "identity"
    for piece, score, kind in ([("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
                               + [("▁", -3, 1), ("a", -4, 1), ("b", -4.5, 1), ("ab", -5, 1), ("▁a", -5.5, 1), ("bab", -6, 1)]):
        p = m.pieces.add()
        p.piece, p.score, p.type = piece, score, kind
    path = str(tmp_path / "uni.model")
    with open(path, "wb") as f:
        f.write(m.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert not pc.has_units(path)
    for t in ["ab", "a b ab", "babab", "x ab", "é", "ab  ba"]:
        assert pc.encode_texts(path, [t]) == [sp.encode(t)], t
