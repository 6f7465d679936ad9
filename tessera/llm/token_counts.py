"""Token counts of whole texts by a SentencePiece model (operator 2).

A text up to ``chunk_chars`` code points is encoded in one call.  A longer one
is encoded as overlapping chunks with offsets, so that memory and time per call
stay bounded, and the chunk encodings are spliced:

* A greedy merge encoder (best pair first, leftmost on ties) gives a sequence
  in which any two neighbouring tokens, encoded alone, come out as themselves;
  and a sequence with that property is the encoding of its text, because the
  first merge across a token border would also happen in the two tokens alone.
* So if two encodings of overlapping stretches share one token (same span,
  same id), the first one up to that token followed by the second one from it
  on is the encoding of the joint stretch: every neighbouring pair in it occurs
  in one of the two.
* If an overlap holds no shared token, the chunk is encoded anew with an
  overlap twice as wide, at the worst back to the last spliced border.

The splice needs an identity normaliser and a BPE model; for any other model
the text is encoded in one call.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text_blocks import text_blocks

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 128
MAX_TOKENS = 4096


@lru_cache(maxsize=4)
def _processor(model_path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path)


@lru_cache(maxsize=4)
def _can_splice(model_path: str) -> bool:
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(model_path, "rb") as f:
        proto.ParseFromString(f.read())
    n = proto.normalizer_spec
    return (proto.trainer_spec.model_type == pb.TrainerSpec.BPE and not n.precompiled_charsmap
            and not n.remove_extra_whitespaces and not n.normalization_rule_tsv
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == pb.ModelProto.SentencePiece.UNUSED for p in proto.pieces))


def _tokens(sp, text: str, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and spans (code points of the whole text) of ``text``, which begins at ``at``."""
    out = sp.encode(text, return_type="offset_mapping")
    spans = np.asarray(out["offsets"], dtype=np.int64).reshape(-1, 2) + at
    return np.asarray(out["ids"], dtype=np.int64), spans[:, 0], spans[:, 1]


def encode_spliced(sp, text: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> np.ndarray:
    """Ids of ``text`` by overlapping chunks; equal to ``sp.encode(text)``."""
    parts: list[np.ndarray] = []  # finished stretches; ``ids[first:]`` follows them
    end = min(len(text), chunk_chars)
    ids, starts, ends = _tokens(sp, text[:end], 0)
    first = 0
    while end < len(text):
        overlap, next_end = max(1, overlap_chars), min(len(text), end + chunk_chars)
        while True:
            begin = max(0, end - overlap)
            ids2, starts2, ends2 = _tokens(sp, text[begin:next_end], begin)
            if begin == 0:  # widened to the whole text so far
                parts, first, shared = [], 0, (0, 0)
                break
            shared = _shared_token(ids, starts, ends, first, ids2, starts2, ends2, begin)
            if shared is not None:
                parts.append(ids[first:shared[0]])
                first = shared[1]
                break
            overlap *= 2
        ids, starts, ends, end = ids2, starts2, ends2, next_end
    return np.concatenate([*parts, ids[first:]])


def _shared_token(ids, starts, ends, first, ids2, starts2, ends2, begin):
    """Positions of the first token with the same span and id in both encodings.

    The second encoding begins with a marker that the text doesn't have, so its
    tokens at ``begin`` don't count.
    """
    low = first + int(np.searchsorted(starts[first:], begin, side="right"))
    mine = {(int(starts[i]), int(ends[i]), int(ids[i])): i for i in range(low, len(ids)) if ends[i] > starts[i]}
    for j in range(int(np.searchsorted(starts2, begin, side="right")), len(ids2)):
        if starts2[j] >= ends[-1]:
            return None
        i = mine.get((int(starts2[j]), int(ends2[j]), int(ids2[j])))
        if i is not None:
            return i, j
    return None


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 limit: int = MAX_TOKENS) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    No begin or end tokens.  Null and empty texts have 0 bytes and 0 tokens;
    ids may be null or repeat and are passed through; other columns are not read.
    ``model_path`` is the model's place on every executor.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        sp = _processor(model_path)
        splice = _can_splice(model_path)
        for block in text_blocks(batches, "text"):
            text = block.column("text")
            texts = text.to_pylist()
            n_tokens = np.zeros(len(texts), np.int64)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars or not splice]
            for i, ids in zip(short, sp.encode([texts[i] for i in short], num_threads=1), strict=True):
                n_tokens[i] = len(ids)
            for i in set(range(len(texts))).difference(short):
                n_tokens[i] = len(encode_spliced(sp, texts[i], chunk_chars, overlap_chars))
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pc.binary_length(text).cast(pa.int64()), pa.array(n_tokens),
                 pa.array(n_tokens > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("id", id_col))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; ``TESSERA_TOKENIZERS`` names another folder."""
    folder = os.environ.get("TESSERA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
