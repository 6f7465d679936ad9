"""Target-distribution importance resampling over hashed n-grams (operator 11).

Features are runs of 1 to ``n`` words; a feature's bucket is the crc32 of its bytes
modulo ``buckets``.  A bucket's gain is the log ratio of its smoothed share in the
target texts and in all documents; a document's weight is the sum of gains over
its features, and a Gumbel draw by its id makes a sample of the highest scores.

The crc32 of a block's distinct features are computed by length-bucketed matrices:
the distinct byte strings of equal length are the rows of a two-dimensional uint8
array, every column of which moves all their CRCs on by a byte, and the results are
scattered back to the features.  A feature of several words begins with a shorter
one, so its row holds only the bytes after that, and starts from its CRC.

Words are runs of ASCII letters (A-Z in lower case), digits and any non-ASCII code
points.  Defined results: a null text has no words; a text without words has weight 0
and no rank; rows with the same id have the same draw and get different ranks; rows
without an id have no score, aren't drawn and don't count among the documents that
could be.  Texts are read whole.  Only the id and the text are read.  An empty table
gives no rows; without target texts all shares of the target are equal.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.text_blocks import text_blocks
from tessera.operators.positions import row_numbers
from tessera.session import cut_lineage

BUCKETS = 10_000
#: Fixed value: the reversed polynomial of crc32.
POLYNOMIAL = 0xEDB88320


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(POLYNOMIAL), c >> 1)
    return c.astype(np.uint32)


TABLE = _table()
_FOLD = np.arange(256, dtype=np.uint8)  # A-Z to lower case
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, bool)  # of lower-cased bytes
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


@dataclass
class Words:
    """Words of a block of texts: ``ids`` number the distinct words, whose bytes are ``flat[starts[i]:starts[i + 1]]``."""

    ids: np.ndarray
    text: np.ndarray
    flat: np.ndarray
    starts: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """Lower-cased words of every text, in order; ``text`` is the number of the text that a word is in."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = _FOLD[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
    ends_of_text = offsets[1:] - offsets[0]
    inside = _IS_WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = ends_of_text[ends_of_text < len(raw)]
    first[edges] = inside[edges]
    begin = np.flatnonzero(first)
    kept = np.concatenate(([0], np.cumsum(inside)))
    at = np.append(kept[begin], kept[-1])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw[inside])])
    coded = words.dictionary_encode()
    vocab = coded.dictionary
    starts = np.frombuffer(vocab.buffers()[1], np.int64)[vocab.offset:vocab.offset + len(vocab) + 1] if len(vocab) else np.zeros(1, np.int64)
    flat = np.frombuffer(vocab.buffers()[2], np.uint8) if len(vocab) else np.zeros(0, np.uint8)
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(ends_of_text, begin, side="right"), flat, starts)


def extend(state: np.ndarray, last: np.ndarray, w: Words) -> np.ndarray:
    """CRC states moved on by the bytes of the words ``last``, by matrices of words of equal length."""
    out = state.copy()
    length = np.diff(w.starts)[last] if len(last) else np.zeros(0, np.int64)
    order = np.argsort(length, kind="stable")
    sizes, cuts = np.unique(length[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, cuts[1:])):
        begin = w.starts[last[rows]]
        if size > 64:  # few and long: no matrix of them at once
            columns = (w.flat[begin + k] for k in range(size))
        else:
            columns = w.flat[begin[:, None] + np.arange(size)].T
        crc = out[rows]
        for column in columns:
            crc = TABLE[(crc ^ column) & np.uint32(255)] ^ crc >> np.uint32(8)
        out[rows] = crc
    return out


def feature_hashes(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of every run of 1 to ``n`` consecutive words of a text, and the text's number."""
    hashes, owners = [], []
    size = len(w.starts) - 1
    gram = w.ids  # number of the run of k words that ends at a word
    state = extend(np.full(size, 0xFFFFFFFF, np.uint32), np.arange(size), w)  # by distinct run
    for k in range(1, n + 1):
        if k > 1:
            follows = w.text[k - 1:] == w.text[:len(w.text) - k + 1]
            before = gram if k == 2 else gram[:-1]
            pairs = before[:len(follows)] * size + w.ids[k - 1:]
            distinct, number = np.unique(pairs[follows], return_inverse=True)
            space = state[distinct // size]
            space = TABLE[(space ^ np.uint32(32)) & np.uint32(255)] ^ space >> np.uint32(8)
            state = extend(space, distinct % size, w)
            gram = np.zeros(len(follows), np.int64)
            gram[follows] = number
            hashes.append((state ^ np.uint32(0xFFFFFFFF))[number])
            owners.append(w.text[k - 1:][follows])
        else:
            hashes.append((state ^ np.uint32(0xFFFFFFFF))[gram])
            owners.append(w.text)
    return np.concatenate(hashes), np.concatenate(owners)


def bucket_counts(df: DataFrame, text_col: str, n: int, buckets: int) -> dict[int, int]:
    """Features of all texts by bucket: each task counts its own, ``buckets`` numbers in all reach the driver."""
    texts = df.select(F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for block in text_blocks(batches):
            hashes, _ = feature_hashes(words_of(block.column("text")), n)
            total += np.bincount(hashes % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "c"])

    counted = texts.mapInArrow(run, "bucket long, c long").groupBy("bucket").agg(F.sum("c").alias("c"))
    return {r.bucket: r.c for r in counted.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of every bucket, each count with one added."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * s_all / ((source.get(b, 0) + 1) * t_all)))
                     for b in range(buckets)], np.int64)


def weigh(df: DataFrame, id_col: str, text_col: str, gain: np.ndarray, n: int) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    schema = T.StructType([rows.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])

    def run(batches):
        by_bucket = shared.value
        for block in text_blocks(batches):
            size = block.num_rows
            w = words_of(block.column("text"))
            hashes, owner = feature_hashes(w, n)
            weight = np.zeros(size, np.int64)
            np.add.at(weight, owner, by_bucket[hashes % np.uint32(len(by_bucket))])
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(np.bincount(w.text, minlength=size), pa.int64()),
                 pa.array(np.bincount(owner, minlength=size), pa.int64()), pa.array(weight)], names=schema.names)

    return rows.mapInArrow(run, schema)


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", n: int = 3,
             buckets: int = BUCKETS, min_words: int = 20, percent: int = 5, seed: int = 42) -> DataFrame:
    """One row per input row: ``id_col``, ``n_features``, ``weight``, ``score`` and ``rank`` (from 1, null if not drawn).

    Of the documents with at least ``min_words`` words the ``percent`` hundredths (rounded
    down) with the highest scores are drawn, ties to the smaller id.
    """
    gain = gains(bucket_counts(df, text_col, n, buckets), bucket_counts(target, target_col, n, buckets), buckets)
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(-1000.0 * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    scored = cut_lineage(weigh(df, id_col, text_col, gain, n).withColumn("score", F.col("weight") + gumbel)
                         .withColumn("eligible", (F.col("n_words") >= min_words) & F.col("id").isNotNull()))
    drawn = percent * scored.where("eligible").count() // 100
    ranked = row_numbers(scored, [F.desc("eligible"), F.desc_nulls_last("score"), "id"], "rank")
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score",
                         F.when(F.col("eligible") & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))
