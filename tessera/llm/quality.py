"""Quality scores of whole texts by supervised subword embeddings (operator 5).

Every text is a bag of hashed features: its words, the character n-grams of
``<word>``, pairs of neighbouring words (a word that repeats its predecessor is
one feature for all words) and the magnitude of its number of words.  Each
feature's bucket has a learnt vector; the vectors' mean goes through a softmax.
Vectors and softmax are trained together by stochastic gradient descent in
numpy, on at most ``MAX_PER_CLASS`` labelled rows of each class (a documented
bound; rows are picked by a hash of their id and weighted to the class sizes).

For scoring, the softmax is applied to every bucket's vector once: as it is
linear up to the last step, the mean of these numbers is the text's log odds.
Scoring is a map over whole texts: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.labelled import class_sample
from tessera.llm.text_blocks import mix64, release_memory, split_words, sums_by_text, text_blocks, word_hashes
from tessera.session import cut_lineage

MAX_PER_CLASS = 2500
BUCKETS = 1 << 17
DIMENSIONS = 16
CHAR_NGRAMS = (3, 4)
EPOCHS = 8
RATE = 4.0
N_SIZES = 40
REPEATED = BUCKETS  # the word before is the same
FIRST_SIZE = BUCKETS + 1
N_ROWS = BUCKETS + 1 + N_SIZES


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.int64) & (BUCKETS - 1)


@dataclass
class Bags:
    """Features of a block of texts: of every distinct word, of every neighbouring pair and of every text."""

    ids: np.ndarray  # words, as numbers of distinct words
    starts: np.ndarray
    grams: np.ndarray  # buckets of the distinct words' own features, word by word
    gram_starts: np.ndarray
    pairs: np.ndarray  # bucket of every word with its predecessor, -1 for a text's first word
    sizes: np.ndarray  # bucket of every text's number of words


def bags(text: pa.Array) -> Bags:
    words = split_words(text)
    vocab, ids, starts = words.vocab, words.ids.astype(np.int64), words.starts
    h = word_hashes(vocab)
    n_vocab = len(vocab)
    # code points of <word><word>...; an n-gram counts if it lies within one word
    points = np.frombuffer("".join(f"<{w}>" for w in vocab.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    length = pc.utf8_length(vocab).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    owner = np.repeat(np.arange(n_vocab), length)
    found, owners = [_buckets(mix64(h))], [np.arange(n_vocab)]
    for n in CHAR_NGRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        x = np.full(m, n, np.uint64)
        for i in range(n):
            x = x * np.uint64(0x100000001B3) + points[i:i + m]
        inside = owner[:m] == owner[n - 1:]
        found.append(_buckets(mix64(x[inside])))
        owners.append(owner[:m][inside])
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    gram_starts = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=n_vocab))))
    pairs = np.full(len(ids), -1, np.int64)
    if len(ids) > 1:
        own = h[ids]
        pairs[1:] = np.where(ids[1:] == ids[:-1], REPEATED,
                             _buckets(mix64(own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:])))
        pairs[starts[:-1][starts[:-1] < len(ids)]] = -1
    sizes = FIRST_SIZE + np.minimum(np.log2(1.0 + np.diff(starts)).astype(np.int64), N_SIZES - 1)
    return Bags(ids, starts, found[order], gram_starts, pairs, sizes)


def bag_of(b: Bags, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of text ``i`` and how often each occurs."""
    lo, hi = b.starts[i], b.starts[i + 1]
    ids, n = np.unique(b.ids[lo:hi], return_counts=True)
    size = b.gram_starts[ids + 1] - b.gram_starts[ids]
    ends = np.cumsum(size)
    own = b.grams[np.arange(ends[-1] if len(ends) else 0) + np.repeat(b.gram_starts[ids] - (ends - size), size)]
    pairs = b.pairs[lo:hi]
    buckets = np.concatenate((own, pairs[pairs >= 0], b.sizes[i:i + 1]))
    weight = np.concatenate((np.repeat(n, size), np.ones(len(buckets) - len(own), np.int64)))
    buckets, at = np.unique(buckets, return_inverse=True)
    return buckets.astype(np.int32), np.bincount(at, weight).astype(np.float32)


@dataclass
class QualityModel:
    """Log odds that every bucket adds to the mean, and the constant part."""

    log_odds: np.ndarray
    bias: float

    def score(self, text: pa.Array) -> np.ndarray:
        b = bags(text)
        table = np.append(self.log_odds, 0.0)  # -1: nothing
        grams = np.concatenate(([0.0], np.cumsum(table[b.grams])))
        per_word = grams[b.gram_starts[1:]] - grams[b.gram_starts[:-1]]
        n_word = np.diff(b.gram_starts).astype(np.float64)
        total = sums_by_text(per_word[b.ids] + table[b.pairs], b.starts) + table[b.sizes]
        n = sums_by_text(n_word[b.ids] + (b.pairs >= 0), b.starts) + 1
        return 1.0 / (1.0 + np.exp(-np.clip(total / n + self.bias, -30, 30)))


def train(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, w: np.ndarray, epochs: int = EPOCHS,
          rate: float = RATE, dimensions: int = DIMENSIONS, seed: int = 1) -> QualityModel:
    """Stochastic gradient descent, one text at a time, with a rate that falls to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dimensions, 1.0 / dimensions, (N_ROWS, dimensions)).astype(np.float32)
    out = np.zeros((2, dimensions), np.float32)
    bias = np.zeros(2, np.float32)
    share = float((y * w).sum() / w.sum())
    bias[1] = np.log(share / (1 - share))
    examples = [(ids, (n / n.sum()).astype(np.float32)) for ids, n in examples]
    w = w / w.mean()
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ids, part = examples[i]
            own = vectors[ids]
            mean = part @ own
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(y[i])] -= 1.0
            step = rate * min(float(w[i]), 4.0) * (1 - done / steps)
            back = p @ out
            out -= 0.1 * step * np.outer(p, mean)
            bias -= 0.01 * step * p
            # a feature's share of the mean is tiny: scale its step to the number of distinct features
            vectors[ids] = own - np.outer(part * (step * len(ids) ** 0.5), back)
            done += 1
    return QualityModel((vectors @ (out[1] - out[0])).astype(np.float64), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", max_per_class: int = MAX_PER_CLASS) -> QualityModel:
    """Fit on at most ``max_per_class`` labelled rows of each class.

    Without labelled rows of both classes every text gets the share of positives (0 without any).
    """
    picked = class_sample(labels, label_col, max_per_class, id_col)

    def run(batches):
        for block in text_blocks(batches, "text"):
            b = bags(block.column("text"))
            found = [bag_of(b, i) for i in range(block.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [block.column("id").cast(pa.string()), block.column("y"), block.column("w"),
                 pa.array([x[0].tobytes() for x in found], pa.binary()),
                 pa.array([x[1].tobytes() for x in found], pa.binary())], names=["id", "y", "w", "ids", "n"])

    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(picked), "id")  # at most two classes of max_per_class ids
            .mapInArrow(run, "id string, y double, w double, ids binary, n binary"))
    rows = cut_lineage(rows)  # read partition by partition: the driver's JVM never holds all bags at once
    rows = pd.DataFrame([tuple(r) for r in rows.toLocalIterator()], columns=["id", "y", "w", "ids", "n"])
    y, w = rows["y"].to_numpy(float), rows["w"].to_numpy(float)
    if len(set(y)) < 2:
        share = np.clip(float(y.mean()) if len(y) else 0.0, 1e-9, 1 - 1e-9)
        return QualityModel(np.zeros(N_ROWS), float(np.log(share / (1 - share))))
    order = np.lexsort((rows["ids"].to_numpy(), rows["id"].to_numpy()))  # the same order whichever task came first
    examples = [(np.frombuffer(rows["ids"][i], np.int32), np.frombuffer(rows["n"][i], np.float32)) for i in order]
    model = train(examples, y[order], w[order])
    del rows, examples
    release_memory()  # the driver goes on with the model alone
    return model
