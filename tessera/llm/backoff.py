"""Stupid-backoff scores of documents under the counts of the whole corpus (operator 9).

The score of a document is the sum, over its words, of the logarithm of
``c(v, w) / c(v)`` for a word ``w`` after ``v`` if the pair occurs at least
``min_count`` times in the corpus, and of ``alpha * c(w) / N`` otherwise; the
first word counts ``c(w) / N``.

The counts are tables partitioned by the hash of the word.  Documents are
exploded into their distinct pairs (packed by block of documents and bucket of
``w``, so a row of numbers is a few bytes) and joined with the tables bucket by
bucket: a pair's count and ``c(w)`` meet in the bucket of ``w``; for pairs that
don't back off, ``c(v)`` follows in the bucket of ``v``.  The parts are summed
per document.

Words that make up more than a ``2 ** -14`` of the corpus and pairs above about
a ``2 ** -10`` would crowd their bucket.  There are at most ``2 ** 14`` and
``2 ** 11`` of them by arithmetic; their exact counts are broadcast, and such
words' pairs are dealt by the pair instead, such pairs scored where they are.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.text_blocks import mix64, split_words, text_blocks, word_hashes
from tessera.session import cut_lineage

ALPHA = 0.4
MIN_COUNT = 2
HOT_WORDS = 1 << 14
HOT_PAIRS = 1 << 11
WORDS_PER_BUCKET = 4_000_000  # a task holds one bucket's words and pairs
PAIRS_AT_ONCE = 1_500_000
MIN_BUCKETS = 16
BLOCK_BYTES = 12 << 20  # larger blocks share more pairs among their documents
PACKED = "bucket int, block string, a binary, b binary, c binary, d binary"


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(v * np.uint64(0x9E3779B97F4A7C15) + w)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def _words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a block's distinct words in order, which of them every word is, and where each text's words begin."""
    words = split_words(text)
    vocab, at = np.unique(mix64(word_hashes(words.vocab)), return_inverse=True)
    return vocab, at[words.ids], words.starts


def _neighbours(ids: np.ndarray, starts: np.ndarray):
    """``v``, ``w`` and the text's number of every pair of neighbouring words."""
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    same = doc[1:] == doc[:-1]
    return ids[:-1][same], ids[1:][same], doc[1:][same]


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.zeros(0, np.int64)


def _cut(bucket: np.ndarray, n: int):
    """Order by bucket, and each bucket that occurs with its stretch of that order."""
    order = np.argsort(bucket.astype(np.uint16) if n <= 1 << 16 else bucket, kind="stable")  # short numbers by radix
    cuts = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=n))))
    return [(int(b), order[cuts[b]:cuts[b + 1]]) for b in np.flatnonzero(np.diff(cuts))]


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in the sorted ``table``, and which of them are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _rows(found: list[tuple], schema: str = PACKED):
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    kinds = [types[f.split()[1]] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)


def word_counts(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Per block of documents: its words' counts by bucket, and as bucket -1 its frequent pairs."""

    def counts(block):
        vocab, ids, starts = _words(block.column("text"))
        if not len(ids):
            return None
        n = np.bincount(ids, minlength=len(vocab))
        words, n_words = vocab[n > 0], n[n > 0]
        found = [(b, "", words[k].tobytes(), n_words[k].astype(np.int64).tobytes(), b"", b"") for b, k in _cut(_bucket(words, n_buckets), n_buckets)]
        v, w, _ = _neighbours(ids, starts)
        can = n * HOT_PAIRS >= len(ids)  # a frequent pair has frequent words
        can = can[v] & can[w]
        pairs, m = np.unique(_pair(vocab[v[can]], vocab[w[can]]), return_counts=True)
        often = m * HOT_PAIRS >= len(ids)
        if often.any():
            found.append((-1, "", pairs[often].tobytes(), m[often].astype(np.int64).tobytes(), b"", b""))
        return _rows(found)

    def run(batches):
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            rows = counts(block)  # its arrays are gone before the next block is read
            if rows is not None:
                yield rows

    return docs.mapInArrow(run, PACKED)


def _merged(frames):
    """One row per bucket: its words in order and their counts over all blocks."""
    now, words, counts = None, [], []

    def out():
        w, at = np.unique(np.concatenate(words), return_inverse=True)
        c = np.bincount(at, np.concatenate(counts), len(w)).astype(np.int64)
        return pd.DataFrame({"bucket": [now], "words": [w.tobytes()], "counts": [c.tobytes()]})

    for pdf in frames:
        for r in pdf.itertuples(index=False):
            if r.bucket != now and words:
                yield out()
                words, counts = [], []
            now = r.bucket
            words.append(np.frombuffer(r.a, np.uint64))
            counts.append(np.frombuffer(r.b, np.int64))
            if len(words) > 64:
                merged = out()
                words, counts = [np.frombuffer(merged["words"][0], np.uint64)], [np.frombuffer(merged["counts"][0], np.int64)]
    if words:
        yield out()


def _hot(table: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Words of the packed ``table`` with at least ``least`` occurrences, sorted, and their counts."""

    def run(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                w, c = np.frombuffer(r.words, np.uint64), np.frombuffer(r.counts, np.int64)
                yield pd.DataFrame({"w": w[c >= least].view(np.int64), "c": c[c >= least]})

    rows = table.mapInPandas(run, "w long, c long").toPandas()
    w, c = rows["w"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)
    order = np.argsort(w)
    return w[order], c[order]


def _pair_counts(docs: DataFrame, pairs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Exact counts of a few pairs of words among the sorted ``words``."""
    if not len(pairs):
        return np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((pairs, words))

    def run(batches):
        pairs, words = shared.value
        n = np.zeros(len(pairs), np.int64)
        for block in text_blocks(batches, "text"):
            vocab, ids, starts = _words(block.column("text"))
            v, w, _ = _neighbours(ids, starts)
            can = _find(words, vocab)[1]
            can = can[v] & can[w]
            at, there = _find(pairs, _pair(vocab[v[can]], vocab[w[can]]))
            n += np.bincount(at[there], minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["i", "n"])

    out = np.zeros(len(pairs), np.int64)
    for r in docs.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r.i] = r.n
    return out


def _entries(v: np.ndarray, w: np.ndarray, doc: np.ndarray, n_words: int, n_docs: int):
    """The distinct (w, v, doc) in order, and how often each occurs."""
    v_bits, doc_bits = n_words.bit_length(), n_docs.bit_length()
    if 2 * v_bits + doc_bits < 64:
        key = (w << (v_bits + doc_bits)) | (v << doc_bits) | doc
        key.sort()
        begin = _runs(key)
        times = np.diff(np.append(begin, len(key)))
        key = key[begin]
        return (key >> doc_bits) & ((1 << v_bits) - 1), key >> (v_bits + doc_bits), key & ((1 << doc_bits) - 1), times
    order = np.lexsort((doc, v, w))
    v, w, doc = v[order], w[order], doc[order]
    begin = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (v[1:] != v[:-1]) | (doc[1:] != doc[:-1])))) if len(w) else np.zeros(0, np.int64)
    return v[begin], w[begin], doc[begin], np.diff(np.append(begin, len(w)))


def explode_pairs(docs: DataFrame, n_buckets: int, hot) -> DataFrame:
    """Packed rows by (bucket of ``w``, block): words ``w`` and how many pairs each ends; ``v`` of the pairs and how many texts have each; the texts and how often.

    A first word is a pair with ``v`` 0.  Row -1 of a block: the texts' ids, numbers of words, and their scores so far.
    """

    def packed(block):
        words, log_words, pairs, log_pairs = hot.value
        vocab, ids, starts = _words(block.column("text"))
        n = np.diff(starts)
        v, w, doc = _neighbours(ids, starts)
        score = np.zeros(len(n))
        context, known = _find(words, vocab)
        hot_both = np.flatnonzero(known[v] & known[w])
        at, there = _find(pairs, _pair(vocab[v[hot_both]], vocab[w[hot_both]]))
        often, at = hot_both[there], at[there]
        score += np.bincount(doc[often], log_pairs[at], len(n))
        score -= np.bincount(doc[often], log_words[context[v[often]]], len(n))
        first = np.flatnonzero(n)
        numbers = block.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
        nulls = np.asarray(block.column("id").is_null().to_numpy(zero_copy_only=False), np.uint8).tobytes()
        name = hashlib.blake2b(b"".join((numbers, nulls, n.astype(np.int64).tobytes(), vocab[ids].tobytes())), digest_size=8).hexdigest()
        found = [(-1, name, numbers, n.astype(np.int64).tobytes(), score.tobytes(), nulls)]
        rest = np.ones(len(w), bool)
        rest[often] = False
        # words and texts are numbers in the order of their hashes: one of 64 bits holds an entry, 0 stands for no first word
        v = np.concatenate((v[rest] + 1, np.zeros(len(first), np.int64)))
        w = np.concatenate((w[rest], ids[starts[:-1][first]]))
        doc = np.concatenate((doc[rest], first))
        del ids, rest, hot_both, often, at
        v, w, doc, times = _entries(v, w, doc, len(vocab) + 1, len(n))
        hashes = np.concatenate((np.zeros(1, np.uint64), vocab))
        bucket = _bucket(vocab, n_buckets)[w]
        common = known[w]
        bucket[common] = _bucket(_pair(hashes[v[common]], vocab[w[common]]), n_buckets)
        for b, part in _cut(bucket, n_buckets):
            pv, pw, pd_, pt = v[part], w[part], doc[part], times[part]
            pair_at = np.flatnonzero(np.concatenate(([True], (pw[1:] != pw[:-1]) | (pv[1:] != pv[:-1]))))
            word_at = _runs(pw[pair_at])
            found.append((b, name,
                          _with_counts(vocab[pw[pair_at][word_at]], np.diff(np.append(word_at, len(pair_at)))),
                          _coded(pv[pair_at], np.diff(np.append(pair_at, len(part))), hashes), _small(pd_), _small(pt)))
        return _rows(found)

    def run(batches):
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            yield packed(block)  # its arrays are gone before the next block is read

    return docs.mapInArrow(run, PACKED)


def _small(x: np.ndarray) -> bytes:
    """Numbers, each in as few bytes as the largest needs, compressed; before them that size and their length in bytes."""
    for size, kind in ((1, "<u1"), (2, "<u2"), (4, "<u4")):
        if not len(x) or x.max() < 1 << (8 * size):
            raw = x.astype(kind).tobytes()
            return bytes([size]) + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)
    raise ValueError("too large")


def _unsmall(raw: bytes) -> np.ndarray:
    plain = pa.decompress(raw[9:], int.from_bytes(raw[1:9], "little"), "zstd", asbytes=True)
    return np.frombuffer(plain, {1: "<u1", 2: "<u2", 4: "<u4"}[raw[0]])


def _with_counts(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Hashes with a number each."""
    return len(values).to_bytes(8, "little") + values.tobytes() + _small(counts)


def _split_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(raw, np.uint64, n, 8), _unsmall(raw[8 + 8 * n:])


def _coded(values: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> bytes:
    """Hashes (``values`` are their places), many of them repeated, with a number each: the distinct ones and which one each is."""
    if 8 * len(values) > len(hashes):
        here = np.zeros(len(hashes), bool)
        here[values] = True
        distinct, at = np.flatnonzero(here), (np.cumsum(here) - 1)[values]
    else:
        distinct, at = np.unique(values, return_inverse=True)
    which = _small(at)
    return (len(distinct).to_bytes(8, "little") + len(which).to_bytes(8, "little") + hashes[distinct].tobytes() + which + _small(counts))


def _decoded(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes, which one each pair has, and the pairs' numbers."""
    n, m = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    end = 16 + 8 * n
    return np.frombuffer(raw, np.uint64, n, 16), _unsmall(raw[end:end + m]), _unsmall(raw[end + m:])


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)))


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
                    min_count: int = MIN_COUNT, words_per_bucket: int = WORDS_PER_BUCKET) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words`` and ``log_score``.

    Words are runs of characters other than ASCII white space.  Null and empty
    texts have no words and score 0.  Repeated rows are counted and scored like
    any others; ids may be null.  An empty table gives no rows; other columns
    are not read.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = max(MIN_BUCKETS, math.ceil(size / 6 / words_per_bucket))
    counted = cut_lineage(word_counts(docs, n_buckets).repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
                          .mapInPandas(_merged, "bucket int, words binary, counts binary"))
    table = counted.where("bucket >= 0")
    total = table.mapInPandas(_sums, "n long").agg(F.sum("n")).first()[0] or 0
    words, n_words = _hot(table, total / HOT_WORDS)
    # local counts where a pair is frequent hold at least half of what a pair above 2 / HOT_PAIRS has
    pairs, _ = _hot(counted.where("bucket < 0"), max(total / HOT_PAIRS, 1))
    n_pairs = _pair_counts(docs, pairs, words)  # HOT_PAIRS is below HOT_WORDS: a hot pair's words are hot
    keep = n_pairs >= max(min_count, total / HOT_PAIRS)
    hot = spark.sparkContext.broadcast((words, np.log(n_words.astype(np.float64)), pairs[keep], np.log(n_pairs[keep].astype(np.float64))))

    exploded = explode_pairs(docs, n_buckets, hot)
    tables = table.select("bucket", F.lit("").alias("block"), F.col("words").alias("a"), F.col("counts").alias("b"), F.lit(b"").alias("c"), F.lit(b"").alias("d"))
    log_alpha, log_total = math.log(alpha), math.log(max(total, 1))

    def by_target(frames):
        for bucket, (counts, entries) in _buckets(frames):
            if bucket < 0:
                for r in entries:
                    yield _frame([(0, -1, r.block, r.a, r.b, r.c, r.d)])
            elif entries:
                yield from _score_targets(counts, entries, hot.value, log_alpha, log_total, min_count, n_buckets)

    scored = (exploded.union(tables).repartition(n_buckets, _spread(n_buckets)).sortWithinPartitions("bucket", F.col("block") != "")
              .mapInPandas(by_target, "kind int, " + PACKED))

    def by_context(frames):
        ready = []

        def waiting():
            for pdf in frames:
                ready.append(pdf[pdf["kind"] == 0])  # parts that are finished pass through
                yield pdf[pdf["kind"] == 1].drop(columns="kind")

        for _, (counts, entries) in _buckets(waiting()):
            while ready:
                yield ready.pop()
            yield from _score_contexts(counts, entries)
        yield from ready

    place = F.when(F.col("kind") == 1, F.col("bucket").cast("string")).otherwise(F.col("block"))
    parts = (scored.union(tables.select(F.lit(1).alias("kind"), "*")).repartition(n_buckets, place)
             .sortWithinPartitions("kind", "bucket", F.col("block") != "").mapInPandas(by_context, "kind int, " + PACKED))

    def total_of(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["bucket"] == -1]
        ids, n = np.frombuffer(head["a"].iloc[0], np.int64), np.frombuffer(head["b"].iloc[0], np.int64)
        null = np.frombuffer(head["d"].iloc[0], np.uint8).astype(bool)
        score = np.frombuffer(head["c"].iloc[0], np.float64).copy()
        for r in pdf[pdf["bucket"] != -1].itertuples(index=False):
            # blocks of equal content have one name; every one of them brought all its parts
            score[_unsmall(r.a)] += np.frombuffer(r.b, np.float64) / len(head)
        one = pd.DataFrame({"id": pd.array(ids, dtype="Int64"), "n_words": n, "log_score": score})
        one.loc[null, "id"] = pd.NA
        return pd.concat([one] * len(head), ignore_index=True)

    return (parts.groupBy("block").applyInPandas(total_of, "id long, n_words long, log_score double")
            .select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "n_words", "log_score"))


def _spread(n: int):
    """Rows with bucket -1 carry no counts to meet; they are dealt by block."""
    return F.when(F.col("bucket") >= 0, F.col("bucket").cast("string")).otherwise(F.col("block"))


def _sums(frames):
    for pdf in frames:
        yield pd.DataFrame({"n": [int(np.frombuffer(c, np.int64).sum()) for c in pdf["counts"]]})


def _frame(rows):
    return pd.DataFrame(rows, columns=["kind", "bucket", "block", "a", "b", "c", "d"])


def _summed(values: np.ndarray, docs: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct texts and the sum of their values."""
    which, at = np.unique(docs, return_inverse=True)
    return _small(which), np.bincount(at, values, len(which)).astype(np.float64).tobytes()


def _buckets(frames):
    """Every bucket with its table of counts (rows without a block come first) and its packed rows."""
    now, counts, entries = None, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), []
    for pdf in frames:
        for r in pdf.itertuples(index=False):
            if r.bucket != now and now is not None:
                yield now, (counts, entries)
                counts, entries = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), []
            now = r.bucket
            if r.block == "":
                counts = np.frombuffer(r.a, np.uint64), np.frombuffer(r.b, np.int64)
            else:
                entries.append(r)
    if now is not None:
        yield now, (counts, entries)


class _Entries:
    """A packed row: words in order, the pairs that each ends, and the texts that have each pair."""

    def __init__(self, r):
        self.block = r.block
        self.w, per_word = _split_counts(r.a)
        self.distinct, self.which, per_pair = _decoded(r.b)
        self.docs, self.times = _unsmall(r.c), _unsmall(r.d)
        self.pair_at, self.entry_at = _offsets(per_word), _offsets(per_pair)
        self.scores = np.zeros(int(self.docs.max()) + 1 if len(self.docs) else 0)
        self.texts = np.zeros(len(self.scores), bool)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # v, text, times

    def part(self, low: int, high: int):
        """``w`` and ``v`` of the pairs of the words between two places, and their texts: pair, text, times."""
        p0, p1 = self.pair_at[low], self.pair_at[high]
        e0, e1 = self.entry_at[p0], self.entry_at[p1]
        w = np.repeat(self.w[low:high], np.diff(self.pair_at[low:high + 1]))
        pair = np.repeat(np.arange(p1 - p0), np.diff(self.entry_at[p0:p1 + 1]))
        return w, self.distinct[self.which[p0:p1]], pair, self.docs[e0:e1].astype(np.int64), self.times[e0:e1].astype(np.int64)


def _score_targets(counts, entries, hot, log_alpha, log_total, min_count, n_buckets):
    """Scores of one bucket's pairs but for ``c(v)`` of contexts that aren't hot, which go to the bucket of ``v``.

    The bucket is worked off by ranges of ``w``, a bounded number of pairs at a
    time; all rows of a pair are in one range.
    """
    rows = [_Entries(r) for r in entries]
    total = sum(len(x.which) for x in rows)
    n_ranges = max(1, -(-total // PAIRS_AT_ONCE))
    cuts = [int(i * 2 ** 64 / n_ranges) for i in range(1, n_ranges)]
    places = [np.concatenate(([0], np.searchsorted(x.w, np.array(cuts, np.uint64)), [len(x.w)])).astype(np.int64) for x in rows]
    for k in range(n_ranges):
        _score_range(counts, [(x, x.part(p[k], p[k + 1])) for x, p in zip(rows, places, strict=True)], hot, log_alpha, log_total, min_count)
    out = []
    for x in rows:
        seen = np.flatnonzero(x.texts)
        out.append((0, 0, x.block, _small(seen), x.scores[seen].tobytes(), b"", b""))
    yield _frame(out)
    waiting = [(i, *u) for i, x in enumerate(rows) for u in x.waiting]
    if waiting:
        # one row for a bucket of contexts, whatever the number of blocks
        block = np.repeat([u[0] for u in waiting], [len(u[1]) for u in waiting])
        pv, pdoc, pt = (np.concatenate([u[i] for u in waiting]) for i in (1, 2, 3))
        order = np.argsort(pv, kind="stable")
        block, pv, pdoc, pt = block[order], pv[order], pdoc[order], pt[order]
        names = np.array([bytes.fromhex(x.block) for x in rows], "V8")
        for b, part in _cut(_bucket(pv, n_buckets), n_buckets):
            at = _runs(pv[part])
            of, which = np.unique(block[part], return_inverse=True)
            yield _frame([(1, b, "*", _with_counts(pv[part][at], np.diff(np.append(at, len(part)))),
                           len(of).to_bytes(8, "little") + names[of].tobytes() + _small(which), _small(pdoc[part]), _small(pt[part]))])


def _score_contexts(counts, entries):
    """Rows with the logarithms of ``c(v)`` by block and text, for one bucket of contexts; a bounded number of pairs at a time."""
    w, c = counts
    log_c = np.log(c.astype(np.float64))
    parts, size = [], 0
    for i, r in enumerate(entries):
        v, m = _split_counts(r.a)
        at, there = _find(w, v)
        if not there.all():
            raise ValueError("a word without a count")
        n = int.from_bytes(r.b[:8], "little")
        block = np.frombuffer(r.b, ">u8", n, 8).astype(np.uint64)[_unsmall(r.b[8 + 8 * n:])]
        parts.append((block, _unsmall(r.c), np.repeat(log_c[at], m) * -_unsmall(r.d).astype(np.float64)))
        size += len(block)
        if size >= PAIRS_AT_ONCE or i == len(entries) - 1:
            block, doc, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            names, of = np.unique(block, return_inverse=True)
            yield _frame([(0, 0, f"{names[b]:016x}", *_summed(value[k], doc[k]), b"", b"") for b, k in _cut(of, len(names))])
            parts, size = [], 0


def _score_range(counts, parts, hot, log_alpha, log_total, min_count):
    """Adds the scores of one range of words to its rows."""
    words, log_words, _, _ = hot
    w, v = (np.concatenate([p[i] for _, p in parts]) for i in (0, 1))
    if not len(w):
        return
    n = np.concatenate([np.bincount(p[2], p[4], len(p[0])) for _, p in parts])
    _, which = np.unique(_pair(v, w), return_inverse=True)
    count = np.bincount(which, n)[which]
    at, there = _find(words, w)
    log_w = np.zeros(len(w))
    log_w[there] = log_words[at[there]]
    at, known = _find(counts[0], w[~there])
    if not known.all():
        raise ValueError("a word without a count")
    log_w[~there] = np.log(counts[1][at].astype(np.float64))
    start = v == 0
    backs_off = ~start & (count < min_count)
    value = np.where(start, log_w - log_total, np.where(backs_off, log_alpha + log_w - log_total, np.log(np.maximum(count, 1))))
    at, hot_v = _find(words, v)
    seen = ~start & ~backs_off
    value[seen & hot_v] -= log_words[at[seen & hot_v]]
    wait = seen & ~hot_v
    begin = 0
    for x, (own_w, own_v, pair, docs, times) in parts:
        mine = slice(begin, begin + len(own_w))
        begin += len(own_w)
        if not len(pair):
            continue
        x.scores += np.bincount(docs, value[mine][pair] * times, len(x.scores))
        x.texts[docs] = True
        pick = wait[mine][pair]
        if pick.any():
            x.waiting.append((own_v[pair][pick], docs[pick], times[pick]))
