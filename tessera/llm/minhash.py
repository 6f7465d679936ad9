"""MinHash fingerprints over word shingles (operator 6).

A text's shingles are its runs of five lower-cased words (fewer words: the
whole sequence; no words: none).  ``PERMUTATIONS`` universal hash functions,
evaluated in numpy over a block's shingles at once, give the smallest value of
each; 16 bits of each are the fingerprint, and the share of equal ones
estimates the Jaccard similarity of two shingle sets.

``near_duplicates`` joins bands of the signatures in Spark and verifies the
Jaccard similarity of every pair that shares one on the whole shingle sets.
``edited_fingerprints`` compares every text with an edited version of itself
and with the next one in id order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.text_blocks import mix64, split_words, text_blocks, window_hashes, word_hashes
from tessera.session import cut_lineage

SHINGLE_WORDS = 5
PERMUTATIONS = 128
BANDS = 32
THRESHOLD = 0.8
ROWS_PER_RANGE = 8_000
CLASSES_PER_BLOCK = 512
SETS_PER_BLOCK = 256
PAIRS_AT_ONCE = 1 << 18
_CHUNK = 1 << 18

_rng = np.random.default_rng(20)
_A = _rng.integers(0, 2 ** 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2 ** 32, PERMUTATIONS, dtype=np.uint32)


def shingles(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of a block of texts, and where each text's begin (one more entry than texts)."""
    words = split_words(text, "ascii")
    h = word_hashes(words.vocab)[words.ids]
    n = np.diff(words.starts)
    windows = window_hashes(h, SHINGLE_WORDS)
    if len(windows):  # windows that lie within one text
        doc = words.text_of()
        windows = windows[doc[:len(windows)] == doc[SHINGLE_WORDS - 1:]]
    count = np.maximum(n - SHINGLE_WORDS + 1, 0)
    short = np.flatnonzero((n > 0) & (n < SHINGLE_WORDS))
    starts = np.concatenate(([0], np.cumsum(count)))
    if len(short):
        own = np.array([mix64(window_hashes(h[words.starts[i]:words.starts[i + 1]], int(n[i])))[0] for i in short],
                       np.uint64)
        windows = np.insert(windows, starts[short], own)
        count[short] = 1
        starts = np.concatenate(([0], np.cumsum(count)))
    return windows, starts


def signatures(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (texts x ``PERMUTATIONS``) and numbers of shingles; a text without shingles has the largest value everywhere."""
    x, starts = shingles(text)
    n = np.diff(starts)
    out = np.full((PERMUTATIONS, len(n)), 0xFFFFFFFF, np.uint32)
    x = (x >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(n)
    ends = starts[1:][full]
    at = 0
    while at < len(full):  # whole texts, about _CHUNK shingles at a time
        to = max(at + 1, int(np.searchsorted(ends, starts[full[at]] + _CHUNK, side="right")))
        begin = starts[full[at]]
        part, cuts = x[begin:ends[to - 1]], starts[full[at:to]] - begin
        for p in range(PERMUTATIONS):
            out[p, full[at:to]] = np.minimum.reduceat(part * _A[p] + _B[p], cuts)
        at = to
    return out.T, n


def encoded(signature: np.ndarray, n: np.ndarray) -> list[str]:
    """Fingerprints as hexadecimal digits; empty for texts without shingles."""
    parts = (signature >> np.uint32(16)).astype(">u2")
    return [parts[i].tobytes().hex() if n[i] else "" for i in range(len(n))]


def likeness(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Share of equal parts of two fingerprints; 1 for two texts without shingles, 0 for one."""
    same = ((a >> np.uint32(16)) == (b >> np.uint32(16))).mean(axis=1)
    return np.where((n_a > 0) & (n_b > 0), same, ((n_a == 0) & (n_b == 0)).astype(np.float64))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per input row, in comparison with the next one by descending id (after the last: the first).

    Columns: ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.  Null texts count as
    empty; rows with equal ids follow each other by text; rows without an id
    come last.  The only row of a table is its own next one; an empty table
    gives no rows.

    Ids are dealt into ranges first (ids alone); the largest id of every range
    is also sent to the range before it.  So the texts are shuffled once, and a
    task reads its range in order and holds one block of it.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = docs.select("id").where(F.col("id").isNotNull())
    n_ranges = max(1, -(-docs.count() // rows_per_range))
    # one row per range comes to the driver: its largest id
    heads = [r.head for r in ids.repartitionByRange(n_ranges, F.desc("id")).groupBy(F.spark_partition_id().alias("r"))
             .agg(F.max("id").alias("head")).select("head").collect()]
    heads = np.sort(np.array(heads))  # ascending; range k holds ids up to its head, range 0 the smallest
    n = max(len(heads), 1)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def targets(values: pd.Series) -> pd.Series:
        own = np.zeros(len(values), np.int64)
        present = values.notna().to_numpy()
        own[present] = np.searchsorted(heads, values[present].to_numpy().astype(heads.dtype))
        is_head = np.zeros(len(values), bool)
        is_head[present] = heads[own[present]] == values[present].to_numpy().astype(heads.dtype)
        # ``n`` more marks a row that is only there to be the next one of another range
        return pd.Series([[k, (k + 1) % n + n] if h else [k] for k, h in zip(own.tolist(), is_head.tolist(), strict=True)])

    if not len(heads):  # no ids: one range, whose first row is its next range's head too
        dealt = docs.withColumn("range", F.lit(0))
    else:
        dealt = docs.withColumn("range", F.explode(targets("id")))
    dealt = (dealt.select("id", "text", (F.col("range") % n).alias("range"), (F.col("range") >= n).alias("extra"))
             .repartitionById(n, F.col("range"))
             .sortWithinPartitions("range", "extra", F.desc_nulls_last("id"), "text"))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n_chars", T.LongType()),
                           T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
                           T.StructField("edited_fingerprint", T.StringType()),
                           T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    wraps = not len(heads)

    def run(batches):
        pending = first = None
        for block in text_blocks(batches, "text"):
            rows = pa.Table.from_batches([block.select(["id", "text", "extra"])])
            if first is None and wraps:
                first = rows.slice(0, 1)
            if pending is not None:
                rows = pa.concat_tables([pending, rows])
            yield from _compared(rows)
            pending = rows.slice(rows.num_rows - 1)
        if wraps and pending is not None:
            yield from _compared(pa.concat_tables([pending, first]))

    return dealt.select("id", "text", "extra").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _compared(rows: pa.Table):
    """Every row of ``rows`` but the last, compared with the row after it; rows marked ``extra`` are left out."""
    rows = rows.combine_chunks()
    if rows.num_rows < 2:
        return
    text = rows.column("text").chunk(0)
    own, n = signatures(text)
    texts = text.to_pylist()
    emit = np.flatnonzero(~np.asarray(rows.column("extra").to_numpy(), bool)[:-1])
    changed = [edited(texts[i], texts[i + 1]) for i in emit]
    other, n_other = signatures(pa.array(changed, pa.large_string()))
    yield pa.RecordBatch.from_arrays([
        rows.column("id").chunk(0).take(pa.array(emit)), pa.array([len(texts[i]) for i in emit], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(encoded(own[emit], n[emit]), pa.string()), pa.array(encoded(other, n_other), pa.string()),
        pa.array(likeness(own[emit], n[emit], other, n_other)),
        pa.array(likeness(own[emit], n[emit], own[emit + 1], n[emit + 1])),
    ], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    bands: int = BANDS) -> DataFrame:
    """Verified links ``id_a`` < ``id_b`` with their ``jaccard``, and every row's class of equal shingle sets.

    Returns one row per link between class representatives (the smallest id of
    the class) and, with a null ``jaccard``, one per row that is not its own
    class's representative (``id_a``: the representative).  Rows without
    shingles or ids have no link.  An id with different texts is in the class of
    each; an id is not linked with itself.

    Every pair of classes that share a band value is verified, once, whichever
    other links the two have.  So the links of a group of ``n`` near copies grow
    with ``n * n``; ``jaccard_join`` gives its component without listing them.  A
    pair at similarity ``s`` shares no band with probability
    ``(1 - s ** rows) ** bands`` for independent hash values: 5e-8 at 0.8 with 32
    bands of 4 rows.  ``jaccard_join`` leaves nothing to chance.

    A crowded band value is dealt as pairs of blocks of its classes, and the pairs
    to verify as pairs of blocks too, so no task holds a whole group.
    """
    from tessera.llm.jaccard_join import _node, texts_of  # which uses the shingles above

    docs = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def sets_of(text):
        x, starts = shingles(text)
        return [np.unique(x[starts[i]:starts[i + 1]]) for i in range(len(starts) - 1)]

    def sign(batches):
        for block in text_blocks(batches, "text"):
            text = block.column("text")
            sets, (sig, n) = sets_of(text), signatures(text)
            values = band_values(sig, bands)
            full = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([
                block.column("id").take(pa.array(full)), pa.array([_node(sets[i]) for i in full], pa.int64()),
                pa.array([len(sets[i]) for i in full], pa.int64()), pa.array([values[i].tobytes() for i in full], pa.binary())],
                names=["id", "node", "n", "bands"])

    signed = cut_lineage(docs.mapInArrow(sign, "id long, node long, n long, bands binary"))
    classes = cut_lineage(signed.groupBy("node").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.min("bands").alias("bands")))
    names = classes.select("node", "rep")
    members = signed.select("id", "node").join(names, "node").where("id <> rep")

    pairs = cut_lineage(band_pairs(classes, bands, threshold))
    concerned = cut_lineage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    n_blocks = max(1, -(-concerned.count() // SETS_PER_BLOCK))

    def verified_sets(batches):
        for block in text_blocks(batches, "text"):
            for node, s in zip(block.column("node").to_pylist(), sets_of(block.column("text")), strict=True):
                if _node(s) == node:  # an id may stand for several texts
                    yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([s.tobytes()], pa.binary())], names=["node", "shingles"])

    sets = (texts_of(docs, concerned.join(names, "node").select("node", F.col("rep").alias("id")))
            .mapInArrow(verified_sets, "node long, shingles binary").dropDuplicates(["node"]))

    def place(column):
        return F.pmod(F.xxhash64(column, F.lit(3)), F.lit(n_blocks)).cast("int")

    placed = pairs.select("a", "b", F.least(place("a"), place("b")).alias("i"), F.greatest(place("a"), place("b")).alias("j"))
    needed = placed.select(F.col("a").alias("node"), "i", "j").union(placed.select("b", "i", "j")).distinct()
    rows = needed.join(sets, "node").select("i", "j", F.lit(False).alias("pair"), F.col("node").alias("a"), F.lit(0).cast("long").alias("b"), "shingles").union(
        placed.select("i", "j", F.lit(True), "a", "b", F.lit(None).cast("binary")))

    def verify(frames):
        for own, wanted in _by_block(frames):
            found = [(a, b, x) for a, b, x in similarities(own, wanted) if x >= threshold]
            if found:
                yield pd.DataFrame(found, columns=["a", "b", "jaccard"])

    links = (rows.repartition("i", "j").sortWithinPartitions("i", "j", "pair")
             .mapInPandas(verify, "a long, b long, jaccard double"))
    links = (links.join(names.withColumnsRenamed({"node": "a", "rep": "id_1"}), "a").join(names.withColumnsRenamed({"node": "b", "rep": "id_2"}), "b")
             .where("id_1 <> id_2").select(F.least("id_1", "id_2").alias("id_a"), F.greatest("id_1", "id_2").alias("id_b"), "jaccard"))
    return (members.select(F.col("rep").alias("id_a"), F.col("id").alias("id_b"), F.lit(None).cast("double").alias("jaccard"))
            .union(links).distinct())


def band_values(signature: np.ndarray, bands: int) -> np.ndarray:
    """32 bits for every band of every signature; equal bands have equal ones."""
    rows = signature.shape[1] // bands
    out = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + signature[:, r:bands * rows:rows].astype(np.uint64))
    return (out >> np.uint64(32)).astype(np.uint32)


def band_pairs(classes: DataFrame, bands: int, threshold: float) -> DataFrame:
    """Pairs (``a``, ``b``) of classes (``node``, ``n``, ``bands``) that share a band and whose sizes allow a link, each pair once."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(values: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(values), np.uint32).reshape(-1, bands).astype(np.int64)
        return pd.Series(list(x | np.arange(bands, dtype=np.int64) << 32))

    every = classes.select("node", F.explode(keys("bands")).alias("key"))
    crowd = every.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    blocks = F.ceil(F.col("k") / CLASSES_PER_BLOCK).cast("int")
    keyed = cut_lineage(every.join(crowd, "key").select("node", "key", blocks.alias("blocks")))
    own = keyed.withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    first = own.select("node", "key", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"))
    second = own.select("node", "key", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"))
    both = first.union(second.where("i < j")).join(classes.select("node", "n", "bands"), "node")

    def run(frames):
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = int(_new_groups(pdf)[-1]) if len(pdf) else 0
            yield from _pairs(pdf.iloc[:last], bands, threshold)
            rest = pdf.iloc[last:]
        if rest is not None:
            yield from _pairs(rest, bands, threshold)

    return (both.select("key", "i", "j", "side", "node", "n", "bands").repartition("key", "i", "j")
            .sortWithinPartitions("key", "i", "j", "side").mapInPandas(run, "a long, b long"))


def _new_groups(pdf: pd.DataFrame) -> np.ndarray:
    """Where each run of equal ``key``, ``i`` and ``j`` begins."""
    x = pdf[["key", "i", "j"]].to_numpy(np.int64)
    return np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]).any(axis=1))))


def _pairs(pdf: pd.DataFrame, bands: int, threshold: float):
    """Pairs within whole groups whose first shared band is that of the group, a bounded number at a time."""
    if not len(pdf):
        return
    begin = _new_groups(pdf)
    size = np.diff(np.append(begin, len(pdf)))
    node, n, side = (pdf[c].to_numpy(np.int64) for c in ("node", "n", "side"))
    band = pdf["key"].to_numpy(np.int64) >> 32
    values = np.frombuffer(b"".join(pdf["bands"]), np.uint32).reshape(-1, bands)
    alone = pdf["i"].to_numpy() == pdf["j"].to_numpy()  # a block with itself
    stop = np.repeat(begin + size, size)
    start = np.where(alone, np.arange(len(pdf)) + 1, np.repeat(begin + size - np.add.reduceat(side, begin), size))
    count = np.where(alone | (side == 0), stop - start, 0)
    ends = np.cumsum(count)
    at = 0
    while at < len(pdf):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        c = count[at:to]
        a = np.repeat(np.arange(at, to), c)
        b = np.repeat(start[at:to] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        fits = np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) * (1 - 1e-9)
        a, b = a[fits], b[fits]
        earliest = (values[a] == values[b]).argmax(axis=1) == band[a]
        if earliest.any():
            yield pd.DataFrame({"a": node[a[earliest]], "b": node[b[earliest]]})
        at = to


def _by_block(frames):
    """The sets and the pairs of every pair of blocks; the sets come first."""
    now, own, wanted = None, {}, []
    for pdf in frames:
        for i, j, pair, a, b, raw in pdf.itertuples(index=False):
            if (i, j) != now:
                if wanted:
                    yield own, wanted
                now, own, wanted = (i, j), {}, []
            if pair:
                wanted.append((a, b))
            else:
                own[a] = np.frombuffer(raw, np.uint64)
    if wanted:
        yield own, wanted


def similarities(sets: dict[int, np.ndarray], pairs: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """Jaccard similarity of every pair; of many pairs by the token matrix of their second sets."""
    out = []
    if len(pairs) < 64:
        for a, b in pairs:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            out.append((a, b, both / (len(sets[a]) + len(sets[b]) - both)))
        return out
    names = sorted({b for _, b in pairs})
    column = {name: k for k, name in enumerate(names)}
    sizes = np.array([len(sets[b]) for b in names])
    tokens, owner = np.concatenate([sets[b] for b in names]), np.repeat(np.arange(len(names)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    partners: dict[int, list[int]] = {}
    for a, b in pairs:
        partners.setdefault(a, []).append(b)
    for a, those in partners.items():
        lo = np.searchsorted(tokens, sets[a])
        c = np.searchsorted(tokens, sets[a], side="right") - lo
        hit = owner[np.repeat(lo - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        at = np.array([column[b] for b in those])
        both = np.bincount(hit, minlength=len(names))[at]
        out += zip([a] * len(those), those, (both / (len(sets[a]) + sizes[at] - both)).tolist(), strict=True)
    return out
