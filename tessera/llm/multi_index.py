"""Nearest neighbours by multi-index hashing (operator 8).

Vectors become binary codes: centred, turned onto their principal axes, rotated
by a rotation learnt on a sample (iterative quantisation), and cut to signs.
Codes are split into substrings of eight bits.  A block of rows has one index
per substring, from its value to the rows; by the pigeonhole principle a code
within Hamming radius ``r = s * m + a`` of a query's agrees with it up to ``s``
bits in one of the first ``a + 1`` substrings or up to ``s - 1`` bits in one of
the others, so probing these values finds every code within the radius.  Those
are ranked by their exact distances.

The index covers every row; the sample (at most ``MAX_SAMPLE`` vectors, picked
by a hash of the id) only fits the rotation and the radius: the smallest one
that holds ``SAMPLE_RECALL`` of the sample's true neighbours.  Rows and queries
meet in blocks of bounded size.  If a block holds fewer than ``k`` codes within
the radius, the radius is widened there, so no query ends up with fewer than
``k`` results while there are rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SAMPLE = 10_000
SAMPLE_QUERIES = 300
SAMPLE_RECALL = 0.97
MAX_BITS = 64
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 4096

_POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8))
_DISTANCE = _POPCOUNT[np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None]]


@dataclass
class BinaryCodes:
    mean: np.ndarray
    projection: np.ndarray  # dimensions x bits
    radius: int = 0

    @classmethod
    def fit(cls, sample: np.ndarray, k: int = 10, rounds: int = 30, seed: int = 7) -> BinaryCodes:
        rng = np.random.default_rng(seed)
        mean = sample.mean(axis=0)
        bits = min(MAX_BITS, sample.shape[1])
        _, _, axes = np.linalg.svd((sample - mean).T @ (sample - mean))
        axes = axes[:bits].T
        flat = (sample - mean) @ axes
        rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
        for _ in range(rounds):
            signs = np.where(flat @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(flat.T @ signs)
            rotation = u @ v
        out = cls(mean, axes @ rotation)
        out.radius = out._radius(sample, k, rng)
        return out

    def _radius(self, sample: np.ndarray, k: int, rng) -> int:
        """Smallest radius that holds ``SAMPLE_RECALL`` of the true neighbours of some sample vectors."""
        n = len(sample)
        if n < 2:
            return 0
        picked = rng.choice(n, min(SAMPLE_QUERIES, n), replace=False)
        codes = self.codes(sample)
        found = []
        for q in picked:
            d = ((sample - sample[q]) ** 2).sum(axis=1)
            d[q] = np.inf
            near = np.argpartition(d, min(k, n - 1) - 1)[:min(k, n - 1)]
            found.append(_POPCOUNT[codes[near] ^ codes[q]].sum(axis=1))
        return int(np.quantile(np.concatenate(found), SAMPLE_RECALL, method="higher"))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of bytes, one byte per substring."""
        return np.packbits((vectors - self.mean) @ self.projection > 0, axis=1)


class SubstringIndex:
    """Rows of a block by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.starts = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, j], minlength=256))))
                       for j in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within ``radius`` of ``code``."""
        m = self.codes.shape[1]
        s, a = divmod(radius, m)
        hit = np.zeros(len(self.codes), bool)
        for j in range(m):
            reach = s if j <= a else s - 1
            if reach < 0:
                continue
            order, starts = self.order[j], self.starts[j]
            for value in np.flatnonzero(_DISTANCE[code[j]] <= reach):
                hit[order[starts[value]:starts[value + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[_POPCOUNT[self.codes[rows] ^ code].sum(axis=1) <= radius]


def search_block(model: BinaryCodes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray,
                 queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query id, id, distance) of every query's ``k`` nearest rows of the block that its codes find."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    # of equal vectors only the k + 1 smallest ids can be among a query's k nearest
    _, which = np.unique(vectors, axis=0, return_inverse=True)
    rank = pd.Series(which.reshape(-1)).groupby(which.reshape(-1)).cumcount().to_numpy()
    ids, vectors = ids[rank <= k], vectors[rank <= k]
    index = SubstringIndex(model.codes(vectors))
    codes = model.codes(queries)
    bits = model.projection.shape[1]
    out = []
    for q, query, code in zip(query_ids.tolist(), queries, codes, strict=True):
        radius = model.radius
        while True:
            rows = index.within(code, radius)
            rows = rows[ids[rows] != q]
            if len(rows) >= k or radius >= bits:
                break
            radius = min(bits, radius + 4)
        distance = np.sqrt(((vectors[rows] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], distance))[:k]
        out += [(q, int(ids[rows[i]]), float(distance[i])) for i in best]
    return out


def nearest(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK,
            max_sample: int = MAX_SAMPLE) -> DataFrame:
    """The ``k`` nearest rows found for every row that ``is_query`` marks: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``score`` is the Euclidean distance in double precision; ties go to the
    smaller id.  A row takes part if it has an id and a vector without nulls,
    not-finite components or all zeros, of the table's most frequent length.
    Of rows with the same id one takes part (the smallest vector).  Without such
    rows the result is empty.
    """
    spark = df.sparkSession
    v = F.col("v")
    usable = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                        is_query.alias("q"))
              .where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                     & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                     & F.exists(v, lambda x: x != 0)))
    lengths = usable.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = lengths[0].d
    rows = usable.where(F.size(v) == d).groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    sample = np.array([r.v for r in rows.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(max_sample).select("v").collect()])
    model = BinaryCodes.fit(sample, k)
    n = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q")).first()
    n_blocks, n_query_blocks = -(-n.n // rows_per_block), max(1, -(-n.q // queries_per_block))

    def every(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def block(seed, count):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(count)).cast("int")

    # the stated queries against all rows, in blocks
    indexed = rows.select("id", "v", F.lit(False).alias("q"), block(11, n_blocks).alias("b"), every(n_query_blocks).alias("qb"))
    asked = rows.where("q").select("id", "v", F.lit(True).alias("q"), every(n_blocks).alias("b"), block(13, n_query_blocks).alias("qb"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        is_q = pdf["q"].to_numpy(dtype=bool)
        if not is_q.any() or is_q.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        vectors, ids = np.stack(pdf["v"].to_numpy()), pdf["id"].to_numpy()
        found = search_block(model, ids[~is_q], vectors[~is_q], ids[is_q], vectors[is_q], k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = indexed.union(asked).groupBy("b", "qb").applyInPandas(search, schema)
    best = F.row_number().over(_by_query())
    return (found.withColumn("rank", best).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _by_query():
    from pyspark.sql import Window

    return Window.partitionBy("query_id").orderBy("score", "vec_id")
