"""Bounded-space online best-fit packing of token sequences (operator 4).

Every document becomes one piece, or, if it is longer than a sequence, pieces
of exactly one sequence and a last one.  Pieces are dealt to partitions by a
hash, so that a partition holds a bounded number of them whatever the input's
size, and every partition packs its own: longest pieces first, each into the
open bin with the least free space that still holds it.  Free space is the key
of a bitset, so finding that bin is one shift and one lowest-set-bit.  At most
``open_bins`` bins are open; to open one more, the fullest is closed.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text_blocks import text_blocks
from tessera.llm.word_tokens import encode_block

SEQUENCE_TOKENS = 2048
OPEN_BINS = 16_384
PIECES_PER_PARTITION = 32_768
BLOCK_BYTES = 8 << 20  # larger blocks hold fewer distinct words a MB


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SEQUENCE_TOKENS, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of every row's token ids followed by ``end_id``.

    One row per piece: ``id_col``, ``piece`` (from 0), ``start``, ``length``,
    ``ids_crc32`` and, with ``keep_ids``, ``ids``.  A null or empty text is the
    single token ``end_id``.  Ids may be null or repeat; other columns are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def run(batches):
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            ids, starts = encode_block(tokenizer_path, block.column("text"))
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row in range(block.num_rows):
                own = np.append(ids[starts[row]:starts[row + 1]], np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(own), size)):
                    part = own[at:at + size]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part.astype(np.int32))
            columns = [block.column("id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("id", id_col))


class BestFit:
    """Online best fit into bins of ``size`` with at most ``open_bins`` open ones."""

    def __init__(self, size: int, open_bins: int, first_id: int = 0):
        self.size, self.open_bins, self.next_id = size, open_bins, first_id
        self.bits = 0  # bit f: some open bin has f free places
        self.free: list[list[int]] = [[] for _ in range(size + 1)]
        self.n_open = 0

    def _take(self, f: int) -> int:
        bins = self.free[f]
        bin_id = bins.pop()
        if not bins:
            self.bits &= ~(1 << f)
        self.n_open -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """Bin of a piece and its place there."""
        fits = self.bits >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(f)
        else:
            f, bin_id = self.size, self.next_id
            self.next_id += 1
        left = f - length
        if left:
            if self.n_open == self.open_bins:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest > left:  # the piece's own bin is the fullest
                    return bin_id, self.size - f
                self._take(fullest)
            self.free[left].append(bin_id)
            self.bits |= 1 << left
            self.n_open += 1
        return bin_id, self.size - f


def pack_pieces(pieces: DataFrame, n_rows: int, size: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS,
                per_partition: int = PIECES_PER_PARTITION, id_col: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; ``n_rows`` (about their number) sets how many partitions pack.

    Equal rows are interchangeable; the order within a partition is total up to
    them, so a task that runs again deals the same sequences.
    """
    n = max(1, math.ceil(n_rows / per_partition))

    def run(frames):
        fit = BestFit(size, open_bins, (TaskContext.get().partitionId()) << 36)
        for pdf in frames:
            placed = [fit.place(x) for x in pdf["length"].tolist()]
            pdf["sequence_id"] = pd.array([p[0] for p in placed], dtype="int64")
            pdf["offset"] = pd.array([p[1] for p in placed], dtype="int64")
            yield pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return (pieces.repartition(n, F.col(id_col), "piece", "ids_crc32")
            .sortWithinPartitions(F.desc("length"), F.col(id_col), "piece", "ids_crc32")
            .mapInPandas(run, schema + ", sequence_id long, offset long"))


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SEQUENCE_TOKENS, end_id: int = 0, keep_ids: bool = False,
                   open_bins: int = OPEN_BINS, per_partition: int = PIECES_PER_PARTITION) -> DataFrame:
    """Whole texts as token pieces packed into sequences of at most ``size`` tokens.

    One row per piece as ``token_pieces`` gives it, with ``sequence_id`` and
    ``offset`` (gapless from 0 within a sequence).  An empty table gives no rows.
    """
    pieces = token_pieces(df, tokenizer_path, id_col, text_col, size, end_id, keep_ids)
    return pack_pieces(pieces, df.count(), size, open_bins, per_partition, id_col)
