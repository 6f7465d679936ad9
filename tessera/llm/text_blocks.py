"""Bounded Arrow blocks of text and their words, shared by the text operators.

A partition reaches Python as a stream of Arrow record batches.  ``text_blocks``
re-cuts that stream so that a block never holds more than ``max_bytes`` of text
(one longer text is a block of its own), and ``split_words`` turns a block into
word positions plus the block's distinct words, so per-word work runs once per
distinct word.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

MAX_BLOCK_BYTES = 4 << 20


def text_blocks(batches: Iterator[pa.RecordBatch], text_col: str = "text",
                max_bytes: int = MAX_BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Yield slices of the batches with at most ``max_bytes`` of text each; null texts become empty.

    When a task ends, memory that its blocks needed goes back to the system:
    Spark keeps the Python process for later tasks.
    """
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            at = batch.schema.get_field_index(text_col)
            # cast first and slice then: a cast slice has offsets that some kernels read wrongly
            arrays = list(batch.columns)
            arrays[at] = pc.fill_null(arrays[at].cast(pa.large_string()), "")
            batch = pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)
            ends = np.cumsum(pc.binary_length(arrays[at]).to_numpy(zero_copy_only=False).astype(np.int64))
            start, done = 0, 0
            while start < len(ends):
                end = max(start + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
                yield batch.slice(start, end - start)
                start, done = end, int(ends[end - 1])
    finally:
        release_memory()


def release_memory(cycles: bool = True) -> None:
    """Give unused memory of Arrow and the C allocator back to the system, with ``cycles`` also what reference cycles hold."""
    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(results: Iterator) -> Iterator:
    """The same results; when the task ends, memory that they needed goes back to the system (as by ``text_blocks``)."""
    try:
        yield from results
    finally:
        release_memory(cycles=False)


@contextmanager
def no_cycle_search():
    """Hold back the search for reference cycles, which walks over every list of a block's words again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


@dataclass
class Words:
    """Words of a block: ``ids`` index ``vocab``; text ``i`` has ``ids[starts[i]:starts[i+1]]``."""

    ids: np.ndarray
    starts: np.ndarray
    vocab: pa.Array

    def text_of(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def split_words(text: pa.Array, lower: str | None = None) -> Words:
    """Split at runs of ASCII white space (\\x20, \\x09-\\x0D); ``lower`` is None, 'ascii' or 'utf8'."""
    if lower == "ascii":
        text = pc.ascii_lower(text)
    elif lower == "utf8":
        text = pc.utf8_lower(text)
    parts = pc.ascii_split_whitespace(text)
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(parts).dictionary_encode()
    ids, vocab = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    starts = np.concatenate(([0], np.cumsum(lengths)))
    empty = pc.index(vocab, "").as_py()
    if empty >= 0:
        keep = ids != empty
        starts = np.concatenate(([0], np.cumsum(keep)))[starts]
        ids = ids[keep]
    return Words(ids, starts, vocab)


def word_hashes(vocab: pa.Array) -> np.ndarray:
    """64-bit hash of every distinct word, the same on every machine and in every run."""
    if len(vocab) == 0:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(vocab.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (empty when there are fewer)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for i in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[i:i + m]
    return mix64(out)


def sums_by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over every text's run of words (0 for texts without words)."""
    total = np.concatenate((np.zeros(1), np.cumsum(values, dtype=np.float64)))
    return total[starts[1:]] - total[starts[:-1]]
