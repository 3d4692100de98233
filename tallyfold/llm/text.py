"""Words and hashes of whole texts inside Arrow batches.

Texts travel as UTF-8 bytes. ``bytes.split()`` cuts at exactly the six
characters ``[\\x20\\x09-\\x0D]`` and ``bytes.lower()`` changes exactly A-Z, which
is what the word rules of the operators ask for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# Rows handled at a time inside a task; the outputs of one slice are in memory together.
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20
# Remembered word hashes of one worker.
VOCABULARY = 200_000
_MIX = tuple(np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 30, 27, 31))


def utf8(name: str) -> Column:
    return F.col(name).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    a, b, s30, s27, s31 = _MIX
    x = (x ^ (x >> s30)) * a
    x = (x ^ (x >> s27)) * b
    return x ^ (x >> s31)


def window_hashes(words: np.ndarray, size: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """One hash per run of ``size`` consecutive words: a polynomial in the word hashes, mixed.

    Runs are built by doubling, so a long window takes a few array operations.
    """
    if len(words) < size:
        return np.empty(0, np.uint64)
    base = seed | 1
    step, done, out = mixed(words + np.uint64(seed)), 0, None
    length = 1
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, done = step, length
            else:  # words [0, done) then [done, done + length)
                n = min(len(out), len(step) - done)
                out = out[:n] * np.uint64(pow(base, length, 1 << 64)) + step[done:done + n]
                done += length
        rest >>= 1
        if rest:
            n = len(step) - length
            step = step[:n] * np.uint64(pow(base, length, 1 << 64)) + step[length:length + n]
            length *= 2
    return mixed(out[: len(words) - size + 1])


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the ``n`` words inside any window of ``size`` words that begins at ``starts``."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + size, n), -1)
    return np.cumsum(marks[:n]) > 0


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An array column from one array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = SLICE_ROWS,
                size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and about ``size`` bytes in a binary column; a longer value is a slice alone."""
    for batch in batches:
        lengths = np.array([0 if v is None else v for v in pc.binary_length(batch[column]).to_pylist()], np.int64)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = ends[start] - lengths[start]
            stop = min(int(np.searchsorted(ends, before + size, "right")), start + rows)
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop
