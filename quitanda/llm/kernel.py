"""Numpy kernels over Arrow string batches: words, 64-bit word hashes, shingles.

They run inside Spark tasks (``mapInArrow``) and see one Arrow batch at a time.
A word is a maximal run of bytes outside space and ``\\t \\n \\v \\f \\r``; the
hash of a word is a polynomial in 2^64 over random byte values, finished with a
64-bit mixer, so all words of a batch are hashed by a handful of array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEPARATORS = (9, 10, 11, 12, 13, 32)
#: Bytes hashed at a time; bounds the temporary arrays of a task.
SEGMENT_BYTES = 1 << 20
#: Text bytes handed to a per-document kernel at a time.
CHUNK_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit hashes (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SEGMENT_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text has length 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    raw = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = raw[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text + total) of all words; texts never share a word."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_IS_SEP[data]
    cut = np.zeros(n + 1, bool)  # a text begins here
    cut[offsets] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | cut[1:n]
    stop = word.copy()
    stop[:-1] &= ~word[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT_BYTES, "right")))
        hi = ends[j - 1]
        up, down = _power_table(int(hi - lo) + 1)
        prefix = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[data[lo:hi]] * up[:hi - lo], out=prefix[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (prefix[e] - prefix[s]) * down[s]
        i = j
    return mix64(out)


def hash_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text + total); ``lower`` folds A-Z."""
    data, offsets = text_buffers(texts)
    starts, ends, first = word_bounds(data, offsets)
    return _hash_spans(data, starts, ends, _BYTE_LOWER if lower else _BYTE), first


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` consecutive words of one array."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * U64(0xD6E8FEB86659FD93) + words[i:i + n]
        out ^= out >> U64(29)
    return mix64(out)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (a longer text goes alone)."""
    if batch.num_rows == 0:
        return
    _, offsets = text_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)


def lists_of(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the first value of each row + total."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
