"""Columnar words: Arrow texts to integer word codes without a Python loop over words.

A word is a run of bytes outside space and 0x09 to 0x0D; A-Z are lower-cased.  Null and
empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """codes[bounds[i]:bounds[i + 1]] index ``vocabulary`` with the words of text i."""

    codes: np.ndarray
    bounds: np.ndarray
    vocabulary: pa.Array

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        own = (xxhash.xxh64_intdigest(w) for w in self.vocabulary.to_pylist())
        table = np.fromiter(own, dtype=np.uint64, count=len(self.vocabulary))
        return table[self.codes] if len(table) else np.zeros(0, np.uint64)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the n + 1 offsets of the texts."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(texts: pa.Array, most_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most_bytes`` of text each, one row at least."""
    _, off = text_buffers(texts)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(off, off[start] + most_bytes, side="right")) - 1)
        yield start, stop
        start = stop


def words_of(texts: pa.Array) -> Words:
    """Split and encode the words of the texts."""
    data, off = text_buffers(texts)
    if not len(data):
        return Words(np.zeros(0, np.int32), np.zeros(len(off), np.int64), pa.array([], pa.large_binary()))
    solid = ~_SPACE[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    edges = off[:-1][off[:-1] < len(data)]
    starts[edges] = solid[edges]  # a text's first byte starts a word even if the last text ended in one
    at = np.flatnonzero(starts)
    bounds = np.searchsorted(at, off)
    kept = np.cumsum(solid, dtype=np.int64)
    packed = _LOWER[data[solid]]
    offsets = np.empty(len(at) + 1, np.int64)
    offsets[:-1] = kept[at] - 1
    offsets[-1] = len(packed)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
    ).dictionary_encode()
    return Words(column.indices.to_numpy(zero_copy_only=False), bounds, column.dictionary)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(word_hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a text, and each run's first word."""
    if len(word_hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(word_hashes) - n + 1
    h = word_hashes[:last].copy()
    for i in range(1, n):
        h = (h ^ (h >> np.uint64(29))) * _MIX + word_hashes[i : i + last]
    h ^= h >> np.uint64(32)
    whole = np.ones(last, dtype=bool)
    for i in range(1, n):  # runs that start in the last n - 1 words of a text reach into the next one
        cut = bounds[1:] - i
        cut = cut[(cut >= 0) & (cut < last)]
        whole[cut] = False
    first = np.flatnonzero(whole)
    return h[first], first
