"""Hashes of words and word n-grams of whole texts, for many texts at once.

A word's hash is a polynomial over random numbers for its bytes, read from running sums, so that the work per byte is a
few array operations. It is mixed before use; all hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; a longer text is hashed alone. A byte takes some 40 bytes of arrays.
CHUNK = 1 << 18
_SPACES = b" \t\n\x0b\x0c\r"
_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.Generator(np.random.Philox(key=11)).integers(0, 2**64, 256 + 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(_SPACES)] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n powers or more of the base and of its inverse. Those for a chunk are kept, more are not."""
    return _kept_powers() if n <= CHUNK else _new_powers(n)


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(CHUNK)


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, pow(_BASE, -1, 2**64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, ends with a leading 0) of runs of texts; a null text is like an empty one."""
    texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if len(texts) and texts.buffers()[2] is not None else np.empty(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, ends: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of the first word of each text, with the number of words behind): A-Z lower-cased."""
    n = len(data)
    low = _LOWER[data]
    inside = ~separators[low]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    cut = ends[1:-1]
    before[cut[cut < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    stops = np.flatnonzero(inside & ~after) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_RANDOM[low] * up[:n], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts]), np.searchsorted(starts, ends)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n consecutive words."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    m = len(hashes) - n + 1
    out = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        out += hashes[k : k + m] * _RANDOM[256 + k % 64]
        if n > 64:
            out = mixed(out)
    return mixed(out)


def shingle_sets(data: np.ndarray, ends: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-word shingles of each text; all words as one if they are fewer, nothing without words."""
    hashes, first = words(data, ends)
    every = grams(hashes, n)
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= n:
            yield np.unique(every[a : b - n + 1])
        else:
            yield grams(hashes[a:b], b - a) if b > a else hashes[:0]
