"""Whole-text tokenising with numpy over Arrow buffers.

A text column arrives as UTF-8 bytes (``cast("binary")``).  ``pieces`` cuts
each Arrow batch into slices of whole texts with a bounded number of bytes
(a longer text is a slice of its own), so the memory a task needs does not
depend on how long the texts of a batch are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SLICE_BYTES = 1 << 20


def _byte_table() -> np.ndarray:
    """One odd-looking 64-bit value per byte, from a multiplicative sequence."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def _space() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def _plain() -> np.ndarray:
    """ASCII letters in lower case and digits stay, bytes of non-ASCII
    characters stay, everything else separates words."""
    t = _lower()
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[65:91] = keep[128:] = True
    t[~keep] = 32
    return t


BYTES = _byte_table()
SPACE = _space()
LOWER = _lower()
PLAIN = _plain()


def buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow binary array; a null is an empty range."""
    wide = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, off


def pieces(batches: Iterable[pa.RecordBatch], column: int = 0,
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets from 0) of slices of whole texts."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        data, off = buffers(batch.column(column))
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
            yield batch.slice(a, b - a), data[off[a]:off[b]], off[a:b + 1] - off[a]
            a = b


def edges(data: np.ndarray, off: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word and the first word of every text; ``space``
    marks the separators.  A word never crosses texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    gap = np.ones(n + 1, bool)
    gap[1:] = space
    word = ~space
    start = np.flatnonzero(word & (gap[:-1] | cut[:-1]))
    gap[:-1] = space
    gap[-1] = True
    end = np.flatnonzero(word & (gap[1:] | cut[1:])) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, by differences of one running polynomial."""
    n = len(data)
    if not n:
        return np.zeros(0, U64)
    base = U64(BASE)
    inv = U64(pow(BASE, -1, 1 << 64))
    run = np.zeros(n + 1, U64)
    np.cumsum(BYTES[data] * np.cumprod(np.full(n, base, U64)), out=run[1:])
    back = np.ones(n + 1, U64)
    np.cumprod(np.full(n, inv, U64), out=back[1:])
    return mix((run[end] - run[start]) * back[start])


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text, and each text's
    first one.  A text with fewer words, but some, has one for all of them."""
    n = len(words)
    counts = np.diff(first)
    rolled = np.zeros(max(0, n - size + 1), U64)
    for k in range(size):
        rolled *= U64(BASE)
        rolled += words[k:k + len(rolled)]
    rolled = mix(rolled)
    at = np.arange(len(rolled))
    full = rolled[at + size <= np.repeat(first[1:], counts)[:len(rolled)]]
    have = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        values = np.zeros(len(short), U64)
        for k in range(size - 1):
            inside = counts[short] > k
            values[inside] = values[inside] * U64(BASE) + words[first[short[inside]] + k]
        values = mix(values + counts[short].astype(U64))
        full = np.insert(full, np.concatenate([[0], np.cumsum(have)])[short], values)
        have[short] = 1
    return full, np.concatenate([[0], np.cumsum(have)])


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as a Spark long column."""
    return pa.array(x.view(np.int64))
