"""Vectorised word and n-gram hashing over the UTF-8 buffer of an Arrow string array.

Words are maximal runs of bytes of a class. The classes in use exclude ASCII characters only, so byte runs
are exactly the code point runs. A word's hash runs over its (A-Z lower-cased) bytes in lanes of eight, each mixed
into what came before, for all words at once; the few words of many lanes go to xxHash one by one. No structure
of a word (say, of two letters in a pattern) makes hashes of 64 bits meet more often than chance does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 2 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of ``[^\x20\x09-\x0D]``.
NOT_WHITE = ~_WHITE
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.
ALNUM = np.ones(256, bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Words of more bytes are hashed one by one.
MOST_LANE_BYTES = 128
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lanes(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first eight bytes from each place (fewer where the length is less), as little-endian integers."""
    padded = np.append(data, np.zeros(8, np.uint8))
    view = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    return view[at] & _MASKS[np.minimum(length, 8)]


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each range, wherever it stands."""
    length = end - start
    h = mix(lanes(data, start, length) ^ length.astype(np.uint64) * _ODD)
    more = np.flatnonzero(length > 8)
    for k in range(8, MOST_LANE_BYTES, 8):
        if k > 8:
            more = more[length[more] > k]
        if not len(more):
            break
        h[more] = mix((h[more] + np.uint64(k)) * _ODD ^ lanes(data, start[more] + k, length[more] - k))
    for i in np.flatnonzero(length > MOST_LANE_BYTES).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return h


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, hashes, and for each text the range of its words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    """Text i has the words first[i] : first[i + 1]."""

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets; nulls are empty."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `most` bytes each (a longer text stands alone)."""
    _, at = buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def words(texts: pa.Array, allowed: np.ndarray) -> Words:
    """Words (runs of bytes that are `allowed` after lower-casing A-Z) of every text."""
    raw, at = buffers(texts)
    data = LOWER[raw]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = allowed[data]
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = at[:-1][(at[:-1] < at[1:])]
    opens[edges] = inside[1:-1][edges]
    closes[edges[edges > 0] - 1] = inside[1:-1][edges[edges > 0] - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, range_hashes(data, start, end), np.searchsorted(start, at))


_SPREAD = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def ngrams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of every k-gram within a text, in order."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h += w.hash[j : n - k + 1 + j] * _SPREAD[j % 64]
    left = np.repeat(w.first[1:], w.counts) - np.arange(n)
    keep = np.flatnonzero(left[: n - k + 1] >= k)
    return keep, mix(h[keep])
