"""Simple-8b word-aligned coding of unsigned integers, vectorised over blocks.

A 64-bit word holds a selector in its top four bits and as many equally wide values as fit in the other sixty.
Values come in blocks of BLOCK; each block starts a word of its own, and the blocks' first words are the offsets
that let a reader decode any block alone. Values of more than sixty bits are escapes: their word holds an index
into a list of full values.
"""

from __future__ import annotations

import numpy as np

# Bits of a value and values in a word, by selector.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
ESCAPE = 15
BLOCK = 1024

_LIMITS = (np.uint64(1) << WIDTHS) - np.uint64(1)
_CLASS_16 = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64)).astype(np.uint8)
_STEP = np.ones(16, np.int64)
_STEP[: len(COUNTS)] = COUNTS


def _classes(values: np.ndarray) -> np.ndarray:
    """The narrowest selector that can hold each value; ESCAPE if none can."""
    if not len(values) or values.max() < 1 << 16:
        return _CLASS_16[values.astype(np.int64)]
    c = np.searchsorted(_LIMITS, values).astype(np.uint8)
    c[c == len(WIDTHS)] = ESCAPE
    return c


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, escaped values); the last block may be short."""
    values = np.ascontiguousarray(values).astype(np.uint64)
    n_blocks = -(-len(values) // BLOCK)
    if not n_blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    most = int(COUNTS[0])
    width = BLOCK + most
    table = np.zeros((n_blocks, width), np.uint64)
    padded = np.zeros(n_blocks * BLOCK, np.uint64)
    padded[: len(values)] = values
    table[:, :BLOCK] = padded.reshape(n_blocks, BLOCK)
    cls = np.zeros((n_blocks, width), np.uint8)
    cls[:, :BLOCK] = _classes(padded).reshape(n_blocks, BLOCK)

    widest = {1: cls}  # widest[m][:, p]: the largest class of the m values from p on
    m = 1
    while 2 * m <= most:
        w = widest[m].copy()
        np.maximum(w[:, :-m], widest[m][:, m:], out=w[:, :-m])
        widest[m := 2 * m] = w
    best = np.full((n_blocks, BLOCK), ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        c = int(COUNTS[s])
        m = 1 << (c.bit_length() - 1)
        w = widest[m]
        fits = w[:, :BLOCK] <= s
        if m < c:
            fits &= w[:, c - m : c - m + BLOCK] <= s
        np.minimum(best, (fits.view(np.uint8) - np.uint8(1)) | np.uint8(s), out=best)  # s where it fits, else 255

    # All blocks go on word by word at once; a block's words start at its marked positions.
    step = _STEP[best].ravel()
    at = np.arange(n_blocks) * BLOCK
    limit = at + BLOCK
    limit[-1] = len(values)
    marked = np.zeros(n_blocks * BLOCK, bool)
    while len(at):
        marked[at] = True
        at = at + step[at]
        if not (go := at < limit).all():
            at, limit = at[go], limit[go]
    start = np.flatnonzero(marked)
    row = start // BLOCK
    pos = start - row * BLOCK
    selector = best.ravel()[start]
    words = selector.astype(np.uint64) << np.uint64(60)
    flat, first = table.ravel(), row * width + pos
    for s in np.unique(selector):
        i = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[i] |= np.arange(len(i), dtype=np.uint64)
            continue
        for j in range(int(COUNTS[s])):
            words[i] |= flat[first[i] + j] << np.uint64(j * int(WIDTHS[s]))
    offsets = np.searchsorted(row, np.arange(n_blocks))
    escaped = flat[first[selector == ESCAPE]]
    return words, offsets, escaped


def decode(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n_values: int) -> np.ndarray:
    """The n_values values of consecutive blocks; offsets are relative to `words`."""
    words = words.astype(np.uint64, copy=False)
    out = np.zeros(len(offsets) * BLOCK + int(COUNTS[0]), np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    step = _STEP[selector]
    before = np.cumsum(step) - step
    block = np.searchsorted(offsets, np.arange(len(words)), "right") - 1
    pos = block * BLOCK + before - before[offsets][block]
    last = np.zeros(len(words), bool)
    last[np.append(offsets[1:], len(words))[np.append(offsets[1:], len(words)) > 0] - 1] = True
    for of in (last, ~last):  # only a block's last word can hold more values than the block has left
        for s in np.unique(selector[of]):
            i = np.flatnonzero(of & (selector == s))
            if s == ESCAPE:
                out[pos[i]] = escaped[(words[i] & np.uint64((1 << 60) - 1)).astype(np.int64)]
                continue
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            for j in range(int(COUNTS[s])):
                v = (words[i] >> np.uint64(j * int(WIDTHS[s]))) & mask
                if of is last:
                    inside = pos[i] + j < (block[i] + 1) * BLOCK
                    out[pos[i][inside] + j] = v[inside]
                else:
                    out[pos[i] + j] = v
    return out[:n_values]
