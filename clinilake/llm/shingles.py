"""Word and shingle hashes of whole texts, vectorised over Arrow buffers.

Words are maximal runs of bytes other than ASCII white space, with A-Z in
lower case.  A word's hash is a difference of prefix sums of its bytes, so a
block of texts costs a few passes over its bytes whatever its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Texts are taken in blocks of about so many bytes (one text at least).
BLOCK = 1 << 19
#: Prefix sums of powers can be fooled by built words of 1,024 letters and
#: more; words from here on are hashed on their own.
LONG_WORD = 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20240229)
_LETTER = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose outputs look independent."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * BLOCK)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([
                np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (_BASE, _BASE_INVERSE))


_POWERS = _Powers()


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive rows; a null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each row's words begin (and end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[rows] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    lower = _LOWER[data]
    _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[lower] * _POWERS.up[:len(data)], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * _POWERS.down[first] + (last - first).astype(np.uint64))
    for k in np.flatnonzero(last - first >= LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(lower[first[k]:last[k]].tobytes())
    return hashes, np.searchsorted(first, rows)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``width`` words, and where each row's begin.

    A row with fewer words gives its whole sequence as one; without words, none.
    """
    counts = np.diff(rows)
    chained = words.copy()
    for k in range(1, width):
        shifted = np.zeros_like(words)
        shifted[:-k or None] = words[k:]
        chained = mixed(chained * np.uint64(0xD6E8FEB86659FD93) + shifted)
    keep = np.zeros(len(words), dtype=bool)
    full = counts >= width
    # One at each row's first full run, minus one past its last.
    marks = np.zeros(len(words) + 1, np.int32)
    np.add.at(marks, rows[:-1][full], 1)
    np.add.at(marks, rows[1:][full] - width + 1, -1)
    keep[:] = np.cumsum(marks[:-1]) > 0
    for r in np.flatnonzero((counts > 0) & ~full):
        whole = words[rows[r]:rows[r + 1]]
        chained[rows[r]] = xxhash.xxh3_64_intdigest(whole.tobytes(), seed=len(whole))
        keep[rows[r]] = True
    sizes = np.where(full, counts - width + 1, (counts > 0).astype(np.int64))
    return chained[keep], np.concatenate([[0], np.cumsum(sizes)])
