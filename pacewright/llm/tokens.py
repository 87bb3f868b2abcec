"""Words of whole texts as numpy spans and hashes, straight from Arrow's UTF-8 buffers.

Separators are ASCII bytes and every other byte of UTF-8 is 128 or more, so cutting between bytes
cuts between code points. Nothing here makes a Python string per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Separators of the word rule [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of the word rule [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Bytes that are hashed at once, so that the wide arrays of one byte's powers stay small however long a text is.
PIECE = 1 << 18


def _spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word; no word crosses a row's edge."""
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(data), PIECE):
        b = min(a + PIECE, len(data))
        lo, hi = max(0, a - 1), min(len(data), b + 1)
        inside = np.zeros(b - a + 2, bool)  # with a byte on either side
        inside[lo - a + 1 : hi - a + 1] = ~separators[data[lo:hi]]
        begins, finals = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        first = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
        begins[first] = inside[first + 1]
        past = offsets[np.searchsorted(offsets, a, "right") : np.searchsorted(offsets, b, "right")] - a
        finals[past - 1] = inside[past]
        starts.append(np.flatnonzero(begins) + a)
        ends.append(np.flatnonzero(finals) + a + 1)
    return np.concatenate(starts), np.concatenate(ends)


class Chunk:
    """Consecutive rows of one batch: bytes (lower-cased A-Z), row offsets, word spans by row."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        self.first, self.data, self.offsets = first, LOWER[data], offsets
        self.starts, self.ends = _spans(self.data, offsets, separators)
        #: Row r has the words from bounds[r] up to bounds[r + 1].
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial of its bytes, mixed. A word that lies in several pieces is the sum of its parts."""
        up, down = _powers()
        h = np.zeros(len(self.starts), U64)
        sums = np.zeros(PIECE + 1, U64)
        for a in range(0, len(self.data), PIECE):
            b = min(a + PIECE, len(self.data))
            i, j = np.searchsorted(self.ends, a, "right"), np.searchsorted(self.starts, b)
            if i == j:
                continue
            np.cumsum(self.data[a:b] * up[: b - a], out=sums[1 : b - a + 1])
            s, e = np.maximum(self.starts[i:j], a) - a, np.minimum(self.ends[i:j], b) - a
            part = (sums[e] - sums[s]) * down[s]
            if self.starts[i] < a:
                part[:1] *= U64(pow(_BASE, a - int(self.starts[i]), 1 << 64))
            h[i:j] += part
        h += (self.ends - self.starts).astype(U64) * U64(0xD6E8FEB86659FD93)
        return mix(h)

    def word_rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(PIECE + 1, _BASE, U64), np.full(PIECE + 1, _BASE_INV, U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hash(word: str) -> int:
    """The hash that ``Chunk.hashes`` gives to one word (already lower-case)."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Chunk(0, data, np.array([0, len(data)]), np.zeros(256, bool)).hashes()[0])


def chunks(texts: pa.Array | pa.ChunkedArray, separators: np.ndarray, target: int = 1 << 20) -> Iterator[Chunk]:
    """The rows of a text column in slices of about ``target`` bytes; nulls are empty texts. A longer text is a slice of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + target, "right")) - 1)
        yield Chunk(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], separators)
        i = j
