"""Words and hashes of whole texts, vectorised over the bytes of an Arrow batch.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``. Every
word becomes one 64-bit hash, so shingles and windows are sums over short arrays
instead of Python strings. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .worker import release

#: Bytes hashed at a time. A longer single word is hashed by blake2b instead.
CHUNK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES["up"] = _powers(_BASE, CHUNK + 1)
        _TABLES["down"] = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 1)
    return _TABLES["up"], _TABLES["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Words:
    """The words of a list of texts: hashes, byte spans, first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data, self.offsets = data, offsets
        keep = ~_SPACE[data]
        before = np.zeros(len(data), dtype=bool)  # the byte before belongs to the same word
        before[1:] = keep[:-1]
        heads = offsets[:-1]
        before[heads[heads < len(data)]] = False
        self.start = np.flatnonzero(keep & ~before)
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = before[1:] & keep[1:]
        self.end = np.flatnonzero(keep & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # text i has words first[i]:first[i+1]
        self.hash = self._hash(_LOWER if lower else _BYTE, lower)

    def _hash(self, table: np.ndarray, lower: bool) -> np.ndarray:
        up, down = _tables()
        start, end = self.start, self.end
        out = np.empty(len(start), dtype=np.uint64)
        i = 0
        while i < len(start):
            j = int(np.searchsorted(end, start[i] + CHUNK, side="right"))
            if j <= i:  # one word longer than a chunk
                word = bytes(self.data[start[i] : end[i]])
                word = word.lower() if lower else word
                out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
                i += 1
                continue
            a, b = int(start[i]), int(end[j - 1])
            total = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(table[self.data[a:b]] * up[: b - a], out=total[1:])
            s, e = start[i:j] - a, end[i:j] - a
            out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts made of the kept words, one space between two."""
        data, mask = self.data.copy(), np.zeros(len(self.data) + 1, dtype=np.int8)
        start, end = self.start[keep], self.end[keep]
        total = np.concatenate(([0], np.cumsum(keep)))[self.first]  # kept words before each text
        gap = np.ones(len(start), dtype=bool)
        gap[total[1:][total[1:] > total[:-1]] - 1] = False  # none after a text's last word
        data[end[gap]] = 32
        mask[start] += 1
        np.subtract.at(mask, end + gap, 1)
        mask = np.cumsum(mask[:-1], dtype=np.int8) > 0
        before = np.concatenate(([0], np.cumsum(mask)))
        return data[mask], before[self.offsets]

    def without(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts without the other words and the white space after them."""
        last = np.zeros(len(self.start), dtype=bool)
        last[self.first[1:][self.first[1:] > self.first[:-1]] - 1] = True
        follow = np.append(self.start[1:], 0)
        text = np.searchsorted(self.offsets, self.start, side="right") - 1
        follow[last] = self.offsets[text[last] + 1]
        mask = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(mask, self.start[~keep], 1)
        np.subtract.at(mask, follow[~keep], 1)
        mask = np.cumsum(mask[:-1]) == 0
        before = np.concatenate(([0], np.cumsum(mask)))
        return self.data[mask], before[self.offsets]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column over bytes and offsets."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def batches(text: pa.Array, size: int = 2 * CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``(from, to, bytes, offsets)`` of a string column, about ``size`` bytes each; null is empty."""
    release()
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    if text.null_count:
        text = text.fill_null("")
    n = len(text)
    buffers = text.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[text.offset : text.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if n and buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def windows(hashes: np.ndarray, length: int, factor: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive hashes (not mixed), by doubling the length."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, have, double, size = None, 0, hashes, 1
    while True:
        if length & size:
            if out is None:
                out, have = double[:n], size
            else:
                step = _U(pow(factor, size, 1 << 64))
                out = out * step + double[have : have + n]
                have += size
        if 2 * size > length:
            return out
        double = double[:-size] * _U(pow(factor, size, 1 << 64)) + double[size:]
        size *= 2


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
