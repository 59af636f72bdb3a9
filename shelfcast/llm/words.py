"""Whole texts as arrays: words, word hashes and shingles of an Arrow column, a few megabytes at a time.

Words are runs of characters outside space and U+0009 to U+000D. A word's
identity is a 64-bit hash of its UTF-8 bytes, computed for all words of a block
at once from prefix sums of a polynomial.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; the arrays beside them take about forty times as much.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


class _Powers:
    """Powers of the polynomial's base and of its inverse modulo 2^64, as far as asked for."""

    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 1))
            cls.up, cls.down = (
                np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, base, _U))])
                for base in (_U(_BASE), _U(pow(_BASE, -1, 1 << 64)))
            )
        return cls.up, cls.down


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Block:
    """Some consecutive rows of a batch: `rows` is their range, `first` and `last` bound each row's words."""

    def __init__(self, rows: range, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.rows = rows
        self.data = _LOWER[data] if lower else data
        n = len(data)
        inside = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        at = np.searchsorted(self.starts, offsets)
        self.first, self.last = at[:-1], at[1:]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        up, down = _Powers.get(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=sums[1:])
        folded = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(folded + (self.ends - self.starts).astype(_U) * _U(_BASE))

    def row_of_word(self) -> np.ndarray:
        """The row, counted from the block's first, of every word."""
        return np.repeat(np.arange(len(self.first)), self.last - self.first)


def blocks(column: pa.Array, lower: bool = True) -> Iterator[Block]:
    """The column's rows in blocks of about BLOCK_BYTES; a longer row is a block of its own."""
    data, offsets = column_bytes(column)
    begin, n = 0, len(offsets) - 1
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, begin + 1), n)
        yield Block(range(begin, end), data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin], lower)
        begin = end


def shingle_sets(block: Block, size: int = 5) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of `size` words; of fewer words, the whole run is one; of none, empty."""
    words = block.hashes()
    total = max(0, len(words) - size + 1)
    full = np.zeros(total, _U)
    for j in range(size):
        full += words[j : j + total] * _WEIGHTS[j % 5] * _U(2 * (j // 5) + 1)
    full = mix(full)
    for a, b in zip(block.first.tolist(), block.last.tolist(), strict=True):
        if b - a >= size:
            yield np.unique(full[a : b - size + 1])
        elif b > a:
            weights = _WEIGHTS[np.arange(b - a) % 5] * (2 * (np.arange(b - a) // 5) + 1).astype(_U)
            run = (words[a:b] * weights).sum(keepdims=True, dtype=_U) + _U(b - a)
            yield mix(run ^ _U(0xA5A5A5A5A5A5A5A5))
        else:
            yield np.zeros(0, _U)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(_U)
