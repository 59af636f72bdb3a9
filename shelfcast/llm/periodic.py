"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart
are the same) and a length of at least max(6, 4 * q) that no neighbouring word
extends with the same period.

Suffixes are sorted by prefix doubling, which names every block of 2^k words by
the place where its equals begin among the sorted suffixes; equal blocks stand
side by side there. A wavelet matrix over the suffix array answers "the next
occurrence of this block after its own place" as a count followed by a k-th
smallest value, for all queries at once. A run of period q, with B the smallest
power of two that is not under q, holds a block of B words that starts at a
multiple of B/2 and occurs again q words later; as B >= q, the block's
occurrences inside the run stand q apart and nowhere else, so the next
occurrence gives q as difference of their progression. Each (block, difference)
is extended both ways by longest common extensions over the blocks' names and
kept if it is long enough. So every run is found and no stretch is tested word
by word.

Several texts of like length are worked on together, a block of about a
megabyte at a time; memory is in proportion to the block or the longest text.

Defined results: a null or empty text has no words and no runs; its collapsed
text is empty. Every row is treated by itself, repeated ones too; an empty
table gives an empty table; a column already named `out` is replaced and all
others pass unchanged.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfcast.llm.shipping import append_column

#: Bytes of text worked on together; the arrays beside them take some fifty times as much.
BLOCK_BYTES = 1 << 20
#: A run has at least this many words, and at least this many periods.
LEAST, TIMES = 6, 4

KIND = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


class Wavelet:
    """Range queries over an array of values below 2^bits."""

    def __init__(self, values: np.ndarray, bits: int):
        self.zeros: list[np.ndarray] = []
        self.bits = bits
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.zeros.append(zeros)
            values = np.concatenate([values[~one], values[one]])

    def count_below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range lie below its bound."""
        below = np.zeros(len(lo), np.int32)
        for level, zeros in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level) & 1).astype(bool)
            left, right = zeros[lo], zeros[hi]
            below += np.where(one, right - left, 0)
            lo, hi = np.where(one, zeros[-1] + lo - left, left), np.where(one, zeros[-1] + hi - right, right)
        return np.where(bound >> self.bits > 0, hi - lo, below)

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of each range, counted from 0."""
        value = np.zeros(len(lo), np.int32)
        for zeros in self.zeros:
            left, right = zeros[lo], zeros[hi]
            one = k >= right - left
            k = np.where(one, k - (right - left), k)
            value = value << 1 | one
            lo, hi = np.where(one, zeros[-1] + lo - left, left), np.where(one, zeros[-1] + hi - right, right)
        return value

    def successors(self, lo: np.ndarray, hi: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The smallest value of each range that is greater than `after`; -1 without one."""
        if not len(lo):
            return np.zeros(0, np.int32)
        k = self.count_below(lo, hi, after + 1)
        some = k < hi - lo
        found = np.full(len(lo), -1, np.int32)
        found[some] = self.kth(lo[some], hi[some], k[some])
        return found


class Index:
    """Sorted suffixes of several texts of word numbers, with the names of their dyadic blocks.

    `words` holds the texts one after the other, `bounds` where they begin and end.
    names[k][i] is where the suffixes that share the 2^k words from i on begin in
    the suffix array; a block that reaches past its text's end shares its name
    with none, and no name occurs in two texts.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.n = n = len(words)
        lengths = np.diff(bounds)
        self.start = np.repeat(bounds[:-1], lengths)
        self.end = np.repeat(bounds[1:], lengths)
        text = np.repeat(np.arange(len(lengths)), lengths)
        self.longest = int(lengths.max(initial=0))
        key = text * (int(words.max(initial=0)) + 1) + words
        self.suffixes = np.argsort(key, kind="stable").astype(np.int32)
        self.names: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        names, sizes = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self._name(key[self.suffixes], np.arange(n, dtype=np.int32), self.suffixes, names, sizes)
        self.names.append(names)
        self.sizes.append(sizes)
        slots = np.arange(n, dtype=np.int32)
        span = 1
        # No block above the smallest power of two that is not under the longest period is asked for.
        while 2 * span < self.longest // 2:
            slots = slots[sizes[names[self.suffixes[slots]]] > 1]
            if not len(slots):
                break
            at = self.suffixes[slots]
            second = np.where(at + span < self.end[at], names[np.minimum(at + span, n - 1)], -1)
            key = names[at].astype(np.int64) * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            at = at[order]
            self.suffixes[slots] = at
            names, sizes = names.copy(), np.ones(n, np.int32)
            self._name(key[order], slots, at, names, sizes)
            self.names.append(names)
            self.sizes.append(sizes)
            span *= 2

    @staticmethod
    def _name(keys: np.ndarray, slots: np.ndarray, at: np.ndarray, names: np.ndarray, sizes: np.ndarray) -> None:
        """Names for the suffixes `at`, which stand in `slots` sorted by `keys`, and how many share each."""
        if not len(keys):
            return
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        lengths = np.diff(np.append(begins, len(keys)))
        names[at] = np.repeat(slots[begins], lengths)
        sizes[slots[begins]] = lengths

    def _steps(self):
        """Levels from the longest block down, the longest one as often as it still fits."""
        for level in range(len(self.names) - 1, -1, -1):
            yield level, 1 << level, level == len(self.names) - 1

    def extend_right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, where i < j within one text."""
        length = np.zeros(len(i), np.int64)
        for level, span, again in self._steps():
            names = self.names[level]
            live = np.arange(len(i))
            while len(live):
                a, b = i[live] + length[live], j[live] + length[live]
                inside = b < self.n
                live, a, b = live[inside], a[inside], b[inside]
                live = live[names[a] == names[b]]
                length[live] += span
                if not again:
                    break
        return length

    def extend_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j, where i < j within one text."""
        length = np.zeros(len(i), np.int64)
        start = self.start[np.minimum(i, self.n - 1)]
        for level, span, again in self._steps():
            names = self.names[level]
            live = np.arange(len(i))
            while len(live):
                a, b = i[live] - length[live] - span, j[live] - length[live] - span
                inside = a >= start[live]
                live, a, b = live[inside], a[inside], b[inside]
                live = live[names[a] == names[b]]
                length[live] += span
                if not again:
                    break
        return length

    def candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks that occur again within their own length: place, block length, difference."""
        bits = max(1, self.longest.bit_length())
        local = self.suffixes - self.start[self.suffixes] if self.n else self.suffixes
        tree = None
        places, spans, periods = [], [], []
        for level, (names, sizes) in enumerate(zip(self.names, self.sizes, strict=True)):
            span = 1 << level
            at = np.arange(self.n, dtype=np.int32)
            if span > 2:
                at = at[(at - self.start) % (span // 2) == 0]
            if span == 1:
                # The window behind a single word is one place.
                at = at[:-1]
                at = at[(names[at] == names[at + 1]) & (at + 1 < self.end[at])]
                gap = np.ones(len(at), np.int32)
            else:
                lo = names[at]
                shared = sizes[lo] > 1
                at, lo = at[shared], lo[shared]
                if not len(at):
                    continue
                tree = tree or Wavelet(local, bits)
                own = at - self.start[at]
                gap = tree.successors(lo, lo + sizes[lo], own) - own
                near = (gap > span // 2) & (gap <= span)
                at, gap = at[near], gap[near]
            places.append(at)
            spans.append(np.full(len(at), span))
            periods.append(gap)
        return tuple(np.concatenate(x).astype(np.int64) for x in (places, spans, periods))

    def runs(self) -> np.ndarray:
        """All runs as rows (place among all words, length, period), by place and period."""
        if not self.n:
            return np.zeros((0, 3), np.int64)
        at, span, period = self.candidates()
        right = self.extend_right(at + span, at + span + period)
        left = self.extend_left(at, at + period)
        found = np.stack([at - left, left + span + period + right, period], axis=1)
        found = found[found[:, 1] >= np.maximum(LEAST, TIMES * period)]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        if len(found):
            found = found[np.concatenate([[True], (found[1:] != found[:-1]).any(axis=1)])]
        return found


def find_runs(texts: list[list]) -> list[np.ndarray]:
    """The runs of each list of words as rows (start, length, period), by start and period."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int32)
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, bounds[-1])
    found = Index(words, bounds).runs()
    cut = np.searchsorted(found[:, 0], bounds)
    return [found[a:b] - [at, 0, 0] for a, b, at in zip(cut, cut[1:], bounds.tolist())]  # noqa: B905


def collapse(words: list, runs: np.ndarray) -> list:
    """The words without those that some run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, np.cumsum(change[:-1]) == 0))


def _blocks(texts: list[bytes]):
    """Numbers of texts of like length, about BLOCK_BYTES at a time."""
    part, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if part and size + len(texts[i]) > BLOCK_BYTES:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(texts[i])
    if part:
        yield part


def _describe(column: pa.Array) -> pa.Array:
    texts = [t.encode() if t else b"" for t in column.to_pylist()]
    found: list = [None] * len(texts)
    counts, collapsed = np.zeros(len(texts), np.int64), [""] * len(texts)
    for part in _blocks(texts):
        # bytes.split cuts at space and U+0009 to U+000D, no other white space.
        words = [texts[i].split() for i in part]
        for i, w, runs in zip(part, words, find_runs(words), strict=True):
            counts[i], found[i], collapsed[i] = len(w), runs, b" ".join(collapse(w, runs)).decode()
    ends = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
    rows = np.concatenate([np.zeros((0, 3), np.int64), *found])
    structs = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(ends), structs)
    return pa.StructArray.from_arrays([pa.array(counts), runs, pa.array(collapsed, pa.string())], ["n_words", "runs", "collapsed"])


def detect(df: DataFrame, text: str = "text", out: str = "periodic") -> DataFrame:
    """`df` with the words, the runs and the collapsed text of each text.

    Words are `[^\\x20\\x09-\\x0D]+`; starts count words from 0; the collapsed
    text drops words that a run holds after its first period and joins the rest
    by one space. With out=text the result takes the text's place.
    """
    return append_column(df, text, out, KIND, _describe)
