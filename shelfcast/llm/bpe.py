"""Byte-level BPE by a two-tier lookup, and decoding.

A pattern cuts a text into pre-tokens. A minimal perfect hash over the
vocabulary's byte strings resolves a pre-token that is a token itself with one
probe and one comparison. Any other is merged bottom-up: its bytes form a linked
list, a heap holds the neighbouring pairs that are tokens by (rank, place), and
the least pair merges until none is left. Pre-tokens recur, so each worker keeps
the ids of those it has met, as bytes to be strung together, in two generations of
a fixed size, or that of one text: the older one goes when the younger is full, and
what is met again moves over.

Defined results: a null text counts as empty and gives no ids; text that the
pattern does not match gives none either (the public patterns match everything);
null ids decode to null, an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from shelfcast.llm.shipping import append_column

#: Pre-tokens of one generation that a worker remembers, some 220 bytes each.
REMEMBERED = 250_000


class PerfectHash:
    """Every key has its own slot among len(keys); a bucket's displacement sends its keys to free slots.

    Buckets are placed from the largest; those of one key name their slot directly.
    """

    def __init__(self, keys: list[bytes]):
        self.size = n = len(keys)
        self.n_buckets = max(1, n // 2)
        self.shift = np.zeros(self.n_buckets, np.int64)
        self.order = np.zeros(n, np.int64)
        buckets: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            buckets.setdefault(h % self.n_buckets, []).append(i)
        taken = bytearray(n)
        free = None
        for bucket, members in sorted(buckets.items(), key=lambda b: (-len(b[1]), b[0])):
            if len(members) == 1:
                if free is None:
                    free = (slot for slot in range(n) if not taken[slot])
                slot = next(free)
                self.shift[bucket] = -slot - 1
                self.order[slot] = members[0]
                continue
            d = 1
            while True:
                slots = [self._slot(hashes[i], d) for i in members]
                if len({*slots}) == len(slots) and not any(taken[s] for s in slots):
                    break
                d += 1
            self.shift[bucket] = d
            for s, i in zip(slots, members, strict=True):
                taken[s] = 1
                self.order[s] = i
        self.shift = self.shift.tolist()
        self.order = self.order.tolist()

    def _slot(self, h: int, d: int) -> int:
        return ((((h >> 20) ^ (d * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF) * 0xBF58476D1CE4E5B9 >> 17) % self.size

    def find(self, key: bytes) -> int:
        """The place of the only key that `key` can be; the caller compares."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.n_buckets]
        return self.order[-d - 1 if d < 0 else self._slot(h, d)]


class Tokenizer:
    """A vocabulary of ranks with a pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        entries = [line.split() for line in ranks.splitlines() if line.strip()]
        self.tokens = [base64.b64decode(token) for token, _ in entries]
        self.ranks = [int(rank) for _, rank in entries]
        self.by_bytes = dict(zip(self.tokens, self.ranks, strict=True))  # ranks of merged pairs
        self.by_id = dict(zip(self.ranks, self.tokens, strict=True))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @functools.cached_property
    def table(self) -> PerfectHash:
        """Built at the first text: decoding does not need it."""
        return PerfectHash(self.tokens)

    def rank(self, piece: bytes) -> int | None:
        at = self.table.find(piece)
        return self.ranks[at] if self.tokens[at] == piece else None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token: the least pair of neighbours merges first, the left one at a tie.

        after[i] is where the part that starts at i ends and the next one starts. A heap entry is
        one number, (rank, start, end of the pair) in order of weight; it is void once its pair no
        longer ends there. Parts that merged into another point to the place past the end.
        """
        n, rank_of, push, pop = len(piece), self.by_bytes.get, heapq.heappush, heapq.heappop
        bits = n.bit_length()
        mask, double = (1 << bits) - 1, 2 * bits
        after, before = [*range(1, n + 1), -1], list(range(-1, n))
        ranks = map(rank_of, map(piece.__getitem__, map(slice, range(n - 1), range(2, n + 1))))
        heap = [rank << double | i << bits | i + 2 for i, rank in enumerate(ranks) if rank is not None]
        heapq.heapify(heap)
        while heap:
            entry = pop(heap)
            i, end = entry >> bits & mask, entry & mask
            j = after[i]
            if after[j] != end:
                continue
            after[i], after[j], before[end] = end, n, i
            if end < n:
                stop = after[end]
                rank = rank_of(piece[i:stop])
                if rank is not None:
                    push(heap, rank << double | i << bits | stop)
            left = before[i]
            if left >= 0:
                rank = rank_of(piece[left:end])
                if rank is not None:
                    push(heap, rank << double | left << bits | end)
        ids, i = [], 0
        while i < n:
            rank = rank_of(piece[i : after[i]])
            if rank is None:
                raise ValueError(f"byte {piece[i : after[i]]!r} is not in the vocabulary")
            ids.append(rank)
            i = after[i]
        return ids

    def _learn(self, words: list[str]) -> None:
        for word in words:
            piece = word.encode()
            rank = self.rank(piece) if piece else None
            ids = [rank] if rank is not None else self.merge(piece)
            self.known[word] = array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        words = self.split(text)
        known, older, unseen = self.known, self.older, []
        new = set(words).difference(known)
        if len(known) + len(new) > REMEMBERED:
            self.older = older = known
            self.known = known = {}
            new = set(words)
        for word in new:
            ids = older.get(word)
            if ids is None:
                unseen.append(word)
            else:
                known[word] = ids
        self._learn(unseen)
        return np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.by_id.__getitem__, ids))
        except KeyError as unknown:
            raise ValueError(f"id {unknown} is not in the vocabulary") from None


@functools.lru_cache(maxsize=4)
def tokenizer(ranks: bytes, pattern: str) -> Tokenizer:
    """Built once per process."""
    return Tokenizer(ranks, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """`df` with the ids of each text. The rank file (under a megabyte) goes out as a broadcast variable."""
    ranks = df.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def ids(column: pa.Array) -> pa.Array:
        made = tokenizer(ranks.value, pattern)
        parts = [made.encode(t or "") for t in column.to_pylist()]
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))

    return append_column(df, text, out, "array<int>", ids)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """`df` with the bytes that each list of ids stands for."""
    ranks = df.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def whole(column: pa.Array) -> pa.Array:
        made = tokenizer(ranks.value, pattern)
        values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        present = column.is_valid().to_numpy(zero_copy_only=False)
        parts = zip(present, ends[:-1], ends[1:], strict=True)
        return pa.array([made.decode(values[a:b].tolist()) if there else None for there, a, b in parts], pa.binary())

    return append_column(df, ids, out, "binary", whole)
