"""Token counts by heap-and-linked-list byte-pair merging, without ids.

A tokenizer file gives an ordered list of merges. A pre-token starts as one
symbol per byte in a linked list; a heap holds the neighbouring pairs that the
list knows by (rank, place), and the lowest rank merges first, the left pair at
a tie. The count is the number of symbols at the start minus the number of
merges. Pre-tokens recur, so each worker keeps the counts of those it has met,
in two generations of a fixed size, or of one text: the older one goes when
the younger is full, and what is met again moves over.

Strings that the file lists as added tokens count as one wherever they stand in
a text, the longest at the leftmost place first, as the file's library handles
them by default; the text between two of them is cut into pre-tokens by itself.

Defined results: a null or empty text has no tokens. Every row keeps its own
count, repeated ones too; an empty table gives an empty table; a column already
named `out` is replaced and all others pass unchanged. A tokenizer file with
steps other than these is an error.
"""

from __future__ import annotations

import functools
import heapq
import json
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfcast.llm.shipping import append_column

#: Pre-tokens of one generation that a worker remembers, some 130 bytes each.
REMEMBERED = 500_000

#: Bytes that a byte-level vocabulary writes as their own character; the others follow from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    others = iter(range(256, 512))
    own = set(PRINTABLE)
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def read_spec(raw: bytes) -> dict:
    """The tokenizer file, if its steps are a byte-level split and plain merges."""
    spec = json.loads(raw)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex")
        and not split.get("add_prefix_space")
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        raise ValueError("only byte-level tokenizers with plain merges are supported")
    return spec


class Counter:
    """Counts the tokens of texts by the merges of one tokenizer file."""

    def __init__(self, raw: bytes, pattern: str):
        spec = read_spec(raw)
        vocabulary = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.first = [vocabulary[c] for c in byte_characters()]
        self.width = max(vocabulary.values()).bit_length()
        self.merged = [vocabulary[a + b] for a, b in merges]
        self.pairs = [vocabulary[a] << self.width | vocabulary[b] for a, b in merges]
        self.ranks = {pair: rank for rank, pair in enumerate(self.pairs)}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merge(self, piece: bytes) -> int:
        """Symbols left of a pre-token when no known pair is left.

        A heap entry is one number, rank before place; it is void once the
        symbols at its place are no longer the pair of its rank.
        """
        n, width, pairs, merged = len(piece), self.width, self.pairs, self.merged
        rank_of, push, pop = self.ranks.get, heapq.heappush, heapq.heappop
        symbols = [self.first[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bits = n.bit_length()
        place = (1 << bits) - 1
        ranks = [rank_of(a << width | b) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        heap = [rank << bits | i for i, rank in enumerate(ranks) if rank is not None]
        heapq.heapify(heap)
        count = n
        while heap:
            entry = pop(heap)
            rank, i = entry >> bits, entry & place
            j = after[i]
            if j >= n or symbols[i] < 0 or symbols[i] << width | symbols[j] != pairs[rank]:
                continue
            symbols[i], symbols[j] = merged[rank], -1
            after[i] = end = after[j]
            count -= 1
            if end < n:
                before[end] = i
                rank = rank_of(symbols[i] << width | symbols[end])
                if rank is not None:
                    push(heap, rank << bits | i)
            left = before[i]
            if left >= 0:
                rank = rank_of(symbols[left] << width | symbols[i])
                if rank is not None:
                    push(heap, rank << bits | left)
        return count

    def _count_plain(self, text: str) -> int:
        words = self.split(text)
        known, older = self.known, self.older
        new = set(words).difference(known)
        if len(known) + len(new) > REMEMBERED:
            self.older = older = known
            self.known = known = {}
            new = set(words)
        for word in new:
            count = older.get(word)
            known[word] = self.merge(word.encode()) if count is None else count
        return sum(map(known.__getitem__, words))

    def count(self, text: str) -> int:
        """The number of tokens of `text`."""
        if self.special is None:
            return self._count_plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._count_plain, parts))


@functools.lru_cache(maxsize=4)
def counter(raw: bytes, pattern: str) -> Counter:
    """Built once per process."""
    return Counter(raw, pattern)


def count_tokens(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """`df` with the token count of each text as a bigint; with out=text the count takes the text's place.

    The tokenizer file (under two megabytes) goes out as a broadcast variable.
    """
    raw = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def counts(column: pa.Array) -> pa.Array:
        made = counter(raw.value, pattern)
        return pa.array([made.count(t) if t else 0 for t in column.to_pylist()], pa.int64())

    return append_column(df, text, out, "bigint", counts)
