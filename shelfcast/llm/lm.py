"""Word model scores from a sharded n-gram trie with Elias-Fano levels.

Tokens are a text's words, A-Z in lower case, then one end; a start stands before
the first. With N tokens and V distinct ones in the training rows,
p(v) = (c(v) + 0.5) / (N + 0.5 (V + 1)) and
p(v | u) = (c(uv) + K p(v)) / (c(u) + K). In logarithms a text's score is a sum of
one number per word, log p(v), one per context, log K / (c(u) + K), and one per
pair that training has seen, log (1 + c(uv) / (K p(v))). So words and pairs are
dealt to shards by their hash, whatever else stands beside them; no context,
however frequent, is gathered in one place, and each shard answers for all texts.

Training reads the texts twice. The first pass counts words; the most frequent
ones, COMMON at most, and the end are broadcast with their counts. The second counts pairs: a
pair of common words travels as one number, sorted and as steps, any other with
the hashes of its rare words. A shard of pairs asks the shards of words for its
rare words' counts and becomes two tries, over the places of common words and over
hashes: a level of contexts, monotone pointers into a level of successors, all
Elias-Fano coded and searched as they are, and the pairs' numbers rounded to whole
STEPs. Shards of pairs are numbered by the distinct
pairs, estimated from one hash in MARKED.

Scoring sends a batch's distinct rare words and distinct pairs to the shards, once
each and without row numbers; the replies are counts and numbers of STEPs in the
order asked, and meet the batch's row numbers, which travel beside them.

Defined results: a null or empty text has the end as its only token; with no
training rows N and V are 0 and every word is unknown; rows of an empty table give
no rows; equal ids, or null ones, give a row each.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shipping import map_arrow, ship
from shelfcast.llm.words import blocks, mix
from shelfcast.session import staging_path

#: Pseudo-count of the shorter context, and what a pair's number is rounded to.
K = 8.0
STEP = 1 / 1024
#: Distinct pairs for each shard of pairs, and bytes of text for each such shard at most.
SHARD_PAIRS = 1_000_000
SHARD_BYTES = 512 << 20
#: Bytes of text for each shard of words.
WORD_BYTES = 64 << 20
#: One pair in so many is looked at to estimate the distinct pairs.
MARKED = 1024
#: Entries a task holds before it sends them on, or a shard before it adds up equal ones.
HELD = 2_000_000
#: Bytes of text that go to the shards as one batch.
BATCH_BYTES = 8_000_000
#: Bound on the number of words that are broadcast, 16 bytes each.
COMMON = 1 << 20

_U = np.uint64
END, START = _U(0x1D8AF6B3C2E45971), _U(0x7A3C95E1B04D2F68)


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def unpack(payload: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def _pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(u * _U(0x9E3779B97F4A7C15) + v)


def _sequence(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, context, token) of every token of the block's rows."""
    words = block.hashes()
    n = block.last - block.first
    tokens = np.insert(words, block.last, END)
    rows = np.repeat(np.arange(len(n)), n + 1)
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[np.concatenate([[0], np.cumsum(n + 1)[:-1]])] = START
    return rows, context, tokens


def _summed(keys: np.ndarray, counts: np.ndarray | None, *beside: np.ndarray):
    """Distinct keys in order, their summed counts (None: one each), and of the arrays beside them one value each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    if counts is None:
        total = np.diff(first, append=len(keys))
    else:
        total = np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    at = order[first]
    return (keys[first], total, *(x[at] for x in beside))


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in the narrowest type."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _planes(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on, byte by byte, so that equal high bytes stand together."""
    x = _small(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.copy()


def _numbers(planes: np.ndarray) -> np.ndarray:
    return planes.T.copy().view(f"u{len(planes)}").reshape(-1).astype(np.int64)


def _shards(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of their shard, and where each shard begins in that order."""
    shard = shard.astype(np.uint16 if shards <= 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


class Common:
    """The broadcast words in order of their hashes, with their counts; a word's place, and START's behind all others."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.size = len(words) + 1

    def places(self, words: np.ndarray) -> np.ndarray:
        """The place of every word; -1 for rare ones."""
        at = np.searchsorted(self.words, words)
        inside = at < len(self.words)
        inside[inside] = self.words[at[inside]] == words[inside]
        return np.where(inside, at, -1)

    def hashes(self, places: np.ndarray) -> np.ndarray:
        return np.append(self.words, START)[places]


class Pairs:
    """The distinct pairs of a sequence of tokens by shard, and for each its occurrences.

    `near` ones, of two common words, are told apart by their places, `far` ones
    by a hash. Each is a tuple: keys, places of one occurrence of each, number of
    occurrences, begins of the shards, all occurrences pair by pair.
    """

    def __init__(self, context: np.ndarray, tokens: np.ndarray, common: Common, shards: int):
        self.context, self.tokens, self.common, self.shards = context, tokens, common, shards
        self.v = common.places(tokens)
        self.u = np.concatenate([[-1], self.v[:-1]])
        self.u[context == START] = common.size - 1
        both = (self.u >= 0) & (self.v >= 0)
        at = np.flatnonzero(both)
        self.near = self._grouped(self.u[at] * common.size + self.v[at], at)
        at = np.flatnonzero(~both)
        self.far = self._grouped(_pair(context[at], tokens[at]), at)

    def _grouped(self, keys: np.ndarray, at: np.ndarray):
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
        times = np.diff(first, append=len(keys))
        one = at[order[first]]
        by, cuts = _shards(_pair(self.context[one], self.tokens[one]) % _U(self.shards), self.shards)
        times, begin = times[by], first[by]
        places = np.repeat(begin - np.cumsum(times) + times, times) + np.arange(len(keys))
        return keys[first][by], one[by], times, cuts, at[order[places]]

    def messages(self):
        """(shard, near keys, near counts, four arrays of far ones, far counts) of every shard that has some."""
        (keys, _, times, cuts, _), (_, one, far_times, far_cuts, _) = self.near, self.far
        for s in range(self.shards):
            a, b, c, d = cuts[s], cuts[s + 1], far_cuts[s], far_cuts[s + 1]
            if b > a or d > c:
                u, v, at = self.u[one[c:d]], self.v[one[c:d]], one[c:d]
                far = far_coded(u, v, self.context[at], self.tokens[at])
                yield s, _planes(np.diff(keys[a:b], prepend=0)), _small(times[a:b]), *far, _small(far_times[c:d])


def far_coded(u: np.ndarray, v: np.ndarray, context: np.ndarray, tokens: np.ndarray):
    """Pairs with a rare word: places plus one, 0 for rare words, and the hashes of those."""
    return _planes(u + 1), _planes(v + 1), context[u < 0], tokens[v < 0]


def far_hashes(u: np.ndarray, v: np.ndarray, rare_u: np.ndarray, rare_v: np.ndarray, common: Common):
    found = []
    for planes, rare in ((u, rare_u), (v, rare_v)):
        places = _numbers(planes) - 1
        hashes = common.hashes(np.maximum(places, 0)) if len(places) else np.zeros(0, _U)
        hashes[places < 0] = rare
        found.append(hashes)
    return found


def _tokens(batches, held: int):
    """(context, token) arrays of at most `held` entries."""
    for batch in batches:
        for block in blocks(batch.column(0)):
            _, context, tokens = _sequence(block)
            for begin in range(0, len(tokens), held):
                yield context[begin : begin + held], tokens[begin : begin + held]


def _held(batches):
    """The same, gathered to about HELD entries."""
    parts, n = [], 0
    for part in _tokens(batches, HELD):
        if n + len(part[0]) > HELD and parts:
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            parts, n = [], 0
        parts.append(part)
        n += len(part[0])
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


_NAMES, _KINDS = ["shard", "kind", "payload"], [pa.int64(), pa.int32(), pa.binary()]
_MESSAGE = "shard bigint, kind int, payload binary"


def _count_words(shards: int):
    """Per task and shard: words with their counts (kind 0) and marked pairs (1)."""

    def sent(words, counts, marks):
        rows = []
        for kind, keys, beside in ((0, words, counts), (1, marks, None)):
            order, cuts = _shards(keys % _U(shards) if kind == 0 else (keys // _U(MARKED)) % _U(shards), shards)
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[s] : cuts[s + 1]]
                rows.append((s, kind, pack(keys[at], _small(beside[at])) if kind == 0 else pack(keys[at])))
        return _batch(rows, _NAMES, _KINDS)

    def count(batches):
        words, counts, marks = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, _U)
        for context, tokens in _held(batches):
            w, c = _summed(tokens, None)
            words, counts = _summed(np.concatenate([words, w]), np.concatenate([counts, c]))
            pairs = _pair(context, tokens)
            marks = np.union1d(marks, pairs[pairs % _U(MARKED) == 0])
            if len(words) > HELD:
                yield sent(words, counts, marks)
                words, counts, marks = words[:0], counts[:0], marks[:0]
        if len(words):
            yield sent(words, counts, marks)

    return count


#: Thresholds by which the common words are picked: counts of 1, 2, 4, ...
POWERS = 48
_WORDS = f"{_MESSAGE}, tokens bigint, ends bigint, marks bigint, {', '.join(f'least{j} bigint' for j in range(POWERS))}"


def _folded(parts, fold):
    """Arrays of messages, added up whenever HELD entries are there, so that a shard holds its distinct ones only."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n > HELD + len(held[0][0]):
            held = [fold(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            n = len(held[0][0])
    return fold(*(np.concatenate(x) for x in zip(*held, strict=True))) if held else None


def _merge_words(table: pa.Table) -> pa.Table:
    kinds, cells = table.column("kind").to_pylist(), table.column("payload")

    def parts(kind: int):
        return (unpack(cell.as_py()) for k, cell in zip(kinds, cells, strict=True) if k == kind)

    words, counts = _folded(parts(0), _summed) or (np.zeros(0, _U), np.zeros(0, np.int64))
    (marks,) = _folded(parts(1), lambda m: (np.unique(m),)) or (np.zeros(0, _U),)
    least = [int((counts >= 1 << j).sum()) for j in range(POWERS)]
    row = (table.column("shard")[0].as_py(), 0, pack(words, counts), int(counts.sum()), int(counts[words == END].sum()), len(marks), *least)
    names = [*_NAMES, "tokens", "ends", "marks", *(f"least{j}" for j in range(POWERS))]
    return pa.Table.from_batches([_batch([row], names, [*_KINDS, *[pa.int64()] * (3 + POWERS)])])


def _frequent(least: int):
    def frequent(batches):
        for batch in batches:
            for cell in batch.column(0):
                words, counts = unpack(cell.as_py())
                kept = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array(words[kept].view(np.int64)), pa.array(counts[kept].astype(np.int64))], ["word", "n"])

    return frequent


def _count_pairs(shards: int, common):
    def count(batches):
        for context, tokens in _held(batches):
            rows = [(s, 1, pack(*arrays)) for s, *arrays in Pairs(context, tokens, common.value, shards).messages()]
            yield _batch(rows, _NAMES, _KINDS)

    return count


def _merge_pairs(word_shards: int, common):
    """Kind 1: a shard's pairs; 2: its question to each shard of words (payload: own shard, rare words)."""

    def merge(table: pa.Table) -> pa.Table:
        shard, cells = table.column("shard")[0].as_py(), table.column("payload")

        def far_fold(u, v, c):
            _, c, u, v = _summed(_pair(u, v), c, u, v)
            return u, v, c

        def near_parts():
            for cell in cells:
                steps, times, *_ = unpack(cell.as_py())
                yield np.cumsum(_numbers(steps)), times

        def far_parts():
            for cell in cells:
                *_, u, v, rare_u, rare_v, times = unpack(cell.as_py())
                yield *far_hashes(u, v, rare_u, rare_v, common.value), times

        near, far = _folded(near_parts(), _summed), _folded(far_parts(), far_fold)
        u, v, c = far
        pu, pv = common.value.places(u), common.value.places(v)
        pu[u == START] = common.value.size - 1
        coded = pack(_planes(np.diff(near[0], prepend=0)), _small(near[1]), *far_coded(pu, pv, u, v), _small(c))
        rows = [(shard, 1, coded)]
        asked = np.unique(v[pv < 0])
        order, cuts = _shards(asked % _U(word_shards), word_shards)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            rows.append((s, 2, pack(np.array([shard]), asked[order[cuts[s] : cuts[s + 1]]])))
        return pa.Table.from_batches([_batch(rows, _NAMES, _KINDS)])

    return merge


def lookup(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of keys in a sorted table; 0 where it has none."""
    if not len(table):
        return np.zeros(len(keys), values.dtype)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0)


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """Questions (left) to a shard of words (right) become answers to the shards that asked."""
    words, counts = unpack(right.column("payload")[0].as_py()) if right.num_rows else (np.zeros(0, _U), np.zeros(0, np.int64))
    rows = []
    for payload in left.column("payload").to_pylist():
        asker, asked = unpack(payload)
        rows.append((int(asker[0]), pack(asked, lookup(asked, words, counts))))
    return pa.Table.from_batches([_batch(rows, ["shard", "payload"], [pa.int64(), pa.binary()])])


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(range / length) bits a value, searched as it is stored.

    The low bits of the values stand one after the other; the high parts are
    unary, a one for each value after a zero for each step of the high part. A
    count of zeros before each word of 64 bits finds the values of a high part.
    """

    def __init__(self, values: np.ndarray):
        self.n = n = len(values)
        self.top = int(values[-1]) if n else 0
        self.low_bits = min(56, max(0, (self.top // max(1, n)).bit_length() - 1))
        width = _U(self.low_bits)
        low = values & ((_U(1) << width) - _U(1))
        bits = np.empty((n, self.low_bits), np.uint8)
        for j in range(self.low_bits):
            bits[:, j] = (low >> _U(j)) & _U(1)
        self.low = self._words(bits.reshape(-1))
        high = (values >> width).astype(np.int64)
        unary = np.zeros(n + (int(high[-1]) if n else 0) + 2, np.uint8)
        unary[high + np.arange(n)] = 1
        self.high = self._words(unary)
        zeros = 64 - np.bitwise_count(self.high).astype(np.int64)
        self.zeros = np.concatenate([[0], np.cumsum(zeros)[:-1]])

    @staticmethod
    def _words(bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits, bitorder="little")
        return np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """The position of the k-th zero of the high parts, from 0 on."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        left = k - self.zeros[word]
        bits, at = ~self.high[word], np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count((bits >> at.astype(_U)) & _U((1 << half) - 1)).astype(np.int64)
            up = ones <= left
            left -= np.where(up, ones, 0)
            at += np.where(up, half, 0)
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(_U)
        pair = (self.low[word] >> shift) | ((self.low[word + 1] << _U(1)) << (_U(63) - shift))
        return pair & _U((1 << self.low_bits) - 1)

    def successor(self, keys: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None):
        """(place, found): the first value from `begin` on, and before `end`, that is not below the key, and whether it equals it."""
        keys = keys.astype(_U)
        high = np.minimum(keys, _U(self.top)) >> _U(self.low_bits)
        high = high.astype(np.int64)
        stop = self._zero(high) - high
        start = np.zeros(len(keys), np.int64)
        later = high > 0
        start[later] = self._zero(high[later] - 1) - (high[later] - 1)
        start = np.maximum(start, begin)
        stop = np.maximum(start, stop if end is None else np.minimum(stop, end))
        last, low = stop.copy(), keys & _U((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(start < stop)
        while len(open_):
            middle = (start[open_] + stop[open_]) >> 1
            below = self._low(middle) < low[open_]
            start[open_[below]] = middle[below] + 1
            stop[open_[~below]] = middle[~below]
            open_ = open_[start[open_] < stop[open_]]
        beyond = keys > _U(self.top)
        start[beyond] = (self.n if end is None else np.maximum(end, begin)[beyond])
        found = ~beyond & (start < last)
        found[found] = self._low(start[found]) == low[found]
        return start, found

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places i: the high part is the number of zeros before the i-th one."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(ones, i, "right") - 1
        left, bits, at = i - ones[word], self.high[word], np.zeros(len(i), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count((bits >> at.astype(_U)) & _U((1 << half) - 1)).astype(np.int64)
            up = count <= left
            left -= np.where(up, count, 0)
            at += np.where(up, half, 0)
        high = (word * 64 + at - i).astype(_U)
        return (high << _U(self.low_bits)) | self._low(i)


class Trie:
    """Contexts, pointers and successors of one shard, with a rounded number per successor."""

    def __init__(self, u: np.ndarray, v: np.ndarray, numbers: np.ndarray):
        contexts, first = np.unique(u, return_inverse=True)
        words, second = np.unique(v, return_inverse=True)
        place = first.astype(np.int64) * len(words) + second
        order = np.argsort(place)
        self.contexts, self.words = EliasFano(contexts), EliasFano(words)
        counts = np.bincount(first, minlength=len(contexts))
        self.pointers = EliasFano(np.concatenate([[0], np.cumsum(counts)]).astype(_U))
        self.successors = EliasFano(place[order].astype(_U))
        self.steps = np.clip(np.rint(numbers[order] / STEP), 1, 65535).astype(np.uint16)

    def find(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The pairs' numbers of STEPs, 0 for pairs not held: the context's range, then the successor within it."""
        found = np.zeros(len(u), np.uint16)
        second, held = self.words.successor(v)
        at = np.flatnonzero(held)
        distinct, back = np.unique(u[at], return_inverse=True)
        first, known = self.contexts.successor(distinct)
        at, back = at[known[back]], back[known[back]]
        places = np.where(known, first, 0)
        begin, end = self.pointers.access(places).astype(np.int64), self.pointers.access(places + 1).astype(np.int64)
        place, held = self.successors.successor(places[back] * self.words.n + second[at], begin[back], end[back])
        found[at[held]] = self.steps[place[held]]
        return found


def _build(tokens: int, types: int, common):
    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, wide = [], common.value
        answers = [unpack(cell.as_py()) for cell in right.column("payload")] or [(np.zeros(0, _U), np.zeros(0, np.int64))]
        words, counts = (np.concatenate(x) for x in zip(*answers, strict=True))
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        for shard, cell in zip(left.column("shard").to_pylist(), left.column("payload"), strict=True):
            steps, times, fu, fv, rare_u, rare_v, far_times = unpack(cell.as_py())
            keys = np.cumsum(_numbers(steps))
            u, v = far_hashes(fu, fv, rare_u, rare_v, wide)
            places = _numbers(fv) - 1
            far = np.where(places >= 0, wide.counts[np.maximum(places, 0)], lookup(v, words, counts))

            def trie(u, v, times, c):
                below = (c + 0.5) / (tokens + 0.5 * (types + 1))
                return Trie(u.astype(_U), v.astype(_U), np.log10(1 + times.astype(np.int64) / (K * below)))

            near = trie(keys // wide.size, keys % wide.size, times, wide.counts[keys % wide.size])
            tries = near, trie(u, v, far_times, far)
            rows.append((shard, 1, zstandard.compress(pickle.dumps(tries, protocol=5), 1)))
        return pa.Table.from_batches([_batch(rows, _NAMES, _KINDS)])

    return build


def _ask(shards: int, word_shards: int, base: float, common):
    """Kind 0 and 1: a batch's rare words and its pairs for a shard; 2: its ids, its sums so far and its row numbers."""
    names, kinds = ["shard", "kind", "batch", "payload"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def out(number, ids, lengths, parts):
        rows, context, tokens = (np.concatenate(x) for x in zip(*parts, strict=True))
        wide, n, sent = common.value, len(ids), []
        pairs = Pairs(context, tokens, wide, shards)
        for s, steps, _, *far, _ in pairs.messages():
            sent.append((s, 1, number, pack(steps, *far)))
        known = pairs.v >= 0
        at, who = pairs.v[known], rows[known]
        sums = _sums(who, wide.counts[at], tokens[known], n, base)
        rare = np.flatnonzero(~known)
        order = rare[np.argsort(tokens[rare])]
        words, times = _summed(tokens[rare], None)
        by, cuts = _shards(words % _U(word_shards), word_shards)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            sent.append((shards + s, 0, number, pack(words[by[cuts[s] : cuts[s + 1]]])))
        begin = np.cumsum(times) - times
        order = order[np.repeat(begin[by] - np.cumsum(times[by]) + times[by], times[by]) + np.arange(len(order))]
        where = [(x[2], rows[x[4]]) for x in (pairs.near, pairs.far)]
        own = [(_small(t), _planes(r)) for t, r in ((times[by], rows[order]), *where)]
        sent.append((number % (shards + word_shards), 2, number, pack(np.array(ids, object), np.concatenate(lengths), sums, own)))
        return _batch(sent, names, kinds)

    def ask(batches):
        number = TaskContext.get().partitionId() << 32
        ids, lengths, parts, size = [], [], [], 0
        for batch in batches:
            keys = batch.column(1).to_pylist()
            for block in blocks(batch.column(0)):
                if size and size + len(block.data) > BATCH_BYTES:
                    number += 1
                    yield out(number, ids, lengths, parts)
                    ids, lengths, parts, size = [], [], [], 0
                rows, context, tokens = _sequence(block)
                parts.append((rows + len(ids), context, tokens))
                lengths.append(block.last - block.first + 1)
                ids += keys[block.rows.start : block.rows.stop]
                size += len(block.data)
        if ids:
            number += 1
            yield out(number, ids, lengths, parts)

    return ask


def _sums(rows: np.ndarray, counts: np.ndarray, tokens: np.ndarray | None, n: int, base: float) -> list[np.ndarray]:
    """Per row the sums over words with these counts: log p(v), known ones, and log K / (c(u) + K) of the words as contexts."""
    context = np.log10(K / (counts + K))
    if tokens is not None:
        context[tokens == END] = 0.0
    return [
        np.bincount(rows, np.log10((counts + 0.5) / base), n),
        np.bincount(rows, counts > 0, n),
        np.bincount(rows, context, n),
    ]


def _replies(common):
    def reply(left: pa.Table, right: pa.Table) -> pa.Table:
        words, counts, tries, wide = np.zeros(0, _U), np.zeros(0, np.int64), None, common.value
        for kind, cell in zip(right.column("kind").to_pylist(), right.column("payload"), strict=True):
            if kind == 0:
                words, counts = unpack(cell.as_py())
            else:
                tries = pickle.loads(zstandard.decompress(cell.as_py()))
        rows = []
        for shard, kind, batch, cell in zip(*(left.column(c).to_pylist() for c in ("shard", "kind", "batch")), left.column("payload"), strict=True):
            payload = cell.as_py()
            if kind == 0:
                payload = pack(_small(lookup(unpack(payload)[0], words, counts)))
            elif kind == 1:
                steps, fu, fv, rare_u, rare_v = unpack(payload)
                keys = np.cumsum(_numbers(steps))
                asked = (keys // wide.size, keys % wide.size), far_hashes(fu, fv, rare_u, rare_v, wide)
                if tries is None:
                    payload = pack(*(np.zeros(len(u), np.uint16) for u, _ in asked))
                else:
                    payload = pack(*(trie.find(u, v) for trie, (u, v) in zip(tries, asked, strict=True)))
            rows.append((batch, kind, shard, payload))
        return pa.Table.from_batches([_batch(rows, ["batch", "kind", "shard", "payload"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()])])

    return reply


def _gather(start: float, base: float):
    """All replies for one batch, in order of their shards, meet its rows."""

    def gather(table: pa.Table) -> pa.Table:
        cells = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "shard", "payload")), strict=True), key=lambda x: x[:2])
        parts = {k: [unpack(payload) for kind, _, payload in cells if kind == k] for k in (0, 1, 2)}
        ids, lengths, sums, own = parts[2][0]
        n = len(ids)
        values = [np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts[0])])]
        values += [np.concatenate([np.zeros(0, np.uint16), *(p[j] for p in parts[1])]) for j in (0, 1)]
        (words, near, far) = ((np.repeat(v, t), _numbers(r)) for v, (t, r) in zip(values, own, strict=True))
        total, known, more = (a + b for a, b in zip(sums, _sums(words[1], words[0], None, n, base), strict=True))
        for steps, rows in (near, far):
            more = more + np.bincount(rows, steps * STEP, n)
        return pa.table(
            {
                "doc_id": pa.array(ids.tolist(), pa.int64()),
                "n_tokens": pa.array(lengths.astype(np.int64)),
                "n_known": pa.array(known.astype(np.int64)),
                "base_score": pa.array(total.astype(float)),
                "score": pa.array((total + more + start).astype(float)),
            }
        )

    return gather


class Model:
    """Tables of a trained model: tries and words by shard, below a shared path; the common words."""

    def __init__(self, tables: DataFrame, shards: int, word_shards: int, tokens: int, types: int, ends: int, common: Common):
        self.tables, self.shards, self.word_shards = tables, shards, word_shards
        self.tokens, self.types, self.ends, self.common = tokens, types, ends, common


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts over all rows of `docs`, merged by shard and written as tables."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(f"`{text}`"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0))).first()[0]
    word_shards = max(8, math.ceil(size / WORD_BYTES))
    path = staging_path(spark, "words")
    counted = map_arrow(texts, _count_words(word_shards), _MESSAGE)
    counted.groupBy("shard").applyInArrow(_merge_words, _WORDS).write.parquet(path)

    def words() -> DataFrame:
        # Read anew: grouping two selections of one frame together mixes up their columns.
        return spark.read.parquet(path)

    figures = ["tokens", "ends", "marks", *(f"least{j}" for j in range(POWERS))]
    tokens, ends, marks, *least = map(int, words().agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in figures]).first())
    power = next(j for j in range(POWERS) if least[j] <= COMMON)
    frequent = map_arrow(words().select("payload"), _frequent(1 << power), "word bigint, n bigint").toArrow()
    picked, times = frequent.column("word").to_numpy().view(_U), frequent.column("n").to_numpy()
    others = picked != END
    common = Common(np.append(picked[others], END), np.append(times[others], ends))
    shared = spark.sparkContext.broadcast(common)

    shards = max(8, math.ceil(marks * MARKED / SHARD_PAIRS), math.ceil(size / SHARD_BYTES))
    pairs_path = staging_path(spark, "pairs")
    counted = map_arrow(texts, _count_pairs(shards, shared), _MESSAGE)
    counted.groupBy("shard").applyInArrow(_merge_pairs(word_shards, shared), _MESSAGE).write.parquet(pairs_path)

    def part(kind: int) -> DataFrame:
        return spark.read.parquet(pairs_path).filter(F.col("kind") == kind)

    answers = part(2).groupBy("shard").cogroup(words().groupBy("shard")).applyInArrow(_answer, "shard bigint, payload binary")
    tries = part(1).groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_build(tokens, least[0], shared), _MESSAGE)
    out = staging_path(spark, "model")
    tries.write.parquet(out)
    tables = spark.read.parquet(out).unionByName(words().select((F.col("shard") + shards).alias("shard"), "kind", "payload"))
    return Model(tables, shards, word_shards, tokens, least[0], ends, common)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row."""
    rows = docs.select(F.col(f"`{text}`"), F.col(f"`{key}`").cast("bigint"))
    common = docs.sparkSession.sparkContext.broadcast(model.common)
    base = model.tokens + 0.5 * (model.types + 1)
    asked = map_arrow(rows, _ask(model.shards, model.word_shards, base, common), "shard bigint, kind int, batch bigint, payload binary")
    replies = asked.groupBy("shard").cogroup(model.tables.groupBy("shard")).applyInArrow(
        _replies(common), "batch bigint, kind int, shard bigint, payload binary"
    )
    start = math.log10(K / (model.ends + K))
    return replies.groupBy("batch").applyInArrow(
        _gather(start, base), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )
