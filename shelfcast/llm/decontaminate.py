"""Benchmark decontamination: retrieval in a latent space and by rare words, then longest common subsequences.

Inverse document frequencies of hashed words are counted over all documents. The
benchmark's TF-IDF rows are factored by a distributed randomised SVD: Spark sums
the row products of A'(A W) per word, and each power round is orthonormalised on
the driver. The rank is the number of items, so the basis keeps each item whole.
Items are searched in bands by length, with windows of the least power of two that
holds a band's items, a quarter of it apart. Every window of every text is compared
with every item of its band by cosine (the norm counts all of a window's words); a window is projected if the sum of its words' greatest
weights in any item, which bounds its cosines, reaches the least cosine.

Beside that, an exact path misses no pair: with all but `missing` words of an item
in the subsequence, at least HITS of its missing + HITS rarest words are in one
stretch of the text. Candidates of both paths are confirmed by the longest common
subsequence of the item and a stretch of the text; whether that leaks the item is
decided by how much of its answer, its last quarter, is in that subsequence. RUN
words of an item in one piece leak it by themselves, at any share. A stretch has as many words as
the item, LEAST at least, and LEAST more.

The benchmark is the stated query set. Its rows go to all tasks as one variable
while it has at most MAX_ITEMS rows; a larger one is taken in blocks of about that
size, each with a basis of its own.

Defined results: null or empty texts and items match nothing; items with fewer
than MIN_WORDS words are matched as whole runs of words only; a repeated item is
reported under each of its ids; the best stretch of a pair counts.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shipping import map_arrow
from shelfcast.llm.words import blocks, mix

FEATURES = 1 << 16
ROUNDS = 2
MAX_ITEMS = 512
LEAST = 32
COSINE = 0.35
LCS = 0.7
ANSWER = 0.5
MIN_WORDS = 4
HITS = 3
RUN = 13
#: Windows projected at a time.
PART = 2048

_U = np.uint64


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(48)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """How many documents hold each hashed word, and how many documents there are."""

    def count(batches):
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for block in blocks(batch.column(0)):
                seen = np.unique(block.row_of_word() * FEATURES + _features(block.hashes()))
                total += np.bincount(seen & (FEATURES - 1), minlength=FEATURES)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used.tolist()], pa.int64()), pa.array([n, *total[used].tolist()], pa.int64())], ["f", "n"]
        )

    rows = map_arrow(docs.select(F.col(f"`{text}`")), count, "f bigint, n bigint").groupBy("f").agg(F.sum("n").alias("n"))
    frequencies, n = np.zeros(FEATURES), 0
    for f, count_f in rows.toLocalIterator():
        if f < 0:
            n = count_f
        else:
            frequencies[f] = count_f
    return frequencies, n


def _rows(column: pa.Array, idf: np.ndarray):
    """(features, TF-IDF values of unit length) of every row."""
    for block in blocks(column):
        f = _features(block.hashes())
        for a, b in zip(block.first.tolist(), block.last.tolist(), strict=True):
            used, counts = np.unique(f[a:b], return_counts=True)
            values = counts * idf[used]
            yield used, values / max(np.linalg.norm(values), 1e-12)


def latent_basis(items: DataFrame, idf: np.ndarray, text: str = "text") -> np.ndarray:
    """Orthonormal columns (FEATURES x number of items) that span the right singular vectors of the items' rows."""
    rank = max(1, items.count())
    basis = np.random.default_rng(7).standard_normal((FEATURES, rank)).astype(np.float32)
    for _ in range(ROUNDS):
        sent = items.sparkSession.sparkContext.broadcast(basis)

        def product(batches, sent=sent):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for used, values in _rows(batch.column(0), idf):
                    image = values @ sent.value[used]
                    for f, v in zip(used.tolist(), values.tolist(), strict=True):
                        total[f] = total[f] + v * image if f in total else v * image
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.int64()), pa.array([x.astype(float) for x in total.values()], pa.list_(pa.float64()))],
                    ["f", "v"],
                )

        parts = map_arrow(items.select(F.col(f"`{text}`")), product, "f bigint, v array<double>")
        summed = parts.select("f", F.posexplode("v").alias("k", "x")).groupBy("f", "k").agg(F.sum("x").alias("x"))
        rows = summed.groupBy("f").agg(F.array_sort(F.collect_list(F.struct("k", "x")))["x"].alias("v"))
        sums = {f: np.array(v) for f, v in rows.toLocalIterator()}
        basis = np.zeros((FEATURES, rank), np.float32)
        if sums:
            left, strengths, _ = np.linalg.svd(np.stack(list(sums.values())), full_matrices=False)
            basis[list(sums), : left.shape[1]] = np.where(strengths > 1e-9 * max(strengths.max(), 1e-300), left, 0)
        sent.unpersist()
    return basis


def common_subsequence(a: list, b: list) -> list[int]:
    """Places in `a` of a longest common subsequence of a and b."""
    n, m = len(a), len(b)
    y, x = np.array([hash(t) for t in b]), [hash(t) for t in a]
    best = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n):
        best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], (best[i, :-1] + 1) * (y == x[i])))
    places, j = [], m
    for i in range(n, 0, -1):
        if best[i, j] == best[i - 1, j]:
            continue
        # The leftmost end in b that still gives this length; it matches a[i - 1].
        j = int(np.searchsorted(best[i, : j + 1], best[i, j]))
        places.append(i - 1)
        j -= 1
    return places[::-1]


def _needed(n: int) -> int:
    """The least length of a common subsequence that has the share LCS of n words."""
    return next(k for k in range(n + 1) if k / n >= LCS)


def _ranges(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after the other, and where each range starts among them."""
    sizes = ends - begins
    starts = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begins - starts, sizes), starts


def _runs(hashes: np.ndarray) -> np.ndarray:
    """A hash of every run of RUN words."""
    total = max(0, len(hashes) - RUN + 1)
    out = np.zeros(total, _U)
    for j in range(RUN):
        out = out * _U(0x9E3779B97F4A7C15) + hashes[j : j + total]
    return mix(out)


class _Searcher:
    def __init__(self, ids: list[int], column: pa.Array, idf: np.ndarray, used: np.ndarray, basis: np.ndarray):
        """`basis` holds the rows of the features `used`; all its other rows are 0."""
        self.idf2 = idf**2
        self.place = np.full(FEATURES, -1, np.int32)
        self.place[used] = np.arange(len(used))
        self.vectors = (basis * idf[used, None]).astype(np.float32)
        self.idf, self.rows = idf, list(_rows(column, idf))
        self.items = np.stack([values @ basis[self.place[f]] for f, values in self.rows]).astype(np.float32)
        self.ids, self.words = ids, []
        for block in blocks(column):
            h = block.hashes()
            self.words += [h[a:b].tolist() for a, b in zip(block.first, block.last, strict=True)]
        self.counts = [Counter(w) for w in self.words]
        self.tiny = {tuple(w): [] for w in self.words if 0 < len(w) < MIN_WORDS}
        for i, w in enumerate(self.words):
            if tuple(w) in self.tiny:
                self.tiny[tuple(w)].append(i)
        self.stretch = np.array([max(len(w), LEAST) + LEAST for w in self.words], np.int64)
        self.hits = np.array([min(HITS, _needed(len(w))) if w else 0 for w in self.words], np.int64)
        rare: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w) >= MIN_WORDS:
                order = sorted(w, key=lambda x: (-idf[x >> 48], x))
                for x in set(order[: len(w) - _needed(len(w)) + int(self.hits[i])]):
                    rare.setdefault(x, []).append(i)
        self.keys = np.array(sorted(rare), _U)
        self.listed = np.array([i for x in sorted(rare) for i in rare[x]], np.int64)
        self.bounds = np.cumsum([0, *[len(rare[x]) for x in sorted(rare)]])
        self.known = np.zeros(FEATURES, bool)
        self.known[_features(self.keys)] = True
        self.runs: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            for k, run in enumerate(_runs(np.array(w, _U)).tolist()):
                self.runs.setdefault(run, []).append((i, k))
        self.run_known = np.zeros(FEATURES, bool)
        self.run_known[_features(np.array(list(self.runs), _U))] = True
        bands: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w) >= MIN_WORDS:
                bands.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        self.windows = [self.sought(size, size // 4, bands[size]) for size in sorted(bands)]

    def by_rare_words(self, block, hashes, f):
        """(row, item, begin, end) of all places of the block where enough rare words of an item are near each other."""
        at = np.flatnonzero(self.known[f])
        if not len(at):
            return
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[key] == hashes[at]
        at, key = at[same], key[same]
        flat, _ = _ranges(self.bounds[key], self.bounds[key + 1])
        item, at = self.listed[flat], np.repeat(at, self.bounds[key + 1] - self.bounds[key])
        row = np.searchsorted(block.last, at, "right")
        order = np.lexsort((at, item, row))
        item, at, row = item[order], at[order], row[order]
        last = np.arange(len(at)) + self.hits[item] - 1
        ok = last < len(at)
        first, last = np.flatnonzero(ok), last[ok]
        ok = (row[first] == row[last]) & (item[first] == item[last]) & (at[last] - at[first] < self.stretch[item[first]])
        first, last = first[ok], last[ok]
        size = self.stretch[item[first]]
        yield from zip(
            row[first].tolist(), item[first].tolist(), (at[last] - size + 1).tolist(), (at[first] + size).tolist(), strict=True
        )

    def by_runs(self, block, hashes):
        """(row, item, begin, end) of the stretches around RUN words of an item in one piece."""
        runs = _runs(hashes)
        for at in np.flatnonzero(self.run_known[_features(runs)]).tolist():
            row = int(np.searchsorted(block.last, at, "right"))
            for item, k in self.runs.get(int(runs[at]), ()):
                if at + RUN <= block.last[row] and hashes[at : at + RUN].tolist() == self.words[item][k : k + RUN]:
                    size = int(self.stretch[item])
                    yield row, item, at + RUN - size, at + size

    def by_cosine(self, block, f):
        """(row, item, begin, end) of the stretches around windows that are like an item."""
        first, last = np.asarray(block.first, np.int64), np.asarray(block.last, np.int64)
        place = self.place[f]
        inside = np.flatnonzero(place >= 0)
        mass, most_alike = np.zeros(len(f) + 1), np.zeros(len(f) + 1)
        np.cumsum(self.idf2[f], out=mass[1:])
        for window, stride, items, greatest in self.windows:
            np.cumsum(greatest[f], out=most_alike[1:])
            most = np.maximum(last - first - window, 0)
            number = np.where(last > first, 1 + -(-most // stride), 0)
            step, starts = _ranges(np.zeros_like(number), number)
            rows = np.repeat(np.arange(len(first)), number)
            begins = first[rows] + np.minimum(step * stride, most[rows])
            ends = np.minimum(begins + window, last[rows])
            norm = np.sqrt(np.maximum(mass[ends] - mass[begins], 1e-9))
            likely = np.flatnonzero(most_alike[ends] - most_alike[begins] >= 0.999 * COSINE * norm)
            low, high = np.searchsorted(inside, begins[likely]), np.searchsorted(inside, ends[likely])
            likely, low, high = likely[high > low], low[high > low], high[high > low]
            for k in range(0, len(likely), PART):
                part = likely[k : k + PART]
                flat, starts = _ranges(low[k : k + PART], high[k : k + PART])
                image = np.add.reduceat(self.vectors[place[inside[flat]]], starts, axis=0)
                cosine = image @ self.items[items].T
                for w, i in zip(*np.nonzero(cosine >= COSINE * norm[part][:, None]), strict=True):
                    w, item = part[w], int(items[i])
                    size = max(len(self.words[item]), LEAST)
                    yield int(rows[w]), item, int(begins[w]) - size // 2, int(ends[w]) + size // 2

    def sought(self, window: int, stride: int, items: list[int]) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(window, stride, items that are looked for with it, per feature the greatest addend to a cosine with one of them)."""
        greatest = np.zeros(FEATURES)
        for i in items:
            f, values = self.rows[i]
            greatest[f] = np.maximum(greatest[f], values * self.idf[f])
        return window, stride, np.array(items, np.int64), greatest

    def confirm(self, item: int, near: list[int], needed: int) -> tuple[float, float]:
        """The greatest (share, answer share) of the item in a stretch of the words `near`, with `needed` words at least."""
        words, size, wanted = self.words[item], int(self.stretch[item]), self.counts[item]
        best = (0.0, 0.0)
        at = [k for k, x in enumerate(near) if x in wanted]
        if (wanted & Counter([near[k] for k in at])).total() < needed:
            return best
        cut = len(words) * 3 // 4
        # Places in `at` that bound the stretches from a word of the item on, without those that are part of the one before.
        ends = [bisect.bisect_left(at, begin + size) for begin in at]
        bounds = [(k, end) for k, end in enumerate(ends) if not k or end > ends[k - 1]]
        # What several stretches cover bounds the shares of each of them.
        todo = [(0, len(bounds) - 1)]
        while todo and best[0] < 1.0:
            low, high = todo.pop()
            kept = [near[k] for k in at[bounds[low][0] : bounds[high][1]]]
            if (wanted & Counter(kept)).total() < max(needed, best[0] * len(words) - 0.5):
                continue
            places = common_subsequence(words, kept)
            share = len(places) / len(words)
            if len(places) < needed or share < best[0]:
                continue
            if low == high:
                best = max(best, (share, sum(p >= cut for p in places) / (len(words) - cut)))
            else:
                middle = (low + high) // 2
                todo += [(middle + 1, high), (low, middle)]
        return best

    def search(self, block):
        """{(row in block, item): (share of the item, answer share, leaked)} of confirmed pairs."""
        hashes = block.hashes()
        f = _features(hashes)
        areas: dict[tuple[int, int], list[tuple[int, int]]] = {}
        runs = list(self.by_runs(block, hashes))
        whole = {(row, item) for row, item, _, _ in runs}
        for path in (runs, self.by_rare_words(block, hashes, f), self.by_cosine(block, f)):
            for row, item, begin, end in path:
                areas.setdefault((row, item), []).append((max(begin, int(block.first[row])), min(end, int(block.last[row]))))
        found: dict[tuple[int, int], tuple[float, float, bool]] = {}
        for (row, item), parts in areas.items():
            parts.sort()
            joined: list[list[int]] = []
            for begin, end in parts:
                if joined and begin <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([begin, end])
            run, needed = (row, item) in whole, _needed(len(self.words[item]))
            least = min(RUN, needed) if run else needed
            share, answer = max(self.confirm(item, hashes[begin:end].tolist(), least) for begin, end in joined)
            if share >= LCS or run:
                found[row, item] = (share, answer, run or answer >= ANSWER)
        if self.tiny:
            for row, (a, b) in enumerate(zip(block.first.tolist(), block.last.tolist(), strict=True)):
                run = hashes[a:b].tolist()
                for words, items in self.tiny.items():
                    if any(tuple(run[i : i + len(words)]) == words for i in range(len(run) - len(words) + 1)):
                        found.update({(row, i): (1.0, 1.0, True) for i in items})
        return found


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, lcs_share, answer_share, leaked): confirmed pairs; leaked needs the answer's share or RUN words in one piece."""
    frequencies, n = document_frequencies(docs, text)
    idf = np.log((n + 1) / (frequencies + 1)) + 0.1
    context = docs.sparkSession.sparkContext
    blocks_of = max(1, -(-items.count() // MAX_ITEMS))
    schema = "doc_id bigint, item_id bigint, lcs_share double, answer_share double, leaked boolean"
    result = None
    for k in range(blocks_of):
        chosen = items.filter(F.pmod(F.xxhash64(F.col(item)), F.lit(blocks_of)) == k).select(item, text)
        part = chosen.toArrow()
        if not part.num_rows:
            continue
        basis = latent_basis(chosen, idf, text=text)
        used = np.flatnonzero(basis.any(axis=1))
        sent = context.broadcast((part.column(0).to_pylist(), part.column(1).combine_chunks(), idf, used, basis[used]))

        def search(batches, sent=sent):
            searcher = _Searcher(*sent.value)
            for batch in batches:
                ids, out = batch.column(0).to_pylist(), []
                for block in blocks(batch.column(1)):
                    for (row, i), judged in searcher.search(block).items():
                        out.append((ids[block.rows.start + row], searcher.ids[i], *judged))
                if out:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()), strict=True)],
                        ["doc_id", "item_id", "lcs_share", "answer_share", "leaked"],
                    )

        rows = docs.select(F.col(f"`{key}`").cast("bigint"), F.col(f"`{text}`"))
        found = map_arrow(rows, search, schema)
        result = found if result is None else result.unionByName(found)
    if result is None:
        result = docs.sparkSession.createDataFrame([], schema)
    return result.distinct()


def drop_leaked(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a leaked item, with all their columns.

    Whether a text leaks depends on nothing but the text, so rows are told apart
    by a 64-bit hash of it: rows without an id go like others, and of repeated
    rows all or none.
    """
    key = "__text"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`")))
    bad = leaks(keyed, items, key, text=text).filter("leaked").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
