"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct 5-word shingles. The set's parity sketch
has one bit per cell, toggled by each shingle that hashes there, so the Hamming
distance of two sketches never exceeds the size of the sets' symmetric
difference. Sets that link (Jaccard of 0.8 or more) differ in at most a ninth of
their summed sizes. In a band of sizes this gives a bound d; a sketch cut into
k > d blocks must then agree in at least k - d blocks with every partner. A
block has 2^32 cells, so that sets without a common shingle hardly ever agree
in one; it is held as the XOR of random 64-bit numbers of its set cells, which
is zero for a block of zeros. Each block, with its place and band, is a join key.

A block of zeros says little. A set with more than d blocks that are not zero
agrees with each partner in one of those, so only sets with d or fewer such
blocks emit their zero blocks too. No agreement is lost by this.

A partner shares at least as many keys as a set has blocks that are not zero
beyond d; a set that shares fewer with all others together leaves. Members of
one key are put under the key's smallest member (its leader), not paired with
each other. Keys travel packed: a task's keys of one part of the hash range are
one row of compressed columns, so a key takes the same bytes in however many
parts the keys are dealt.

Sets are then dealt into chunks of bounded size by their smallest leader, and
the sets of a chunk compared as a block with exact intersections. Where members
of a leader are in several chunks, the one that shares the most keys (its
pivot) visits these chunks. Members that links inside a block join to the pivot
need no comparison with each other. Each other member visits those chunks of its
leader with which it has keys enough in common. So every pair that shares a key is verified or already joined, a large
group of near copies costs a visit for each of its chunks and not for each two
of them, and a spanning forest of the links goes on to the components.

Defined results: a null text, or one without words, has an empty set, which
links with nothing; equal sets are one class from the start, kept once per task
before the shuffle; rows repeated under one id are the same document; further
columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.shipping import map_arrow
from shelfcast.llm.words import blocks, mix, shingle_sets, signed
from shelfcast.session import staging_path

#: Words of a shingle; sets link at 100 * intersection >= 80 * union.
SHINGLE = 5
PERCENT = 80
#: Shingles, counted with a share for each set, that a chunk of sets holds at most, but for one larger set.
CHUNK = 400_000
SET_SHARE = 400
#: Rows of candidate sets up to which they are broadcast to find texts and shingles; beyond, they are joined.
BROADCAST_IDS = 2_000_000
#: Keys that a task packs at a time, and that one part of the hash range holds about.
PACKED_KEYS = 1 << 19
PART_KEYS = 1 << 20
#: Packed keys of a batch of rows, about.
BATCH_KEYS = 100_000
#: Keys of a set, nearly: a share of its shingles and some more.
KEYS_PER_SHINGLE, KEYS_PER_SET = 0.6, 4
#: Bits of a key that tell it from the others of its part; a chance meeting costs one more comparison.
KEY_BITS = 40
#: Classes a task remembers to emit equal sets once; forgetting costs repeated rows only.
REMEMBERED = 500_000

#: The low bits of a tag hold how many keys a set shares with each partner at least; the rest, the band.
NEED_BITS = 20
NEED = (1 << NEED_BITS) - 1

_U = np.uint64
#: Cells of a block: the low 32 bits of a shingle's hash.
_CELLS = _U(0xFFFFFFFF)


def most_apart(a: int, b: int) -> int:
    """The largest symmetric difference at which sets of these sizes still link."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


class Band:
    """Pairs whose smaller set has between `low` and `high` shingles; partners reach up to `top`."""

    def __init__(self, low: int, high: int):
        self.low, self.high, self.top = low, high, high * 100 // PERCENT
        self.apart = most_apart(high, self.top)
        self.blocks = self.apart + 2 + math.ceil(0.25 * self.apart)
        self.seed = mix(np.array([low], _U))[0]

    def keys(self, members: np.ndarray) -> tuple[np.ndarray, int]:
        """The keys of a set, given by its shingles' hashes, and a tag of the band and of the keys each partner shares at least."""
        spread = mix(members ^ self.seed)
        block = ((spread >> _U(32)) * _U(self.blocks)) >> _U(32)
        order = np.argsort(block)
        block = block[order]
        used = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        sketch = np.zeros(self.blocks, _U)
        sketch[block[used]] = np.bitwise_xor.reduceat(mix(spread[order] & _CELLS), used)
        shown = np.flatnonzero(sketch)
        least = max(1, len(shown) - self.apart)
        if len(shown) <= self.apart:
            shown = np.arange(self.blocks)
        return mix(sketch[shown] ^ mix(shown.astype(_U) ^ self.seed)), self.low << NEED_BITS | min(least, NEED)


@functools.lru_cache(maxsize=None)
def _band_from(low: int) -> Band:
    return Band(low, max(low, low * 5 // 4 - 1))


@functools.lru_cache(maxsize=100_000)
def bands(size: int) -> tuple[Band, ...]:
    """The bands a set of this size takes part in."""
    found, low = [], 4
    while low <= size:
        band = _band_from(low)
        if size <= band.top and band.apart:
            found.append(band)
        low = band.high + 1
    return tuple(found)


def class_id(members: np.ndarray) -> int:
    """A 64-bit hash of the set itself; equal sets are one class."""
    salted = mix(members ^ _U(0x5851F42D4C957F2D))
    folded = np.array([salted.sum(dtype=_U) + _U(len(members)), np.bitwise_xor.reduce(salted)], _U)
    return int(signed(mix(folded + mix(folded[::-1])))[0])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(document id, set) of every row with (id, text)."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for block in blocks(batch.column(1)):
            yield from zip(ids[block.rows.start : block.rows.stop], shingle_sets(block, SHINGLE), strict=True)


def _classify(batches):
    ids, classes, sizes = [], [], []
    for doc, members in _sets(batches):
        ids.append(doc)
        classes.append(class_id(members) if len(members) else None)
        sizes.append(len(members))
        if len(ids) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "class", "n"])
            ids, classes, sizes = [], [], []
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "class", "n"])


_KEY_BYTES = KEY_BITS // 8
_ROW_BYTES = _KEY_BYTES + 8 + 8


def pack(keys: np.ndarray, owners: np.ndarray, tags: np.ndarray, of: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """(part, number, bytes) of the keys of each part, with their classes and tags; `of` is each key's place among these."""
    part = ((keys >> _U(32)) * _U(parts)) >> _U(32)
    keys = keys & _U((1 << KEY_BITS) - 1)
    order = np.lexsort((keys, part)) if parts > 1 << 64 - KEY_BITS else np.argsort(part << _U(KEY_BITS) | keys)
    part, keys, of = part[order], keys[order], of[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])).tolist()
    codec = pa.Codec("zstd", 1)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        low, owner, tag = (c.view(np.uint8).reshape(-1, 8) for c in (keys[a:b], owners[of[a:b]], tags[of[a:b]]))
        plain = np.concatenate([low[:, :_KEY_BYTES].T.ravel(), owner.ravel(), tag.T.ravel()])
        yield int(part[a]), b - a, codec.compress(plain, asbytes=True)


def unpack(rows: list[tuple[int, pa.Buffer]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What pack() put into rows of (number, bytes): the keys without their part, classes and tags."""
    codec, total = pa.Codec("zstd"), sum(n for n, _ in rows)
    keys, owners, tags = (np.zeros((total, 8), np.uint8) for _ in range(3))
    end = 0
    for n, packed in rows:
        plain = np.frombuffer(codec.decompress(packed, n * _ROW_BYTES), np.uint8)
        at, end = slice(end, end + n), end + n
        keys[at, :_KEY_BYTES] = plain[: _KEY_BYTES * n].reshape(_KEY_BYTES, n).T
        owners[at] = plain[_KEY_BYTES * n : -8 * n].reshape(n, 8)
        tags[at] = plain[-8 * n :].reshape(8, n).T
    return keys.view(_U).ravel(), owners.view(np.int64).ravel(), tags.view(np.int64).ravel()


def _emit(batches, parts: int):
    seen: set[int] = set()
    keys, owners, tags, held = [], [], [], 0

    def out():
        of = np.repeat(np.arange(len(keys), dtype=np.int32), [len(k) for k in keys])
        every = np.concatenate(keys)
        keys.clear()
        rows = pack(every, np.array(owners), np.array(tags), of, parts)
        step = max(1, BATCH_KEYS * parts // len(every))
        while some := list(itertools.islice(rows, step)):
            kinds = (pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*some, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "number", "packed"])

    for _, members in _sets(batches):
        if not (taking := bands(len(members))):
            continue
        owner = class_id(members)
        if owner in seen:
            continue
        if len(seen) >= REMEMBERED:
            seen.clear()
        seen.add(owner)
        for band in taking:
            found, tag = band.keys(members)
            keys.append(found)
            owners.append(owner)
            tags.append(tag)
            held += len(found)
        if held >= PACKED_KEYS:
            yield from out()
            keys, owners, tags, held = [], [], [], 0
    if held:
        yield from out()


def meetings(keys: np.ndarray, owners: np.ndarray, tags: np.ndarray) -> list[np.ndarray]:
    """Arrays class, tag, leader, shared: how many keys a class has under a leader, of the keys that unlike classes share."""
    order = np.argsort(keys)
    same = np.flatnonzero(np.diff(keys[order]) == 0)
    order = order[np.union1d(same, same + 1)]
    order = order[np.lexsort((owners[order], keys[order]))]
    keys, owners, tags = keys[order], owners[order], tags[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners, tags = keys[fresh], owners[fresh], tags[fresh]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    leaders = np.repeat(owners[starts], sizes)
    met = np.repeat(sizes > 1, sizes)
    owners, tags, leaders = owners[met], tags[met], leaders[met]
    order = np.lexsort((leaders, tags, owners))
    owners, tags, leaders = owners[order], tags[order], leaders[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (tags[1:] != tags[:-1]) | (leaders[1:] != leaders[:-1])
    starts = np.flatnonzero(new)
    return [owners[starts], tags[starts], leaders[starts], np.diff(np.append(starts, len(owners)))]


def _meet(batches):
    rows = [(n, data.as_buffer()) for batch in batches for n, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True)]
    if rows:
        found = meetings(*unpack(rows))
        rows.clear()
        table = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["class", "tag", "leader", "shared"])
        for begin in range(0, table.num_rows, 100_000):
            yield table.slice(begin, 100_000)


def _with_members(batches):
    for batch in batches:
        classes = batch.column(2)
        for block in blocks(batch.column(1)):
            part = classes.slice(block.rows.start, len(block.rows))
            found = [signed(s) for s in shingle_sets(block, SHINGLE)]
            ends = np.cumsum([0, *(len(s) for s in found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([part, lists], ["class", "members"])


def links_between(sets: list[np.ndarray], side: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the sets that link; across: only pairs of different sides."""
    sizes = np.array([len(s) for s in sets])
    n = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    both = np.zeros((n, n), np.float32)
    if len(column):
        column = np.cumsum(np.concatenate([[0], (np.diff(column) > 0).astype(np.int64)]))
        width = max(1, min(8192, 4_000_000 // n))
        cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b > a:
                part = np.zeros((n, int(column[b - 1] - column[a]) + 1), np.float32)
                part[owner[a:b], column[a:b] - column[a]] = 1
                both += part @ part.T
    linked = (100 + PERCENT) * both.astype(np.int64) >= PERCENT * (sizes[:, None] + sizes[None, :])
    if across:
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(linked, 1))
    return i, j


def _roots(labels: list[int], i: np.ndarray, j: np.ndarray) -> list[int]:
    """Of each class the smallest class of its local component."""
    parent = list(range(len(labels)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = root(a), root(b)
        if a != b:
            low, high = (a, b) if labels[a] < labels[b] else (b, a)
            parent[high] = low
    return [labels[root(x)] for x in range(len(labels))]


def _verify(batches, across: bool):
    """Rows come sorted by (chunk, slice); each run of equal ones is one comparison. across: of visitors with the chunk only."""
    names = ["chunk", "slice", "class", "root"]
    run, labels, homes, sets, done = None, [], [], [], []

    def compare():
        if not labels:
            return
        if len(labels) == 1 or across and all(homes):
            roots = labels
        else:
            roots = _roots(labels, *links_between(sets, np.array(homes), across))
        done.extend((*run, label, root) for label, root in zip(labels, roots, strict=True))

    def out():
        rows = [pa.array(c, pa.int64()) for c in zip(*done, strict=True)]
        return pa.RecordBatch.from_arrays(rows, names)

    for batch in batches:
        chunk, part, home, label = (batch.column(k).to_pylist() for k in range(4))
        members = batch.column(4)
        ends, values = members.offsets.to_numpy(), members.values.to_numpy()
        for k in range(len(chunk)):
            if (chunk[k], part[k]) != run:
                compare()
                run, labels, homes, sets = (chunk[k], part[k]), [], [], []
            labels.append(label[k])
            homes.append(home[k])
            sets.append(values[ends[k] : ends[k + 1]].copy())
        if len(done) > 100_000:
            yield out()
            done = []
    compare()
    if done:
        yield out()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class, n): a hash of the document's set (null if empty) and the set's size."""
    rows = docs.select(F.col(f"`{key}`").cast("bigint"), F.col(f"`{text}`"))
    return map_arrow(rows, _classify, "doc_id bigint, class bigint, n bigint")


def _staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table below the shared folder, which takes less disk than a checkpoint."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _need() -> Column:
    return F.col("tag").bitwiseAND(F.lit(NEED))


def _if_few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def candidates(docs: DataFrame, text: str = "text", parts: int = 1) -> DataFrame:
    """(class, tag, leader, shared, all): classes under the smallest class of a key they share with others.

    `shared` counts the keys of the band that a class has under the leader, and
    `all` those it has under any. A class stays in a band only if it shares as
    many keys with all others as it must share with any one partner. The keys
    are dealt into as many parts as given.
    """
    rows = docs.select(F.lit(0).cast("bigint"), F.col(f"`{text}`"))
    emitted = map_arrow(rows, functools.partial(_emit, parts=parts), "part bigint, number bigint, packed binary")
    dealt = emitted.repartitionById(parts, F.col("part").cast("int"))
    found = map_arrow(dealt, _meet, "class bigint, tag bigint, leader bigint, shared bigint")
    met = _staged(found.groupBy("class", "tag", "leader").agg(F.sum("shared").alias("shared")), "met")
    enough = met.groupBy("class", "tag").agg(F.sum("shared").alias("all"))
    return met.join(enough.filter(F.col("all") >= _need()), ["class", "tag"])


def _parts(table: DataFrame) -> int:
    """Parts for the keys of the documents in the outcome of classes()."""
    n, rows = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    return max(1, math.ceil((KEYS_PER_SHINGLE * n + KEYS_PER_SET * rows) / PART_KEYS))


def _chunks(met: DataFrame, sizes: DataFrame) -> DataFrame:
    """(class, rep, n, chunk): the chunk that each class is dealt to."""
    home = met.groupBy("class").agg(F.min("leader").alias("home")).join(sizes, "class")
    parts = home.groupBy("home").agg(F.ceil(F.sum(F.col("n") + SET_SHARE) / CHUNK).alias("parts"))
    chunk = F.xxhash64("home", F.pmod(F.xxhash64("class"), F.col("parts")))
    return home.join(parts, "home").select("class", "rep", "n", chunk.alias("chunk"))


def _compared(sets: DataFrame, dealt: DataFrame, visits: DataFrame, across: bool) -> DataFrame:
    """(chunk, slice, class, root): the smallest class that links in a comparison join with the class.

    A comparison is one of a chunk's sets with those that visit it; more
    visitors than a chunk may hold come in slices. across: only sets and their
    visitors are compared, and chunks without visitors left out.
    """
    guests = visits.join(dealt.select("class", "n"), "class")
    slices = guests.groupBy("chunk").agg(F.ceil(F.sum(F.col("n") + SET_SHARE) / CHUNK).alias("slices"))
    of_guest = F.pmod(F.xxhash64("class"), F.col("slices"))
    guests = guests.join(slices, "chunk").select("class", "chunk", of_guest.alias("slice"), F.lit(False).alias("home"))
    homes = dealt.select("class", "chunk").join(slices, "chunk", "inner" if across else "left")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("slices", F.lit(1)) - 1))
    units = _staged(homes.select("class", "chunk", each.alias("slice"), F.lit(True).alias("home")).unionByName(guests), "units")
    rows = (
        sets.join(_if_few(units), "class")
        .select("chunk", "slice", "home", "class", "members")
        .repartition("chunk", "slice")
        .sortWithinPartitions("chunk", "slice")
    )
    found = map_arrow(rows, functools.partial(_verify, across=across), "chunk bigint, slice bigint, class bigint, root bigint")
    return _staged(found, "compared")


def _apart(at: DataFrame, crossing: DataFrame, seen: DataFrame) -> DataFrame:
    """(class, chunk): visits of members that are not joined to their leader's pivot to the other chunks of the leader.

    A visit needs a band in which the class has, under the leaders that the
    chunk has members of, as many keys as it shares with each partner at least.
    """
    pivots = seen.groupBy("chunk", F.col("class").alias("pivot")).agg(F.min(F.struct("slice", "root")).alias("first"))
    pivots = pivots.select("chunk", "pivot", "first.slice", F.col("first.root").alias("joined"))
    under = at.join(crossing, "leader").withColumn("band", F.shiftright("tag", NEED_BITS))
    odd = under.select("leader", "pivot", "class", "chunk").distinct().join(pivots, ["chunk", "pivot"])
    odd = odd.join(seen, ["chunk", "slice", "class"]).filter("root <> joined").select("class", "leader", F.lit(1).alias("odd"))
    odd = _staged(odd, "odd")
    ways = under.join(odd.select("class").distinct(), "class").join(odd, ["class", "leader"], "left")
    ways = ways.select("class", "tag", "band", "leader", "shared", "odd", F.col("chunk").alias("home"))
    others = under.select("band", "leader", "chunk").distinct()
    shares = ways.join(others, ["band", "leader"]).filter("chunk <> home").groupBy("class", "chunk", "tag")
    shares = shares.agg(F.sum("shared").alias("shared"), F.max("odd").alias("odd"))
    visits = shares.groupBy("class", "chunk").agg(F.max(F.col("shared") >= _need()).alias("enough"), F.max("odd").alias("odd"))
    return visits.filter("enough and odd = 1").select("class", "chunk")


def links(docs: DataFrame, table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b): edges that join linked classes; `table` is the outcome of classes().

    The edges span the same components as all links do; pairs of a component
    that other edges already join are left out.
    """
    met = _staged(candidates(docs, text, _parts(table)), "candidates")
    reps = table.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    reps = reps.filter("rep is not null")
    dealt = _staged(_chunks(met, reps), "dealt")
    ids = dealt.select(F.col("rep").alias("__rep"), "class")
    texts = docs.select(F.col(f"`{key}`").cast("bigint").alias("__id"), F.col(f"`{text}`").alias("__text"))
    found = texts.join(_if_few(ids), F.col("__id") == F.col("__rep")).select("__id", "__text", "class")
    sets = _staged(map_arrow(found, _with_members, "class bigint, members array<bigint>"), "sets")
    at = _staged(met.join(dealt.select("class", "chunk"), "class"), "under")
    pivot = F.max(F.struct("all", "class", "chunk")).alias("most")
    crossing = at.groupBy("leader").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"), pivot)
    crossing = crossing.filter("low <> high")
    crossing = _staged(crossing.select("leader", F.col("most.class").alias("pivot"), F.col("most.chunk").alias("from")), "crossing")
    visits = at.join(crossing, "leader").filter("chunk <> from").select(F.col("pivot").alias("class"), "chunk").distinct()
    seen = _compared(sets, dealt, visits, across=False)
    apart = _staged(_apart(at, crossing, seen), "apart")
    if not apart.isEmpty():
        seen = seen.unionByName(_compared(sets, dealt, apart, across=True))
    return seen.filter("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; see the module's notes."""
    spark = docs.sparkSession
    path = staging_path(spark, "classes")
    classes(docs, key, text).write.parquet(path)
    table = spark.read.parquet(path)
    labels = components(links(docs, table, key, text))
    placed = table.join(labels, table["class"] == labels["node"], "left").select(
        "doc_id", "n", F.coalesce("label", "class").alias("group")
    )
    smallest = placed.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return placed.join(smallest, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest id; every column stays.

    Rows without an id belong to no group and all stay. Of rows with equal id and text one stays; unlike texts under
    one id are not taken for repetitions. Only ids that go or come more than once are looked for, and only rows of the
    latter moved.
    """
    named = docs.where(F.col(f"`{key}`").isNotNull())
    of_id = near_duplicates(named, key, text).groupBy("doc_id")
    known = of_id.agg(F.max(F.col("doc_id") == F.col("component_id")).alias("__stays"), F.count("*").alias("__times"))
    told = _staged(known.filter("not __stays or __times > 1").withColumnRenamed("doc_id", "__known"), "told")
    found = named.join(_if_few(told), named[key] == F.col("__known"), "left")
    once = found.filter("__known is null").select(*(named[f"`{c}`"] for c in docs.columns))
    twice = found.filter("__stays").select(*(named[f"`{c}`"] for c in docs.columns)).dropDuplicates([key, text])
    return once.unionByName(twice).unionByName(docs.where(F.col(f"`{key}`").isNull()))
