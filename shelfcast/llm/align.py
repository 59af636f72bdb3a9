"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole and grouped exactly, so that copies leave one row with
their number. Each distinct text is cut by a byte-level BPE (A) and a
sentencepiece model (B), both with one space put in front. The byte offsets
where tokens of both end cut the text into groups; the two tokens that end
there are a link. Links are counted per id pair, each text's weighted by its
copies, and the counts come back to the texts and to every document.

The aligned texts are written once to the shared folder, with the pairs of each
text, and read from there for the counts and for the measures. Pairs that hold
more than one in HEAVY of all links, of which there are under HEAVY, are joined
by broadcast; the rest, none of which is frequent, by a shuffle. Texts that make
more than one in HOT of all rows, of which there are under HOT, are joined to
their documents by broadcast in the same way.

Defined results: a null or empty text, and one whose tokens do not join to the
text's bytes with a space in front (B's model may change characters), has no
tokens: its measures are 0 and its groups are ''. Every row, repeated ones and
rows without an id too, gets the measures of its text; an empty table gives
empty tables; only the columns named as keys are kept, so that others may have
any name. Strings of special tokens are plain text. Two texts are told apart
by their whole bytes where they are grouped and by SHA-256 afterwards.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shipping import map_arrow
from shelfcast.llm.token_count import byte_characters, read_spec
from shelfcast.session import staging_path

#: Bytes of text aligned together.
BLOCK_BYTES = 1 << 20
#: Bounds of the broadcast pairs and of the broadcast texts.
HEAVY, HOT = 200_000, 1_000
#: Columns of a document's measures.
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

_DIGITS = 6


class Vocabulary:
    """The bytes of each id, their number, and the id's digits with room for a separator."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.digits = np.zeros((len(entries), _DIGITS), np.uint8)
        self.n_digits = np.array([len(str(i)) for i in range(len(entries))], np.int64)
        for i in range(len(entries)):
            self.digits[i, : self.n_digits[i]] = list(str(i).encode())


class Aligner:
    """Both tokenizers and the alignment of texts by them."""

    def __init__(self, a: bytes, b: bytes, pattern: str):
        spec = read_spec(a)
        byte_of = {c: i for i, c in enumerate(byte_characters())}
        entries = {i: bytes(map(byte_of.__getitem__, token)) for token, i in spec["model"]["vocab"].items()}
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        ranks = {token: i for i, token in entries.items() if i not in special}
        self.encode_a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        known = entries | special
        self.a = Vocabulary([known.get(i, b"") for i in range(max(known) + 1)])
        model = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.encode_b = functools.partial(model.encode, num_threads=1)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.b = Vocabulary(
            [
                bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        if len(self.a.entries) * len(self.b.entries) >= 1 << 31:
            raise ValueError("a pair of ids is kept as one 32-bit number")

    def tokens(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of A and B, or none where they do not join to the text with a space in front."""
        whole = " " + text
        target = whole.encode()
        b = self.encode_b(text)
        if b"".join(map(self.b.entries.__getitem__, b)) != target:
            return None
        a = self.encode_a(whole)
        return (a, b) if b"".join(map(self.a.entries.__getitem__, a)) == target else None

    def align(self, texts: list[str], listing: bool) -> dict[str, list]:
        """Of each text the numbers of tokens, groups and links, its groups, and its pairs with their times."""
        cut = [self.tokens(t) for t in texts]
        none: list[int] = []
        ids = [[c[k] if c else none for c in cut] for k in (0, 1)]
        a_ids, b_ids = (np.fromiter((i for part in side for i in part), np.int64, sum(map(len, side))) for side in ids)
        a_at, b_at = (np.concatenate([[0], np.cumsum([len(p) for p in side])]).astype(np.int64) for side in ids)
        # Both sides cover the same bytes of each text, so running sums agree over all of them.
        a_end, b_end = np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b.lengths[b_ids])
        size = int(a_end[-1]) + 1 if len(a_end) else 1
        in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
        in_a[a_end], in_b[b_end] = True, True
        a_cut, b_cut = in_b[a_end], in_a[b_end]
        a_link, b_link = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
        at = np.searchsorted(a_link, a_at)
        groups = np.diff(at)
        text = np.repeat(np.arange(len(texts), dtype=np.int64), groups)
        code = a_ids[a_link] * len(self.b.entries) + b_ids[b_link]
        pairs, times = np.unique(text << 31 | code, return_counts=True)
        ends = np.searchsorted(pairs, np.arange(len(texts) + 1, dtype=np.int64) << 31)
        listed = [""] * len(texts)
        if len(a_ids):
            listed = self._listing(a_ids, b_ids, a_cut, b_cut, a_link, b_link, a_at, b_at, listing)
        return {
            "n_a": np.diff(a_at),
            "n_b": np.diff(b_at),
            "n_groups": groups,
            "n_links": groups,
            "groups": listed,
            "pairs": (ends, (pairs & ((1 << 31) - 1)).astype(np.int32), times.astype(np.int32)),
        }

    def _listing(self, a_ids, b_ids, a_cut, b_cut, a_link, b_link, a_at, b_at, whole) -> list[str]:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`, or the SHA-256 of it, written for all texts at once."""
        a_before = np.concatenate([[0], a_link + 1])
        b_before = np.concatenate([[0], b_link + 1])
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        a_place = np.arange(len(a_ids)) + b_before[a_group]
        b_place = np.arange(len(b_ids)) + a_before[b_group + 1]
        n = len(a_ids) + len(b_ids)
        digits, lengths = np.empty((n, _DIGITS), np.uint8), np.empty(n, np.int64)
        for place, side, ids, cut, last in ((a_place, self.a, a_ids, a_cut, b"|"), (b_place, self.b, b_ids, b_cut, b";")):
            row, many = side.digits[ids], side.n_digits[ids]
            row[np.arange(len(ids)), many] = np.where(cut, last[0], ord(","))
            digits[place], lengths[place] = row, many
        written = digits[np.arange(_DIGITS) <= lengths[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths + 1)])[a_at + b_at].tolist()
        parts = (written[x : max(x, y - 1)] for x, y in zip(ends, ends[1:]))  # noqa: B905
        if whole:
            return [p.decode() for p in parts]
        return [hashlib.sha256(p).hexdigest() if p else "" for p in parts]


@functools.lru_cache(maxsize=2)
def aligner(a: bytes, b: bytes, pattern: str) -> Aligner:
    """Built once per process."""
    return Aligner(a, b, pattern)


def _blocks(texts: list[str]):
    """Bounds of consecutive texts of about BLOCK_BYTES."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > BLOCK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


@dataclass(frozen=True)
class Alignment:
    """The distinct texts and id pairs of an aligned corpus.

    texts: digest (SHA-256 of the text), copies, n_a, n_b, n_groups, n_links,
    groups, and the text's pairs with their times. pairs: pair, a_id, b_id,
    count, and whether the count is the highest of its b_id.
    """

    texts: DataFrame
    pairs: DataFrame


def _digest(text) -> F.Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def align_texts(docs: DataFrame, a_path: str, b_path: str, pattern: str, text: str = "text", listing: bool = False) -> Alignment:
    """Both tables of the corpus, written to the shared folder.

    The groups are the SHA-256 of their listing, or with `listing` the listing
    itself. The tokenizer files (under two megabytes) go out as broadcasts.
    """
    spark = docs.sparkSession
    a, b = (spark.sparkContext.broadcast(Path(p).read_bytes()) for p in (a_path, b_path))
    n_b = len(aligner(a.value, b.value, pattern).b.entries)
    distinct = docs.select(F.col(text).alias("text")).filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    kind = "digest binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<int>, times array<int>"

    def run(batches):
        made = aligner(a.value, b.value, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _blocks(texts):
                got = made.align(texts[begin:end], listing)
                ends, pairs, times = got["pairs"]
                ends = pa.array(ends.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(2).slice(begin, end - begin),
                        *[pa.array(got[k]) for k in ("n_a", "n_b", "n_groups", "n_links")],
                        pa.array(got["groups"], pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(pairs)),
                        pa.ListArray.from_arrays(ends, pa.array(times)),
                    ],
                    ["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    texts_path, pairs_path = staging_path(spark, "aligned-texts"), staging_path(spark, "pairs")
    map_arrow(distinct.select(_digest(F.col("text")).alias("digest"), "text", "copies"), run, kind).write.parquet(texts_path)
    texts = spark.read.parquet(texts_path)
    weighted = texts.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = weighted.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(F.col("link.times") * F.col("copies")).alias("count"))
    a_id, b_id = F.expr(f"pair div {n_b}").cast("int"), F.expr(f"pair % {n_b}").cast("int")
    counts.select("pair", a_id.alias("a_id"), b_id.alias("b_id"), "count").write.parquet(pairs_path)
    counted = spark.read.parquet(pairs_path)
    # One row per id of B at most.
    highest = counted.groupBy("b_id").agg(F.max("count").alias("highest"))
    pairs = counted.join(F.broadcast(highest), "b_id").select("pair", "a_id", "b_id", "count", (F.col("count") == F.col("highest")).alias("best"))
    return Alignment(texts, pairs)


def _text_sums(found: Alignment) -> DataFrame:
    """Per digest n_best and count_sum over the text's links."""
    total = found.pairs.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    heavy = found.pairs.filter(F.col("count") * HEAVY > total).select("pair", "count", "best")
    rare = found.pairs.filter(F.col("count") * HEAVY <= total).select("pair", "count", "best")
    links = found.texts.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("digest", F.col("link.pairs").alias("pair"), F.col("link.times").cast("bigint").alias("times"))
    sums = (
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    frequent = links.join(F.broadcast(heavy), "pair").groupBy("digest").agg(*sums)
    others = links.join(F.broadcast(heavy.select("pair")), "pair", "left_anti").join(rare, "pair").groupBy("digest").agg(*sums)
    both = frequent.unionByName(others)
    return both.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def measures(docs: DataFrame, found: Alignment, keys: list[str], text: str = "text") -> DataFrame:
    """The columns `keys` of every row of `docs` with the measures and groups of its text."""
    spark = docs.sparkSession
    path = staging_path(spark, "text-measures")
    numbers = found.texts.select("digest", "copies", *MEASURES[:4], "groups")
    numbers.join(_text_sums(found), "digest", "left").write.parquet(path)
    numbers = spark.read.parquet(path)
    total = numbers.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.col("copies") * HOT > total
    often, seldom = numbers.filter(hot).drop("copies"), numbers.filter(~hot).drop("copies")
    rows = docs.select(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], F.when(F.col(text) != "", _digest(F.col(text))).alias("digest"))
    # Rows without a text have nothing to look up and stay out of the shuffle.
    empty = rows.filter("digest is null").withColumns({c: F.lit(None).cast(t) for c, t in often.dtypes if c != "digest"})
    filled = rows.filter("digest is not null")
    frequent = filled.join(F.broadcast(often), "digest")
    others = filled.join(F.broadcast(often.select("digest")), "digest", "left_anti").join(seldom, "digest", "left")
    joined = frequent.unionByName(others).unionByName(empty)
    return joined.select(
        *[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)],
        *[F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in MEASURES],
        F.coalesce("groups", F.lit("")).alias("groups"),
    )
