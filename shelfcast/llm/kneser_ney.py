"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is of runs of three characters (white space as one space, case kept),
trained on every document labelled good (of several rows with one id, the least text).
Spark counts the runs and joins counts with the totals and continuation counts of
their contexts, each sharded by its key. A model of at most COMMON runs is broadcast
whole. Of a larger one only the most frequent COMMON runs are; the other runs of the
documents are joined, once each, with the stored levels, so that no run is left out and
neither the driver nor a worker holds the model. Every document then gets its perplexity
per character, and is kept if that is at most SLACK times the QUANTILE of the
trusted documents in its language, of all trusted documents where the language is
null or has none.

Defined results: a null text, or one without a character but white space, has no
perplexity and is not kept; without trusted rows nothing is kept; repeated labels
of a document count once; equal documents get a row each; an empty table gives none.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shipping import append_column, map_arrow
from shelfcast.session import staging_path

QUANTILE = 0.995
SLACK = 1.25
#: Languages whose thresholds are broadcast; with more, rows are dealt by language.
LANGUAGES = 10_000
#: Runs of which a broadcast model has at most (16 MB a level), and entries after which a worker's counts go out.
COMMON = FLUSH = 1 << 20
_LOW, _LOWEST = (1 << 42) - 1, (1 << 21) - 1


def _runs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(f"  {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


def _discounted(counts: DataFrame, value: str) -> DataFrame:
    """The column `less`: the discount of a count of 1, 2, 3 or more, from the numbers of counts 1 to 4."""
    n = counts.agg(*[F.coalesce(F.sum((F.col(value) == k).cast("double")), F.lit(0.0)).alias(f"n{k}") for k in range(1, 5)]).first()
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
    d = [max(0.1, k - (k + 1) * y * n[k] / n[k - 1]) if n[k - 1] and n[k] else 0.5 for k in (1, 2, 3)]
    c = F.col(value)
    return counts.withColumn("less", F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2]))


def _level(counts: DataFrame, context, lower: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(gram, p) interpolated with the lower level's p of gram's suffix, and (context, back) weights; counts: gram, c, suffix."""
    graded = _discounted(counts, "c").withColumn("context", context)
    totals = graded.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("less") / F.sum("c")).alias("back"))
    joined = graded.join(totals, "context")
    below = F.lit(1.0 / 1024)
    if lower is not None:
        joined = joined.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q")), "suffix", "left")
        below = F.col("q")
    p = (F.col("c") - F.col("less")) / F.col("total") + F.col("back") * below
    return joined.select("gram", p.alias("p"), "c"), totals.select("context", "back")


class Levels(NamedTuple):
    """Tables (runs, p, c), (pairs, back), (pairs, p, c), (letters, back), (letters, p, c); p of an unknown letter; number of runs."""

    runs: DataFrame
    back3: DataFrame
    pairs: DataFrame
    back2: DataFrame
    letters: DataFrame
    floor: float
    size: int


def _low(mask: int):
    return F.col("gram").bitwiseAND(F.lit(mask))


def _merged(kept: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    grams, at = np.unique(np.concatenate([g for g, _ in kept]), return_inverse=True)
    sums = np.zeros(len(grams), np.int64)
    np.add.at(sums, at, np.concatenate([c for _, c in kept]))
    return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(sums)], ["gram", "c"])


def levels(docs: DataFrame, text: str = "text") -> Levels:
    """The model of all texts as tables."""

    def count(batches):
        kept, held = [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                kept.append(_runs(t))
                held += len(kept[-1][0])
                if held >= FLUSH:
                    yield _merged(kept)
                    kept, held = [], 0
        if held:
            yield _merged(kept)

    three = map_arrow(docs.select(F.col(f"`{text}`")), count, "gram bigint, c bigint").groupBy("gram").agg(F.sum("c").alias("c"))
    path = staging_path(docs.sparkSession, "runs")
    three.write.parquet(path)  # one row a distinct run; every level below reads them
    three = docs.sparkSession.read.parquet(path).withColumn("suffix", _low(_LOW))
    two = three.groupBy(F.col("suffix").alias("gram")).agg(F.count("*").alias("c")).withColumn("suffix", _low(_LOWEST))
    one = two.groupBy(F.col("suffix").alias("gram")).agg(F.count("*").alias("c")).withColumn("suffix", F.lit(0))
    p1, back1 = _level(one, F.lit(0).cast("bigint"), None)
    p2, back2 = _level(two, F.shiftright("gram", 21), p1)
    p3, back3 = _level(three, F.shiftright("gram", 21), p2)
    last = back1.first()
    return Levels(p3, back3, p2, back2, p1, last[1] / 1024 if last else 1 / 1024, three.count())


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = df.toArrow()
    keys, values = (rows.column(i).to_numpy().astype(t) for i, t in ((0, np.int64), (1, float)))
    order = np.argsort(keys)
    return keys[order], values[order]


def collect(model: Levels) -> tuple[np.ndarray, ...]:
    """Sorted arrays (runs, p), (pairs, back), (pairs, p), (letters, back), (letters, p) and the p of an unknown letter."""
    return *(a for df in model[:5] for a in _arrays(df)), np.array([model.floor])


def train(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, ...]:
    """The arrays of a model whose runs fit a worker."""
    return collect(levels(docs, text))


def _find(keys: np.ndarray, table: np.ndarray, values: np.ndarray, missing) -> np.ndarray:
    if not len(table):
        return np.full(len(keys), missing, float) if np.isscalar(missing) else missing
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], missing)


def probabilities(runs: np.ndarray, model: tuple[np.ndarray, ...]) -> np.ndarray:
    """p of each run's last character after the other two."""
    k3, p3, b3, w3, k2, p2, b2, w2, k1, p1, floor = model
    one = _find(runs & ((1 << 21) - 1), k1, p1, float(floor[0]))
    middle = runs >> 21 & ((1 << 21) - 1)
    two = _find(runs & ((1 << 42) - 1), k2, p2, _find(middle, b2, w2, 1.0) * one)
    return _find(runs, k3, p3, _find(runs >> 21, b3, w3, 1.0) * two)


def perplexity(df: DataFrame, model: tuple[np.ndarray, ...], text: str = "text", out: str = "perplexity") -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(model)

    def measure(column: pa.Array) -> pa.Array:
        values = []
        for t in column.to_pylist():
            runs, counts = _runs(t)
            values.append(float(np.exp(-(counts @ np.log(probabilities(runs, sent.value))) / counts.sum())) if len(runs) else None)
        return pa.array(values, pa.float64())

    return append_column(df, text, out, "double", measure)


def looked_up(grams: DataFrame, model: Levels) -> DataFrame:
    """(gram, p) of the distinct runs in `grams`, each by joins with the levels; the p of `probabilities`."""

    def joined(df: DataFrame, table: DataFrame, key, value: str, out: str) -> DataFrame:
        return df.withColumn("_at", key).join(table.select(F.col(table.columns[0]).alias("_at"), F.col(value).alias(out)), "_at", "left").drop("_at")

    found = joined(grams, model.runs, F.col("gram"), "p", "_p3")
    found = joined(found, model.back3, F.shiftright("gram", 21), "back", "_b3")
    found = joined(found, model.pairs, _low(_LOW), "p", "_p2")
    found = joined(found, model.back2, F.shiftright("gram", 21).bitwiseAND(F.lit(_LOWEST)), "back", "_b2")
    found = joined(found, model.letters, _low(_LOWEST), "p", "_p1")
    one = F.coalesce("_p1", F.lit(float(model.floor)))
    two = F.coalesce("_p2", F.coalesce("_b2", F.lit(1.0)) * one)
    return found.select("gram", F.coalesce("_p3", F.coalesce("_b3", F.lit(1.0)) * two).alias("p"))


def perplexity_by_joins(df: DataFrame, model: Levels, text: str = "text", out: str = "perplexity") -> DataFrame:
    """`perplexity` under a model of any size, without the texts: frequent runs by broadcast, the others by joins."""
    spark = df.sparkSession
    path = staging_path(spark, "levels")
    for name, table in zip(model._fields, model[:5]):
        table.write.parquet(f"{path}/{name}")
    model = Levels(*(spark.read.parquet(f"{path}/{name}") for name in model._fields[:5]), *model[5:])
    sent = spark.sparkContext.broadcast(_arrays(model.runs.orderBy(F.desc("c"), "gram").limit(COMMON).select("gram", "p")))
    kind = pa.struct([("total", pa.int64()), ("known", pa.float64()), ("rest", pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))])

    def measure(column: pa.Array) -> pa.Array:
        grams, p = sent.value
        rows = []
        for t in column.to_pylist():
            runs, counts = _runs(t)
            found = _find(runs, grams, p, 0.0)
            hit = found > 0
            rest = [{"gram": g, "n": n} for g, n in zip(runs[~hit].tolist(), counts[~hit].tolist(), strict=True)]
            rows.append({"total": int(counts.sum()), "known": float(counts[hit] @ np.log(found[hit])), "rest": rest})
        return pa.array(rows, kind)

    asked = append_column(df, text, "_sums", "struct<total:bigint,known:double,rest:array<struct<gram:bigint,n:bigint>>>", measure).drop(text)
    path = staging_path(spark, "asked")
    asked.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)  # the numbers stay as written
    asked = spark.read.parquet(path)
    rest = asked.select("_row", F.inline("_sums.rest"))
    priced = rest.join(looked_up(rest.select("gram").distinct(), model), "gram")
    sums = priced.groupBy("_row").agg(F.sum(F.col("n") * F.ln("p")).alias("_rest"))
    total = F.col("_sums.total")
    value = F.when(total > 0, F.exp(-(F.col("_sums.known") + F.coalesce("_rest", F.lit(0.0))) / total))
    return asked.join(sums, "_row", "left").withColumn(out, value).drop("_row", "_rest", "_sums")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) of every document; labels: (doc_id, quality)."""
    good = labels.filter("quality = 1").select(F.col(key)).distinct()
    trusted = docs.select(key, text).join(good, key, "left_semi").groupBy(key).agg(F.min(text).alias(text))
    model = levels(trusted, text)
    path = staging_path(docs.sparkSession, "perplexity")
    rows = docs.select(key, lang, text)
    if model.size <= COMMON:
        rows = perplexity(rows, collect(model), text).drop(text)
    else:
        rows = perplexity_by_joins(rows, model, text)
    rows.write.parquet(path)
    scored = docs.sparkSession.read.parquet(path)
    reference = scored.join(good, key, "left_semi")
    bound = (SLACK * F.percentile_approx("perplexity", QUANTILE, 10_000)).alias("threshold")
    every = reference.agg(bound).first()[0]
    found = staging_path(docs.sparkSession, "thresholds")
    reference.filter(F.col(lang).isNotNull()).groupBy(lang).agg(bound).write.parquet(found)
    limits = docs.sparkSession.read.parquet(found)
    if limits.count() <= LANGUAGES:
        limits = F.broadcast(limits)
    limit = F.coalesce("threshold", F.lit(every).cast("double"))
    return scored.join(limits, lang, "left").select(
        F.col(key).alias("doc_id"),
        F.col(lang).alias("lang"),
        "perplexity",
        limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"),
    )
