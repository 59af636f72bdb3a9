"""Language identification by hyperdimensional profiles.

A letter has a random vector of +1 and -1, fixed by its code point. A run of
three letters binds them: the first two rotated by two places and one, all three
multiplied. A document bundles (sums) its runs; a language's prototype bundles
the runs of its training documents, each document weighing the same. After the
prototypes' mean is taken off, the language with the largest cosine is chosen.

Training sums one vector per language and task, so a frequent language costs no
more to gather than a rare one. Defined results: `und` and score 0 for a null
text or one without letters, or if nothing was learned; the language that sorts
first wins a tie; rows without a language are not learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shipping import append_column, map_arrow
from shelfcast.llm.words import mix

SIZE = 512
#: Runs whose vectors a worker remembers.
REMEMBERED = 60_000
_U = np.uint64
_LETTERS = regex.compile(r"\p{L}+").findall


def _letter(code: int) -> np.ndarray:
    bits = mix(np.arange(SIZE // 64, dtype=_U) + _U(code * 1_000_003))
    return np.unpackbits(bits.view(np.uint8)).astype(np.int8) * 2 - 1


class Runs:
    """Vectors of runs of three letters, made once and remembered."""

    def __init__(self):
        self.place: dict[int, int] = {}
        self.rows = np.zeros((REMEMBERED, SIZE), np.int8)

    def vectors(self, runs: np.ndarray) -> np.ndarray:
        if len(self.place) + len(runs) > REMEMBERED:
            self.place.clear()
        if len(runs) > REMEMBERED:
            return np.concatenate([self.vectors(runs[:REMEMBERED]), self.vectors(runs[REMEMBERED:])])
        at = []
        for run in runs.tolist():
            k = self.place.get(run)
            if k is None:
                k = self.place[run] = len(self.place)
                a, b, c = (_letter(run >> s & 0x1FFFFF) for s in (42, 21, 0))
                self.rows[k] = np.roll(a, 2) * np.roll(b, 1) * c
            at.append(k)
        return self.rows[at]


def runs_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of three in the text's words, each between spaces, and their counts."""
    words = _LETTERS((text or "").lower())
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages of the rows and their prototypes; the driver gets SIZE numbers a language."""

    def bundle(batches):
        weights: dict[str, dict[int, float]] = {}
        sums: dict[str, np.ndarray] = {}
        made = Runs()

        def flush():
            for name, runs in weights.items():
                ids = np.fromiter(runs, np.int64, len(runs))
                values = np.fromiter(runs.values(), float, len(runs))
                for i in range(0, len(ids), 4096):
                    sums[name] = sums.get(name, 0) + values[i : i + 4096] @ made.vectors(ids[i : i + 4096])
            weights.clear()

        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs, counts = runs_of(t)
                if name is not None and len(runs):
                    own = weights.setdefault(name, {})
                    for run, w in zip(runs.tolist(), (counts / counts.sum()).tolist(), strict=True):
                        own[run] = own.get(run, 0.0) + w
                    if len(own) > 500_000:
                        flush()
        flush()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([list(v) for v in sums.values()])], ["l", "v"])

    rows = map_arrow(docs.select(F.col(f"`{text}`"), F.col(f"`{lang}`").cast("string")), bundle, "l string, v array<double>")
    summed = rows.select("l", F.posexplode("v").alias("k", "x")).groupBy("l", "k").agg(F.sum("x").alias("x"))
    vectors: dict[str, np.ndarray] = {}
    for name, k, x in summed.toLocalIterator():
        vectors.setdefault(name, np.zeros(SIZE))[k] = x
    names = sorted(vectors)
    return names, np.stack([vectors[n] / np.linalg.norm(vectors[n]) for n in names]) if names else np.zeros((0, SIZE))


def predict(df: DataFrame, names: list[str], prototypes: np.ndarray, text: str = "text", out: str = "language") -> DataFrame:
    """`df` with struct<lang, score>; the score is (1 + cosine) / 2."""
    mean = prototypes.mean(axis=0) if len(names) else np.zeros(SIZE)
    centred = prototypes - mean if len(names) > 1 else prototypes
    centred = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    sent = df.sparkSession.sparkContext.broadcast((names, mean, centred))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
    held: list[Runs] = []

    def choose(column: pa.Array) -> pa.Array:
        names, mean, centred = sent.value
        if not held:
            held.append(Runs())
        rows = []
        for t in column.to_pylist():
            runs, counts = runs_of(t)
            if not len(runs) or not names:
                rows.append({"lang": "und", "score": 0.0})
                continue
            vector = counts.astype(np.float32) @ held[0].vectors(runs).astype(np.float32)
            vector = vector / max(np.linalg.norm(vector), 1e-12)
            vector = vector - mean if len(names) > 1 else vector
            cosine = centred @ (vector / max(np.linalg.norm(vector), 1e-12))
            best = int(np.argmax(cosine))
            rows.append({"lang": names[best], "score": float(np.clip((1 + cosine[best]) / 2, 0, 1))})
        return pa.array(rows, kind)

    return append_column(df, text, out, "struct<lang:string,score:double>", choose)


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key's decimal text, modulo `parts`; null keys count as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))
