"""Language id and quality classifier against plain Python that follows their definitions."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from shelfcast.llm import catalog, kneser_ney, langid

SF = "/root/testdata/sf0.001"


def runs(text: str) -> Counter:
    joined = f"  {' '.join(text.split())} "
    return Counter(joined[i : i + 3] for i in range(len(joined) - 2)) if text.split() else Counter()


class Plain:
    """Modified Kneser-Ney over strings: p(run) by recursion on its suffixes."""

    def __init__(self, texts):
        three = sum((runs(t) for t in texts), Counter())
        two = Counter(g[1:] for g in three)
        one = Counter(g[1:] for g in two)
        self.levels = {3: three, 2: two, 1: one}
        self.less, self.total, self.back = {}, {}, {}
        for n, counts in self.levels.items():
            of = Counter(counts.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else 0.5
            d = [max(0.1, k - (k + 1) * y * of[k + 1] / of[k]) if of[k] and of[k + 1] else 0.5 for k in (1, 2, 3)]
            total, spare = Counter(), defaultdict(float)
            for g, c in counts.items():
                self.less[n, g] = d[min(c, 3) - 1]
                total[g[:-1]] += c
                spare[g[:-1]] += self.less[n, g]
            self.total[n] = total
            self.back[n] = {g: spare[g] / total[g] for g in total}

    def p(self, g: str) -> float:
        n = len(g)
        if n == 0:
            return 1 / 1024
        below, context = self.p(g[1:]), g[:-1]
        if context not in self.back[n]:
            return below
        c = self.levels[n].get(g, 0)
        own = (c - self.less[n, g]) / self.total[n][context] if c else 0.0
        return own + self.back[n][context] * below

    def perplexity(self, text):
        found = runs(text or "")
        if not found:
            return None
        return math.exp(-sum(c * math.log(self.p(g)) for g, c in found.items()) / sum(found.values()))


ROWS = [
    (1, "the cat sat on the mat and the cat ran", "en", "x"),
    (2, "the dog and the cat sat on a mat", "en", "x"),
    (2, "the dog and the cat sat on a mat", "en", "y"),
    (3, "le chat est sur le tapis", "fr", "x"),
    (4, "zq xv jk wq zz qq xj", "en", "x"),
    (5, None, "en", "x"),
    (6, "  ", None, "x"),
    (7, "the cat and the dog sat", None, "x"),
    (8, "the mat", "de", "x"),
    (None, "the cat sat", "en", "x"),
]
LABELS = [(1, 1), (1, 1), (2, 1), (3, 1), (4, 0), (7, 1), (99, 1)]


def frames(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, threshold string")
    return docs, spark.createDataFrame(LABELS, "doc_id bigint, quality int")


def test_kneser_ney_equals_the_plain_recursion(spark):
    texts = [r[1] for r in ROWS[:4]]
    plain = Plain(texts)
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    asked = sorted(set().union(*(runs(t) for t in [*texts, "zq the chat qu", "sat\u00e9 on"])))
    codes = np.array([(ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2]) for g in asked])
    assert kneser_ney.probabilities(codes, model) == pytest.approx([plain.p(g) for g in asked], rel=1e-9)


@pytest.mark.parametrize("languages", [10_000, 0])
def test_classify_equals_plain_thresholds(spark, monkeypatch, languages):
    monkeypatch.setattr(kneser_ney, "LANGUAGES", languages)
    docs, labels = frames(spark)
    good = {1, 2, 3, 7}
    plain = Plain([t for t in {i: t for i, t, *_ in ROWS if i in good}.values()])
    known = [(lang, plain.perplexity(t)) for i, t, lang, _ in ROWS if i in good]

    def limit(lang):
        # The quantile is above 1 - 1 / n here, so it is the largest value.
        own = [p for name, p in known if name == lang and lang is not None] or [p for _, p in known]
        return kneser_ney.SLACK * max(own)

    want = []
    for i, t, lang, _ in ROWS:
        p = plain.perplexity(t)
        want.append((i or 0, lang or "", p is not None and p <= limit(lang), round(limit(lang), 6), -1 if p is None else round(p, 6)))
    got = [
        (r.doc_id or 0, r.lang or "", r.kept, round(r.threshold, 6), -1 if r.perplexity is None else round(r.perplexity, 6))
        for r in kneser_ney.classify(docs, labels).collect()
    ]
    assert sorted(got) == sorted(want)
    assert {g[0]: g[2] for g in got}[4] is False


def test_classify_learns_from_every_good_document(spark):
    """More of them than the 4,000 that a sample once took; the last ones alone hold letters of their own."""
    texts = [f"word {i} of {chr(0x4E00 + i % 500)}" for i in range(4300)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 as quality")
    plain = Plain(texts)
    got = {r.doc_id: r.perplexity for r in kneser_ney.classify(docs, labels).collect()}
    assert got == {i: pytest.approx(plain.perplexity(t), rel=1e-9) for i, t in enumerate(texts)}


@pytest.mark.parametrize("common", [0, 5])
def test_classify_by_joins_equals_the_broadcast_model(spark, monkeypatch, common):
    docs, labels = frames(spark)

    def result():
        rows = kneser_ney.classify(docs, labels).collect()
        return sorted((r.doc_id or 0, r.lang or "", r.kept, round(r.threshold, 9), -1 if r.perplexity is None else round(r.perplexity, 9)) for r in rows)

    want = result()
    monkeypatch.setattr(kneser_ney, "COMMON", common)
    assert result() == want and len(want) == len(ROWS)


def test_classify_without_trusted_rows_or_documents(spark):
    docs, labels = frames(spark)
    assert not any(r.kept for r in kneser_ney.classify(docs, labels.filter("quality = 5")).collect())
    assert kneser_ney.classify(docs.limit(0), labels).collect() == []


def test_language_id_equals_plain_bundles(spark):
    """Every document of the table, bundled run by run."""
    made: dict[str, np.ndarray] = {}

    def vector(text):
        words = regex.findall(r"\p{L}+", (text or "").lower())
        joined = f" {' '.join(words)} "
        counts = Counter(joined[i : i + 3] for i in range(len(joined) - 2)) if words else Counter()
        total = np.zeros(langid.SIZE)
        for g, c in counts.items():
            if g not in made:
                a, b, d = (langid._letter(ord(x)).astype(float) for x in g)
                made[g] = np.roll(a, 2) * np.roll(b, 1) * d
            total += c * made[g]
        return total, sum(counts.values())

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    bundles = {r.doc_id: vector(r.text) for r in rows}
    sums = defaultdict(lambda: np.zeros(langid.SIZE))
    for r in rows:
        total, n = bundles[r.doc_id]
        if n and r.lang is not None and not held[r.doc_id]:
            sums[r.lang] += total / n
    names = sorted(sums)
    prototypes = np.stack([sums[n] / np.linalg.norm(sums[n]) for n in names])
    mean = prototypes.mean(axis=0)
    centred = prototypes - mean
    centred /= np.linalg.norm(centred, axis=1, keepdims=True)
    got = catalog.op7_language_id(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        total, n = bundles[r.doc_id]
        if not n:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        own = total / np.linalg.norm(total) - mean
        cosine = centred @ (own / np.linalg.norm(own))
        assert r.held_out == held[r.doc_id] and r.score == pytest.approx((1 + cosine.max()) / 2, abs=1e-5)
        assert cosine[names.index(r.lang_pred)] == pytest.approx(cosine.max(), abs=1e-5)


def test_language_id_of_odd_rows(spark):
    """Equal languages tie to the first name; nothing learned, empty tables and a column of the output's name are fine."""
    rows = [(1, "aba aba", "b", "x"), (2, "aba aba", "a", "y"), (2, "aba aba", "a", "y"), (None, "...", "a", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, language string")
    names, prototypes = langid.learn(df)
    assert names == ["a", "b"]
    got = langid.predict(df, names, prototypes).select("doc_id", "language.lang").collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, "a"), (2, "a"), (None, "und")]
    assert langid.predict(df.limit(0), names, prototypes).collect() == []
    none = langid.learn(df.limit(0))
    assert {r.language.lang for r in langid.predict(df, *none).collect()} == {"und"}
