"""Token counts, periodic runs and tokenizer alignment against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from bisect import bisect_left
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfcast.llm import align, catalog, periodic, token_count

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a<|endoftext|>b  <|endoftext|>  c", "<|endoftext|>", "x" * 4000, "日本語 é́ 🎉", " \n\n x\t▁y", "ab " * 900, "ﬁne <s> </s>"]


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(A)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def odd_docs(spark, folder):
    """Odd texts twice each, with columns of clashing names and a row without an id, as a documents table."""
    rows = [(i, t, "k", 7) for i, t in enumerate(ODD)] + [(i, t, None, None) for i, t in enumerate(ODD)] + [(None, "a b a b a b a b", "k", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, best int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{folder}/empty/documents.parquet")
    return rows


def test_token_counts_equal_the_library(spark, library, texts):
    got = catalog.op13_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
        assert r.over_limit == (r.n_tokens > 512)


def test_token_counts_of_odd_texts_with_a_small_memory(library, monkeypatch):
    monkeypatch.setattr(token_count, "REMEMBERED", 3)
    with open(A, "rb") as f:
        made = token_count.Counter(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(2)
    noise = ["".join(rng.choices("abcdeht iongs'.,0#\n\té日", k=rng.randint(1, 60))) for _ in range(3000)]
    for text in [t or "" for t in ODD] + noise:
        assert made.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_keep_rows_and_columns(spark, library, tmp_path):
    rows = odd_docs(spark, str(tmp_path))
    got = catalog.op13_token_counts(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in got if r.doc_id is not None) == sorted(
        (False, i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows if i is not None
    )
    assert len(got) == len(rows) and catalog.op13_token_counts(spark, f"{tmp_path}/empty").count() == 0
    kept = token_count.count_tokens(spark.read.parquet(f"{tmp_path}/documents.parquet"), A, public_tokenizers.PATTERN)
    assert sorted(kept.columns) == ["best", "doc_id", "n_tokens", "text"]


def test_token_counts_refuse_other_tokenizers():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f, pytest.raises(ValueError, match="byte-level"):
        token_count.Counter(f.read(), public_tokenizers.PATTERN)


def plain_runs(words):
    """Runs by testing every period at every place."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The row that the query owes for one document."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_equal_plain_search_on_few_letters():
    rng = random.Random(3)
    for _ in range(300):
        batch = []
        for _ in range(rng.randint(0, 9)):
            n = rng.randint(0, 70)
            words = rng.choices("abcd"[: rng.randint(1, 4)], k=n)
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            batch.append(words)
        assert [[*map(tuple, r.tolist())] for r in periodic.find_runs(batch)] == [plain_runs(w) for w in batch]


def test_runs_of_long_periods_and_blocks_of_one_text(monkeypatch):
    rng = random.Random(4)
    for period, times in ((1, 4000), (333, 4), (512, 5), (513, 4), (1000, 4)):
        unit = [str(rng.random()) for _ in range(period)]
        words = ["x", "y", *(unit * times), unit[0] if period > 1 else "z", "end"]
        length = period * times + (period > 1)
        assert periodic.find_runs([words])[0].tolist() == [[2, length, period]]
        assert periodic.find_runs([words, words[:-2], []])[1].tolist() == [[2, period * times, period]]


def test_wavelet_successors():
    import numpy as np

    rng = np.random.default_rng(5)
    values = rng.permutation(200)
    tree = periodic.Wavelet(values, 8)
    lo = rng.integers(0, 200, 500)
    hi = np.minimum(200, lo + rng.integers(0, 60, 500))
    after = rng.integers(0, 255, 500)
    want = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in zip(lo, hi, after, strict=True)]
    assert tree.successors(lo, hi, after).tolist() == want


def test_periodic_query_equals_plain_python(spark, texts):
    short = {i: t for i, t in texts.items() if len((t or "").split()) < 900}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in catalog.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(texts) and len(short) > 150
    for i, t in short.items():
        assert got[i] == plain_row(i, t)


def test_periodic_query_of_odd_rows(spark, tmp_path):
    rows = odd_docs(spark, str(tmp_path))
    got = catalog.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, [tuple(r[c] for c in COLUMNS) for r in got])) == sorted(str(plain_row(i, t)) for i, t, *_ in rows)
    assert catalog.op12_periodic_runs(spark, f"{tmp_path}/empty").count() == 0


def plain_alignment(rows, library):
    """The rows that the query owes, by the libraries and dictionaries."""
    library.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(token_count.byte_characters())}
    model = sentencepiece.SentencePieceProcessor(model_file=B)

    def ends(parts):
        at, found = 0, []
        for p in parts:
            at += len(p)
            found.append(at)
        return found

    cut = []
    for _, text in rows:
        target = f" {text}".encode()
        entry = None
        if text:
            coded = library.encode(f" {text}", add_special_tokens=False)
            a, b = coded.ids, model.encode(text)
            a_bytes = [bytes(byte_of[c] for c in t) for t in coded.tokens]
            pieces = [model.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
            if b"".join(a_bytes) == target == b"".join(b_bytes):
                entry = (a, b, ends(a_bytes), ends(b_bytes))
        cut.append(entry)
    library.encode_special_tokens = False
    counts, links = Counter(), []
    for entry in cut:
        of = []
        if entry:
            a, b, a_end, b_end = entry
            at = {e: i for e, i in zip(b_end, b, strict=True)}
            of = [(i, at[e]) for e, i in zip(a_end, a, strict=True) if e in at]
        links.append(of)
        counts.update(of)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for (doc_id, _), entry, of in zip(rows, cut, links, strict=True):
        if not entry:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, a_end, b_end = entry
        common = sorted({*a_end} & {*b_end})
        sides = []
        for ids, at in ((a, a_end), (b, b_end)):
            members = [[] for _ in common]
            for i, x in zip(ids, at, strict=True):
                members[bisect_left(common, x)].append(str(i))
            sides.append(members)
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides, strict=True)]
        listing = ";".join(groups)
        best = sum(counts[p] == highest[p[1]] for p in of)
        out.append((doc_id, len(a), len(b), len(groups), len(of), best, sum(counts[p] for p in of), hashlib.sha256(listing.encode()).hexdigest()))
    return sorted(out, key=str)


ALIGNED = ("doc_id", *align.MEASURES, "groups_sha256")


@pytest.mark.parametrize(("heavy", "hot"), [(align.HEAVY, align.HOT), (50, 20)])
def test_alignment_equals_the_libraries(spark, library, monkeypatch, tmp_path, heavy, hot):
    monkeypatch.setattr(align, "HEAVY", heavy)
    monkeypatch.setattr(align, "HOT", hot)
    rows = [(i, t) for i, t, *_ in odd_docs(spark, str(tmp_path))]
    rng = random.Random(6)
    few = ["the cat sat", "le chat noir\n", "token = 12345", "日本 x", "a▁b"]
    rows += [(100 + i, " ".join(rng.choices(few, k=rng.randint(1, 30)))) for i in range(60)] + [(500 + i, "hot text of many rows") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.repartition(7).write.parquet(f"{tmp_path}/more/documents.parquet")
    got = catalog.op11_cross_tokenizer_alignment(spark, f"{tmp_path}/more").collect()
    assert sorted((tuple(r[c] for c in ALIGNED) for r in got), key=str) == plain_alignment(rows, library)
    assert catalog.op11_cross_tokenizer_alignment(spark, f"{tmp_path}/empty").count() == 0


def test_alignment_query_equals_the_libraries(spark, library, texts):
    got = catalog.op11_cross_tokenizer_alignment(spark, SF).collect()
    want = plain_alignment(sorted(texts.items()), library)
    assert sorted((tuple(r[c] for c in ALIGNED) for r in got), key=str) == want


def test_alignment_lists_its_groups(spark):
    docs = spark.createDataFrame([("k", " cats"), ("k", " cats")], "groups string, text string")
    found = align.align_texts(docs, A, B, public_tokenizers.PATTERN, listing=True)
    rows = align.measures(docs, found, ["groups"]).collect()
    assert len(rows) == 2 and rows[0].n_a == len(rows[0][-1].split(";")) and found.pairs.agg({"count": "sum"}).first()[0] == 2 * rows[0].n_links
