"""The pipeline as a whole, and its stages on odd rows."""

from __future__ import annotations

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import bpe, decontaminate

WORDS = ["bcdfgklmnprst"[i % 13] + "aeiou"[i // 13 % 5] + "lmnrst"[i // 65 % 6] + "aeo"[i // 390] for i in range(900)]
ITEM = "what is the capital of the country whose rivers all run to the northern sea and whose flag is blue answer it is harbour town"


def prose(start, n=120):
    """Words that pass the quality rules, different for each start."""
    small = ("the", "of", "and", "to", "in")
    return " ".join(f"{WORDS[(start * 37 + i * 7) % 900]} {small[i % 5]} {WORDS[(start * 53 + i * 11) % 900]}." for i in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    leaked = f"{prose(1)} {ITEM} {prose(2, 20)}"
    secret = f"{prose(3)} password = hunter2hunter2 {prose(4, 10)}"
    rows = [
        (1, prose(5), "en", "a"),
        (2, prose(5), "en", "b"),
        (2, prose(5), "en", "b"),
        (3, leaked, "en", "a"),
        (None, leaked, None, None),
        (4, secret, None, "a"),
        (5, None, "en", "a"),
        (6, "", "en", "a"),
        (7, "too short", "en", "a"),
        (None, prose(6), "en", "a"),
        (8, prose(7), "de", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    docs.withColumn("n_chars", F.length("text").cast("bigint")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_the_pipeline_keeps_and_drops_what_its_stages_say(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        made = bpe.Tokenizer(f.read(), public_tokenizers.PATTERN)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=made.by_bytes, special_tokens={})
    got = {(r.doc_id, known.decode(r.ids)) for r in out.collect()}
    texts = {t for _, t in got}
    assert {i for i, _ in got} == {1, 4, 8, None} and len(got) == out.count() == 4
    assert prose(5) in texts and prose(6) in texts and prose(7) in texts
    assert not any("harbour town" in t or "hunter2" in t for t in texts)
    assert all(r.n_tokens == len(r.ids) for r in out.collect())


def test_the_pipeline_over_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_every_stage_but_the_last_keeps_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_secrets_are_replaced_and_lengths_follow(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.redact_secrets(spark, docs, folder).collect()}
    assert "hunter2" not in got[4].text and got[4].n_chars == len(got[4].text)
    assert got[5].text is None and got[5].n_chars is None and got[6].text == "" and got[8].text == prose(7)


def test_leaked_rows_go_with_and_without_an_id(spark):
    rows = [(1, f"before {ITEM} after", "x"), (None, f"before {ITEM} after", "y"), (None, "clean words only", "z"), (2, None, "w"), (3, "", "v")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, __text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    got = decontaminate.drop_leaked(docs, items)
    assert got.columns == docs.columns and sorted(r["__text"] for r in got.collect()) == ["v", "w", "z"]
