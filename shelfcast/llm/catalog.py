"""Registered queries of the subpackage, with their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    align,
    bpe,
    decontaminate,
    html_extract,
    jaccard,
    kneser_ney,
    langid,
    license_scan,
    lm,
    periodic,
    quality,
    secret_scan,
    sql,
    token_count,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id",
        *[F.col(f"quality.measures.{c}").alias(c) for c in base],
        F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.leaks(docs.select("doc_id", "text"), items.select("item_id", "text"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    text = F.col("main_text")
    return pages.select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"))


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    decoded = bpe.decode(encoded.select("doc_id", "ids"), ranks, pattern)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = (langid.remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    names, prototypes = langid.learn(docs.filter(langid.remainder(F.col("doc_id"), 4) != 2).filter("lang is not null"))
    named = langid.predict(docs.select("doc_id", "text", held), names, prototypes)
    return named.select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in secret_scan.BASE],
        F.sha2(secret_scan.listing(spans, secret_scan.BASE).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listing(spans).alias("spans"),
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.train(docs.filter(langid.remainder(F.col("doc_id"), 5) != 1))
    return lm.score(docs, model).select(
        "doc_id",
        (langid.remainder(F.col("doc_id"), 5) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return kneser_ney.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    hits = F.col("notices")
    return found.select(
        "doc_id",
        F.size(hits).cast("bigint").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(hits["license"])), ",").alias("licenses"),
        F.array_join(F.transform(hits, lambda x: F.concat_ws(":", x["license"], x["start"], x["end"])), ",").alias("spans"),
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    found = align.align_texts(docs, *files, public_tokenizers.PATTERN)
    return align.measures(docs, found, ["doc_id"]).withColumnRenamed("groups", "groups_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Ids and texts; where the id's checksum divides by ten, the words from some place on repeat in a period."""
    sums = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = sums.select("doc_id", "text", F.expr("h div 10").alias("g"), F.when(F.col("h") % 10 == 0, words).alias("words"))
    placed = cut.select("*", F.expr("if(size(words) > 0, g % size(words), null)").alias("a"))
    placed = placed.select("*", F.expr("1 + (size(words) - a) div (3 + g % 8)").alias("p"))
    repeated = "transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)]))"
    return placed.select("doc_id", F.expr(f"if(words is null, text, array_join({repeated}, ' '))").alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic.detect(docs, out="text").select("doc_id", "text.*")
    runs = F.col("runs")
    # The runs come by start and period, so the first of several with the same exponent stays.
    best = F.aggregate(runs, F.get(runs, 0), lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "n_words", "runs", "collapsed", best.alias("best"), F.array_join(line, "").alias("lines")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), F.col("text").alias("n_tokens"))
    counted = token_count.count_tokens(sized, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, "n_tokens", "n_tokens")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


QUERIES: dict[str, Query] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_byte_level_bpe": op6_byte_level_bpe,
    "op7_language_id": op7_language_id,
    "op8_secret_scans": op8_secret_scans,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_license_scans": op10_license_scans,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": f"with {sql.quality('documents')} select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged",
    "op3_ngram_jaccard_join": f"with recursive {sql.near_duplicates('documents')} select * from grouped",
}
