"""A corpus through five stages, each over all rows that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns the columns of `documents`,
but for the last, which returns token ids. Between stages the rows are written
as Parquet below spark.checkpoint.dir and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, decontaminate, jaccard, quality, secret_scan
from shelfcast.session import staging_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links join, the one with the smallest id stays."""
    return jaccard.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.drop_leaked(docs, items)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; n_chars follows the text."""
    clean = secret_scan.redact(secret_scan.scan(docs, out="__spans"), spans="__spans")
    counted = clean.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return counted.select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with their number."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern)
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("byte-level BPE encoding and decoding", to_tokens),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
