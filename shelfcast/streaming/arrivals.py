"""Weekly files as a stream: checked on arrival, stored, and scored once they are complete.

Each query works through what has arrived and stops (availableNow), keeps its
place in a checkpoint, and writes with dynamic partition overwrite. Stored rows
are keyed by the file they came from, so neither a repeated batch nor a new
checkpoint loses or doubles any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.config import Profile
from shelfcast.functions import dates
from shelfcast.operators.panel import DATE, ID
from shelfcast.plans.weekly import score_week
from shelfcast.session import durable
from shelfcast.sources.files import HISTORY, LANDING_PATH, clean, write_dated

STORED = "unique_id string, date date, y double, file string, source bigint"


def arriving(spark: SparkSession, folder: str, schema: str = HISTORY, sep: str = ",") -> DataFrame:
    """Rows of arriving files with the name they came from, its hash and whether it is accepted."""
    options = {"header": "true", "sep": sep, "recursiveFileLookup": "true"}
    rows = spark.readStream.schema(schema).options(**options).csv(folder)
    path = F.input_file_name()
    name = F.regexp_extract(path, LANDING_PATH, 1)
    return clean(rows).withColumns({"file": name, "source": F.xxhash64(path), "accepted": name != ""})


def _store(rows: DataFrame, table: str) -> None:
    """Rows below the file they came from; a file that is read again replaces its own rows only."""
    (
        rows.select(ID, DATE, "y", "file", "source")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source")
        .parquet(table)
    )


def ingest(
    spark: SparkSession, folder: str, table: str, quarantine: str, checkpoint: str, sep: str = ","
) -> StreamingQuery:
    """Accepted rows to the history, the others to quarantine."""

    def store(batch: DataFrame, batch_id: int) -> None:
        _store(batch.where("accepted"), table)
        _store(batch.where("not accepted"), quarantine)

    return (
        arriving(spark, folder, sep=sep)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_history(spark: SparkSession, table: str) -> DataFrame:
    """One row per series and date: of the file with the newest name, there the largest value."""
    rows = spark.read.schema(STORED).parquet(table)
    newest = F.max(F.struct(dates.parse_file_date(F.split_part("file", F.lit("."), F.lit(1))), "file", "y"))
    return rows.groupBy(ID, DATE).agg(newest["y"].alias("y"))


def score_arrivals(
    spark: SparkSession,
    truth_table: str,
    forecasts: DataFrame,
    history: DataFrame,
    profile: Profile,
    score_table: str,
    checkpoint: str,
) -> StreamingQuery:
    """Score a published forecast when all its dates have sales.

    New rows only wake the query: truth is read from all that is stored, so it
    may come in parts, late, or with other weeks. A correction scores again and
    replaces the scores of that forecast.
    """

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        actual = stored_history(spark, truth_table).withColumnRenamed("y", "True")
        evaluated = durable(forecasts.drop("True").join(actual, [ID, DATE], "left"))
        known = evaluated.groupBy(DATE).agg(F.count("True").alias("rows"))
        if known.agg(F.coalesce(F.min("rows"), F.lit(0)).alias("least")).first()["least"] == 0:
            return
        write_dated(score_week(history, evaluated, profile), score_table)

    return (
        spark.readStream.schema(STORED)
        .parquet(truth_table)
        .writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
