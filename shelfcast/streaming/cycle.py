"""The weekly cycle: files land, forecasts are scored as their truth arrives, the next one is published.

Four tables below one folder: `history` (sold rows by the file they came from),
`published` (forecasts by the date they were made from), `owed` (forecast rows
whose date some file covers, with the sales of that file) and `scores` (by the
batch that wrote them). Every step keeps its place in a checkpoint, so that a
run which ends early is taken up again and a file is worked through once.

What a published forecast still lacks is state of the stream, kept per forecast
and series: a batch touches the series whose dates have arrived and reads no
stored truth again. A row is emitted when the last date of a series has come,
again when a later file corrects one, and with what is known when no file has
brought the rest within the days of grace.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from shelfcast.functions import dates
from shelfcast.operators import scoring
from shelfcast.operators.panel import DATE, ID
from shelfcast.plans.weekly import run_decision
from shelfcast.session import durable
from shelfcast.sources.files import write_dated
from shelfcast.streaming.arrivals import STORED, _store, arriving, stored_history

PUBLISHED = "unique_id string, date date, Model string, y double, fh int, forecast date"
OWED = "unique_id string, date date, forecast date, truth double, explicit boolean, stamp timestamp, ends date, n_dates int, source bigint"
ARRIVED = "forecast date, unique_id string, date date, truth double, complete boolean"
SCORES = "unique_id string, Model string, cv int, date date, rmsse double, mae double, bias double, complete boolean, forecast date, batch bigint"


@dataclass(frozen=True)
class Store:
    """Where the cycle keeps its tables and its place in the streams."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema({"history": STORED, "published": PUBLISHED, "owed": OWED, "scores": SCORES}[name]).parquet(self.at(name))

    def create(self, spark: SparkSession) -> None:
        """Empty tables, so that every read finds its folder; nothing is done to tables that are there."""
        keys = {"history": "source", "quarantine": "source", "published": "forecast", "owed": "source", "scores": "batch"}
        kinds = {"history": STORED, "quarantine": STORED, "published": PUBLISHED, "owed": OWED, "scores": SCORES}
        for name, key in keys.items():
            spark.createDataFrame([], kinds[name]).write.mode("append").partitionBy(key).parquet(self.at(name))


def history(spark: SparkSession, store: Store) -> DataFrame:
    return stored_history(spark, store.at("history"))


def scores(spark: SparkSession, store: Store) -> DataFrame:
    """The newest scores of each forecast, series and model."""
    rows = store.table(spark, "scores")
    keys = [ID, "Model", "cv", DATE, "forecast"]
    newest = F.max_by(F.struct("rmsse", "mae", "bias", "complete"), "batch").alias("s")
    return rows.groupBy(*keys).agg(newest).select(*keys, "s.*")


def _owed(batch: DataFrame, published: DataFrame) -> DataFrame:
    """Forecast rows of the dates that the batch's files cover; 0 where a file has no row of the series."""
    spans = published.groupBy("forecast").agg(F.max(DATE).alias("ends"), F.count_distinct(DATE).cast("int").alias("n_dates"))
    due = published.select("forecast", ID, DATE).distinct()
    # One row per file and day, and per forecast.
    covered = batch.groupBy("source", DATE).agg(F.max("stamp").alias("stamp"))
    sold = batch.groupBy("source", ID, DATE).agg(F.max("y").alias("sold"))
    rows = due.join(F.broadcast(covered), DATE).join(F.broadcast(spans), "forecast")
    found = rows.join(sold, ["source", ID, DATE], "left").select(
        ID,
        DATE,
        "forecast",
        F.coalesce("sold", F.lit(0.0)).alias("truth"),
        F.col("sold").isNotNull().alias("explicit"),
        "stamp",
        "ends",
        "n_dates",
        "source",
    )
    # A row of each file without a forecast, so that time goes on where nothing is owed to it.
    beats = covered.groupBy("source").agg(F.max("stamp").alias("stamp"))
    return found.unionByName(beats, allowMissingColumns=True)


def ingest(spark: SparkSession, store: Store, folder: str, sep: str = ",") -> StreamingQuery:
    """New files to the history, those with other names to quarantine, and what forecasts owe to them."""

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = durable(batch)
        good = batch.where("accepted")
        _store(batch.where("not accepted"), store.at("quarantine"))
        _store(good, store.at("history"))
        stamped = good.withColumn("stamp", dates.parse_file_date(F.split_part("file", F.lit("."), F.lit(1))).cast("timestamp"))
        owed = _owed(stamped, store.table(spark, "published"))
        owed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(store.at("owed"))

    return (
        arriving(spark, folder, sep=sep)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", store.at("progress/ingest"))
        .trigger(availableNow=True)
        .start()
    )


def _tracker(grace: int) -> StatefulProcessor:
    """Per forecast and series the truth by date; made in a function, so that workers get it with the job."""

    def rows_of(key: tuple, known: dict, complete: bool) -> pd.DataFrame:
        entries = [(key[0], key[1], date.fromisoformat(d), value, complete) for d, (value, _, _) in sorted(known.items())]
        return pd.DataFrame(entries, columns=["forecast", "unique_id", "date", "truth", "complete"])

    class Tracker(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self.handle = handle
            self.state = handle.getValueState("truth", "known string, n_dates int")

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            if key[0] is None:
                return
            table = pd.concat(list(rows))
            deadline = int(pd.Timestamp(table["ends"].iloc[0] + timedelta(days=grace + 1), tz="UTC").timestamp() * 1000)
            if timerValues.getCurrentWatermarkInMs() > deadline:
                return
            first = not self.state.exists()
            known = {} if first else json.loads(self.state.get()[0])
            before = json.dumps(known, sort_keys=True)
            for row in table.itertuples():
                day, new = row.date.isoformat(), [float(row.truth), bool(row.explicit), int(row.stamp.timestamp())]
                old = known.get(day)
                # What a file says counts more than what it leaves out, and a newer file more than an older one.
                if old is None or (new[1], new[2], new[0]) > (old[1], old[2], old[0]):
                    known[day] = new
            n_dates = int(table["n_dates"].iloc[0])
            self.state.update((json.dumps(known), n_dates))
            if first:
                self.handle.registerTimer(deadline)
            if len(known) == n_dates and json.dumps(known, sort_keys=True) != before:
                yield rows_of(key, known, True)

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            if self.state.exists():
                text, n_dates = self.state.get()
                known = json.loads(text)
                if len(known) < n_dates:
                    yield rows_of(key, known, False)
                self.state.clear()

        def close(self) -> None:
            pass

    return Tracker()


def score_owed(spark: SparkSession, store: Store, metrics=scoring.DEFAULT_METRICS, grace: int = 28) -> StreamingQuery:
    """Scores of every series whose forecast has its truth, in the units of the history before the forecast."""

    def score(batch: DataFrame, batch_id: int) -> None:
        batch = durable(batch.withColumnRenamed("truth", "True"))
        made = [r["forecast"] for r in batch.select("forecast").distinct().collect()]  # some weeks
        sold = history(spark, store)
        found = []
        for cutoff in made:
            # Partitions of the other forecasts are not read.
            published = store.table(spark, "published").where(F.col("forecast") == F.lit(cutoff))
            rows = published.join(batch.where(F.col("forecast") == F.lit(cutoff)).drop("forecast"), [ID, DATE])
            before = sold.where(F.col(DATE) <= F.lit(cutoff))
            end = published.agg(F.max(DATE)).scalar()
            keys = (ID, "Model", "cv", "complete")
            scored = scoring.score(rows.withColumn("cv", F.lit(1)), scoring.in_sample_scale(before, 0), metrics, keys)
            found.append(scored.withColumns({DATE: end, "forecast": F.lit(cutoff), "batch": F.lit(batch_id).cast("bigint")}))
        if found:
            write_dated(reduce(DataFrame.unionByName, found), store.at("scores"), "batch")

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    owed = spark.readStream.schema(OWED).parquet(store.at("owed")).withWatermark("stamp", "0 seconds")
    return (
        owed.groupBy("forecast", ID)
        .transformWithStateInPandas(_tracker(grace), ARRIVED, "Update", "EventTime")
        .writeStream.foreachBatch(score)
        .outputMode("update")
        .option("checkpointLocation", store.at("progress/scores"))
        .trigger(availableNow=True)
        .start()
    )


Make = Callable[[DataFrame], DataFrame]


def publish_if_due(spark: SparkSession, store: Store, make: Make) -> bool:
    """Publish a forecast from the stored history when the last one is used up."""
    sold = history(spark, store)
    published = store.table(spark, "published")
    newest = published.agg(F.max("forecast").alias("d")).first()["d"]
    latest = None if newest is None else published.where(F.col("forecast") == F.lit(newest)).withColumn("True", F.lit(None).cast("double"))
    if not run_decision(sold, latest, None).first()["forecast"]:
        return False
    last = sold.agg(F.max(DATE).alias("d")).first()["d"]
    rows = make(sold).select(ID, DATE, "Model", "y", "fh").withColumn("forecast", F.lit(last))
    write_dated(rows, store.at("published"), "forecast")
    return True


def run(spark: SparkSession, store: Store, folder: str, make: Make, grace: int = 28, sep: str = ",") -> bool:
    """One turn of the cycle: take what has landed, score, publish if due; true if it published.

    A turn that was ended early is made up by the next one: files are read from
    where the checkpoint stands, and tables are overwritten by file, forecast
    and batch.
    """
    store.create(spark)
    ingest(spark, store, folder, sep).awaitTermination()
    score_owed(spark, store, grace=grace).awaitTermination()
    return publish_if_due(spark, store, make)
