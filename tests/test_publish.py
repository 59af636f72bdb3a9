from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from conftest import SERIES, day
from pyspark.sql import functions as F

from shelfcast.config import Labels
from shelfcast.functions.rules import round_half_even, traffic_light
from shelfcast.operators import intervals, publish, quantiles, ranking, report, scoring
from shelfcast.plans import weekly
from shelfcast.sources import files
from shelfcast.streaming import arrivals

LABELS = Labels()
FORECAST = "unique_id string, date date, Model string, y double, fh int"


def ensemble_of(spark, *ys):
    rows = [("a", day(0), f"m{i}", y, 1) for i, y in enumerate(ys)]
    return publish.guarded_ensemble(spark.createDataFrame(rows, FORECAST), "e").first()["y"]


@pytest.mark.parametrize(
    ("ys", "expected"),
    [
        ((0.0, 0.0), 0.0),
        ((0.0, 3.0, None), 3.0),
        ((9.9, 19.8), 14.85),
        ((9.9, 19.9), 19.9),
        ((10.0, 50.0), 30.0),
        ((10.0, 50.1), 50.1),
        ((49.9, 249.4), 149.65),
        ((50.0, 350.0), 200.0),
        ((50.0, 350.1), 350.1),
        ((4.0, 5.0, 6.0, 0.0), 5.0),
    ],
)
def test_ensemble_thresholds(spark, ys, expected):
    assert ensemble_of(spark, *ys) == pytest.approx(expected)


def test_rounding_and_colours(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.4,)], "y double")
    assert [r[0] for r in df.select(round_half_even(F.col("y"))).collect()] == [0, 2, 2, 0]
    df = spark.createDataFrame([(19.99,), (20.0,), (39.99,), (40.0,), (None,)], "y double")
    assert [r[0] for r in df.select(traffic_light(F.col("y"))).collect()] == [
        "green",
        "yellow",
        "yellow",
        "red",
        "red",
    ]


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([("a", -1.0), ("b", None), ("c", 2.0)], "unique_id string, y double")
    assert {r["unique_id"]: r["y"] for r in publish.clip_forecasts(df).collect()} == {"a": 0, "b": None, "c": 2}


def forecast_rows(spark, days):
    rows = [("a", day(d), m, 1.0, i + 1) for i, d in enumerate(days) for m in ("Primary", "SeasonalNaive")]
    return spark.createDataFrame(rows, FORECAST)


@pytest.mark.parametrize(("truth_days", "attached"), [((0, 1), True), ((0,), False), ((5, 6), False), ((0, 1, 2), False)])
def test_truth_needs_the_same_dates(spark, truth_days, attached):
    truth = spark.createDataFrame([("a", day(d), 7.0) for d in truth_days], SERIES)
    got = scoring.attach_truth(forecast_rows(spark, (0, 1)), truth).collect()
    assert len(got) == 4 and all((r["True"] == 7.0) is attached for r in got)


@pytest.mark.parametrize(("days", "used"), [((0,), True), ((0, 9), False)])
def test_confirmed_rows_or_placeholders(spark, days, used):
    published = forecast_rows(spark, (0, 1)).withColumn("Color", F.lit("red"))
    confirmed = spark.createDataFrame([("a", day(d), 3.0) for d in days], SERIES)
    got = publish.attach_confirmed(published, confirmed, LABELS).where("Model = 'Confirmed'").collect()
    assert sorted((r["date"], r["y"], r["fh"]) for r in got) == (
        [(day(0), 3.0, 1)] if used else [(day(0), None, 1), (day(1), None, 2)]
    )


def test_rmsse_of_a_constant_series_is_zero(spark, series):
    scale = scoring.in_sample_scale(series({"a": {i: 4.0 for i in range(10)}}), 2)
    rows = spark.createDataFrame([("a", "m", 1, 5.0, 4.0)], "unique_id string, Model string, cv int, y double, `True` double")
    got = scoring.score(rows, scale, ["rmsse", "mase", "bias", "mape"]).first()
    assert (got["rmsse"], got["mase"], got["bias"]) == (0.0, None, 1.0)
    assert got["mape"] == pytest.approx(0.2)


def test_naive_scores_about_one_on_its_own_history(spark, series):
    ys = {i: float(v) for i, v in enumerate(np.random.default_rng(3).integers(0, 30, 200))}
    df = series({"a": ys})
    rows = df.select("unique_id", "date", F.col("y").alias("True")).join(
        df.select("unique_id", F.date_add("date", 1).alias("date"), "y"), ["unique_id", "date"]
    )
    tagged = rows.withColumns({"Model": F.lit("Naive"), "cv": F.lit(1)})
    got = scoring.score(tagged, scoring.in_sample_scale(df, 0), ["rmsse", "mase"]).first()
    assert got["rmsse"] == pytest.approx(1) and got["mase"] == pytest.approx(1)


BACKTEST = "unique_id string, fh int, y double, `True` double"


def test_error_quantiles_and_intervals(spark):
    rows = [("z", 1, 2.0, 2.0)] * 3 + [("a", 1, 0.0, e) for e in (0.0, 1.0, 2.0, 4.0)]
    df = spark.createDataFrame(rows, BACKTEST)
    skipped = intervals.error_quantiles(df, [50], error_type="normal")
    assert {r["unique_id"]: r["upper_50%"] for r in skipped.collect()} == {"z": 0.0, "a": 2.0}
    kept = intervals.error_quantiles(df, [50], error_type="normal", skip_zeros=False)
    assert {r["unique_id"]: r["upper_50%"] for r in kept.collect()} == {"z": 0.0, "a": 1.5}
    forecasts = spark.createDataFrame([("a", 1, 5.0), ("q", 1, 5.0)], "unique_id string, fh int, y double")
    got = intervals.upper_intervals(forecasts, skipped, [50]).collect()
    assert {r["unique_id"]: r["up_50"] for r in got} == {"a": 7.0, "q": 0.0}


def test_upper_bounds_grow_with_the_level(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([("a", 1, 0.0, float(v)) for v in rng.normal(size=40)], BACKTEST)
    got = intervals.error_quantiles(df, [0.5, 0.8, 0.95], error_type="absolute").first()
    assert got["upper_50%"] <= got["upper_80%"] <= got["upper_95%"]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    groups = {
        "hot": rng.integers(0, 5000, 20000).astype(float),
        "ties": np.repeat([1.0, 2.0, 9.0], [500, 3, 2]),
        "one": np.array([4.0]),
        "normal": rng.normal(size=777),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: r["quantiles"] for r in quantiles.exact_quantiles(df, ["k"], "v", shares).collect()}
    for name, vs in groups.items():
        assert got[name] == pytest.approx(list(np.quantile(vs, shares))), name


def test_distributed_rank(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 100).repartition(7)
    got = ranking.with_rank(df, [F.col("v").desc(), F.col("id")], "place").collect()
    expected = sorted(((r["v"], r["id"]) for r in got), key=lambda x: (-x[0], x[1]))
    places = {(r["v"], r["id"]): r["place"] for r in got}
    assert [places[k] for k in expected] == list(range(1, 5001))


def test_weekday_totals_across_a_year_end(spark):
    rows = [("a", date(2024, 12, 23), 1.0), ("a", date(2024, 12, 30), 2.0), ("a", date(2025, 1, 6), 3.0)]
    got = report.weekday_totals(spark.createDataFrame(rows, SERIES)).collect()
    assert {r["Week"]: r["y"] for r in got} == {"Current Week": 3, "Last Week": 2, "Two Weeks Ago": 1}


def test_missing_benchmark_is_null(spark):
    rows = [("a", "f", 1, day(0), 3.0), ("b", "f", 1, day(0), 2.0), ("a", "g", 1, day(0), 1.0)]
    df = spark.createDataFrame(rows, "unique_id string, Model string, cv int, date date, mae double")
    got = {r["unique_id"]: r["benchmark"] for r in report.worst_items(df, "f", "g").collect()}
    assert got == {"a": 1.0, "b": None}


@pytest.mark.parametrize(
    ("history_days", "update_days", "expected"),
    [((0, 1), (8, 9), (False, True)), ((0, 8), (8, 9), (True, False)), ((0, 1), (3,), (False, False))],
)
def test_run_decision(spark, history_days, update_days, expected):
    table = lambda ds: spark.createDataFrame([("a", day(d), 1.0) for d in ds], SERIES)
    forecasts = forecast_rows(spark, (8, 9)).withColumn("True", F.lit(None).cast("double"))
    got = weekly.run_decision(table(history_days), forecasts, table(update_days)).first()
    assert (got["forecast"], got["score"]) == expected
    assert weekly.run_decision(table(history_days), None, None).first()["forecast"]


def test_documents_keep_nulls(spark):
    rows = [("a", day(1), "m", 1.0, "red", None), ("a", day(0), "m", 2.0, None, 3.0)]
    df = spark.createDataFrame(rows, "unique_id string, date date, Model string, y double, Color string, `True` double")
    documents = publish.forecast_documents(df)
    assert documents.first()["records"] == (
        '[{"date":"2024-01-01","y":2.0,"Model":"m","Color":null,"True":3.0},'
        '{"date":"2024-01-02","y":1.0,"Model":"m","Color":"red","True":null}]'
    )
    back = publish.read_documents(documents).select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_file_versions(spark):
    names = ["main_28022016.csv", "main_06032016.csv", "07032016.csv", "99992016.csv", "140316.xlsx"]
    names += ["forecasts_2016-03-13.csv", "evaluation_01032016.csv", "evaluation_02032016.cs", "notes.txt"]
    paths = spark.createDataFrame([(f"x/data/{n}",) for n in names], "path string")
    got = {r["category"]: r["name"] for r in files.newest_versions(paths).collect()}
    assert got == {
        "main": "main_06032016.csv",
        "update": "140316.xlsx",
        "forecast": "forecasts_2016-03-13.csv",
        "evaluation": "evaluation_01032016.csv",
    }


def test_listing_and_delimiters(spark, tmp_path):
    (tmp_path / "070316.csv").write_text("unique_id;date;y\na;2016.03.07;1.5\nb;bad;NaN\n")
    (tmp_path / "140316.csv").write_text("unique_id,date,y\na,2016-03-14,2\n")
    listed = files.landing_check(files.list_files(spark, str(tmp_path))).collect()
    assert sorted(r["name"] for r in listed if r["accepted"]) == ["070316.csv", "140316.csv"]
    first = {tuple(r) for r in files.read_update(spark, str(tmp_path / "070316.csv")).collect()}
    assert first == {("a", date(2016, 3, 7), 1.5), ("b", None, None)}
    second = {tuple(r) for r in files.read_update(spark, str(tmp_path / "140316.csv")).collect()}
    assert second == {("a", date(2016, 3, 14), 2.0)}


def test_appending_the_same_day_changes_nothing(spark, series):
    main = series({"a": {0: 1.0, 1: 2.0}})
    assert files.append_update(main, series({"b": {1: 5.0}})).count() == 2
    assert files.append_update(main, series({"b": {2: 5.0}})).count() == 3
    assert files.append_update(main, None) is main


def test_arrivals_are_checked_and_read_once(spark, tmp_path):
    landing, table, bad, progress = (str(tmp_path / n) for n in ("in", "table", "bad", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "070316.csv").write_text("unique_id,date,y\na,2016-03-07,1\n")
    (tmp_path / "in" / "week.csv").write_text("unique_id,date,y\nz,2016-03-07,9\n")
    arrivals.ingest(spark, landing, table, bad, progress).awaitTermination()
    (tmp_path / "in" / "140316.csv").write_text("unique_id,date,y\na,2016-03-14,2\n")
    arrivals.ingest(spark, landing, table, bad, progress).awaitTermination()
    arrivals.ingest(spark, landing, table, bad, progress).awaitTermination()
    stored = spark.read.parquet(table).select("unique_id", "date", "y").collect()
    assert sorted(map(tuple, stored)) == [("a", date(2016, 3, 7), 1.0), ("a", date(2016, 3, 14), 2.0)]
    assert [r["unique_id"] for r in spark.read.parquet(bad).collect()] == ["z"]


def test_a_new_checkpoint_and_an_overlapping_file_lose_and_double_nothing(spark, tmp_path):
    landing, table, bad = (str(tmp_path / n) for n in ("in", "table", "bad"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "070316.csv").write_text("unique_id,date,y\na,2016-03-06,1\na,2016-03-07,1\n")
    arrivals.ingest(spark, landing, table, bad, str(tmp_path / "p1")).awaitTermination()
    (tmp_path / "in" / "140316.csv").write_text("unique_id,date,y\na,2016-03-07,5\na,2016-03-14,2\n")
    arrivals.ingest(spark, landing, table, bad, str(tmp_path / "p1")).awaitTermination()
    arrivals.ingest(spark, landing, table, bad, str(tmp_path / "p2")).awaitTermination()
    stored = sorted(map(tuple, arrivals.stored_history(spark, table).collect()))
    assert stored == [("a", date(2016, 3, 6), 1.0), ("a", date(2016, 3, 7), 5.0), ("a", date(2016, 3, 14), 2.0)]
    assert spark.read.parquet(table).count() == 4


def test_named_files_are_replaced_whole(spark, series, tmp_path):
    from shelfcast.sources import files

    folder = str(tmp_path / "weekly")
    rows = series({"a": {i: float(i) for i in range(14)}, "b": {3: 1.0}})
    files.write_batches(rows.withColumn("y", F.lit(9.0)), folder)
    files.write_batches(rows.where("date < '2024-01-08'"), folder)
    got = {(r.file, r.unique_id, r.date): r.y for r in files.read_named(spark, folder, files.HISTORY).collect()}
    assert {f for f, *_ in got} == {"07012024.csv", "14012024.csv"} and len(got) == 15
    assert got["07012024.csv", "b", day(3)] == 1.0 and got["14012024.csv", "a", day(13)] == 9.0
    assert sorted(p.name for p in (tmp_path / "weekly").iterdir() if not p.name.startswith(".")) == ["07012024.csv", "14012024.csv"]


def test_drawn_settings_repeat_and_stay_in_their_ranges():
    from shelfcast.config import LOSS_CANDIDATES, ModelConfig
    from shelfcast.plans import study

    drawn = study.drawn_settings(ModelConfig(), 20, seed=1)
    assert drawn == study.drawn_settings(ModelConfig(), 20, seed=1) != study.drawn_settings(ModelConfig(), 20, seed=2)
    assert all(7 <= c.lags <= 34 and 120 <= c.trees <= 300 and 0.005 <= c.learning_rate <= 0.2 and c.loss in LOSS_CANDIDATES for c in drawn.values())
