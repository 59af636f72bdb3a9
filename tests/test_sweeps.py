"""Sweeps and backtests of the global model: real fits on small panels."""

from __future__ import annotations

import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from conftest import day
from pyspark.sql import functions as F

from shelfcast.catalog import globals as queries
from shelfcast.catalog import panels as p
from shelfcast.config import ModelConfig
from shelfcast.operators import globalmodel, scoring, targets
from shelfcast.plans import study, weekly

SF = "/root/testdata/sf0.001"
TINY = ModelConfig(lags=3, loss="mse", date_features=("dayofweek",), trees=2, depth=2, scale=False)


def panel_of(series, n=40, names=("a", "b", "c")):
    return series({s: {i: float((k + 2) * (i % 7) + k) for i in range(n)} for k, s in enumerate(names)})


def test_sweeps_try_the_named_settings(spark, monkeypatch):
    seen = {}

    def record(rows, scale, settings, *, h, windows, last):
        seen[len(settings)] = (settings, h, windows)
        return rows

    monkeypatch.setattr(queries.study, "sweep", record)
    for run in (queries.m21_loss_sweep, queries.m22_calendar_sweep, queries.m23_lag_sweep):
        run(spark, SF)
    assert {n: (h, w) for n, (_, h, w) in seen.items()} == {9: (p.H, 5), 16: (p.H, 5), 21: (p.H, 5)}
    losses, calendars, lags = (seen[n][0] for n in (9, 16, 21))
    assert losses["scaled/fair"].scale and not losses["covariates/mae"].scale
    assert losses["covariates/tweedie"].covariates == queries.COVARIATES and losses["scaled/mse"].covariates == ()
    assert calendars["covariates/dayofweek+month+day"].loss == "mae" and calendars["scaled/none"].loss == "fair"
    assert sorted(c.lags for c in lags.values()) == [*range(7, 28)] and {c.loss for c in lags.values()} == {"fair"}


def test_a_sweep_equals_single_backtests(spark, series):
    # Noise, so that no two splits are equally good.
    rng = np.random.default_rng(7)
    rows = series({s: {i: float(10 * (i % 7) + rng.normal()) for i in range(40)} for s in "abc"})
    scale = scoring.in_sample_scale(rows, 8)
    settings = study.set_ups(
        plain=study.lag_settings(TINY, (2, 5)), scaled={"month": replace(TINY, scale=True, date_features=("month", "day"))}
    )
    board = study.sweep(rows, scale, settings, h=4, windows=2, last=day(39))
    got = {r.setting: (r.rmsse, r.mae, r.bias) for r in board.collect()}
    assert set(got) == {"plain/lags02", "plain/lags05", "scaled/month"}
    for name, config in settings.items():
        found = []
        for cutoff in (day(34), day(35)):
            known = rows.where(F.col("date") <= F.lit(cutoff))
            found.append(globalmodel.predict(globalmodel.fit(known, config), known, 4, cutoff).withColumn("cv", F.lit(str(cutoff))))
        joined = found[0].unionByName(found[1]).join(rows.withColumnRenamed("y", "True"), ["unique_id", "date"])
        scores = scoring.score(joined, scale).agg(*[F.avg(m) for m in scoring.DEFAULT_METRICS]).first()
        assert got[name] == pytest.approx(tuple(scores))


def test_models_are_kept_over_windows(series):
    rows = panel_of(series)
    every = globalmodel.rolling_origin(rows, TINY, 3, 3, day(39), refit=2, step=2)
    got = every.groupBy("cv").agg(F.min("cutoff").alias("c"), F.count("*").alias("n")).collect()
    assert {r.cv: (r.c, r.n) for r in got} == {1: (day(32), 9), 2: (day(34), 9), 3: (day(36), 9)}


def test_lost_series_are_an_error(series):
    rows = panel_of(series).unionByName(series({"late": {38: 1.0, 39: 2.0}}))
    with pytest.raises(Exception, match="backtest rows were lost"):
        globalmodel.rolling_origin(rows, TINY, 3, 1, day(39)).collect()


def test_business_day_cutoffs(spark, series):
    rows = series({"a": {i: float(i) for i in range(20) if i % 7 < 5}})
    assert globalmodel.rolling_cutoffs(rows, 3, 2, day(11), freq="B") == [day(7), day(8)]


@pytest.mark.parametrize("chain", [(targets.Difference(1),), (targets.Difference(7),), (targets.Log(), targets.Difference(2)), ()])
def test_target_transforms_undo_themselves(series, chain):
    ys = [float(v) for v in np.random.default_rng(3).integers(0, 30, 40)]
    rows = series({"a": dict(enumerate(ys)), "b": {i: 2 * v + 1 for i, v in enumerate(ys)}})
    config = ModelConfig(lags=4, loss="mse", date_features=(), transforms=chain)
    known = rows.where(F.col("date") <= F.lit(day(29)))
    state = globalmodel.last_values(known, config, day(29))
    # Steps that are the true values in the model's units must come back as the true values.
    moved = targets.forward(rows, chain).where(F.col("date") > F.lit(day(29)))
    true = moved.groupBy("unique_id").agg(F.sort_array(F.collect_list(F.struct("date", "y"))).alias("t"))

    def step(df):
        index = F.datediff("date", "cutoff") - 1
        return df.withColumn("prediction", (F.get(F.col("t"), index)["y"] - F.col("y_mean")) / F.col("y_std"))

    found = globalmodel.recurse(state.join(true, "unique_id"), step, config, 10, named=False)
    got = {(r.unique_id, r.fh): r.y for r in found.collect()}
    for k in range(10):
        assert got["a", k + 1] == pytest.approx(ys[30 + k]) and got["b", k + 1] == pytest.approx(2 * ys[30 + k] + 1)
    fitted = globalmodel.fit(known, replace(config, trees=1, depth=2))
    values = globalmodel.fitted_values(fitted, known).where("unique_id = 'a'").collect()
    assert all(r.y == pytest.approx(ys[(r.date - day(0)).days]) for r in values) and len(values) > 15


def test_transforms_of_a_setting_are_stored(tmp_path):
    config = ModelConfig(transforms=(targets.Difference(7), targets.Log()))
    assert globalmodel.settings_of(globalmodel.settings_json(config)) == config


def coded_panel(spark, n=60):
    """y follows a category that numbers cannot order, and a static one."""
    rows, rng = [], np.random.default_rng(11)
    for s, level in (("a", 0), ("b", 1), ("c", 2)):
        for i in range(n):
            code = int(rng.integers(0, 4))
            rows.append((s, day(i), float({0: 5, 1: 50, 2: 5, 3: 50}[code] + 100 * (level == 1)), code, level))
    return spark.createDataFrame(rows, "unique_id string, date date, y double, menu int, kind int")


def test_categories_are_named_and_a_covariate_changes_the_forecast(spark):
    rows = coded_panel(spark)
    config = replace(TINY, covariates=("menu",), static_features=("kind",), categorical=("menu", "kind"), date_features=(), trees=4, depth=4, learning_rate=1.0)
    fitted = globalmodel.fit(rows, config)
    field = fitted.pipeline.stages[0].transform(globalmodel.feature_rows(rows, config)).schema["features"]
    assert [(a["name"], a["num_vals"]) for a in field.metadata["ml_attr"]["attrs"]["nominal"]] == [("menu", 5), ("kind", 4)]

    def ahead(code):
        return spark.createDataFrame([(s, day(60), code) for s in "abc"] * 2, "unique_id string, date date, menu int")

    low, high, odd = (
        {r.unique_id: r.y for r in globalmodel.predict(fitted, rows, 1, day(59), future=ahead(c)).collect()} for c in (0, 1, 99)
    )
    assert low["a"] == pytest.approx(5, abs=3) and high["a"] == pytest.approx(50, abs=3)
    assert low["b"] == pytest.approx(105, abs=3) and high["b"] == pytest.approx(150, abs=3)
    assert set(odd) == set("abc")
    with pytest.raises(ValueError, match="future covariates"):
        globalmodel.predict(fitted, rows, 1, day(59))


def test_stored_pipeline_forecasts_in_another_process(spark, series, tmp_path):
    rows = panel_of(series)
    config = replace(TINY, transforms=(targets.Difference(7),), scale=True)
    fitted = globalmodel.fit(rows, config)
    want = sorted((r.unique_id, r.fh, round(r.y, 9)) for r in globalmodel.predict(fitted, rows, 5, day(39)).collect())
    globalmodel.save(fitted, str(tmp_path), globalmodel.last_values(rows, config, day(39)))
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from shelfcast.operators import globalmodel
from shelfcast.session import build_session
spark = build_session("other", "local[2]")
found = globalmodel.predict_state(globalmodel.load({str(tmp_path)!r}), globalmodel.load_state({str(tmp_path)!r}), 5)
print(sorted((r.unique_id, r.fh, round(r.y, 9)) for r in found.collect()))
spark.stop()
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert run.stdout.strip().splitlines()[-1] == str(want)


def test_holiday_is_coded_as_a_number(spark):
    from shelfcast.operators import features

    df = spark.createDataFrame([("10",), ("2",), ("2.0",), (None,), ("x",)], "Holiday string")
    assert [r.Holiday for r in features.categorise(df, ["Holiday"]).collect()] in ([1, 0, 0, -1, -1],) or sorted(
        r.Holiday for r in features.categorise(df, ["Holiday"]).collect()
    ) == [-1, -1, 0, 0, 1]


def test_weekday_profile_uses_its_covariates(spark):
    orders = p.weekday_orders(spark, SF)
    last = orders.agg(F.max("date")).first()[0]
    end = F.date_sub(F.lit(last), 7)
    known, later = orders.where(F.col("date") <= end), orders.where(F.col("date") > end).drop("y")
    profile = queries.WEEKDAY_ORDERS.with_model(trees=2, depth=3)
    found = weekly.publish_week(known, profile, future=later)
    by_model = {r.Model: r.n for r in found.groupBy("Model").agg(F.count("*").alias("n")).collect()}
    assert by_model[profile.labels.primary] > 0 and found.where(F.weekday("date") > 4).count() == 0
    with pytest.raises(ValueError, match="future covariates"):
        weekly.publish_week(known, profile)


def test_the_sweeps_panel_reads_the_facts_once(spark):
    """It stands on stored daily rows, and is what one pass per step would give."""
    days = p.span(spark, SF)
    rows = queries._covariate_history(spark, SF, days)
    assert not any("lineitem" in f for f in rows.inputFiles())
    names = ["sell_price", "event_type_1", "snap"]
    plain = queries.panel.fill_calendar(p.brand_with_covariates(spark, SF), covars=names, span=days)
    plain = queries.panel.fill_most_frequent(plain, item_covars=names[:2], item_time_covars=names[2:])
    plain = queries.panel.drop_first_dates(queries.features.categorise(plain, ["event_type_1"]), 180, days)
    assert rows.columns == plain.columns and rows.exceptAll(plain).count() == plain.exceptAll(rows).count() == 0
