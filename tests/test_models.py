from __future__ import annotations

import numpy as np
import pytest
from conftest import day
from pyspark.sql import functions as F

from shelfcast.config import LagTransform, ModelConfig, expand_rolling, seasonal_periods
from shelfcast.functions import dates
from shelfcast.operators import backtest, features, globalmodel, models, smoothing


def found(df, *keys):
    return {tuple(r[k] for k in keys): r["y"] for r in df.collect()}


def last(offset):
    return F.array(F.lit(day(offset)))


def test_window_models(series):
    ys = [float(v) for v in np.random.default_rng(0).integers(0, 20, 30)]
    df = series({"a": dict(enumerate(ys))})
    got = found(models.window_forecasts(df, last(29), 9, season=7, window=5, seasonal_window=4), "Model", "fh")
    for fh in range(1, 10):
        slot = (fh - 1) % 7
        assert got["Naive", fh] == ys[-1]
        assert got["SeasonalNaive", fh] == ys[30 - 7 + slot]
        assert got["WindowAverage", fh] == pytest.approx(np.mean(ys[-5:]))
        same = [ys[30 - 7 * j + slot] for j in range(1, 5)]
        assert got["SeasonalWindowAverage", fh] == pytest.approx(np.mean(same))


def test_short_history_falls_back_to_the_last_value(series):
    df = series({"a": {0: 1.0, 1: 2.0, 2: 3.0}})
    got = found(models.window_forecasts(df, last(2), 7, season=7, models=("SeasonalNaive",)), "fh")
    # Steps 5 to 7 repeat the three known days, the others have no value a season back.
    assert [got[(fh,)] for fh in range(1, 8)] == [3, 3, 3, 3, 1, 2, 3]


def test_business_day_forecast_dates(series):
    df = series({"a": {i: float(i) for i in (0, 1, 2, 3, 4)}})
    got = models.window_forecasts(df, last(4), 5, season=5, models=("SeasonalNaive",), freq="B")
    rows = sorted((r["date"], r["y"]) for r in got.collect())
    assert rows == [(day(7 + i), float(i)) for i in range(5)]


def test_business_index_and_shift_agree(spark):
    frame = spark.range(0, 60).select(F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("d"))
    weekdays = frame.where(F.weekday("d") < 5)
    moved = weekdays.withColumn("m", dates.shift_date(F.col("d"), -8, "B"))
    gap = dates.day_index(F.col("d"), "B") - dates.day_index(F.col("m"), "B")
    assert moved.where((gap != 8) | (F.weekday("m") > 4)).count() == 0


def test_backtest_has_every_window_and_step(series):
    df = series({"a": {i: float(i) for i in range(40)}, "b": {i: 1.0 for i in range(40)}})
    got = backtest.rolling_origin(df, 7, 3, models=("Naive", "SBA", "Theta"), last=day(39))
    assert got.count() == 2 * 3 * 7 * 3
    firsts = got.where("fh = 1 and unique_id = 'a' and Model = 'Naive'").select("cv", "cutoff", "y", "True")
    assert sorted(map(tuple, firsts.collect())) == [
        (1, day(30), 30.0, 31.0),
        (2, day(31), 31.0, 32.0),
        (3, day(32), 32.0, 33.0),
    ]


def test_backtest_raises_when_rows_are_lost(series):
    df = series({"a": {i: float(i) for i in range(40)}, "b": {39: 1.0}})
    with pytest.raises(Exception, match="lost"):
        backtest.rolling_origin(df, 7, 2, models=("Naive",), last=day(39)).collect()


def ses(values, alpha):
    level = values[0]
    sse = 0.0
    for v in values[1:]:
        sse += (v - level) ** 2
        level = alpha * v + (1 - alpha) * level
    return level, sse


def test_croston_family(series):
    ys = [0, 0, 3, 0, 5, 2, 0, 0, 0, 8, 0]
    df = series({"a": {i: float(v) for i, v in enumerate(ys)}, "z": {i: 0.0 for i in range(11)}})
    demand = [float(v) for v in ys if v]
    at = [i + 1 for i, v in enumerate(ys) if v]
    gaps = [float(b - a) for a, b in zip([0, *at], at)]
    classic = ses(demand, 0.1)[0] / ses(gaps, 0.1)[0]
    best = lambda v: min((ses(v, a)[1], a, ses(v, a)[0]) for a in smoothing.CROSTON_GRID)[2]
    expected = {"classic": classic, "sba": classic * 0.95, "optimized": best(demand) / best(gaps)}
    for variant, value in expected.items():
        got = found(smoothing.croston(df, last(10), 2, variant), "unique_id", "fh")
        assert got["a", 2] == pytest.approx(value)
        assert got["z", 1] == 0


def test_theta_of_a_line_continues_it_half_way(series):
    df = series({"a": {i: 2.0 * i + 1 for i in range(20)}})
    got = found(smoothing.theta(df, last(19), 3, 0.5), "fh")
    line = [2.0 * t + 1 for t in range(20)]
    level, _ = ses(line, 0.5)
    assert got[(2,)] == pytest.approx(0.5 * (2 * 21 + 1) + 0.5 * level)


def test_exponential_smoothing_finds_the_cycle(series):
    cycle = [10.0, 2.0, 3.0, 4.0, 5.0, 6.0, 20.0]
    df = series({"a": {i: cycle[i % 7] for i in range(70)}})
    got = found(smoothing.exponential_smoothing(df, last(69), 7), "fh")
    assert [round(got[(fh,)], 6) for fh in range(1, 8)] == cycle


def test_ses_residuals(series):
    ys = [3.0, 5.0, 4.0, 8.0]
    rows = smoothing.ses_residuals(series({"a": dict(enumerate(ys)), "b": {0: 1.0}}), 0.3).collect()
    level, expected = ys[0], {}
    for i, v in enumerate(ys[1:], 1):
        expected[day(i)] = (day(i - 1), v, level)
        level = 0.3 * v + 0.7 * level
    assert {r["date"]: (r["cutoff"], r["y_true"], pytest.approx(r["y_pred"])) for r in rows} == expected


@pytest.mark.parametrize("block", [1, 3, 64])
def test_ses_residuals_over_blocks(series, block):
    rng = np.random.default_rng(5)
    days = [i for i in range(90) if rng.random() < 0.6 and not 20 <= i < 45]
    ys = [float(v) for v in rng.integers(0, 30, len(days))]
    df = series({"a": dict(zip(days, ys)), "late": {88: 2.0, 89: 6.0}})
    got = {(r["unique_id"], r["cv"]): (r["date"], r["cutoff"], r["y_pred"]) for r in smoothing.ses_residuals(df, 0.3, block=block).collect()}
    level = ys[0]
    for k in range(1, len(days)):
        assert got["a", k] == (day(days[k]), day(days[k - 1]), pytest.approx(level))
        level = 0.3 * ys[k] + 0.7 * level
    assert got["late", 1] == (day(89), day(88), 2.0) and len(got) == len(days)


def test_croston_needs_no_zeros(series):
    ys = {2: 3.0, 4: 5.0, 5: 2.0, 9: 8.0}
    full = series({"a": {i: ys.get(i, 0.0) for i in range(11)}, "z": {i: 0.0 for i in range(11)}})
    sparse = series({"a": ys, "z": {3: 0.0}})
    for variant in ("classic", "optimized"):
        want = found(smoothing.croston(full, last(10), 2, variant), "unique_id", "fh")
        assert found(smoothing.croston(sparse, last(10), 2, variant, start=F.lit(day(0))), "unique_id", "fh") == want


def test_autoregression_matches_least_squares(series):
    rng = np.random.default_rng(1)
    ys = list(rng.normal(size=3))
    for _ in range(60):
        ys.append(1 + 0.6 * ys[-1] - 0.3 * ys[-2] + rng.normal() * 0.1)
    df = series({"a": dict(enumerate(map(float, ys)))})
    got = found(globalmodel.autoregression(df, day(len(ys) - 1), 3, (1, 2), ridge=0.0), "fh")
    y = np.array(ys)
    x = np.column_stack([np.ones(len(y) - 2), y[1:-1], y[:-2]])
    w = np.linalg.lstsq(x, y[2:], rcond=None)[0]
    state = list(ys)
    for fh in range(1, 4):
        state.append(w @ [1, state[-1], state[-2]])
        assert got[(fh,)] == pytest.approx(state[-1], rel=1e-6)


def test_rolling_features_agree_between_training_and_windows(series):
    ys = {i: float((i * 7) % 11) for i in range(30)}
    df = series({"a": ys})
    transforms = (LagTransform("mean", 3, 2), LagTransform("std", 3, 1, 5), LagTransform("max", 2, 1, 5))
    config = ModelConfig(lags=3, lag_transforms=transforms, date_features=(), scale=False, loss="mse")
    names = [t.name for t in transforms]
    trained = {r["date"]: [r[n] for n in names] for r in globalmodel.training_rows(df, config).collect()}
    windows = {r["date"]: [r[n] for n in names] for r in features.add_rolling(df, transforms).collect()}
    assert trained and all(v == pytest.approx(windows[d]) for d, v in trained.items())


def test_global_model_learns_a_cycle_and_survives_storage(spark, series, tmp_path):
    cycle = [10.0, 2.0, 3.0, 4.0, 5.0, 6.0, 20.0]
    df = series({n: {i: k * cycle[i % 7] for i in range(84)} for n, k in (("a", 1.0), ("b", 3.0), ("c", 9.0))})
    config = ModelConfig(lags=7, loss="mse", date_features=("dayofweek",), trees=5, depth=4, learning_rate=1.0)
    fitted = globalmodel.fit(df, config)
    got = found(globalmodel.predict(fitted, df, 7, day(83)), "unique_id", "fh")
    assert [got["b", fh] for fh in range(1, 8)] == pytest.approx([3 * v for v in cycle], abs=2)
    globalmodel.save(fitted, str(tmp_path / "m"))
    again = globalmodel.load(str(tmp_path / "m"))
    assert again.config == config
    assert found(globalmodel.predict(again, df, 7, day(83)), "unique_id", "fh") == got


@pytest.mark.parametrize("loss", ["huber", "mape", "poisson"])
def test_other_losses_fit(series, loss):
    df = series({n: {i: k + (i % 7) for i in range(50)} for n, k in (("a", 1.0), ("b", 3.0))})
    config = ModelConfig(lags=7, loss=loss, date_features=(), trees=2, depth=2)
    rows = globalmodel.predict(globalmodel.fit(df, config), df, 2, day(49)).collect()
    assert len(rows) == 4 and all(r["y"] is not None for r in rows)


def test_all_zero_rows_need_a_zero_first_lag(spark):
    rows = [(0.0, 0.0, 0.0), (0.0, None, 0.0), (None, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "lag1 double, lag2 double, y double")
    assert features.drop_all_zero_rows(df).count() == 3


def test_constant_series_scale_to_zero(series):
    rows = features.scale_in_place(series({"a": {0: 4.0, 1: 4.0}})).collect()
    assert [(r["y"], r["y_std"]) for r in rows] == [(0.0, 1.0), (0.0, 1.0)]


def test_frequency_table():
    assert seasonal_periods("D") == (7, 30, 364)
    assert seasonal_periods("2M") == (6,)
    assert seasonal_periods("B") == (5,)
    assert seasonal_periods("MS") == (12,)


def test_rolling_expansion():
    names = [t.name for t in expand_rolling((("mean", 7, 2, 1), ("mean", 3, 1, 7)))]
    assert names == [
        "rolling_mean_lag1_window7",
        "rolling_mean_lag2_window7",
        "seasonal_rolling_mean_lag1_window3_season7",
    ]
