"""Rolling-origin backtests of the per-series models in one pass over the panel."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import models as window_models
from shelfcast.operators import smoothing
from shelfcast.operators.panel import DATE, last_date
from shelfcast.operators.scoring import backtest_truth

SES_GRID = (0.1, 0.3, 0.5, 0.7, 0.9)

_FOLDS = {
    "CrostonClassic": lambda df, cuts, h, o: smoothing.croston(df, cuts, h, "classic", o["freq"]),
    "SBA": lambda df, cuts, h, o: smoothing.croston(df, cuts, h, "sba", o["freq"]),
    "CrostonOptimized": lambda df, cuts, h, o: smoothing.croston(df, cuts, h, "optimized", o["freq"]),
    "SES": lambda df, cuts, h, o: smoothing.ses(df, cuts, h, SES_GRID, o["freq"]),
    "ETS": lambda df, cuts, h, o: smoothing.exponential_smoothing(
        df, cuts, h, season=o["season"], freq=o["freq"]
    ),
    "Theta": lambda df, cuts, h, o: smoothing.theta(df, cuts, h, 0.5, o["freq"]),
}


def benchmark_forecasts(
    history: DataFrame,
    cutoffs,
    h: int,
    models: Sequence[str],
    *,
    season: int = 7,
    window: int = 7,
    seasonal_window: int = 4,
    freq: str = "D",
) -> DataFrame:
    """Forecasts of any per-series models after each cutoff, stacked."""
    simple = [m for m in models if m in window_models.WINDOW_MODELS]
    folded = [m for m in models if m in _FOLDS]
    unknown = set(models) - set(simple) - set(folded)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    options = {"season": season, "freq": freq}
    tables = [_FOLDS[m](history, cutoffs, h, options) for m in folded]
    if simple:
        tables.append(
            window_models.window_forecasts(
                history,
                cutoffs,
                h,
                season=season,
                models=simple,
                window=window,
                seasonal_window=seasonal_window,
                freq=freq,
            )
        )
    return reduce(DataFrame.unionByName, tables)


def rolling_origin(
    history: DataFrame,
    h: int,
    windows: int,
    *,
    models: Sequence[str],
    step: int = 1,
    season: int = 7,
    window: int = 7,
    seasonal_window: int = 4,
    freq: str = "D",
    last=None,
    check: bool = True,
) -> DataFrame:
    """Forecasts and truth for every window; `last` is the newest date when known."""
    newest = last_date(history) if last is None else F.lit(last)
    cuts = window_models.backtest_cutoffs(newest, h, windows, step, freq)
    found = window_models.with_window_code(
        benchmark_forecasts(
            history,
            cuts,
            h,
            models,
            season=season,
            window=window,
            seasonal_window=seasonal_window,
            freq=freq,
        ),
        cuts,
    )
    validation = history.where((F.col(DATE) > F.array_min(cuts)) & (F.col(DATE) <= newest))
    return backtest_truth(found, validation, check)
