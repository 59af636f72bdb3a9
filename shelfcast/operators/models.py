"""Per-series benchmark models and the codes of a forecast table.

Models with a fixed memory (naive, seasonal naive, window averages) read only
the last days before each cutoff and are one aggregate per series. Models with
unbounded memory (Croston, smoothing, theta) fold over the series as an array,
whose length is that of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.operators.panel import DATE, ID, last_date

NAIVE = "Naive"
SEASONAL_NAIVE = "SeasonalNaive"
WINDOW_AVERAGE = "WindowAverage"
SEASONAL_WINDOW_AVERAGE = "SeasonalWindowAverage"
WINDOW_MODELS = (NAIVE, SEASONAL_NAIVE, WINDOW_AVERAGE, SEASONAL_WINDOW_AVERAGE)


def backtest_cutoffs(
    last: Column, h: int, windows: int, step: int = 1, freq: str = "D"
) -> Column:
    """Cutoff dates of rolling-origin windows, oldest first.

    Window i of n ends at last - h - step * (n - 1 - i).
    """
    return F.array(
        *[dates.shift_date(last, -(h + step * (windows - 1 - i)), freq) for i in range(windows)]
    )


def single_cutoff(df: DataFrame) -> Column:
    """The newest date, for a forecast beyond the data."""
    return F.array(last_date(df))


def tag_windows(df: DataFrame, cutoffs: Column, depth: int | None, freq: str = "D") -> DataFrame:
    """Rows once per window they belong to, with `back` steps before its cutoff.

    `depth` keeps the last steps only, which also bounds what is exploded.
    """
    back = dates.day_index(F.col("cutoff"), freq) - dates.day_index(F.col(DATE), freq)
    rows = df.where(F.col(DATE) <= F.array_max(cutoffs))
    if depth is not None:
        rows = rows.where(F.col(DATE) > dates.shift_date(F.array_min(cutoffs), -depth, freq))
    tagged = rows.withColumn("cutoff", F.explode_outer(cutoffs)).withColumn("back", back)
    inside = F.col("back") >= 0
    return tagged.where(inside if depth is None else inside & (F.col("back") < depth))


def window_forecasts(
    df: DataFrame,
    cutoffs: Column,
    h: int,
    *,
    season: int = 7,
    models: Sequence[str] = WINDOW_MODELS,
    window: int = 7,
    seasonal_window: int = 4,
    freq: str = "D",
    keys: Sequence[str] = (ID,),
) -> DataFrame:
    """Forecasts of the fixed-memory models, one row per series, cutoff, step and model.

    A model without the history it needs falls back to the last value.
    """
    unknown = set(models) - set(WINDOW_MODELS)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    depths = {
        NAIVE: 1,
        SEASONAL_NAIVE: season,
        WINDOW_AVERAGE: window,
        SEASONAL_WINDOW_AVERAGE: season * seasonal_window,
    }
    depth = max(depths[m] for m in models)
    tagged = tag_windows(df, cutoffs, depth, freq)
    back, y = F.col("back"), F.col("y")

    aggregates = [F.max_by("y", DATE).alias("_last")]
    if SEASONAL_NAIVE in models:
        slots = [F.max(F.when(back == season - 1 - k, y)) for k in range(season)]
        aggregates.append(F.array(*slots).alias("_naive_slots"))
    if WINDOW_AVERAGE in models:
        aggregates.append(F.avg(F.when(back < window, y)).alias("_average"))
    if SEASONAL_WINDOW_AVERAGE in models:
        recent = back < season * seasonal_window
        slots = [F.avg(F.when(recent & (back % season == season - 1 - k), y)) for k in range(season)]
        aggregates.append(F.array(*slots).alias("_average_slots"))
    memory = tagged.groupBy(*keys, "cutoff").agg(*aggregates)

    slot = (F.col("fh") - 1) % season
    value = {
        NAIVE: F.col("_last"),
        WINDOW_AVERAGE: F.col("_average") if WINDOW_AVERAGE in models else None,
        SEASONAL_NAIVE: F.get("_naive_slots", slot) if SEASONAL_NAIVE in models else None,
        SEASONAL_WINDOW_AVERAGE: (
            F.get("_average_slots", slot) if SEASONAL_WINDOW_AVERAGE in models else None
        ),
    }
    steps = memory.withColumn("fh", F.explode_outer(F.sequence(F.lit(1), F.lit(h))))
    per_model = F.array(
        *[
            F.struct(F.lit(m).alias("Model"), F.coalesce(value[m], F.col("_last")).alias("y"))
            for m in models
        ]
    )
    return steps.select(
        *keys,
        dates.shift_date(F.col("cutoff"), F.col("fh"), freq).alias(DATE),
        "cutoff",
        F.inline_outer(per_model),
        "fh",
    )


def with_window_code(df: DataFrame, cutoffs: Column) -> DataFrame:
    """cv: 1-based position of the cutoff among all cutoffs."""
    return df.withColumn("cv", F.array_position(F.sort_array(cutoffs), F.col("cutoff")).cast("int"))


def as_plain_forecast(df: DataFrame) -> DataFrame:
    """A forecast beyond the data: no cutoff, and cv is null."""
    return df.drop("cutoff").withColumn("cv", F.lit(None).cast("int"))


def horizon_code(df: DataFrame) -> DataFrame:
    """fh as the rank of the date within its series."""
    window = Window.partitionBy(ID).orderBy(DATE)
    return df.withColumn("fh", F.dense_rank().over(window))


def backtest_codes(df: DataFrame) -> DataFrame:
    """cv as the rank of the cutoff within its series, fh as days after the cutoff."""
    window = Window.partitionBy(ID).orderBy("cutoff")
    return df.withColumns(
        {
            "cv": F.dense_rank().over(window),
            "fh": F.datediff(F.col(DATE), F.col("cutoff")),
        }
    )


def with_fallback(forecasts: DataFrame, naive: DataFrame) -> DataFrame:
    """Null forecasts replaced by the naive value of the same series and date."""
    keys = [c for c in (ID, DATE, "cutoff") if c in forecasts.columns and c in naive.columns]
    spare = naive.select(*keys, F.col("y").alias("_naive"))
    return (
        forecasts.join(spare, keys, "left")
        .withColumn("y", F.coalesce("y", "_naive"))
        .drop("_naive")
    )


def only_future_ids(df: DataFrame, future: DataFrame) -> DataFrame:
    """Series that occur in the table of future covariates."""
    return df.join(future.select(ID).distinct(), ID, "left_semi")


def one_step_residuals(df: DataFrame, model: str, *, season: int = 7, window: int = 7) -> DataFrame:
    """In-sample one-step errors of the fixed-memory models."""
    order = Window.partitionBy(ID).orderBy(DATE)
    if model == NAIVE:
        fitted = F.lag("y", 1).over(order)
    elif model == SEASONAL_NAIVE:
        fitted = F.lag("y", season).over(order)
    elif model == WINDOW_AVERAGE:
        frame = order.rowsBetween(-window, -1)
        fitted = F.when(F.count("y").over(frame) == window, F.avg("y").over(frame))
    else:
        raise ValueError(f"no residuals for {model!r}")
    return (
        df.select(
            ID,
            DATE,
            F.lag(DATE, 1).over(order).alias("cutoff"),
            F.col("y").alias("y_true"),
            fitted.alias("y_pred"),
        )
        .where(F.col("y_pred").isNotNull())
        .withColumns(
            {
                "Model": F.lit(model),
                "residual": F.col("y_true") - F.col("y_pred"),
                "fh": F.lit(1),
                "cv": F.dense_rank().over(Window.partitionBy(ID).orderBy("cutoff")),
            }
        )
    )
