"""Prediction intervals: error quantiles, model-based bounds and their reshapes."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.models import NAIVE, SEASONAL_NAIVE, one_step_residuals
from shelfcast.operators.panel import DATE, ID


def as_shares(levels: Sequence[float]) -> list[float]:
    """Levels of 1 and above are percents."""
    return [x / 100 for x in levels] if levels[0] >= 1 else list(levels)


def percent(level: float) -> int:
    return int(round(level * 100, 2))


def forecast_error(kind: str) -> Column:
    truth, forecast = F.col("True"), F.col("y")
    if kind == "absolute":
        return F.abs(forecast - truth)
    if kind == "normal":
        return truth - forecast
    if kind == "positive":
        gap = truth - forecast
        return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))
    raise ValueError("error type should be absolute, normal or positive")


def error_quantiles(
    backtest: DataFrame,
    levels: Sequence[float],
    *,
    method: str = "empirical",
    skip_zeros: bool = True,
    error_type: str = "absolute",
    on: Sequence[str] = (ID, "fh"),
) -> DataFrame:
    """upper_{p}%: linear quantiles of the backtest errors per key.

    With `skip_zeros` zero errors are left out, and a key with nothing else
    gets 0. A key holds one error per window (and step), so its exact
    quantile is over a handful of values.
    """
    if method not in {"empirical", "conformal"}:
        raise ValueError("method should be either empirical or conformal")
    shares = as_shares(levels)
    skip = skip_zeros and method == "empirical"
    errors = backtest.withColumn("_error", forecast_error(error_type))
    used = F.when(F.col("_error") != 0, F.col("_error")) if skip else F.col("_error")
    found = F.percentile(used, F.array(*[F.lit(q) for q in shares]))
    grouped = errors.groupBy(*on).agg(found.alias("_q"), F.count_if(F.col("_error") == 0).alias("_zeros"))
    columns = []
    for position, level in enumerate(shares):
        value = F.get("_q", F.lit(position))
        if skip:
            value = F.coalesce(value, F.when(F.col("_zeros") > 0, F.lit(0.0)))
        columns.append(value.alias(f"upper_{percent(level)}%"))
    return grouped.select(*on, *columns)


def upper_intervals(
    forecasts: DataFrame,
    quantiles: DataFrame,
    levels: Sequence[float],
    on: Sequence[str] = (ID, "fh"),
) -> DataFrame:
    """up_{p} = forecast plus quantile, 0 when negative or unknown."""
    joined = forecasts.join(quantiles, list(on), "left")
    columns = []
    for level in as_shares(levels):
        bound = F.col("y") + F.col(f"`upper_{percent(level)}%`")
        columns.append(F.when(bound > 0, bound).otherwise(0.0).alias(f"up_{percent(level)}"))
    return joined.select(*[F.col(f"`{c}`") for c in forecasts.columns], *columns)


def normal_intervals(
    forecasts: DataFrame,
    history: DataFrame,
    model: str,
    levels: Sequence[float],
    season: int = 7,
) -> DataFrame:
    """{model}-lo-{level} and {model}-hi-{level} from the in-sample error spread.

    The spread grows with the square root of the steps (naive) or of the
    started seasons (seasonal naive). Levels below 1 count as shares.
    """
    percents = [int(round(x * 100)) if x < 1 else int(x) for x in levels]
    residuals = one_step_residuals(history, model, season=season)
    sigma = residuals.groupBy(ID).agg(
        F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("_sigma")
    )
    if model == NAIVE:
        growth = F.sqrt(F.col("fh"))
    elif model == SEASONAL_NAIVE:
        growth = F.sqrt(F.floor((F.col("fh") - 1) / season) + 1)
    else:
        raise ValueError(f"no model-based intervals for {model!r}")
    bounds = []
    for level in percents:
        z = NormalDist().inv_cdf(0.5 + level / 200)
        reach = F.col("_sigma") * growth * F.lit(z)
        bounds.append((F.col("y") - reach).alias(f"{model}-lo-{level}"))
        bounds.append((F.col("y") + reach).alias(f"{model}-hi-{level}"))
    keys = [c for c in forecasts.columns if c not in {"Model", "y"}]
    return (
        forecasts.where(F.col("Model") == model)
        .join(sigma, ID)
        .select(*keys, F.col("y").alias(model), *bounds)
    )


def melt_intervals(
    wide: DataFrame,
    models: Sequence[str],
    levels: Sequence[int],
    *,
    keys: Sequence[str] = (ID, DATE),
    invert: bool = False,
    non_negative: bool = False,
) -> DataFrame:
    """{model}-lo/hi-{level} columns to rows per model with low_{l} and up_{l}.

    One pass builds a struct per model, so nothing is pivoted or joined back.
    `invert` publishes low_{p} as up_{100-p}.
    """
    present = set(wide.columns)
    rows = []
    for model in models:
        fields = [F.lit(model).alias("Model"), F.col(f"`{model}`").cast("double").alias("y")]
        for level in levels:
            for side, name in (("lo", "low"), ("hi", "up")):
                source = f"{model}-{side}-{level}"
                value = F.col(f"`{source}`") if source in present else F.lit(None)
                value = value.cast("double")
                if non_negative:
                    value = F.when(value < 0, F.lit(0.0)).otherwise(value)
                fields.append(value.alias(f"{name}_{level}"))
        rows.append(F.struct(*fields))
    melted = wide.select(*keys, F.inline_outer(F.array(*rows)))
    if not invert:
        return melted
    renamed = melted.withColumnsRenamed({f"low_{level}": f"up_{100 - level}" for level in levels})
    bounds = [c for c in renamed.columns if c not in {*keys, "Model", "y"}]
    bounds.sort(key=lambda c: (c.split("_")[0], int(c.split("_")[1])))
    return renamed.select(*keys, "Model", "y", *bounds)


def extract_intervals(wide: DataFrame, models: Sequence[str], levels: Sequence[int]) -> DataFrame:
    """Lower-{l} and Upper-{l} per model."""
    renamed = melt_intervals(wide, models, levels).withColumnRenamed("Model", "model")
    return renamed.withColumnsRenamed(
        {f"low_{level}": f"Lower-{level}" for level in levels}
        | {f"up_{level}": f"Upper-{level}" for level in levels}
    )
