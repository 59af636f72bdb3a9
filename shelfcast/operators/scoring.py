"""Truth joins, in-sample scales, scores per series and leaderboards."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import relative_error, resolve, squared_error
from shelfcast.operators.panel import DATE, ID, fill_calendar, panel_bounds

DEFAULT_METRICS = ("rmsse", "mae", "bias")
SCORE_KEYS = (ID, "Model", "cv")


def same_dates(left: DataFrame, right: DataFrame) -> Column:
    """True when both tables hold the same set of dates."""
    a, b = left.select(DATE).distinct(), right.select(DATE).distinct()
    odd = a.exceptAll(b).unionAll(b.exceptAll(a))
    return odd.agg(F.count("*") == 0).scalar()


def attach_truth(forecasts: DataFrame, truth: DataFrame | None) -> DataFrame:
    """`True` from the new data when both cover the same dates, else null."""
    plain = forecasts.drop("True")
    if truth is None:
        return plain.withColumn("True", F.lit(None).cast("double"))
    actual = truth.select(ID, DATE, F.col("y").alias("True")).where(same_dates(plain, truth))
    return plain.join(actual, [ID, DATE], "left")


def join_truth(forecasts: DataFrame, truth: DataFrame) -> DataFrame:
    """`True` with 0 where nothing was sold, and window 1 where none is given."""
    actual = truth.select(ID, DATE, F.coalesce("y", F.lit(0.0)).alias("True"))
    return (
        forecasts.drop("True")
        .join(actual, [ID, DATE], "left")
        .withColumns(
            {
                "True": F.coalesce("True", F.lit(0.0)),
                "cv": F.coalesce("cv", F.lit(1)),
            }
        )
    )


def backtest_truth(forecasts: DataFrame, validation: DataFrame, check: bool = True) -> DataFrame:
    """Validation rows with their forecasts; an error when a row found none.

    The test is part of the join: a row without a forecast raises when it is
    read, so no second pass over the forecasts is needed.
    """
    actual = validation.select(ID, DATE, F.col("y").alias("True"))
    plain = forecasts.drop("True")
    if not check:
        return actual.join(plain, [ID, DATE])
    lost = F.raise_error(F.lit("backtest rows were lost: the panel has gaps")).cast("double")
    joined = actual.join(plain, [ID, DATE], "left")
    return joined.withColumn("True", F.when(F.col("Model").isNull(), lost).otherwise(F.col("True")))


def rows_to_score(df: DataFrame, primary: str) -> DataFrame:
    """Without null forecasts and truths, and without series the primary model missed."""
    missed = df.where((F.col("Model") == primary) & F.col("y").isNull()).select(ID).distinct()
    return df.join(missed, ID, "left_anti").where(
        F.col("y").isNotNull() & F.col("True").isNotNull()
    )


def in_sample_scale(
    history: DataFrame,
    trim: int | Column,
    fill: bool = True,
    span: tuple | None = None,
    lag: int = 1,
) -> DataFrame:
    """Naive one-step squared and absolute error per series.

    Meant for the daily zero-filled panel without its last `trim` dates, where
    trim is the number of windows plus the horizon minus one. The zeros are not
    materialised: next to a gap the value itself is the step, and inside a gap
    the step is 0. Series without any value are left out. With `fill` off the
    rows are taken as they are, and a `lag` above 1 compares with an older value.
    """
    known = history.where(F.col("y").isNotNull()).select(ID, DATE, "y")
    trim = F.lit(trim) if isinstance(trim, int) else trim
    first, last = panel_bounds(known, span)
    end = F.date_sub(last, trim.cast("int"))
    order = Window.partitionBy(ID).orderBy(DATE)
    here, y = F.col(DATE), F.col("y")
    before, value_before = F.lag(DATE).over(order), F.lag("y").over(order)
    if not fill or lag > 1:
        daily = fill_calendar(known, span=span) if fill else known
        change = y - F.lag("y", lag).over(order)
        rows = daily.where(here <= end).withColumn("_change", change)
        return rows.groupBy(ID).agg(
            F.avg(F.col("_change") * F.col("_change")).alias("naive_mse"),
            F.avg(F.abs("_change")).alias("naive_mae"),
        )
    after = F.lead(DATE).over(order)
    joined = before == F.date_sub(here, 1)
    step_in = (
        F.when(here > end, F.lit(0.0)).when(joined, y - value_before).when(here > first, y).otherwise(0.0)
    )
    gap_follows = after.isNull() | (after > F.date_add(here, 1))
    step_out = F.when((here < end) & gap_follows, y).otherwise(F.lit(0.0))
    rows = known.withColumns({"_in": step_in, "_out": step_out})
    steps = F.nullif(F.datediff(end, first), F.lit(0))
    return rows.groupBy(ID).agg(
        (F.sum(F.col("_in") * F.col("_in") + F.col("_out") * F.col("_out")) / steps).alias("naive_mse"),
        (F.sum(F.abs("_in") + F.abs("_out")) / steps).alias("naive_mae"),
    )


def evaluated_span(forecasts: DataFrame) -> Column:
    """Windows plus horizon minus one, read from the forecast table."""
    return forecasts.agg(F.count_distinct("cv") + F.count_distinct("fh") - 1).scalar()


def score(
    evaluated: DataFrame,
    scale: DataFrame | None,
    metrics: Sequence = DEFAULT_METRICS,
    keys: Sequence[str] = SCORE_KEYS,
    date: Column | None = None,
) -> DataFrame:
    """Metrics per key over the forecast steps, forecast first and truth second.

    Partial aggregates are combined before the shuffle; the scale is joined to
    the aggregated rows only.
    """
    chosen = resolve(metrics)
    a, p = F.col("y"), F.col("True")
    parts: dict[str, Column] = {}
    for metric in chosen:
        parts.update(metric.aggregates(a, p))
    grouped = evaluated.groupBy(*keys).agg(*[c.alias(f"_{n}") for n, c in parts.items()])
    if any(metric.needs_scale for metric in chosen):
        if scale is None:
            raise ValueError("these metrics need the in-sample scale")
        renamed = scale.select(
            ID, F.col("naive_mse").alias("_naive_mse"), F.col("naive_mae").alias("_naive_mae")
        )
        grouped = grouped.join(renamed, ID)
    columns = [m.finish(lambda name: F.col(f"_{name}")).alias(m.name) for m in chosen]
    out = grouped.select(*keys, *columns)
    return out if date is None else out.withColumn(DATE, date)


def score_with(
    evaluated: DataFrame, function: Callable, name: str, keys: Sequence[str] = SCORE_KEYS
) -> DataFrame:
    """A metric of the caller given as a function of two pandas Series."""
    from pyspark.sql.functions import pandas_udf

    aggregate = pandas_udf(function, "double")
    return evaluated.groupBy(*keys).agg(aggregate(F.col("y"), F.col("True")).alias(name))


def row_scores(evaluated: DataFrame) -> DataFrame:
    """Error terms of every single forecast."""
    a, p = F.col("y"), F.col("True")
    return evaluated.withColumns(
        {
            "error": a - p,
            "squared_error": squared_error(a, p),
            "absolute_error": F.abs(a - p),
            "percentage_error": relative_error(a, p),
        }
    )


def leaderboard(scores: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """Mean of every metric per model, best RMSSE first when it is among them."""
    board = scores.groupBy("Model").agg(*[F.avg(m).alias(m) for m in metrics])
    return board.orderBy("rmsse", "Model") if "rmsse" in metrics else board.orderBy("Model")


def score_history(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.unionByName(new, allowMissingColumns=True)
