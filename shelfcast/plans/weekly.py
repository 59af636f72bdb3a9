"""The weekly run: decide, preprocess, forecast, post-process, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.config import Profile
from shelfcast.operators import features, globalmodel, models, panel, publish, scoring
from shelfcast.operators.backtest import benchmark_forecasts
from shelfcast.operators.panel import DATE, ID
from shelfcast.session import durable


def _overlap(left: DataFrame, right: DataFrame):
    """True when the tables share a date."""
    shared = left.select(DATE).distinct().join(right.select(DATE).distinct(), DATE, "left_semi")
    return shared.agg(F.count("*") > 0).scalar()


def run_decision(
    history: DataFrame, forecasts: DataFrame | None, update: DataFrame | None
) -> DataFrame:
    """One row: is a new forecast due, or are the old ones to be scored.

    A forecast is due when there is none or the history has reached its dates.
    Otherwise it is scored once new sales overlap it and it has no truth yet.
    """
    if forecasts is None:
        return history.agg(F.lit(True).alias("forecast"), F.lit(False).alias("score"))
    facts = forecasts.agg(F.count("*").alias("rows"), F.count("True").alias("known"))
    due = (F.col("rows") == 0) | _overlap(history, forecasts)
    arrived = F.lit(False) if update is None else _overlap(update, forecasts)
    return facts.select(due.alias("forecast"), (~due & arrived & (F.col("known") == 0)).alias("score"))


def preprocess(
    raw: DataFrame, profile: Profile, filter_dates: bool = True, future: DataFrame | None = None
) -> DataFrame:
    """Calendar fill, covariate fill and coding, warm-up cut, in this order.

    Rows of `future`, which bring covariates of later dates, are filled and
    coded along with the history, so that codes agree; their y stays null.
    """
    settings = profile.forecast
    groups = {
        "item_covars": [c for c in settings.item_covars if c in raw.columns],
        "item_time_covars": [c for c in settings.item_time_covars if c in raw.columns],
        "time_covars": [c for c in settings.time_covars if c in raw.columns],
    }
    covars = [c for columns in groups.values() for c in columns]
    span = panel.date_span(raw)
    rows = panel.fill_calendar(
        raw, covars=covars, business_days=settings.remove_weekends, span=span
    )
    if future is not None:
        later = future.where(F.col(DATE) > F.lit(span[1])).select(ID, DATE, *[c for c in covars if c in future.columns])
        if settings.remove_weekends:
            later = later.where(F.weekday(DATE) < 5)
        rows = rows.unionByName(later, allowMissingColumns=True)
    if covars:
        observed = panel.observed_rows(raw, covars=covars, business_days=settings.remove_weekends)
        if future is not None:
            observed = observed.unionByName(later, allowMissingColumns=True)
        rows = panel.fill_most_frequent(rows, **groups, observed=observed)
        rows = features.categorise(rows, features.categorical_columns(rows))
    if not filter_dates:
        return rows
    return panel.drop_first_dates(rows, settings.warm_up, span, settings.remove_weekends)


def split_future(prepared: DataFrame, last) -> tuple[DataFrame, DataFrame]:
    """The prepared history, and the covariates of later dates."""
    return prepared.where(F.col(DATE) <= F.lit(last)), prepared.where(F.col(DATE) > F.lit(last)).drop("y")


def forecast_week(
    prepared: DataFrame, profile: Profile, seasonal_window: int = 4, future: DataFrame | None = None
) -> DataFrame:
    """Global model and benchmarks beyond the data, stacked.

    The benchmarks use every series, the global model those with enough history
    and, if its settings name covariates, with rows in `future`.
    """
    settings, model = profile.forecast, profile.model
    last = panel.date_span(prepared)[1]
    cutoffs = F.array(F.lit(last))
    trained = panel.with_min_history(prepared, globalmodel.depth(model))
    fitted = globalmodel.fit(trained, model)
    ahead = future if model.covariates else None
    predicted = globalmodel.predict(fitted, trained, settings.h, last, settings.freq, ahead)
    tables = predicted.select(ID, DATE, "Model", "y", "fh")
    if model.fit_benchmarks:
        simple = benchmark_forecasts(
            prepared,
            cutoffs,
            settings.h,
            model.benchmarks,
            season=settings.seasonal_length,
            seasonal_window=seasonal_window,
            freq=settings.freq,
        )
        tables = tables.unionByName(simple.select(ID, DATE, "Model", "y", "fh"))
    return models.as_plain_forecast(tables)


def publish_week(
    raw: DataFrame, profile: Profile, update: DataFrame | None = None, future: DataFrame | None = None
) -> DataFrame:
    """The published forecast table, with truth where the new sales cover its dates.

    `future` holds the covariates of the forecast days, for models that use some.
    """
    last = panel.date_span(raw)[1]
    prepared = durable(preprocess(raw, profile, future=future))  # read by every fit and forecast
    history, ahead = split_future(prepared, last)
    forecasts = durable(forecast_week(history, profile, future=ahead if future is not None else None))
    published = publish.postprocess(
        forecasts, profile.labels, globalmodel.NAME, ensemble=profile.model.ensemble
    )
    return scoring.attach_truth(published, update)


def score_week(history: DataFrame, published: DataFrame, profile: Profile) -> DataFrame:
    """Scores of a published forecast whose truth has arrived, dated by its last day."""
    rows = scoring.rows_to_score(published.withColumn("cv", F.lit(1)), profile.labels.primary)
    scale = scoring.in_sample_scale(history, profile.forecast.h)
    return scoring.score(rows, scale, profile.metrics, date=panel.last_date(published))
