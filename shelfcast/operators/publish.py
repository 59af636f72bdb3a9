"""Post-processing of forecasts: ensembles, flags, unions, documents, exports."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import Labels
from shelfcast.functions.rules import clip_at_zero, joined_key, round_half_even, traffic_light
from shelfcast.operators.panel import DATE, ID

# Columns of an order line that identify it.
ORDER_KEY = ("Datum", "Rit", "Hoeveelheidstype", "Verpakkingstype", "Menugroep", "Menusoort")
# Order states that count as confirmed.
CONFIRMED_STATES = ("Website", "Telefoon")
WEDNESDAY = 2


def label(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("Model", F.lit(name))


def clip_forecasts(df: DataFrame) -> DataFrame:
    return df.withColumn("y", clip_at_zero(F.col("y")))


def round_forecasts(df: DataFrame) -> DataFrame:
    return df.withColumn("y", round_half_even(F.col("y")))


def weekday_off(df: DataFrame, rules: DataFrame) -> DataFrame:
    """0 on Wednesdays for series whose rule says no extra day."""
    closed = (F.weekday(DATE) == WEDNESDAY) & (F.col("ExtraDay") == 0)
    return (
        df.join(rules.select(ID, "ExtraDay"), ID, "left")
        .withColumn("y", F.when(closed, F.lit(0.0)).otherwise(F.col("y")))
        .drop("ExtraDay")
    )


def _guarded(ratios: Sequence[float]) -> Column:
    y = F.when(F.col("y") != 0, F.col("y"))
    least, most = F.min(y), F.max(y)
    limit = F.when(least < 10, ratios[0]).when(least < 50, ratios[1]).otherwise(ratios[2])
    return (
        F.when(F.count(y) == 0, F.lit(0.0))
        .when((F.count(y) > 1) & (most / least > limit), most)
        .otherwise(F.median(y))
    )


def guarded_ensemble(
    df: DataFrame,
    name: str,
    ratios: Sequence[float] = (2, 5, 7),
    keys: Sequence[str] = (ID, DATE, "fh"),
) -> DataFrame:
    """Median of the non-zero forecasts, or their maximum when they disagree too much.

    The allowed ratio depends on the smallest forecast: below 10, below 50, above.
    A key holds one row per model, so its median is over a few values.
    """
    return df.groupBy(*keys).agg(_guarded(ratios).alias("y")).withColumn("Model", F.lit(name))


def two_step_ensemble(df: DataFrame, labels: Labels, global_model: str = "global") -> DataFrame:
    """With more than two models, the others are combined first and added as one more."""
    enough = df.agg(F.count_distinct("Model") > 2).scalar()
    others = guarded_ensemble(
        df.where(F.col("Model") != global_model), labels.ensemble, (1, 1, 1)
    ).where(enough)
    both = df.select(ID, DATE, "fh", "y", "Model").unionByName(others)
    return guarded_ensemble(both, labels.primary)


def median_ensembles(
    df: DataFrame,
    models: Sequence[str],
    always: Sequence[str] = (),
    keys: Sequence[str] = (ID, DATE, "cutoff", "True", "cv", "fh"),
) -> DataFrame:
    """Median forecast for every non-empty subset of `models`, in one pass.

    A row is sent to the subsets its model is in; models in `always` join all.
    """
    subsets = [c for r in range(1, len(models) + 1) for c in combinations(models, r)]
    named = F.array(
        *[
            F.struct(
                F.lit("+".join(s)).alias("combo"),
                F.array(*[F.lit(m) for m in [*s, *always]]).alias("members"),
            )
            for s in subsets
        ]
    )
    member_of = F.filter(named, lambda s: F.array_contains(s["members"], F.col("Model")))
    return (
        df.withColumn("combo", F.explode(F.transform(member_of, lambda s: s["combo"])))
        .groupBy("combo", *keys)
        .agg(F.median("y").alias("y"))
        .withColumn("Model", F.lit("Ensemble"))
    )


def model_disagreement(df: DataFrame, labels: Labels) -> DataFrame:
    """Mean absolute gap between the primary and the benchmark model, with its colour."""
    of = lambda name: F.first(F.when(F.col("Model") == name, F.col("y")), ignorenulls=True)
    pairs = df.groupBy(ID, DATE, "fh").agg(
        of(labels.primary).alias("_a"), of(labels.benchmark).alias("_b")
    )
    return (
        pairs.where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
        .groupBy(ID)
        .agg(F.avg(F.abs(F.col("_a") - F.col("_b"))).alias("AbsDifference"))
        .withColumn("Color", traffic_light(F.col("AbsDifference")))
    )


def primary_forecast(
    df: DataFrame, labels: Labels, global_model: str, ensemble: bool, two_step: bool = False
) -> DataFrame:
    """The published forecast: an ensemble, or the global model under its label."""
    if ensemble and two_step:
        return two_step_ensemble(df, labels, global_model)
    if ensemble:
        return guarded_ensemble(df, labels.primary)
    picked = df.where(F.col("Model") == global_model)
    return label(picked.select(ID, DATE, "fh", "y", "Model"), labels.primary)


def postprocess(
    forecasts: DataFrame,
    labels: Labels,
    global_model: str = "global",
    ensemble: bool = False,
    two_step: bool = False,
) -> DataFrame:
    """Clip, pick or combine, round, add the benchmark rows and the colour per series."""
    clipped = clip_forecasts(forecasts)
    benchmark = clipped.where(F.col("Model") == labels.benchmark).select(ID, DATE, "fh", "y", "Model")
    primary = round_forecasts(primary_forecast(clipped, labels, global_model, ensemble, two_step))
    published = primary.withColumn("y", F.col("y").cast("double")).unionByName(benchmark)
    colours = model_disagreement(published, labels).select(ID, "Color")
    return published.join(colours, ID, "left")


def with_order_key(df: DataFrame) -> DataFrame:
    return df.withColumn("identifier", joined_key(*[F.col(c) for c in ORDER_KEY]))


def split_confirmed(orders: DataFrame, drop: Sequence[str] = ("BEVESTIGD", "Postcode")):
    """(confirmed, predicted) order lines; an unknown state counts as predicted."""
    confirmed = F.coalesce(F.col("BEVESTIGD").isin(*CONFIRMED_STATES), F.lit(False))
    return orders.where(confirmed).drop(*drop), orders.where(~confirmed).drop(*drop)


def restrict_to_span(df: DataFrame, other: DataFrame, date_col: str = "Datum") -> DataFrame:
    """Rows between the first and last date of another table."""
    span = other.agg(F.min(date_col).alias("a"), F.max(date_col).alias("b"))
    return df.where(F.col(date_col).between(span.select("a").scalar(), span.select("b").scalar()))


def add_missing_orders(latest: DataFrame, future: DataFrame) -> DataFrame:
    """Lines of the full table in the span of the latest one that it does not hold."""
    keyed = with_order_key(restrict_to_span(future, latest))
    missing = keyed.join(with_order_key(latest).select("identifier").distinct(), "identifier", "left_anti")
    return latest.unionByName(missing.drop("identifier"), allowMissingColumns=True)


def is_fresh(confirmed: DataFrame, history: DataFrame) -> DataFrame:
    """One row: does the confirmed table end a week after the history."""
    expected = history.agg(F.date_add(F.max(DATE), 7)).scalar()
    return confirmed.agg(
        F.max("Datum").alias("newest"), F.coalesce(F.max("Datum") == expected, F.lit(False)).alias("fresh")
    )


def attach_confirmed(forecasts: DataFrame, confirmed: DataFrame | None, labels: Labels) -> DataFrame:
    """Confirmed orders as one more model, or empty placeholder rows.

    The orders are used when all their dates are forecast dates. Both branches
    are filtered by that one test, so the choice is made while running.
    """
    extra = {"Model": F.lit(labels.confirmed), "Color": F.lit("green")}
    slots = forecasts.select(ID, DATE, "fh").distinct()
    placeholder = slots.withColumns({**extra, "y": F.lit(None).cast("double")})
    base = forecasts.select(ID, DATE, "fh", "Model", "y", "Color")
    if confirmed is None:
        return base.unionByName(placeholder)
    dates = forecasts.groupBy(DATE).agg(F.min("fh").alias("fh"))
    stray = confirmed.select(DATE).distinct().join(dates, DATE, "left_anti")
    usable = stray.agg(F.count("*") == 0).scalar()
    steps = F.broadcast(dates)  # one row per forecast day
    rows = (
        confirmed.select(ID, DATE, F.col("y").cast("double").alias("y"))
        .join(steps, DATE, "left")
        .withColumns(extra)
        .where(usable)
    )
    return base.unionByName(rows).unionByName(placeholder.where(~usable))


def forecast_documents(df: DataFrame) -> DataFrame:
    """One JSON list of records per series; it holds one entry per model and step."""
    record = F.struct(
        F.col(DATE).cast("string").alias("date"),
        "Model",
        F.col("y").cast("double").alias("y"),
        "Color",
        F.col("True").cast("double").alias("True"),
    )
    ordered = F.array_sort(F.collect_list(record))
    shaped = F.transform(
        ordered,
        lambda r: F.struct(
            r["date"].alias("date"),
            r["y"].alias("y"),
            r["Model"].alias("Model"),
            r["Color"].alias("Color"),
            r["True"].alias("True"),
        ),
    )
    return df.groupBy(ID).agg(F.to_json(shaped, {"ignoreNullFields": "false"}).alias("records"))


def read_documents(df: DataFrame) -> DataFrame:
    """Rows back from the nested documents."""
    schema = "array<struct<date:string,y:double,Model:string,Color:string,`True`:double>>"
    rows = df.select(ID, F.inline_outer(F.from_json("records", schema)))
    return rows.where(F.col(DATE).isNotNull()).withColumn(DATE, F.col(DATE).cast("date"))


def order_export(df: DataFrame, dates: Sequence[str], models: Sequence[str]) -> DataFrame:
    """One text row per series with a column per date and model, '' when missing."""
    columns = []
    for day in dates:
        here = F.col(DATE) == F.lit(day).cast("date")
        for model in models:
            value = F.first(F.when(here & (F.col("Model") == model), F.col("y")), ignorenulls=True)
            columns.append(F.coalesce(value.cast("string"), F.lit("")).alias(f"{day}_{model}"))
        truth = F.max(F.when(here, F.col("True")))
        columns.append(F.coalesce(truth.cast("string"), F.lit("")).alias(f"{day}_True"))
    return df.groupBy(F.col(ID).alias("Unique ID")).agg(*columns)


def model_columns(df: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per series and date with a column per model, the truth and the colour."""
    picks = [
        F.first(F.when(F.col("Model") == m, F.col("y")), ignorenulls=True).alias(m) for m in models
    ]
    return df.groupBy(ID, DATE).agg(
        *picks, F.max("True").alias("True"), F.first("Color", ignorenulls=True).alias("Color")
    )
