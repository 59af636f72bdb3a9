"""Scores, metrics, ensembles and error quantiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query, rounded
from shelfcast.config import Labels
from shelfcast.operators import intervals, models, publish, scoring

LABELS = Labels()


@query(
    "a8_scores",
    """select unique_id, Model, cv, round(rmsse, 6) as rmsse, round(mae, 6) as mae,
              round(bias, 6) as bias from sc""",
)
def a8_scores(spark, sf):
    return rounded(p.scores(spark, sf))


@query(
    "a7_in_sample_scale",
    "select unique_id, round(naive_mse, 6) as naive_mse, round(naive_mae, 6) as naive_mae from scale",
)
def a7_in_sample_scale(spark, sf):
    return rounded(p.scale(spark, sf))


@query(
    "k7_scale_at_lag",
    """select unique_id, round(avg(d * d), 6) as naive_mse, round(avg(abs(d)), 6) as naive_mae
       from (select unique_id, y - lag(y, 7) over (partition by unique_id order by date) as d
             from filled where date <= (select max(date) from f1) - 11) group by 1""",
)
def k7_scale_at_lag(spark, sf):
    days = p.span(spark, sf)
    return rounded(scoring.in_sample_scale(p.brand_sales(spark, sf), p.TRIM, span=days, lag=7))


ALL_METRICS = ("bias", "mse", "rmse", "mae", "mape", "smape", "wmape", "scaled_error", "mase", "rmsse")


@query(
    "k_all_metrics",
    """select e.unique_id, Model, cv, round(avg(y - "True"), 6) as bias,
              round(avg((y - "True") * (y - "True")), 6) as mse,
              round(sqrt(avg((y - "True") * (y - "True"))), 6) as rmse,
              round(avg(abs(y - "True")), 6) as mae,
              round(avg(abs((y - "True") / nullif(y, 0))), 6) as mape,
              round(avg(2 * abs(y - "True") / (abs(y) + abs("True") + 2.220446049250313e-16::double)), 6) as smape,
              round(avg(abs(y - "True") / nullif(abs(y), 0)), 6) as wmape,
              round(avg(y - "True") / nullif(any_value(naive_mse), 0), 6) as scaled_error,
              round(avg(abs(y - "True")) / nullif(any_value(naive_mae), 0), 6) as mase,
              round(case when any_value(naive_mse) = 0 then 0 else
                    sqrt(avg((y - "True") * (y - "True")) / any_value(naive_mse)) end, 6) as rmsse
       from ev e join scale s on e.unique_id = s.unique_id group by 1, 2, 3""",
)
def k_all_metrics(spark, sf):
    return rounded(p.scores(spark, sf, ALL_METRICS))


@query(
    "k_metrics_by_step",
    """select Model, fh, round(avg(abs(y - "True")), 6) as mae, round(avg(y - "True"), 6) as bias,
              round(sqrt(avg((y - "True") * (y - "True"))), 6) as rmse from ev group by 1, 2""",
)
def k_metrics_by_step(spark, sf):
    return rounded(scoring.score(p.evaluated(spark, sf), None, ["mae", "bias", "rmse"], ["Model", "fh"]))


@query(
    "a9_row_scores",
    """select unique_id, date, cutoff, Model, round(y, 6) as y, fh, cv, "True", round(y - "True", 6) as error,
              round((y - "True") * (y - "True"), 6) as squared_error, round(abs(y - "True"), 6) as absolute_error,
              round((y - "True") / nullif(y, 0), 6) as percentage_error from ev""",
)
def a9_row_scores(spark, sf):
    return rounded(scoring.row_scores(p.evaluated(spark, sf)))


@query(
    "a10_leaderboard",
    "select Model, round(avg(rmsse), 6) as rmsse, round(avg(mae), 6) as mae, round(avg(bias), 6) as bias from sc group by 1",
)
def a10_leaderboard(spark, sf):
    return rounded(scoring.leaderboard(p.scores(spark, sf)))


def _median_absolute_error(a: pd.Series, p: pd.Series) -> float:
    return float((a - p).abs().median())


@query(
    "x1_user_metric",
    'select unique_id, Model, cv, round(median(abs(y - "True")), 6) as medae from ev group by 1, 2, 3',
)
def x1_user_metric(spark, sf):
    return rounded(scoring.score_with(p.evaluated(spark, sf), _median_absolute_error, "medae"))


def _ensemble_sql(source: str, name: str, ratios, keys="unique_id, date, fh") -> str:
    low, mid, high = ratios
    return f"""
      select {keys}, '{name}' as Model,
             case when count(y) filter (where y <> 0) = 0 then 0
                  when count(y) filter (where y <> 0) > 1
                   and max(y) filter (where y <> 0) / min(y) filter (where y <> 0) >
                       case when min(y) filter (where y <> 0) < 10 then {low}
                            when min(y) filter (where y <> 0) < 50 then {mid} else {high} end
                  then max(y) filter (where y <> 0)
                  else median(y) filter (where y <> 0) end as y
      from {source} group by {keys}"""


@query(
    "a1_guarded_ensemble",
    "with e as (" + _ensemble_sql("fc", "Primary", (2, 5, 7), "unique_id, date, cutoff, fh") + ") "
    "select unique_id, date, cutoff, fh, Model, round(y, 6) as y from e",
)
def a1_guarded_ensemble(spark, sf):
    keys = ["unique_id", "date", "cutoff", "fh"]
    return rounded(publish.guarded_ensemble(p.backtest(spark, sf), LABELS.primary, keys=keys))


@query(
    "a2_two_step_ensemble",
    "with o as (select * from pf where Model <> 'SeasonalWindowAverage'), s as ("
    + _ensemble_sql("o", "SeasonalEnsemble", (1, 1, 1))
    + "), u as (select unique_id, date, fh, Model, y from pf union all select unique_id, date, fh, Model, y from s), e as ("
    + _ensemble_sql("u", "Primary", (2, 5, 7))
    + ") select unique_id, date, fh, Model, round(y, 6) as y from e",
)
def a2_two_step_ensemble(spark, sf):
    found = publish.two_step_ensemble(p.forecast(spark, sf), LABELS, models.SEASONAL_WINDOW_AVERAGE)
    return rounded(found)


_SUBSETS = (
    "values ('Naive', ['Naive']), ('SeasonalNaive', ['SeasonalNaive']), ('SeasonalWindowAverage', ['SeasonalWindowAverage']),"
    "('Naive+SeasonalNaive', ['Naive', 'SeasonalNaive']), ('Naive+SeasonalWindowAverage', ['Naive', 'SeasonalWindowAverage']),"
    "('SeasonalNaive+SeasonalWindowAverage', ['SeasonalNaive', 'SeasonalWindowAverage']),"
    "('Naive+SeasonalNaive+SeasonalWindowAverage', ['Naive', 'SeasonalNaive', 'SeasonalWindowAverage'])"
)


@query(
    "a3_median_ensembles",
    f"""select combo, unique_id, date, cutoff, "True", cv, fh, round(median(y), 6) as y, 'Ensemble' as Model
        from ev join ({_SUBSETS}) t(combo, members) on list_contains(members, Model) group by all""",
)
def a3_median_ensembles(spark, sf):
    return rounded(publish.median_ensembles(p.evaluated(spark, sf), p.FORECAST_MODELS))


@query(
    "a3_ensemble_leaderboard",
    f"""with e as (select combo, unique_id, date, "True", cv, fh, median(y) as y
                  from ev join ({_SUBSETS}) t(combo, members) on list_contains(members, Model) group by all),
        s as (select combo, e.unique_id, cv, sqrt(avg((y - "True") * (y - "True")) / any_value(naive_mse)) as rmsse,
                     avg(abs(y - "True")) as mae, avg(y - "True") as bias
              from e join scale on e.unique_id = scale.unique_id group by all)
        select combo as Model, round(avg(rmsse), 6) as rmsse, round(avg(mae), 6) as mae, round(avg(bias), 6) as bias
        from s group by 1""",
)
def a3_ensemble_leaderboard(spark, sf):
    days = p.span(spark, sf)
    combined = publish.median_ensembles(p.evaluated(spark, sf, days=days), p.FORECAST_MODELS)
    named = combined.withColumn("Model", F.col("combo"))
    return rounded(scoring.leaderboard(scoring.score(named, p.scale(spark, sf, days))))


@query(
    "a4_model_disagreement",
    "select unique_id, round(AbsDifference, 6) as AbsDifference, Color from colour",
)
def a4_model_disagreement(spark, sf):
    return rounded(publish.model_disagreement(p.published(spark, sf, LABELS).drop("Color"), LABELS))


def _quantile_sql(error: str, skip: bool, keys: str) -> str:
    kept = "filter (where e <> 0)" if skip else ""
    columns = ", ".join(
        f"round(coalesce(quantile_cont(e, {q}) {kept}, {'0' if skip else 'null'}), 6) as \"upper_{round(q * 100)}%\""
        for q in (0.5, 0.8, 0.95)
    )
    return f"""with x as (select *, {error} as e from ev where Model = 'SeasonalWindowAverage')
               select {keys}, {columns} from x group by {keys}"""


LEVELS = [50, 80, 95]


def _average_backtest(spark, sf):
    return p.evaluated(spark, sf, (models.SEASONAL_WINDOW_AVERAGE,))


@query("a5_error_quantiles", _quantile_sql('"True" - y', True, "unique_id, fh"))
def a5_error_quantiles(spark, sf):
    rows = _average_backtest(spark, sf)
    return rounded(intervals.error_quantiles(rows, LEVELS, error_type="normal"))


@query("a5_error_quantiles_series", _quantile_sql('abs(y - "True")', False, "unique_id"))
def a5_error_quantiles_series(spark, sf):
    rows = _average_backtest(spark, sf)
    found = intervals.error_quantiles(
        rows, [0.5, 0.8, 0.95], method="conformal", error_type="absolute", on=["unique_id"]
    )
    return rounded(found)


@query("a5_error_quantiles_positive", _quantile_sql('greatest(0, "True" - y)', True, "unique_id, fh"))
def a5_error_quantiles_positive(spark, sf):
    rows = _average_backtest(spark, sf)
    return rounded(intervals.error_quantiles(rows, LEVELS, error_type="positive"))
