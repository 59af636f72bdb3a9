"""Lag, rolling, scaling and calendar features and their codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query, rounded
from shelfcast.config import LagTransform
from shelfcast.operators import features, models, report

_ORDER = "(partition by unique_id order by date)"


@query(
    "w1_lags",
    "select * from (select unique_id, date, y, "
    + ", ".join(f"lag(y, {i}) over {_ORDER} as lag{i}" for i in range(1, 22))
    + " from filled) where lag21 is not null",
)
def w1_lags(spark, sf):
    return features.add_lags(p.filled(spark, sf), range(1, 22))


def _rolling_sql(function: str, window: int, lag: int, name: str) -> str:
    frame = f"(partition by unique_id order by date rows between {lag + window - 1} preceding and {lag} preceding)"
    return f"case when count(y) over {frame} = {window} then round({function}(y) over {frame}, 6) end as {name}"


ROLLING = (
    LagTransform("mean", 3, 1),
    LagTransform("mean", 7, 2),
    LagTransform("max", 4, 1),
    LagTransform("min", 4, 3),
)


@query(
    "w2_rolling",
    "select unique_id, date, y, "
    + ", ".join(
        _rolling_sql({"mean": "avg", "max": "max", "min": "min"}[t.kind], t.window, t.lag, t.name) for t in ROLLING
    )
    + " from filled",
)
def w2_rolling(spark, sf):
    return rounded(features.add_rolling(p.filled(spark, sf), ROLLING))


SEASONAL = (
    LagTransform("mean", 3, 1, 7),
    LagTransform("std", 3, 2, 7),
    LagTransform("max", 3, 5, 7),
)


def _seasonal_sql(t: LagTransform) -> str:
    lags = [f"lag(y, {t.lag + t.season * j}) over {_ORDER}" for j in range(t.window)]
    values = "[" + ", ".join(lags) + "]"
    function = {"mean": "list_avg", "std": "list_stddev_samp", "max": "list_max"}[t.kind]
    return f"case when {lags[-1]} is not null then round({function}({values}), 6) end as {t.name}"


@query(
    "w3_seasonal_rolling",
    "select unique_id, date, y, " + ", ".join(_seasonal_sql(t) for t in SEASONAL) + " from filled",
)
def w3_seasonal_rolling(spark, sf):
    return rounded(features.add_rolling(p.filled(spark, sf), SEASONAL))


@query(
    "w5_scale",
    """with s as (select unique_id, avg(y) as m, case when stddev_pop(y) = 0 then 1 else stddev_pop(y) end as d
                 from filled group by 1)
       select filled.unique_id, date, round((y - m) / d, 6) as y, round(m, 6) as y_mean, round(d, 6) as y_std
       from filled join s on filled.unique_id = s.unique_id""",
)
def w5_scale(spark, sf):
    return rounded(features.scale_in_place(p.filled(spark, sf)))


@query("w5_scale_inverse", "select unique_id, date, round(y, 6) as y from filled")
def w5_scale_inverse(spark, sf):
    rows, transform = p.filled(spark, sf), features.StandardScale()
    stats = transform.stats(rows)
    return rounded(transform.inverse(transform.forward(rows, stats), stats))


@query(
    "w6_calendar_features",
    """select *, cast(isodow(date) - 1 as int) as dayofweek, cast(month(date) as int) as month,
              cast(day(date) as int) as day, cast(year(date) as int) as year from filled""",
)
def w6_calendar_features(spark, sf):
    return features.add_calendar(p.filled(spark, sf), ["dayofweek", "month", "day", "year"])


@query(
    "w7_horizon_code",
    "select unique_id, date, Model, round(y, 6) as y, fh from fc where cv = 5 and Model <> 'Naive'",
)
def w7_horizon_code(spark, sf):
    plain = p.forecast(spark, sf).where(F.col("Model") != models.NAIVE).drop("fh", "cv")
    return rounded(models.horizon_code(plain))


@query("w8_backtest_codes", "select unique_id, date, cutoff, Model, round(y, 6) as y, cv, fh from fc")
def w8_backtest_codes(spark, sf):
    return rounded(models.backtest_codes(p.backtest(spark, sf).drop("cv", "fh")))


@query(
    "w9_horizon_days",
    "select unique_id, cutoff, date, cast(date - cutoff as int) as fh from fc where Model = 'Naive'",
)
def w9_horizon_days(spark, sf):
    rows = p.backtest(spark, sf, (models.NAIVE,)).drop("cv", "fh")
    return models.backtest_codes(rows).select("unique_id", "cutoff", "date", "fh")


@query(
    "w10_moving_averages",
    """with t as (select cat_id, date, sum(y) as y from f9 group by 1, 2),
       r as (select *, row_number() over (partition by cat_id order by date) as n from t)
       select cat_id, date, y,"""
    + ",".join(
        f"""case when n >= {w} then round(avg(y) over
            (partition by cat_id order by date rows between {w - 1} preceding and current row), 6) end as ma_{w}"""
        for w in (7, 30, 90)
    )
    + " from r",
)
def w10_moving_averages(spark, sf):
    return rounded(report.moving_averages(p.store_sales(spark, sf), "cat_id"))


@query(
    "w10_store_moving_averages",
    """with t as (select store_id, date, sum(y) as y from f9 group by 1, 2),
       r as (select *, row_number() over (partition by store_id order by date) as n from t)
       select store_id, date, y,"""
    + ",".join(
        f"""case when n >= {w} then round(avg(y) over
            (partition by store_id order by date rows between {w - 1} preceding and current row), 6) end as ma_{w}"""
        for w in (7, 30, 90)
    )
    + " from r",
)
def w10_store_moving_averages(spark, sf):
    return rounded(report.moving_averages(p.store_sales(spark, sf), "store_id"))


@query("w11_first_difference", f"select unique_id, date, y - lag(y) over {_ORDER} as change from filled")
def w11_first_difference(spark, sf):
    rows = features.naive_at_lag(p.filled(spark, sf), 1)
    return rows.select("unique_id", "date", (F.col("y") - F.col("naive")).alias("change"))


@query("k10_naive_at_lag", f"select unique_id, date, y, lag(y, 7) over {_ORDER} as naive from filled")
def k10_naive_at_lag(spark, sf):
    return features.naive_at_lag(p.filled(spark, sf), 7)
