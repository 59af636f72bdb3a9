"""Joins that no other query covers."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query, rounded
from shelfcast.operators import features, models, panel, scoring


@query(
    "j3_static_covariates",
    """select f2.unique_id, f2.date, y, s_nationkey as nation, day_class from f2
       left join supplier on f2.unique_id = 'S' || s_suppkey left join f5 on f2.date = f5.date""",
)
def j3_static_covariates(spark, sf):
    homes = p.table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("unique_id"),
        F.col("s_nationkey").alias("nation"),
    )
    rows = p.supplier_sales(spark, sf).join(homes, "unique_id", "left")
    return rows.join(F.broadcast(p.day_class(spark, sf)), "date", "left")


@query(
    "j4_future_covariates_right",
    """with l as (select unique_id, date, y, lag(y, 1) over (partition by unique_id order by date) as lag1 from filled)
       select l.unique_id, l.date as ds, l.y, l.lag1, f4.sell_price, f4.snap
       from f4 right join l on l.unique_id = f4.unique_id and l.date = f4.date where lag1 is not null""",
)
def j4_future_covariates_right(spark, sf):
    rows = features.add_lags(p.filled(spark, sf), [1])
    extra = p.brand_covariates(spark, sf).select("unique_id", "date", "sell_price", "snap")
    return panel.rename_for_library(rows.join(extra, ["unique_id", "date"], "left"))


@query(
    "j5_one_key_covariates",
    """select filled.unique_id, filled.date as ds, y, day_class from filled left join f5 on filled.date = f5.date""",
)
def j5_one_key_covariates(spark, sf):
    rows = p.filled(spark, sf).join(F.broadcast(p.day_class(spark, sf)), "date", "left")
    return panel.rename_for_library(rows)


@query(
    "j7_truth_zero_fill",
    """select fc.unique_id, fc.date, Model, fc.y, fh, 1 as cv, coalesce(f1.y, 0) as "True"
       from fc left join f1 on fc.unique_id = f1.unique_id and fc.date = f1.date where cv = 5""",
)
def j7_truth_zero_fill(spark, sf):
    return scoring.join_truth(p.forecast(spark, sf), p.brand_sales(spark, sf))


@query(
    "j11_semi_joins",
    """select * from f2 where unique_id in (select 'S' || s_suppkey from supplier where s_acctbal > 0)
       and date in (select date from f5 where day_class = '1-URGENT')""",
)
def j11_semi_joins(spark, sf):
    rich = (
        p.table(spark, sf, "supplier")
        .where(F.col("s_acctbal") > 0)
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("unique_id"))
    )
    urgent = p.day_class(spark, sf).where(F.col("day_class") == "1-URGENT").select("date")
    rows = p.supplier_sales(spark, sf).join(rich, "unique_id", "left_semi")
    return rows.join(F.broadcast(urgent), "date", "left_semi")


@query(
    "j12_anti_joins",
    """select * from f2 where unique_id not in (select 'S' || s_suppkey from supplier where s_acctbal > 0)
       and date not in (select date from f5 where day_class = '1-URGENT')""",
)
def j12_anti_joins(spark, sf):
    rich = (
        p.table(spark, sf, "supplier")
        .where(F.col("s_acctbal") > 0)
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("unique_id"))
    )
    urgent = p.day_class(spark, sf).where(F.col("day_class") == "1-URGENT").select("date")
    rows = p.supplier_sales(spark, sf).join(rich, "unique_id", "left_anti")
    return rows.join(F.broadcast(urgent), "date", "left_anti")


@query(
    "j13_price_calendar",
    """with w as (select unique_id, cast(floor((date - date '1970-01-05') / 7) as int) as wm_yr_wk,
                     max(sell_price) as sell_price from f4 group by 1, 2),
       c as (select date, cast(floor((date - date '1970-01-05') / 7) as int) as wm_yr_wk from f5)
       select unique_id, date, w.wm_yr_wk, sell_price from w join c on w.wm_yr_wk = c.wm_yr_wk""",
)
def j13_price_calendar(spark, sf):
    from shelfcast.functions.dates import day_index

    week = day_index(F.col("date"), "W").alias("wm_yr_wk")
    prices = (
        p.brand_covariates(spark, sf)
        .groupBy("unique_id", week)
        .agg(F.max("sell_price").alias("sell_price"))
    )
    calendar = p.day_class(spark, sf).select("date", week)
    return panel.price_calendar(prices, calendar)


@query(
    "j14_sales_covariates",
    """select filled.unique_id, filled.date, y, sell_price, event_type_1, snap
       from filled left join f4 on filled.unique_id = f4.unique_id and filled.date = f4.date""",
)
def j14_sales_covariates(spark, sf):
    return p.filled(spark, sf).join(p.brand_covariates(spark, sf), ["unique_id", "date"], "left")


@query(
    "j15_backtest_truth",
    """select unique_id, date, cutoff, Model, round(y, 6) as y, fh, cv, "True" from ev""",
)
def j15_backtest_truth(spark, sf):
    days = p.span(spark, sf)
    found = scoring.backtest_truth(
        p.backtest(spark, sf, days=days), p.recent_truth(spark, sf, p.TRIM, days)
    )
    return rounded(found)


@query(
    "j18_step_lookup",
    """select f1.unique_id, f1.date, f1.y, s.fh from f1 left join (select date, min(fh) as fh from pf group by 1) s
       on f1.date = s.date where f1.date > (select max(date) from f1) - 10""",
)
def j18_step_lookup(spark, sf):
    days = p.span(spark, sf)
    steps = p.forecast(spark, sf, days=days).groupBy("date").agg(F.min("fh").alias("fh"))
    recent = p.brand_sales(spark, sf).where(F.col("date") > F.date_sub(F.lit(days[1]), 10))
    return recent.join(F.broadcast(steps), "date", "left")


@query(
    "j18_step_lookup_history",
    """select f1.unique_id, f1.date, f1.y, s.fh from f1 left join (select date, min(fh) as fh from pf group by 1) s
       on f1.date = s.date""",
)
def j18_step_lookup_history(spark, sf):
    """Every sold day with its forecast step, null before the forecast."""
    steps = p.forecast(spark, sf).groupBy("date").agg(F.min("fh").alias("fh"))
    # One row per forecast day.
    return p.brand_sales(spark, sf).join(F.broadcast(steps), "date", "left")


@query(
    "j20_scores_with_scale",
    """select sc.unique_id, Model, cv, round(mae, 6) as mae, round(naive_mse, 6) as naive_mse,
              round(naive_mae, 6) as naive_mae from sc join scale on sc.unique_id = scale.unique_id""",
)
def j20_scores_with_scale(spark, sf):
    days = p.span(spark, sf)
    plain = scoring.score(p.evaluated(spark, sf, days=days), None, ["mae"])
    return rounded(plain.join(p.scale(spark, sf, days), "unique_id"))


@query(
    "m15_future_ids_only",
    """select * from f1 where unique_id in (select unique_id from f7 where ExtraDay = 1)""",
)
def m15_future_ids_only(spark, sf):
    future = p.extra_days(spark, sf).where(F.col("ExtraDay") == 1)
    return models.only_future_ids(p.brand_sales(spark, sf), future)
