"""Report and exploration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query, rounded
from shelfcast.config import Labels
from shelfcast.operators import models, panel, report

LABELS = Labels()


@query(
    "a11_scores_over_time",
    """select cutoff as date, Model, round(avg(mae), 6) as mae, round(avg(abs(bias)), 6) as abs_bias
       from sc group by 1, 2""",
)
def a11_scores_over_time(spark, sf):
    return rounded(report.scores_over_time(p.dated_scores(spark, sf)))


@query(
    "a13_item_map",
    """with m as (select unique_id, round(avg(round(mae, 6)), 6) as mae from sc group by 1),
       r as (select *, row_number() over (order by mae desc, unique_id) as place, count(*) over () as n from m)
       select unique_id, mae, place, cast(floor((place - 1) / ceil(sqrt(n))) as int) as grid_row,
              cast((place - 1) % ceil(sqrt(n)) as int) as grid_col from r""",
)
def a13_item_map(spark, sf):
    return report.item_map(rounded(p.dated_scores(spark, sf)), "mae").withColumn(
        "mae", F.round("mae", 6)
    )


@query(
    "a13_item_map_latest",
    """with m as (select unique_id, Model, round(mae, 6) as mae from sc where cv = 5),
       r as (select *, row_number() over (order by mae desc, unique_id, Model) as place, count(*) over () as n from m)
       select unique_id, Model, mae, place, cast(floor((place - 1) / ceil(sqrt(n))) as int) as grid_row,
              cast((place - 1) % ceil(sqrt(n)) as int) as grid_col from r""",
)
def a13_item_map_latest(spark, sf):
    return report.item_map(rounded(p.dated_scores(spark, sf)), "mae", overall=False)


@query(
    "a14_weekday_totals",
    """with x as (select *, date_trunc('week', (select max(date) from f1)) as newest from f1)
       select ['Current Week', 'Last Week', 'Two Weeks Ago', 'Three Weeks Ago']
                [cast(date_diff('day', date_trunc('week', date), newest) // 7 + 1 as int)] as Week,
              dayname(date) as day_name, sum(y) as y
       from x where date >= newest - interval 21 day group by 1, 2""",
)
def a14_weekday_totals(spark, sf):
    return report.weekday_totals(p.brand_sales(spark, sf))


@query("a15_daily_totals", "select date, sum(y) as y from f1 group by 1")
def a15_daily_totals(spark, sf):
    return report.daily_totals(p.brand_sales(spark, sf))


@query(
    "a16_hierarchy_totals",
    """select cat_id, item_id, store_id, date, sum(y) as y,
              grouping(cat_id, item_id, store_id, date) as level_id
       from f9 group by grouping sets ((cat_id, item_id, date), (cat_id, date), (item_id, date), (store_id, date))""",
)
def a16_hierarchy_totals(spark, sf):
    levels = [["cat_id", "item_id"], ["cat_id"], ["item_id"], ["store_id"]]
    return report.hierarchy_totals(p.store_sales(spark, sf), levels)


@query("a17_distinct_items", "select cat_id, count(distinct item_id) as items from f9 group by 1")
def a17_distinct_items(spark, sf):
    return report.distinct_items(p.store_sales(spark, sf), "cat_id", "item_id")


@query("a18_top_store", "select store_id, sum(y) as y from f9 group by 1 order by y desc, store_id limit 1")
def a18_top_store(spark, sf):
    return report.top_store(p.store_sales(spark, sf))


@query(
    "a19_seasonal_boxes",
    """with x as (select cast(isodow(date) - 1 as int) as dayofweek,
                    case when month(date) in (12, 1, 2) then 'Winter' when month(date) < 6 then 'Spring'
                         when month(date) < 9 then 'Summer' else 'Autumn' end as season, y from f9 where y > 0),
       q as (select dayofweek, season, quantile_cont(y, 0.25) as q1, quantile_cont(y, 0.5) as median,
                    quantile_cont(y, 0.75) as q3, count(*) as n from x group by 1, 2)
       select q.*, min(x.y) as whisker_low, max(x.y) as whisker_high
       from q join x on q.dayofweek = x.dayofweek and q.season = x.season
         and x.y between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
       group by all""",
)
def a19_seasonal_boxes(spark, sf):
    return report.seasonal_boxes(p.store_sales(spark, sf))


@query(
    "a20_calendar_heat",
    """with t as (select store_id, date, sum(y) as y from f9 group by 1, 2),
       g as (select s.store_id, cal.date, coalesce(t.y, 0) as y from (select distinct store_id from t) s
             cross join cal left join t on t.store_id = s.store_id and t.date = cal.date),
       z as (select *, year(date) as yr, (y - avg(y) over w) / case when stddev_pop(y) over w = 0 then 1
                    else stddev_pop(y) over w end as z
             from g window w as (partition by store_id, year(date)))
       select cast(yr as int) as year, cast(isodow(date) - 1 as int) as dayofweek, """
    + ", ".join(f"round(avg(z) filter (where month(date) = {m}), 6) as m{m}" for m in range(1, 13))
    + " from z group by 1, 2",
)
def a20_calendar_heat(spark, sf):
    totals = p.store_sales(spark, sf).groupBy("store_id", "date").agg(F.sum("y").alias("y"))
    rows = panel.fill_calendar(totals, keys=["store_id"], span=p.span(spark, sf))
    return rounded(report.calendar_heat(rows))


@query(
    "a21_profile",
    """with x as (select f4.*, f5.day_class from f4 left join f5 on f4.date = f5.date)
       select count(*) filter (where unique_id is null) as null_unique_id, count(*) filter (where date is null) as null_date,
              count(*) filter (where sell_price is null) as null_sell_price,
              count(*) filter (where day_class is null) as null_day_class,
              min(sell_price) as lowest_price, max(sell_price) as highest_price, count(distinct date) as total_days,
              count(distinct unique_id) as total_series, min(date) as first_date, max(date) as last_date,
              round((max(date) - min(date) + 1) / 365, 2) as total_years,
              round((max(date) - min(date) + 1) / 365 * 52, 2) as total_weeks from x""",
)
def a21_profile(spark, sf):
    rows = p.brand_covariates(spark, sf).join(F.broadcast(p.day_class(spark, sf)), "date", "left")
    chosen = rows.select("unique_id", "date", "sell_price", "day_class")
    return panel.profile(chosen, "sell_price", ["unique_id"])


@query(
    "a23_worst_items",
    """with n as (select * from sc where cutoff = (select max(cutoff) from sc)),
       t as (select unique_id, cv, mae from n where Model = 'SeasonalWindowAverage' order by round(mae, 6) desc, unique_id limit 40)
       select t.unique_id, t.cv, round(t.mae, 6) as focus, round(b.mae, 6) as benchmark
       from t left join n b on b.Model = 'SeasonalNaive' and b.unique_id = t.unique_id and b.cv = t.cv""",
)
def a23_worst_items(spark, sf):
    return report.worst_items(
        rounded(p.dated_scores(spark, sf)), models.SEASONAL_WINDOW_AVERAGE, LABELS.benchmark
    )


@query(
    "a24_confirmed_errors",
    """select unique_id, 'Confirmed' as Model, cv, cutoff as date, round(rmsse, 6) as rmsse, round(mae, 6) as mae,
              round(bias, 6) as bias, case when round(mae, 6) > 0.5 then 'red' else 'green' end as flag
       from sc where Model = 'Naive' order by round(mae, 6) desc, unique_id, cv limit 40""",
)
def a24_confirmed_errors(spark, sf):
    scores = rounded(p.dated_scores(spark, sf))
    named = scores.withColumn(
        "Model", F.when(F.col("Model") == models.NAIVE, LABELS.confirmed).otherwise(F.col("Model"))
    )
    return report.confirmed_errors(named, LABELS.confirmed)


@query(
    "l2_top_suppliers",
    "select unique_id, sum(y) as y from f2 group by 1 order by y desc, unique_id limit 40",
)
def l2_top_suppliers(spark, sf):
    totals = p.supplier_sales(spark, sf).groupBy("unique_id").agg(F.sum("y").alias("y"))
    return totals.orderBy(F.col("y").desc(), "unique_id").limit(40)


@query("l4_latest_rows", "select * from f2 where date = (select max(date) from f2)")
def l4_latest_rows(spark, sf):
    rows = p.supplier_sales(spark, sf)
    return rows.where(F.col("date") == panel.last_date(rows))
