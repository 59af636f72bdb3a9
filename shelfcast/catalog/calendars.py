"""Calendar fills, covariate fills, resampling and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query
from shelfcast.functions import dates
from shelfcast.operators import panel
from shelfcast.session import durable


@query("g1_calendar_fill", "select unique_id, date, y from filled")
def g1_calendar_fill(spark, sf):
    return p.filled(spark, sf)


@query(
    "g1_calendar_fill_covariates",
    """select filled.unique_id, filled.date, filled.y, sell_price, event_type_1, snap
       from filled left join f4 on filled.unique_id = f4.unique_id and filled.date = f4.date""",
)
def g1_calendar_fill_covariates(spark, sf):
    rows = p.brand_with_covariates(spark, sf)
    return panel.fill_calendar(
        rows, covars=["sell_price", "event_type_1", "snap"], span=p.span(spark, sf)
    )


_COVARS = ["event_type_1", "snap", "day_class"]


def _covariate_rows(spark, sf):
    return p.brand_with_covariates(spark, sf).join(F.broadcast(p.day_class(spark, sf)), "date", "left")


def _covariate_panel(spark, sf):
    return panel.fill_calendar(_covariate_rows(spark, sf), covars=_COVARS, span=p.span(spark, sf))


_COVARIATE_SQL = """
    with obs as (select f4.*, f5.day_class from f4 left join f5 on f4.date = f5.date),
    g as (select filled.unique_id, filled.date, filled.y, event_type_1, snap, day_class
          from filled left join obs on filled.unique_id = obs.unique_id and filled.date = obs.date)"""


@query(
    "g2_most_frequent_fill",
    _COVARIATE_SQL
    + """,
    m1 as (select unique_id, first(v order by n desc, v) as v from (
             select unique_id, event_type_1 as v, count(*) as n from g
             where event_type_1 is not null group by 1, 2) group by 1),
    m2 as (select date, first(v order by n desc, v) as v from (
             select date, snap as v, count(*) as n from g where snap is not null group by 1, 2) group by 1),
    m3 as (select first(v order by n desc, v) as v from (
             select day_class as v, count(*) as n from g where day_class is not null group by 1))
    select g.unique_id, g.date, y, coalesce(event_type_1, m1.v) as event_type_1,
           coalesce(snap, m2.v) as snap, coalesce(day_class, (select v from m3)) as day_class
    from g left join m1 on g.unique_id = m1.unique_id left join m2 on g.date = m2.date""",
)
def g2_most_frequent_fill(spark, sf):
    # The daily rows are far fewer than the facts; both the fill and the modes read them.
    rows = durable(panel.observed_rows(_covariate_rows(spark, sf), covars=_COVARS))
    return panel.fill_most_frequent(
        panel.fill_calendar(rows, covars=_COVARS, span=p.span(spark, sf)),
        item_covars=["event_type_1"],
        item_time_covars=["snap"],
        time_covars=["day_class"],
        observed=rows,
    )


@query(
    "g3_constant_fill",
    _COVARIATE_SQL
    + """
    select unique_id, date, y, coalesce(event_type_1, 'none') as event_type_1, snap,
           coalesce(day_class, 'none') as day_class from g""",
)
def g3_constant_fill(spark, sf):
    return panel.fill_constant(_covariate_panel(spark, sf), "none", ["event_type_1", "day_class"])


@query(
    "g4_series_fill",
    """with days as (
         select unique_id, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
         from f2 group by 1)
       select days.unique_id, days.date, coalesce(f2.y, 0) as y, s_nationkey as nation, day_class
       from days left join f2 on days.unique_id = f2.unique_id and days.date = f2.date
       join supplier on days.unique_id = 'S' || s_suppkey
       join f5 on days.date = f5.date""",
)
def g4_series_fill(spark, sf):
    homes = p.table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("unique_id"),
        F.col("s_nationkey").alias("nation"),
    )
    return panel.fill_series(
        p.supplier_sales(spark, sf),
        covariates={
            "nation": (homes, "unique_id"),
            "day_class": (p.day_class(spark, sf), "date"),
        },
        spread=True,
    )


@query(
    "g5_reindex_daily",
    """select ids.unique_id, cal.date, f1.y from ids cross join cal
       left join f1 on ids.unique_id = f1.unique_id and cal.date = f1.date""",
)
def g5_reindex_daily(spark, sf):
    return panel.reindex_daily(p.brand_sales(spark, sf))


@query("g6_business_days", "select * from filled where isodow(date) < 6")
def g6_business_days(spark, sf):
    return panel.fill_calendar(p.brand_sales(spark, sf), business_days=True, span=p.span(spark, sf))


def _periods(spark, sf, unit):
    """Labels of all periods in the span; at most the length of the calendar."""
    first, last = p.span(spark, sf)
    months = {"M": 1, "Q": 3, "Y": 12}[unit]
    labels = []
    at = (first.year * 12 + first.month - 1) // months * months
    while at <= last.year * 12 + last.month - 1:
        labels.append((at // 12, at % 12 + 1))
        at += months
    return labels


def _period_labels(spark, sf, unit):
    from datetime import date, timedelta

    months = {"M": 1, "Q": 3, "Y": 12}[unit]
    ends = []
    for year, month in _periods(spark, sf, unit):
        at = year * 12 + month - 1 + months
        ends.append(str(date(at // 12, at % 12 + 1, 1) - timedelta(days=1)))
    return ends


@query(
    "g7_long_to_wide",
    "select unique_id, "
    + ", ".join(
        f"coalesce(sum(y) filter (where year(date) = {y}), 0) as \"{y}-12-31\"" for y in range(1995, 2002)
    )
    + " from f1 group by 1",
)
def g7_long_to_wide(spark, sf):
    yearly = panel.resample(p.brand_sales(spark, sf), "Y", "sum")
    return panel.to_wide(yearly, _period_labels(spark, sf, "Y"), fill_value=0)


@query(
    "g8_wide_to_long",
    """select unique_id, cast(date_trunc('quarter', date) + interval 3 month - interval 1 day as date) as date,
              sum(y) as y from f1 group by 1, 2""",
)
def g8_wide_to_long(spark, sf):
    quarterly = panel.resample(p.brand_sales(spark, sf), "Q", "sum")
    wide = panel.to_wide(quarterly, _period_labels(spark, sf, "Q"), fill_value=0)
    return panel.to_long(wide, drop_zeros=True)


def _resample_sql(unit: str, value: str, end: str) -> str:
    return f"""
      with g as (select unique_id, date_trunc('{unit}', date) as s, {value} as y from f1 group by 1, 2),
      grid as (select unique_id, s from (select distinct unique_id from f1)
               cross join (select distinct date_trunc('{unit}', date) as s from cal))
      select grid.unique_id, cast(grid.s + {end} as date) as date, coalesce(g.y, 0) as y
      from grid left join g on grid.unique_id = g.unique_id and grid.s = g.s"""


@query("g10_resample_week", _resample_sql("week", "sum(y)", "interval 6 day"))
def g10_resample_week(spark, sf):
    return panel.resample(p.brand_sales(spark, sf), "W", "sum")


@query("g10_resample_month_last", _resample_sql("month", "max_by(y, date)", "interval 1 month - interval 1 day"))
def g10_resample_month_last(spark, sf):
    return panel.resample(p.brand_sales(spark, sf), "M", "last")


@query("g10_resample_quarter", _resample_sql("quarter", "sum(y)", "interval 3 month - interval 1 day"))
def g10_resample_quarter(spark, sf):
    return panel.resample(p.brand_sales(spark, sf), "Q", "sum")


@query("g10_resample_year_last", _resample_sql("year", "max_by(y, date)", "interval 1 year - interval 1 day"))
def g10_resample_year_last(spark, sf):
    return panel.resample(p.brand_sales(spark, sf), "Y", "last")


@query(
    "g14_day_columns",
    """with m as (select store_id, cat_id, item_id, cast(date_trunc('month', date) as date) as date, sum(y) as y
                 from f9 group by all),
       grid as (select * from (select distinct store_id, cat_id, item_id from f9)
                cross join (select distinct cast(date_trunc('month', date) as date) as date from cal))
       select grid.store_id, grid.cat_id, grid.item_id, grid.date, coalesce(m.y, 0) as y
       from grid left join m on grid.store_id = m.store_id and grid.cat_id = m.cat_id
            and grid.item_id = m.item_id and grid.date = m.date""",
)
def g14_day_columns(spark, sf):
    keys = ["store_id", "cat_id", "item_id"]
    first, last = p.span(spark, sf)
    months = len(_periods(spark, sf, "M"))
    start = dates.period_start(F.col("date"), "M")
    number = F.months_between(start, F.lit(first.replace(day=1))).cast("int") + 1
    columns = [f"d_{k}" for k in range(1, months + 1)]
    wide = (
        p.store_sales(spark, sf)
        .withColumn("d", F.concat(F.lit("d_"), number.cast("string")))
        .groupBy(*keys)
        .pivot("d", columns)
        .agg(F.sum("y"))
        .fillna(0.0)
    )
    calendar = (
        p.sold(spark, sf)
        .select(dates.period_start(F.col("date"), "M").alias("date"))
        .agg(F.min("date").alias("a"), F.max("date").alias("b"))
        .select(F.posexplode_outer(F.sequence("a", "b", F.expr("interval 1 month"))).alias("k", "date"))
        .select(F.concat(F.lit("d_"), (F.col("k") + 1).cast("string")).alias("d"), "date")
    )
    return panel.melt_day_columns(wide, calendar, keys)


@query("d3_library_format", "select unique_id, date as ds, y from f1")
def d3_library_format(spark, sf):
    return panel.rename_for_library(p.brand_sales(spark, sf))
