"""Series tables derived from the test tables, as DataFrames and as SQL.

`PARTS` holds named SQL subqueries; `sql(body)` puts the ones a statement
mentions in front of it, in the order they are defined.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import models, panel, publish, scoring

H, SEASON, WINDOWS, SEASONAL_WINDOW = 7, 7, 5, 4
TRIM = WINDOWS + H - 1


# Declared, so that opening a table needs no footer pass.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def day(column: str):
    return F.col(column).cast("date")


def sold(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their part."""
    lines = table(spark, sf, "lineitem").withColumn("date", day("l_shipdate"))
    return lines.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))


def brand_sales(spark: SparkSession, sf: str) -> DataFrame:
    """daily quantity per brand."""
    return (
        sold(spark, sf)
        .groupBy(F.col("p_brand").alias("unique_id"), "date")
        .agg(F.sum("l_quantity").alias("y"))
    )


def supplier_sales(spark: SparkSession, sf: str) -> DataFrame:
    """daily quantity per supplier, mostly zeros once filled."""
    lines = table(spark, sf, "lineitem")
    key = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    return lines.groupBy(key.alias("unique_id"), day("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("y")
    )


def event_counts(spark: SparkSession, sf: str) -> DataFrame:
    """daily events per type."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("unique_id"), day("ts").alias("date"))
        .agg(F.count("*").cast("double").alias("y"))
    )


def brand_covariates(spark: SparkSession, sf: str) -> DataFrame:
    """price, event category and flag per brand and day."""
    price = F.max(F.col("l_extendedprice") / F.col("l_quantity"))
    return (
        sold(spark, sf)
        .groupBy(F.col("p_brand").alias("unique_id"), "date")
        .agg(
            price.alias("sell_price"),
            F.max("l_returnflag").alias("event_type_1"),
            F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("snap"),
        )
    )


def brand_with_covariates(spark: SparkSession, sf: str) -> DataFrame:
    """F1 and F4 in one aggregate."""
    price = F.max(F.col("l_extendedprice") / F.col("l_quantity"))
    return (
        sold(spark, sf)
        .groupBy(F.col("p_brand").alias("unique_id"), "date")
        .agg(
            F.sum("l_quantity").alias("y"),
            price.alias("sell_price"),
            F.max("l_returnflag").alias("event_type_1"),
            F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("snap"),
        )
    )


def weekday_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Weekday sales per brand with item features from its number and groups of the day's orders."""
    number = F.substring("unique_id", 7, 2)
    daily = (
        sold(spark, sf)
        .where(F.weekday("date") < 5)
        .groupBy(F.col("p_brand").alias("unique_id"), "date")
        .agg(
            F.sum("l_quantity").alias("y"),
            F.max("l_returnflag").alias("ProteinGroup"),
            F.max("l_linestatus").alias("VegetablesGroup"),
            F.min("l_returnflag").alias("StarchGroup"),
        )
    )
    return daily.withColumns(
        {
            "School": F.concat(F.lit("S"), F.substring(number, 1, 1)),
            "Size": F.concat(F.lit("M"), F.substring(number, 2, 1)),
            "Type": F.when(F.substring(number, 2, 1) < "3", "warm").otherwise("cold"),
            "Customer": F.col("unique_id"),
        }
    )


def day_class(spark: SparkSession, sf: str) -> DataFrame:
    """one class per order date."""
    return (
        table(spark, sf, "orders")
        .groupBy(day("o_orderdate").alias("date"))
        .agg(F.min("o_orderpriority").alias("day_class"))
    )


def extra_days(spark: SparkSession, sf: str) -> DataFrame:
    """rule calendar, every tenth brand flagged."""
    number = F.substring("p_brand", 7, 10).cast("int")
    return (
        table(spark, sf, "part")
        .select(
            F.col("p_brand").alias("unique_id"),
            F.when(number % 10 == 0, 1).otherwise(0).alias("ExtraDay"),
        )
        .distinct()
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """F8: raw order lines in the client's format."""
    state = F.when(F.col("l_linenumber") == 1, "Website").when(F.col("l_linenumber") == 2, "Telefoon")
    return sold(spark, sf).select(
        F.col("date").alias("Datum"),
        F.col("l_suppkey").cast("string").alias("Rit"),
        F.col("l_returnflag").alias("Hoeveelheidstype"),
        F.col("l_linestatus").alias("Verpakkingstype"),
        F.col("p_type").alias("Menugroep"),
        F.col("p_brand").alias("Menusoort"),
        state.alias("BEVESTIGD"),
        F.col("l_orderkey").cast("string").alias("Postcode"),
        F.col("l_quantity").alias("y"),
    )


def store_sales(spark: SparkSession, sf: str) -> DataFrame:
    """region as store, part type as category, brand as item."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    homes = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    return (
        sold(spark, sf)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.col("r_name").alias("store_id"),
            F.col("p_type").alias("cat_id"),
            F.col("p_brand").alias("item_id"),
            "date",
        )
        .agg(F.sum("l_quantity").alias("y"))
    )


def span(spark: SparkSession, sf: str) -> tuple[date, date]:
    """First and last day of F1, from the scan of one column."""
    return panel.date_span(table(spark, sf, "lineitem").select(day("l_shipdate").alias("date")))


def filled(spark: SparkSession, sf: str, days=None, back: int | None = None) -> DataFrame:
    """F1 on the whole calendar, or on its last `back` days."""
    days = days or span(spark, sf)
    since = None if back is None else days[1] - timedelta(days=back - 1)
    return panel.fill_calendar(brand_sales(spark, sf), span=days, since=since)


# Days a forecast of the fixed-memory models looks at, from the oldest cutoff.
MEMORY = TRIM + SEASON * SEASONAL_WINDOW


def cutoffs(days):
    return models.backtest_cutoffs(F.lit(days[1]), H, WINDOWS)


FORECAST_MODELS = (models.NAIVE, models.SEASONAL_NAIVE, models.SEASONAL_WINDOW_AVERAGE)


def backtest(spark: SparkSession, sf: str, chosen=FORECAST_MODELS, days=None) -> DataFrame:
    """F11 with windows: forecasts from five cutoffs."""
    days = days or span(spark, sf)
    cuts = cutoffs(days)
    found = models.window_forecasts(
        filled(spark, sf, days, MEMORY),
        cuts,
        H,
        season=SEASON,
        models=chosen,
        seasonal_window=SEASONAL_WINDOW,
    )
    return models.with_window_code(found, cuts)


def evaluated(spark: SparkSession, sf: str, chosen=FORECAST_MODELS, days=None) -> DataFrame:
    """F11 with the truth of F12."""
    days = days or span(spark, sf)
    found = backtest(spark, sf, chosen, days)
    return scoring.backtest_truth(found, recent_truth(spark, sf, TRIM, days), check=False)


def scale(spark: SparkSession, sf: str, days=None) -> DataFrame:
    days = days or span(spark, sf)
    return scoring.in_sample_scale(brand_sales(spark, sf), TRIM, span=days)


def scores(
    spark: SparkSession, sf: str, metrics=scoring.DEFAULT_METRICS, chosen=FORECAST_MODELS
) -> DataFrame:
    days = span(spark, sf)
    return scoring.score(evaluated(spark, sf, chosen, days), scale(spark, sf, days), metrics)


def dated_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score history with one entry date per window."""
    days = span(spark, sf)
    keys = ("unique_id", "Model", "cv", "cutoff")
    found = scoring.score(evaluated(spark, sf, days=days), scale(spark, sf, days), keys=keys)
    return found.withColumnRenamed("cutoff", "date")


def forecast(spark: SparkSession, sf: str, holdback: int = H, days=None) -> DataFrame:
    """F11 without windows: one forecast, `holdback` days before the end."""
    days = days or span(spark, sf)
    last = F.array(F.date_sub(F.lit(days[1]), holdback))
    found = models.window_forecasts(
        filled(spark, sf, days, MEMORY),
        last,
        H,
        season=SEASON,
        models=FORECAST_MODELS,
        seasonal_window=SEASONAL_WINDOW,
    )
    return models.as_plain_forecast(found)


def recent_truth(spark: SparkSession, sf: str, back: int, days=None) -> DataFrame:
    """filled sales of the last `back` days."""
    days = days or span(spark, sf)
    return filled(spark, sf, days, back)


def truth(spark: SparkSession, sf: str, days=None) -> DataFrame:
    return recent_truth(spark, sf, H, days)


def published(spark: SparkSession, sf: str, labels) -> DataFrame:
    """F11 through post-processing, the seasonal window average as primary model."""
    return publish.postprocess(
        forecast(spark, sf), labels, global_model=models.SEASONAL_WINDOW_AVERAGE
    )


# Named SQL subqueries on the registered views.
PARTS: dict[str, str] = {
    "sold": """
        select *, cast(l_shipdate as date) as date from lineitem join part on l_partkey = p_partkey""",
    "f1": """
        select p_brand as unique_id, date, cast(sum(l_quantity) as double) as y
        from sold group by 1, 2""",
    "f2": """
        select 'S' || l_suppkey as unique_id, cast(l_shipdate as date) as date,
               cast(sum(l_quantity) as double) as y
        from lineitem group by 1, 2""",
    "f3": """
        select event_type as unique_id, cast(ts as date) as date, cast(count(*) as double) as y
        from events group by 1, 2""",
    "f4": """
        select p_brand as unique_id, date,
               max(l_extendedprice / l_quantity) as sell_price,
               max(l_returnflag) as event_type_1,
               cast(max(case when l_linestatus = 'O' then 1 else 0 end) as int) as snap
        from sold group by 1, 2""",
    "f5": """
        select cast(o_orderdate as date) as date, min(o_orderpriority) as day_class
        from orders group by 1""",
    "f7": """
        select distinct p_brand as unique_id,
               cast(case when cast(substr(p_brand, 7) as int) % 10 = 0 then 1 else 0 end as int) as ExtraDay
        from part""",
    "f8": """
        select date as Datum, cast(l_suppkey as varchar) as Rit, l_returnflag as Hoeveelheidstype,
               l_linestatus as Verpakkingstype, p_type as Menugroep, p_brand as Menusoort,
               case when l_linenumber = 1 then 'Website' when l_linenumber = 2 then 'Telefoon' end as BEVESTIGD,
               cast(l_orderkey as varchar) as Postcode, l_quantity as y
        from sold""",
    "f9": """
        select r_name as store_id, p_type as cat_id, p_brand as item_id, date,
               cast(sum(l_quantity) as double) as y
        from sold join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        group by 1, 2, 3, 4""",
    "cal": """
        select cast(range as date) as date
        from range((select min(date) from f1), (select max(date) + 1 from f1), interval 1 day)""",
    "ids": "select distinct unique_id from f1",
    "filled": """
        select ids.unique_id, cal.date, coalesce(f1.y, 0) as y
        from ids cross join cal left join f1 on f1.unique_id = ids.unique_id and f1.date = cal.date""",
    "cal2": """
        select cast(range as date) as date
        from range((select min(date) from f2), (select max(date) + 1 from f2), interval 1 day)""",
    "filled2": """
        select i.unique_id, cal2.date, coalesce(f2.y, 0) as y
        from (select distinct unique_id from f2) i cross join cal2
        left join f2 on f2.unique_id = i.unique_id and f2.date = cal2.date""",
    "cuts": """
        select cast(5 - k as int) as cv, cast((select max(date) from f1) - cast(7 + k as int) as date) as cutoff
        from range(0, 5) t(k)""",
    "steps": "select cast(fh as int) as fh from range(1, 8) t(fh)",
    "fc": """
        select unique_id, cast(cutoff + fh as date) as date, cutoff, 'Naive' as Model, y, fh, cv
        from filled join cuts on date = cutoff, steps
        union all
        select unique_id, cast(cutoff + fh as date), cutoff, 'SeasonalNaive', y, fh, cv
        from cuts, steps, filled where date = cutoff - 7 + (fh - 1) % 7 + 1
        union all
        select unique_id, cast(cutoff + fh as date), cutoff, 'SeasonalWindowAverage', avg(y), fh, cv
        from cuts, steps, range(1, 5) t(j), filled
        where date = cutoff - cast(7 * j as int) + (fh - 1) % 7 + 1
        group by unique_id, cutoff, fh, cv""",
    "ev": """
        select fc.unique_id, fc.date, cutoff, Model, fc.y, fh, cv, filled.y as "True"
        from fc join filled on fc.unique_id = filled.unique_id and fc.date = filled.date""",
    "scale": """
        select unique_id, avg(d * d) as naive_mse, avg(abs(d)) as naive_mae
        from (select unique_id, y - lag(y) over (partition by unique_id order by date) as d
              from filled where date <= (select max(date) from f1) - 11)
        group by 1""",
    "sc": """
        select e.unique_id, Model, cv, cutoff,
               case when any_value(naive_mse) = 0 then 0
                    else sqrt(avg((y - "True") * (y - "True")) / any_value(naive_mse)) end as rmsse,
               avg(abs(y - "True")) as mae, avg(y - "True") as bias
        from ev e join scale s on e.unique_id = s.unique_id
        group by 1, 2, 3, 4""",
    "pf": """
        select unique_id, date, Model, y, fh from fc where cv = 5""",
    "tr": "select * from filled where date > (select max(date) from f1) - 7",
    "prim": """
        select unique_id, date, fh, cast(round_even(greatest(y, 0), 0) as double) as y, 'Primary' as Model
        from pf where Model = 'SeasonalWindowAverage'""",
    "mixed": """
        select unique_id, date, fh, y, Model from prim
        union all
        select unique_id, date, fh, greatest(y, 0), Model from pf where Model = 'SeasonalNaive'""",
    "gap_of": """
        select p.unique_id, avg(abs(p.y - b.y)) as AbsDifference
        from prim p join mixed b on b.Model = 'SeasonalNaive' and p.unique_id = b.unique_id and p.date = b.date
        group by 1""",
    "colour": """
        select unique_id, AbsDifference,
               case when AbsDifference < 20 then 'green' when AbsDifference < 40 then 'yellow'
                    else 'red' end as Color
        from gap_of""",
    "pub": """
        select mixed.*, colour.Color from mixed left join colour on mixed.unique_id = colour.unique_id""",
    "pubt": """
        select pub.*, tr.y as "True" from pub
        left join tr on pub.unique_id = tr.unique_id and pub.date = tr.date""",
}


def sql(body: str) -> str:
    """`body` with the named subqueries it uses, directly or through others, in front."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                visit(PARTS[name])

    visit(body)
    parts = [f"{name} as ({PARTS[name].strip()})" for name in PARTS if name in used]
    if not parts:
        return body.strip()
    head = "with " + ",\n".join(parts)
    stripped = body.strip()
    if stripped.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(parts) + ",\n" + stripped[len("with recursive ") :]
    if stripped.lower().startswith("with "):
        return head + ",\n" + stripped[5:]
    return head + "\n" + stripped
