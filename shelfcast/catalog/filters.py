"""Projections, filters, typing and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query
from shelfcast.config import Labels
from shelfcast.functions import dates, rules
from shelfcast.operators import features, models, panel, publish, scoring

LABELS = Labels()


@query(
    "p1_parse_date",
    """with d as (select distinct l_orderkey, l_linenumber, case l_linenumber % 3
                     when 0 then strftime(l_shipdate, '%Y.%m.%d')
                     when 1 then strftime(l_shipdate, '%Y-%m-%d')
                     else strftime(l_shipdate, '%d/%m/%Y') end as raw from lineitem)
       select l_orderkey, l_linenumber, raw,
              cast(coalesce(try_strptime(raw, '%Y.%m.%d'), try_strptime(raw, '%Y-%m-%d')) as date) as date
       from d""",
)
def p1_parse_date(spark, sf):
    kind = F.col("l_linenumber") % 3
    raw = (
        F.when(kind == 0, F.date_format("l_shipdate", "yyyy.MM.dd"))
        .when(kind == 1, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy"))
    )
    rows = p.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw")).distinct()
    return rows.withColumn("date", dates.parse_date(F.col("raw")))


@query(
    "p2_categorise",
    """with c as (select event_type_1 as v, cast(row_number() over (order by event_type_1) - 1 as int) as code
                 from (select distinct event_type_1 from f4)),
       d as (select day_class as v, cast(row_number() over (order by day_class) - 1 as int) as code
             from (select distinct day_class from f5))
       select f4.unique_id, f4.date, sell_price, c.code as event_type_1, snap, coalesce(d.code, -1) as day_class
       from f4 join c on f4.event_type_1 = c.v
       left join f5 on f4.date = f5.date left join d on f5.day_class = d.v""",
)
def p2_categorise(spark, sf):
    rows = p.brand_covariates(spark, sf).join(F.broadcast(p.day_class(spark, sf)), "date", "left")
    chosen = features.categorical_columns(rows)
    return features.categorise(rows, chosen)


@query(
    "p3_item_parts",
    """with i as (select distinct p_brand || '_' || p_size || '_' || p_type as unique_id, p_type as ProteinGroup,
                     p_brand as VegetablesGroup, case when p_size % 5 > 0 then cast(p_size as varchar) end as StarchGroup
                  from part)
       select *, case when regexp_full_match(split_part(unique_id, '_', 1), '[0-9]+') then split_part(unique_id, '_', 1)
                      else left(split_part(unique_id, '_', 1), length(split_part(unique_id, '_', 1)) - 1) end as School,
              split_part(unique_id, '_', 2) as Size, split_part(unique_id, '_', 3) as Type,
              ProteinGroup || '_' || VegetablesGroup || '_' || StarchGroup as Meal
       from i""",
)
def p3_item_parts(spark, sf):
    ids = (
        p.table(spark, sf, "part")
        .select(
            F.concat_ws("_", "p_brand", F.col("p_size").cast("string"), "p_type").alias("unique_id"),
            F.col("p_type").alias("ProteinGroup"),
            F.col("p_brand").alias("VegetablesGroup"),
            F.when(F.col("p_size") % 5 > 0, F.col("p_size").cast("string")).alias("StarchGroup"),
        )
        .distinct()
    )
    return features.add_item_parts(ids)


@query(
    "p4_order_key",
    """select *, cast(Datum as varchar) || '_' || Rit || '_' || Hoeveelheidstype || '_' || Verpakkingstype
              || '_' || Menugroep || '_' || Menusoort as identifier from f8""",
)
def p4_order_key(spark, sf):
    return publish.with_order_key(p.order_lines(spark, sf))


@query(
    "p5_future_covariates",
    """with c as (select event_type_1 as v, cast(row_number() over (order by event_type_1) - 1 as int) as code
                 from (select distinct event_type_1 from f4))
       select filled.unique_id, filled.date as ds, sell_price, coalesce(c.code, -1) as event_type_1, snap
       from filled left join f4 on filled.unique_id = f4.unique_id and filled.date = f4.date
       left join c on f4.event_type_1 = c.v""",
)
def p5_future_covariates(spark, sf):
    covars = ["sell_price", "event_type_1", "snap"]
    rows = panel.fill_calendar(
        p.brand_with_covariates(spark, sf), covars=covars, span=p.span(spark, sf)
    )
    coded = features.categorise(rows, ["event_type_1"])
    return panel.rename_for_library(coded).select("unique_id", "ds", *covars)


@query(
    "p6_drop_warm_up",
    """select * from filled where date >= (select date from
         (select distinct date from filled) order by date limit 1 offset 180)""",
)
def p6_drop_warm_up(spark, sf):
    span = p.span(spark, sf)
    kept = p.filled(spark, sf, span, back=(span[1] - span[0]).days + 1 - 180)
    return panel.drop_first_dates(kept, 180, span)


@query("p7_clip", "select unique_id, date, greatest(y - 30, 0) as y from f1")
def p7_clip(spark, sf):
    return publish.clip_forecasts(p.brand_sales(spark, sf).withColumn("y", F.col("y") - 30))


@query("p8_round", "select unique_id, date, cast(round_even(y / 4, 0) as int) as y from f1")
def p8_round(spark, sf):
    return publish.round_forecasts(p.brand_sales(spark, sf).withColumn("y", F.col("y") / 4))


@query(
    "p9_traffic_light",
    """select unique_id, date, y, case when y < 20 then 'green' when y < 40 then 'yellow' else 'red' end as Color
       from f1""",
)
def p9_traffic_light(spark, sf):
    return p.brand_sales(spark, sf).withColumn("Color", rules.traffic_light(F.col("y")))


@query("p10_label", "select unique_id, date, y, 'Confirmed' as Model from f1")
def p10_label(spark, sf):
    return publish.label(p.brand_sales(spark, sf), LABELS.confirmed)


@query(
    "p11_weekday_off",
    """select filled.unique_id, date, case when isodow(date) = 3 and ExtraDay = 0 then 0 else y end as y
       from filled left join f7 on filled.unique_id = f7.unique_id""",
)
def p11_weekday_off(spark, sf):
    return publish.weekday_off(p.filled(spark, sf), p.extra_days(spark, sf))


@query(
    "p12_rows_to_score",
    """with x as (select unique_id, date, Model, fh, cv,
                    case when Model = 'SeasonalWindowAverage' and unique_id like '%3' then null
                         when Model = 'Naive' and fh = 2 then null else y end as y,
                    case when isodow(date) = 7 then null else "True" end as "True" from ev)
       select * from x where y is not null and "True" is not null and unique_id not in
         (select unique_id from x where Model = 'SeasonalWindowAverage' and y is null)""",
)
def p12_rows_to_score(spark, sf):
    model = F.col("Model")
    missed = (model == models.SEASONAL_WINDOW_AVERAGE) & F.col("unique_id").endswith("3")
    holes = (model == models.NAIVE) & (F.col("fh") == 2)
    rows = (
        p.evaluated(spark, sf)
        .withColumn("y", F.when(~(missed | holes), F.col("y")))
        .withColumn("True", F.when(F.weekday("date") != 6, F.col("True")))
        .drop("cutoff")
    )
    return scoring.rows_to_score(rows, models.SEASONAL_WINDOW_AVERAGE)


@query(
    "p13_drop_all_zero_rows",
    """with l as (select unique_id, date, y, lag(y, 1) over w as lag1, lag(y, 2) over w as lag2, lag(y, 3) over w as lag3
                 from filled2 window w as (partition by unique_id order by date))
       select * from l where lag3 is not null and not (lag1 = 0 and lag2 = 0 and lag3 = 0 and y = 0)""",
)
def p13_drop_all_zero_rows(spark, sf):
    rows = panel.fill_calendar(p.supplier_sales(spark, sf), span=p.span(spark, sf), spread=True)
    return features.drop_all_zero_rows(features.add_lags(rows, [1, 2, 3]))


@query(
    "p14_min_history",
    """select * from f2 where unique_id in (select unique_id from f2 group by 1 having count(y) >= 530)""",
)
def p14_min_history(spark, sf):
    return panel.with_min_history(p.supplier_sales(spark, sf), 530)


@query(
    "p17_confirmed_split",
    """select Datum, Rit, Hoeveelheidstype, Verpakkingstype, Menugroep, Menusoort, y,
              case when BEVESTIGD in ('Website', 'Telefoon') then 'confirmed' else 'predicted' end as part
       from f8""",
)
def p17_confirmed_split(spark, sf):
    confirmed, predicted = publish.split_confirmed(p.order_lines(spark, sf))
    return confirmed.withColumn("part", F.lit("confirmed")).unionByName(
        predicted.withColumn("part", F.lit("predicted"))
    )


@query(
    "p18_restrict_to_span",
    """select * from f8 where Datum between (select min(Datum) from f8 where BEVESTIGD = 'Website' and y = 50 and Menugroep = 'SMALL')
         and (select max(Datum) from f8 where BEVESTIGD = 'Website' and y = 50 and Menugroep = 'SMALL')""",
)
def p18_restrict_to_span(spark, sf):
    orders = p.order_lines(spark, sf)
    other = orders.where((F.col("BEVESTIGD") == "Website") & (F.col("y") == 50) & (F.col("Menugroep") == "SMALL"))
    return publish.restrict_to_span(orders, other)


@query(
    "p19_freshness",
    """select max(Datum) as newest,
              max(Datum) = (select max(date) - 7 + 7 from f1) as fresh from f8""",
)
def p19_freshness(spark, sf):
    history = p.brand_sales(spark, sf)
    history = history.where(F.col("date") <= F.date_sub(F.lit(p.span(spark, sf)[1]), 7))
    # The history is cut a week before the orders end.
    return publish.is_fresh(p.order_lines(spark, sf), history)


@query("p20_model_slot", "select unique_id, date, Model, y, fh from pf where Model = 'SeasonalNaive'")
def p20_model_slot(spark, sf):
    rows = p.forecast(spark, sf).where(F.col("Model") == LABELS.benchmark)
    return rows.select("unique_id", "date", "Model", "y", "fh")


@query("p21_slice", "select * from f9 where cat_id = 'ECONOMY' and store_id = 'ASIA'")
def p21_slice(spark, sf):
    return p.store_sales(spark, sf).where((F.col("cat_id") == "ECONOMY") & (F.col("store_id") == "ASIA"))


@query("p22_keep_last_days", "select * from filled where date > (select max(date) from f1) - 730")
def p22_keep_last_days(spark, sf):
    span = p.span(spark, sf)
    return panel.keep_last_days(p.filled(spark, sf, span, back=730), 730, span[1])


@query(
    "p23_validation_split",
    """select *, case when date >= (select date from (select distinct date from f2) order by date desc limit 1 offset 55)
              then 'validation' else 'train' end as part from f2""",
)
def p23_validation_split(spark, sf):
    train, validation = panel.split_last_dates(p.supplier_sales(spark, sf), 56)
    return train.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )


@query("p24_drop_zero_sales", "select * from filled2 where y > 0")
def p24_drop_zero_sales(spark, sf):
    rows = panel.fill_calendar(p.supplier_sales(spark, sf), span=p.span(spark, sf), spread=True)
    return rows.where(F.col("y") > 0)


@query(
    "p25_recent_weeks",
    "select * from f1 where date >= date_trunc('week', (select max(date) from f1)) - interval 21 day",
)
def p25_recent_weeks(spark, sf):
    return panel.recent_weeks(p.brand_sales(spark, sf))
