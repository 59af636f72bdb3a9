"""Post-processing, unions, documents and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query, rounded
from shelfcast.config import Labels
from shelfcast.operators import models, publish, scoring
from shelfcast.plans import weekly

LABELS = Labels()


@query(
    "j6_attach_truth",
    """select pf.unique_id, pf.date, Model, round(pf.y, 6) as y, fh, cast(null as int) as cv, tr.y as "True"
       from pf left join tr on pf.unique_id = tr.unique_id and pf.date = tr.date""",
)
def j6_attach_truth(spark, sf):
    days = p.span(spark, sf)
    return rounded(scoring.attach_truth(p.forecast(spark, sf, days=days), p.truth(spark, sf, days)))


@query(
    "j6_attach_truth_other_dates",
    """select unique_id, date, Model, round(y, 6) as y, fh, cast(null as int) as cv,
              cast(null as double) as "True" from pf""",
)
def j6_attach_truth_other_dates(spark, sf):
    days = p.span(spark, sf)
    longer = p.recent_truth(spark, sf, p.TRIM, days)
    return rounded(scoring.attach_truth(p.forecast(spark, sf, days=days), longer))


@query("m27_postprocess", "select unique_id, date, fh, round(y, 6) as y, Model, Color from pub")
def m27_postprocess(spark, sf):
    return rounded(p.published(spark, sf, LABELS))


@query(
    "m27_postprocess_ensemble",
    """with e as (select unique_id, date, fh,
             case when count(y) filter (where y <> 0) = 0 then 0
                  when count(y) filter (where y <> 0) > 1
                   and max(y) filter (where y <> 0) / min(y) filter (where y <> 0) >
                       case when min(y) filter (where y <> 0) < 10 then 2
                            when min(y) filter (where y <> 0) < 50 then 5 else 7 end
                  then max(y) filter (where y <> 0)
                  else median(y) filter (where y <> 0) end as y
             from pf group by all),
       r as (select unique_id, date, fh, cast(round_even(y, 0) as double) as y, 'Primary' as Model from e),
       b as (select unique_id, date, fh, y, Model from pf where Model = 'SeasonalNaive'),
       c as (select r.unique_id, avg(abs(r.y - b.y)) as g from r join b on r.unique_id = b.unique_id and r.date = b.date
             group by 1),
       u as (select * from r union all select * from b)
       select u.*, case when g < 20 then 'green' when g < 40 then 'yellow' else 'red' end as Color
       from u join c on u.unique_id = c.unique_id""",
)
def m27_postprocess_ensemble(spark, sf):
    found = publish.postprocess(
        p.forecast(spark, sf), LABELS, models.SEASONAL_WINDOW_AVERAGE, ensemble=True
    )
    return rounded(found)


@query(
    "u1_union_models",
    """select unique_id, date, cutoff, Model, round(y, 6) as y, fh from fc where Model = 'Naive'
       union all
       select unique_id, date, cutoff, Model, round(y, 6), fh from fc where Model = 'SeasonalWindowAverage'""",
)
def u1_union_models(spark, sf):
    from shelfcast.operators.backtest import benchmark_forecasts

    days = p.span(spark, sf)
    rows, cuts = p.filled(spark, sf, days), p.cutoffs(days)
    first = benchmark_forecasts(rows, cuts, p.H, [models.NAIVE])
    second = benchmark_forecasts(rows, cuts, p.H, [models.SEASONAL_WINDOW_AVERAGE])
    return rounded(first.unionByName(second, allowMissingColumns=True))


_LATEST = "select * from f8 where BEVESTIGD = 'Website' and y >= 48"


@query(
    "u3_add_missing_orders",
    f"""with l as ({_LATEST}), k as (select distinct Datum, Rit, Hoeveelheidstype, Verpakkingstype, Menugroep, Menusoort from l)
       select * from l
       union all
       select f8.* from f8 where Datum between (select min(Datum) from l) and (select max(Datum) from l)
         and not exists (select 1 from k where k.Datum = f8.Datum and k.Rit = f8.Rit
           and k.Hoeveelheidstype = f8.Hoeveelheidstype and k.Verpakkingstype = f8.Verpakkingstype
           and k.Menugroep = f8.Menugroep and k.Menusoort = f8.Menusoort)""",
)
def u3_add_missing_orders(spark, sf):
    orders = p.order_lines(spark, sf)
    latest = orders.where((F.col("BEVESTIGD") == "Website") & (F.col("y") >= 48))
    return publish.add_missing_orders(latest, orders)


@query(
    "u4_attach_confirmed",
    """select unique_id, date, fh, Model, round(y, 6) as y, Color from pub
       union all
       select f1.unique_id, f1.date, s.fh, 'Confirmed', f1.y, 'green' from f1
       join (select distinct date, fh from pf) s on f1.date = s.date""",
)
def u4_attach_confirmed(spark, sf):
    days = p.span(spark, sf)
    confirmed = p.brand_sales(spark, sf).where(F.col("date") > F.date_sub(F.lit(days[1]), p.H))
    return rounded(publish.attach_confirmed(p.published(spark, sf, LABELS), confirmed, LABELS))


@query(
    "u4_attach_confirmed_placeholder",
    """select unique_id, date, fh, Model, round(y, 6) as y, Color from pub
       union all
       select distinct unique_id, date, fh, 'Confirmed', cast(null as double), 'green' from pub""",
)
def u4_attach_confirmed_placeholder(spark, sf):
    confirmed = p.brand_sales(spark, sf)
    return rounded(publish.attach_confirmed(p.published(spark, sf, LABELS), confirmed, LABELS))


def _with_truth(spark, sf):
    days = p.span(spark, sf)
    return scoring.attach_truth(p.published(spark, sf, LABELS), p.truth(spark, sf, days))


@query(
    "a12_documents",
    """select unique_id, cast(to_json(list({'date': cast(date as varchar), 'y': y, 'Model': Model, 'Color': Color, 'True': "True"}
              order by date, Model)) as varchar) as records
       from pubt group by 1""",
)
def a12_documents(spark, sf):
    return publish.forecast_documents(_with_truth(spark, sf))


@query("a12_documents_read_back", """select unique_id, date, y, Model, Color, "True" from pubt""")
def a12_documents_read_back(spark, sf):
    return publish.read_documents(publish.forecast_documents(_with_truth(spark, sf)))


@query(
    "s12_order_export",
    'select unique_id as "Unique ID", '
    + ", ".join(
        f"""coalesce(cast(max(case when fh = {k} and {test} then {value} end) as varchar), '') as "step{k}_{name}\""""
        for k in range(1, 8)
        for name, test, value in (
            ("Primary", "Model = 'Primary'", "y"),
            ("SeasonalNaive", "Model = 'SeasonalNaive'", "y"),
            ("Confirmed", "Model = 'Confirmed'", "y"),
            ("True", "true", '"True"'),
        )
    )
    + " from pubt group by 1",
)
def s12_order_export(spark, sf):
    days = p.span(spark, sf)
    from datetime import timedelta

    dates = [str(days[1] - timedelta(days=p.H - k)) for k in range(1, p.H + 1)]
    wide = publish.order_export(
        _with_truth(spark, sf), dates, [LABELS.primary, LABELS.benchmark, LABELS.confirmed]
    )
    # The SQL side cannot name columns by the newest date, so both use the step.
    names = {
        f"{day}_{m}": f"step{k}_{m}"
        for k, day in enumerate(dates, 1)
        for m in (LABELS.primary, LABELS.benchmark, LABELS.confirmed, "True")
    }
    return wide.withColumnsRenamed(names)


@query(
    "s13_model_columns",
    """select unique_id, date, max(case when Model = 'Primary' then y end) as "Primary",
              max(case when Model = 'SeasonalNaive' then y end) as "SeasonalNaive",
              max("True") as "True", any_value(Color) as Color from pubt group by 1, 2""",
)
def s13_model_columns(spark, sf):
    return publish.model_columns(_with_truth(spark, sf), [LABELS.primary, LABELS.benchmark])


def _decision_sql(history: str, update: str) -> str:
    return f"""
      with x as (select exists (select 1 from ({history}) h join pf on h.date = pf.date) as due,
                        exists (select 1 from ({update}) u join pf on u.date = pf.date) as arrived)
      select due as forecast, not due and arrived as score from x"""


@query("st3_run_decision_score", _decision_sql("select * from f1 where date <= (select max(date) from f1) - 7", "select * from tr"))
def st3_run_decision_score(spark, sf):
    days = p.span(spark, sf)
    history = p.brand_sales(spark, sf).where(F.col("date") <= F.date_sub(F.lit(days[1]), p.H))
    forecasts = scoring.attach_truth(p.forecast(spark, sf, days=days), None)
    return weekly.run_decision(history, forecasts, p.truth(spark, sf, days))


@query("st3_run_decision_forecast", _decision_sql("select * from f1", "select * from tr"))
def st3_run_decision_forecast(spark, sf):
    days = p.span(spark, sf)
    forecasts = scoring.attach_truth(p.forecast(spark, sf, days=days), None)
    return weekly.run_decision(p.brand_sales(spark, sf), forecasts, p.truth(spark, sf, days))


@query(
    "u5_date_overlap",
    """select count(*) filter (where date in (select date from f5)) as shared,
              count(*) filter (where date not in (select date from f5)) as only_left
       from (select distinct date from f1)""",
)
def u5_date_overlap(spark, sf):
    left = p.brand_sales(spark, sf).select("date").distinct()
    right = p.day_class(spark, sf).select("date")
    known = left.join(F.broadcast(right.withColumn("_in", F.lit(1))), "date", "left")
    return known.agg(
        F.count("_in").alias("shared"), F.count_if(F.col("_in").isNull()).alias("only_left")
    )
