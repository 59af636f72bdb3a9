"""Forecast models, backtests, intervals and candidate search."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from shelfcast.catalog import panels as p
from shelfcast.catalog.registry import query, rounded
from shelfcast.config import SearchSpace
from shelfcast.operators import intervals, models, smoothing

Z80, Z95 = NormalDist().inv_cdf(0.9), NormalDist().inv_cdf(0.975)


def _ahead(spark, sf, chosen, **options):
    """Forecast beyond the data of the brand panel."""
    days = p.span(spark, sf)
    last = F.array(F.lit(days[1]))
    recent = p.filled(spark, sf, days, p.MEMORY)
    found = models.window_forecasts(recent, last, p.H, models=chosen, **options)
    return rounded(models.as_plain_forecast(found))


_LAST = "(select max(date) from f1)"


@query(
    "m1_naive",
    f"""select unique_id, cast(date + fh as date) as date, 'Naive' as Model, y, fh, cast(null as int) as cv
        from filled, steps where date = {_LAST}""",
)
def m1_naive(spark, sf):
    return _ahead(spark, sf, (models.NAIVE,))


@query(
    "m2_seasonal_naive",
    f"""select unique_id, cast({_LAST} + fh as date) as date, 'SeasonalNaive' as Model, y, fh, cast(null as int) as cv
        from steps, filled where date = {_LAST} - 7 + (fh - 1) % 7 + 1""",
)
def m2_seasonal_naive(spark, sf):
    return _ahead(spark, sf, (models.SEASONAL_NAIVE,))


@query(
    "m3_window_average",
    f"""select unique_id, cast({_LAST} + fh as date) as date, 'WindowAverage' as Model, round(avg(y), 6) as y, fh,
               cast(null as int) as cv
        from steps, filled where date > {_LAST} - 14 group by unique_id, fh""",
)
def m3_window_average(spark, sf):
    return _ahead(spark, sf, (models.WINDOW_AVERAGE,), window=14)


@query(
    "m4_seasonal_window_average",
    f"""select unique_id, cast({_LAST} + fh as date) as date, 'SeasonalWindowAverage' as Model, round(avg(y), 6) as y,
               fh, cast(null as int) as cv
        from steps, range(1, 5) t(j), filled where date = {_LAST} - cast(7 * j as int) + (fh - 1) % 7 + 1
        group by unique_id, fh""",
)
def m4_seasonal_window_average(spark, sf):
    return _ahead(spark, sf, (models.SEASONAL_WINDOW_AVERAGE,))


def _croston_sql(label: str, factor: float) -> str:
    return f"""
      with n as (select *, row_number() over (partition by unique_id order by date) as pos from filled2),
      d as (select *, row_number() over w as k, count(*) over (partition by unique_id) as total,
                   pos - coalesce(lag(pos) over w, 0) as gap
            from n where y > 0 window w as (partition by unique_id order by date)),
      r as (select unique_id, sum(pow(0.9, total - k) * case when k = 1 then 1 else 0.1 end * y)
                 / sum(pow(0.9, total - k) * case when k = 1 then 1 else 0.1 end * gap) as rate from d group by 1)
      select unique_id, cast((select max(date) from f2) + fh as date) as date, (select max(date) from f2) as cutoff,
             '{label}' as Model, round(rate * {factor}, 6) as y, fh from r, steps"""


def _croston(spark, sf, variant):
    first, last = p.span(spark, sf)
    rows = p.supplier_sales(spark, sf)
    return rounded(smoothing.croston(rows, F.array(F.lit(last)), p.H, variant, start=F.lit(first)))


@query("m5_croston", _croston_sql("CrostonClassic", 1.0))
def m5_croston(spark, sf):
    return _croston(spark, sf, "classic")


@query("m6_croston_sba", _croston_sql("SBA", 0.95))
def m6_croston_sba(spark, sf):
    return _croston(spark, sf, "sba")


def _fit_sql(values: str, grid) -> str:
    """Struct of the last level and squared error of simple exponential smoothing."""
    return f"""list_reduce(list_transform({values}, lambda v: {{'level': v, 'sse': 0.0::double, 'v': v}}),
        lambda s, e: {{'level': a * e.v + (1 - a) * s.level,
                       'sse': s.sse + (e.v - s.level) * (e.v - s.level), 'v': e.v}})"""


@query(
    "m7_croston_optimized",
    f"""with n as (select *, row_number() over (partition by unique_id order by date) as pos from filled2),
      d as (select *, cast(pos - coalesce(lag(pos) over (partition by unique_id order by date), 0) as double) as gap
            from n where y > 0),
      l as (select unique_id, list(y order by date) as dem, list(gap order by date) as gaps from d group by 1),
      g as (select unnest([0.1, 0.15, 0.2, 0.25, 0.3])::double as a),
      f as (select unique_id, {_fit_sql('dem', None)} as fd, {_fit_sql('gaps', None)} as fg from l, g),
      r as (select unique_id, arg_min(fd.level, fd.sse) / arg_min(fg.level, fg.sse) as rate from f group by 1)
      select unique_id, cast((select max(date) from f2) + fh as date) as date, (select max(date) from f2) as cutoff,
             'CrostonOptimized' as Model, round(rate, 6) as y, fh from r, steps""",
)
def m7_croston_optimized(spark, sf):
    return _croston(spark, sf, "optimized")


SES_GRID = (0.1, 0.3, 0.5, 0.7, 0.9)


@query(
    "m8_ses",
    f"""with l as (select unique_id, list(y order by date) as ys from filled group by 1),
      g as (select unnest([0.1, 0.3, 0.5, 0.7, 0.9])::double as a),
      f as (select unique_id, {_fit_sql('ys', None)} as ft from l, g),
      r as (select unique_id, arg_min(ft.level, ft.sse) as level from f group by 1)
      select unique_id, cast({_LAST} + fh as date) as date, {_LAST} as cutoff, 'SES' as Model,
             round(level, 6) as y, fh from r, steps""",
)
def m8_ses(spark, sf):
    days = p.span(spark, sf)
    return rounded(smoothing.ses(p.filled(spark, sf, days), F.array(F.lit(days[1])), p.H, SES_GRID))


@query("m8_exponential_smoothing")
def m8_exponential_smoothing(spark, sf):
    days = p.span(spark, sf)
    rows = p.filled(spark, sf, days)
    return rounded(smoothing.exponential_smoothing(rows, F.array(F.lit(days[1])), p.H, season=p.SEASON))


@query(
    "m9_theta",
    f"""with t as (select *, cast(row_number() over (partition by unique_id order by date) - 1 as double) as t from filled),
      g as (select unique_id, regr_slope(y, t) as b, regr_intercept(y, t) as a0, cast(count(*) as double) as n
            from t group by 1),
      c as (select t.unique_id, list(2 * y - (a0 + b * t) order by t) as ys, any_value(a0) as a0, any_value(b) as b,
                   any_value(n) as n from t join g on t.unique_id = g.unique_id group by 1),
      r as (select *, list_reduce(ys, lambda s, x: 0.5 * x + 0.5 * s) as level from c)
      select unique_id, cast({_LAST} + fh as date) as date, {_LAST} as cutoff, 'Theta' as Model,
             round(0.5 * (a0 + b * (n - 1 + fh)) + 0.5 * level, 6) as y, fh from r, steps""",
)
def m9_theta(spark, sf):
    days = p.span(spark, sf)
    return rounded(smoothing.theta(p.filled(spark, sf, days), F.array(F.lit(days[1])), p.H, 0.5))


@query(
    "m11_fallback",
    """with s as (select unique_id, date, cutoff, Model, fh, cv, case when fh > 3 then null else y end as y
                 from fc where Model = 'SeasonalNaive')
       select s.unique_id, s.date, s.cutoff, s.Model, s.fh, s.cv, coalesce(s.y, n.y) as y from s
       join fc n on n.Model = 'Naive' and s.unique_id = n.unique_id and s.date = n.date and s.cutoff = n.cutoff""",
)
def m11_fallback(spark, sf):
    rows = p.backtest(spark, sf, (models.NAIVE, models.SEASONAL_NAIVE))
    failed = rows.where(F.col("Model") == models.SEASONAL_NAIVE).withColumn(
        "y", F.when(F.col("fh") <= 3, F.col("y"))
    )
    return models.with_fallback(failed, rows.where(F.col("Model") == models.NAIVE))


@query(
    "m16_backtest",
    """with n as (select *, row_number() over (partition by unique_id order by date) as pos from filled),
       x as (select n.*, cutoff, cv from n join cuts on date <= cutoff where y > 0),
       d as (select *, row_number() over w as k, count(*) over (partition by unique_id, cutoff) as total,
                    pos - coalesce(lag(pos) over w, 0) as gap
             from x window w as (partition by unique_id, cutoff order by date)),
       r as (select unique_id, cutoff, cv, sum(pow(0.9, total - k) * case when k = 1 then 1 else 0.1 end * y)
                  / sum(pow(0.9, total - k) * case when k = 1 then 1 else 0.1 end * gap) as rate from d group by all),
       a as (select unique_id, date, cutoff, Model, y, fh, cv from fc
             union all
             select unique_id, cast(cutoff + fh as date), cutoff, 'WindowAverage', avg(y), fh, cv
             from cuts, steps, filled where date > cutoff - 7 and date <= cutoff group by unique_id, cutoff, fh, cv
             union all
             select unique_id, cast(cutoff + fh as date), cutoff, 'CrostonClassic', rate, fh, cv from r, steps)
       select a.unique_id, a.date, cutoff, Model, round(a.y, 6) as y, fh, cv, filled.y as "True"
       from a join filled on a.unique_id = filled.unique_id and a.date = filled.date""",
)
def m16_backtest(spark, sf):
    from shelfcast.operators.backtest import rolling_origin

    days = p.span(spark, sf)
    found = rolling_origin(
        p.filled(spark, sf, days),
        p.H,
        p.WINDOWS,
        models=(*models.WINDOW_MODELS, "CrostonClassic"),
        season=p.SEASON,
        window=7,
        seasonal_window=p.SEASONAL_WINDOW,
        last=days[1],
    )
    return rounded(found)


@query(
    "m17_upper_intervals",
    """with x as (select *, "True" - y as e from ev where Model = 'SeasonalWindowAverage'),
       q as (select unique_id, fh, coalesce(quantile_cont(e, 0.8) filter (where e <> 0), 0) as a,
                    coalesce(quantile_cont(e, 0.95) filter (where e <> 0), 0) as b from x group by 1, 2)
       select pf.unique_id, pf.date, pf.Model, round(y, 6) as y, pf.fh, cast(null as int) as cv,
              round(case when y + a > 0 then y + a else 0 end, 6) as up_80,
              round(case when y + b > 0 then y + b else 0 end, 6) as up_95
       from pf join q on pf.unique_id = q.unique_id and pf.fh = q.fh where Model = 'SeasonalWindowAverage'""",
)
def m17_upper_intervals(spark, sf):
    days = p.span(spark, sf)
    chosen = (models.SEASONAL_WINDOW_AVERAGE,)
    quantiles = intervals.error_quantiles(
        p.evaluated(spark, sf, chosen, days), [80, 95], error_type="normal"
    )
    rows = p.forecast(spark, sf, days=days).where(F.col("Model") == models.SEASONAL_WINDOW_AVERAGE)
    return rounded(intervals.upper_intervals(rows, quantiles, [80, 95]))


def _spread_sql(select: str) -> str:
    """Spread of one-step and one-season errors up to the cutoff, and the forecasts made there."""
    return f"""
      with fm as materialized (select * from filled),
      b as materialized (select max(date) - 7 as cutoff from f1),
      r as (select unique_id, y - lag(y, 1) over w as e1, y - lag(y, 7) over w as e7 from fm
            where date <= (select cutoff from b) window w as (partition by unique_id order by date)),
      s as materialized (select unique_id, sqrt(avg(e1 * e1)) as s1, sqrt(avg(e7 * e7)) as s7 from r group by 1),
      made as (select unique_id, cast(cutoff + fh as date) as date, 'Naive' as Model, y, fh from fm join b on date = cutoff, steps
             union all
             select unique_id, cast(date + 7 as date), 'SeasonalNaive', y, cast(date - (cutoff - 7) as int)
             from fm join b on date > cutoff - 7 and date <= cutoff)
      {select}"""


@query(
    "m18_normal_intervals",
    _spread_sql(
        f"""select made.unique_id, date, fh, cast(null as int) as cv, y as "Naive",
              round(y - s1 * sqrt(fh) * {Z80}, 6) as "Naive-lo-80", round(y + s1 * sqrt(fh) * {Z80}, 6) as "Naive-hi-80",
              round(y - s1 * sqrt(fh) * {Z95}, 6) as "Naive-lo-95", round(y + s1 * sqrt(fh) * {Z95}, 6) as "Naive-hi-95"
            from made join s on made.unique_id = s.unique_id where Model = 'Naive'"""
    ),
)
def m18_normal_intervals(spark, sf):
    return rounded(_normal(spark, sf, models.NAIVE))


def _normal(spark, sf, model, levels=(0.8, 0.95)):
    days = p.span(spark, sf)
    history = p.filled(spark, sf, days).where(F.col("date") <= F.date_sub(F.lit(days[1]), p.H))
    return intervals.normal_intervals(
        p.forecast(spark, sf, days=days), history, model, levels, season=p.SEASON
    )


@query(
    "g12_melt_intervals",
    _spread_sql(
        f"""select made.unique_id, date, Model, y,
              round(greatest(0, y - s7 * {Z80}), 6) as up_20, round(greatest(0, y + s7 * {Z80}), 6) as up_80,
              round(greatest(0, y - s7 * {Z95}), 6) as up_5, round(greatest(0, y + s7 * {Z95}), 6) as up_95
            from made join s on made.unique_id = s.unique_id where Model = 'SeasonalNaive'"""
    ),
)
def g12_melt_intervals(spark, sf):
    wide = _normal(spark, sf, models.SEASONAL_NAIVE).drop("fh", "cv")
    found = intervals.melt_intervals(
        wide, [models.SEASONAL_NAIVE], [80, 95], invert=True, non_negative=True
    )
    return rounded(found)


@query(
    "g13_extract_intervals",
    _spread_sql(
        f"""select made.unique_id, date, Model as model, y,
              round(y - s1 * sqrt(fh) * {Z80}, 6) as "Lower-80", round(y + s1 * sqrt(fh) * {Z80}, 6) as "Upper-80",
              round(y - s1 * sqrt(fh) * {Z95}, 6) as "Lower-95", round(y + s1 * sqrt(fh) * {Z95}, 6) as "Upper-95"
            from made join s on made.unique_id = s.unique_id where Model = 'Naive'"""
    ),
)
def g13_extract_intervals(spark, sf):
    wide = _normal(spark, sf, models.NAIVE).drop("fh", "cv")
    return rounded(intervals.extract_intervals(wide, [models.NAIVE], [80, 95]))


@query(
    "m19_residuals",
    """with r as (select unique_id, date, lag(date) over w as cutoff, y as y_true, lag(y, 7) over w as y_pred
                 from filled window w as (partition by unique_id order by date))
       select unique_id, date, cutoff, y_true, y_pred, 'SeasonalNaive' as Model, y_true - y_pred as residual,
              1 as fh, cast(row_number() over (partition by unique_id order by date) as int) as cv
       from r where y_pred is not null""",
)
def m19_residuals(spark, sf):
    return models.one_step_residuals(p.filled(spark, sf), models.SEASONAL_NAIVE, season=p.SEASON)


@query(
    "m19_ses_residuals",
    """with recursive n as (select unique_id, date, y, row_number() over (partition by unique_id order by date) as i from filled),
       l as (select unique_id, date, cast(null as date) as cutoff, y, cast(null as double) as y_pred, y as level, i from n where i = 1
             union all
             select n.unique_id, n.date, l.date, n.y, l.level, 0.3 * n.y + 0.7 * l.level, n.i
             from l join n on n.unique_id = l.unique_id and n.i = l.i + 1)
       select unique_id, date, cutoff, y as y_true, round(y_pred, 6) as y_pred, 'SES' as Model,
              round(y - y_pred, 6) as residual, 1 as fh, cast(i - 1 as int) as cv from l where i > 1""",
)
def m19_ses_residuals(spark, sf):
    days = p.span(spark, sf)
    n_blocks = (days[1] - days[0]).days // smoothing.BLOCK + 2
    return rounded(smoothing.ses_residuals(p.filled(spark, sf, days), 0.3, n_blocks))


@query(
    "m24_candidate_grid",
    """with cand as (select 'WindowAverage' as family, cast(w as int) as size from range(7, 29, 7) t(w)
                    union all select 'SeasonalWindowAverage', cast(w as int) from range(2, 7, 2) t(w)),
       pr as (select family, size, unique_id, cutoff, cv, fh, avg(y) as y from cand, cuts, steps, filled
              where family = 'WindowAverage' and date > cutoff - size and date <= cutoff group by all
              union all
              select family, size, unique_id, cutoff, cv, fh, avg(y) from cand, cuts, steps, range(1, 7) t(j), filled
              where family = 'SeasonalWindowAverage' and j <= size
                and date = cutoff - cast(7 * j as int) + (fh - 1) % 7 + 1 group by all),
       s as (select family, size, pr.unique_id, cv, sqrt(avg((pr.y - f.y) * (pr.y - f.y)) / any_value(naive_mse)) as rmsse,
                    avg(abs(pr.y - f.y)) as mae, avg(pr.y - f.y) as bias
             from pr join filled f on f.unique_id = pr.unique_id and f.date = cutoff + fh
             join scale on scale.unique_id = pr.unique_id group by all)
       select family, size, round(avg(rmsse), 6) as rmsse, round(avg(mae), 6) as mae, round(avg(bias), 6) as bias
       from s group by 1, 2""",
)
def m24_candidate_grid(spark, sf):
    from shelfcast.plans.study import score_candidates

    days = p.span(spark, sf)
    found = score_candidates(
        p.filled(spark, sf, days),
        p.scale(spark, sf, days),
        h=p.H,
        windows=p.WINDOWS,
        season=p.SEASON,
        window_sizes=(7, 14, 21, 28),
        seasonal_sizes=(2, 4, 6),
        last=days[1],
    )
    return rounded(found)


def _candidates_sql(space: SearchSpace) -> str:
    """The candidate table of a search space."""
    parts = []
    for family, r in space.ranges:
        count = int(round((r.high - r.low) / r.step)) + 1
        kept = f"qualify row_number() over (order by md5('{space.seed}:{family}:' || k)) <= {r.sample}" if r.sample else ""
        parts.append(
            f"""(select '{family}' as family, cast(k as int) as number,
                  round({float(r.low)}::double + k * {float(r.step)}::double, 10) as parameter from range({count}) t(k) {kept})"""
        )
    return " union all ".join(parts)


@query("m24_candidate_table", _candidates_sql(SearchSpace()))
def m24_candidate_table(spark, sf):
    from shelfcast.plans.study import candidate_table

    return candidate_table(spark, SearchSpace())


@query(
    "m24_candidate_search",
    f"""with cand as ({_candidates_sql(SearchSpace())}),
       n as (select *, row_number() over (partition by unique_id order by date) as pos from filled),
       x as (select n.*, cutoff from n join cuts on date <= cutoff),
       lists as (select unique_id, cutoff, list(y order by date) as ys, regr_slope(y, pos - 1) as b,
                        regr_intercept(y, pos - 1) as a0, count(*) as n from x group by 1, 2),
       curved as (select *, list_transform(ys, lambda v, i: 2 * v - (a0 + b * (i - 1))) as cs from lists),
       d as (select *, row_number() over w as k, count(*) over (partition by unique_id, cutoff) as total,
                    pos - coalesce(lag(pos) over w, 0) as gap
             from x where y > 0 window w as (partition by unique_id, cutoff order by date)),
       rates as (select family, number, parameter as a, unique_id, cutoff,
                   sum(pow(1 - parameter, total - k) * case when k = 1 then 1 else parameter end * y)
                   / sum(pow(1 - parameter, total - k) * case when k = 1 then 1 else parameter end * gap) as y
             from cand, d where family in ('Croston', 'SBA') group by all),
       pr as (select family, number, parameter, unique_id, cutoff, fh, avg(y) as y from cand, cuts, steps, filled
              where family = 'WindowAverage' and date > cutoff - cast(parameter as int) and date <= cutoff group by all
              union all
              select family, number, parameter, unique_id, cutoff, fh, avg(y) from cand, cuts, steps, range(1, 9) t(j), filled
              where family = 'SeasonalWindowAverage' and j <= parameter and date = cutoff - cast(7 * j as int) + fh group by all
              union all
              select family, number, parameter, unique_id, cutoff, fh, list_reduce(ys, lambda s, v: parameter * v + (1 - parameter) * s)
              from cand, curved, steps where family = 'SES'
              union all
              select family, number, parameter, unique_id, cutoff, fh,
                     0.5 * (a0 + b * (n - 1 + fh)) + 0.5 * list_reduce(cs, lambda s, v: parameter * v + (1 - parameter) * s)
              from cand, curved, steps where family = 'Theta'
              union all
              select family, number, a, unique_id, cutoff, fh, case when family = 'SBA' then 0.95 * y else y end from rates, steps),
       s as (select family, number, parameter, pr.unique_id, cutoff,
                    sqrt(avg((pr.y - f.y) * (pr.y - f.y)) / any_value(naive_mse)) as rmsse,
                    avg(abs(pr.y - f.y)) as mae, avg(pr.y - f.y) as bias
             from pr join filled f on f.unique_id = pr.unique_id and f.date = cutoff + fh
             join scale on scale.unique_id = pr.unique_id group by all)
       select family, number, parameter, round(avg(rmsse), 6) as rmsse, round(avg(mae), 6) as mae, round(avg(bias), 6) as bias
       from s group by 1, 2, 3""",
)
def m24_candidate_search(spark, sf):
    from shelfcast.plans.study import search

    days = p.span(spark, sf)
    found = search(
        p.filled(spark, sf, days),
        p.scale(spark, sf, days),
        SearchSpace(),
        h=p.H,
        windows=p.WINDOWS,
        season=p.SEASON,
        last=days[1],
    )
    return rounded(found)


@query(
    "l3_ranked_candidates",
    """with m as (select Model, round(avg(rmsse), 6) as rmsse from sc group by 1)
       select Model, rmsse, cast(row_number() over (order by rmsse, Model) as bigint) as place from m""",
)
def l3_ranked_candidates(spark, sf):
    from shelfcast.operators.ranking import with_rank
    from shelfcast.operators.scoring import leaderboard

    board = rounded(leaderboard(p.scores(spark, sf)).select("Model", "rmsse"))
    return with_rank(board, [F.col("rmsse"), F.col("Model")], "place")
