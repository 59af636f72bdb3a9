"""Models that fold over a whole series: Croston, exponential smoothing, theta.

Exponential smoothing and theta gather the history of a series once as an array,
as long as the calendar, and slice it per cutoff; the intermittent-demand models
gather its days with demand only; residual traces run over short blocks whose
starts a prefix scan finds. The folds are native `aggregate` expressions. Free
parameters come from a fixed grid tried next to each other on each row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.operators.panel import DATE, ID

# Fixed value: smoothing constant of the classic intermittent-demand method.
CROSTON_ALPHA = 0.1
# Fixed value: bias correction of the Syntetos-Boylan variant.
SBA_FACTOR = 0.95
# Constants tried by the optimised variant.
CROSTON_GRID = (0.1, 0.15, 0.2, 0.25, 0.3)


def series_arrays(df: DataFrame, cutoffs: Column) -> DataFrame:
    """One row per series and cutoff with its values in date order as `ys`."""
    gathered = df.groupBy(ID).agg(
        F.array_sort(F.collect_list(F.struct(DATE, "y"))).alias("_history")
    )
    cut = gathered.withColumn("cutoff", F.explode_outer(cutoffs))
    upto = F.filter("_history", lambda x: x[DATE] <= F.col("cutoff"))
    return cut.select(ID, "cutoff", F.transform(upto, lambda x: x["y"]).alias("ys")).where(
        F.size("ys") > 0
    )


def tail(values: Column) -> Column:
    """All but the first element."""
    return F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))


def ses_level(values: Column, alpha: Column) -> Column:
    """Last level of simple exponential smoothing started at the first value."""
    return F.aggregate(tail(values), F.get(values, F.lit(0)), lambda s, v: alpha * v + (1 - alpha) * s)


def ses_fit(values: Column, alpha: Column) -> Column:
    """Struct of the last level and the in-sample squared error."""
    start = F.struct(F.get(values, F.lit(0)).alias("level"), F.lit(0.0).alias("sse"))

    def step(state: Column, value: Column) -> Column:
        error = value - state["level"]
        return F.struct(
            (alpha * value + (1 - alpha) * state["level"]).alias("level"),
            (state["sse"] + error * error).alias("sse"),
        )

    return F.aggregate(tail(values), start, step)


def best_ses(values: Column, grid: Sequence[float]) -> Column:
    """Level at the grid constant with the least squared error, the smallest among ties."""
    fits = F.transform(
        F.array(*[F.lit(float(a)) for a in grid]),
        lambda alpha: F.struct(alpha.alias("alpha"), ses_fit(values, alpha).alias("fit")),
    )
    tried = F.transform(
        fits,
        lambda x: F.struct(
            x["fit"]["sse"].alias("sse"), x["alpha"].alias("alpha"), x["fit"]["level"].alias("level")
        ),
    )
    return F.array_min(tried)


def demand_and_intervals(df: DataFrame, cutoffs: Column, start: Column | None = None, freq: str = "D") -> DataFrame:
    """Per series and cutoff the sizes of its demands and the steps between them.

    Only days with demand are gathered, so a panel need not hold its zeros; the
    first interval counts from the day before `start`, by default the series'
    first row.
    """
    entry = F.when(F.col("y") > 0, F.struct(DATE, F.col("y").cast("double").alias("y")))
    first = F.min(DATE) if start is None else F.least(F.min(DATE), F.max(start))
    gathered = df.groupBy(ID).agg(F.array_sort(F.collect_list(entry)).alias("_sold"), first.alias("_first"))
    cut = gathered.withColumn("cutoff", F.explode_outer(cutoffs)).where(F.col("_first") <= F.col("cutoff"))
    seen = cut.withColumn("_seen", F.filter("_sold", lambda x: x[DATE] <= F.col("cutoff")))
    before = dates.day_index(F.col("_first"), freq) - 1

    def gap(x: Column, i: Column) -> Column:
        last = F.when(i == 0, before).otherwise(dates.day_index(F.get("_seen", i - 1)[DATE], freq))
        return (dates.day_index(x[DATE], freq) - last).cast("double")

    return seen.select(
        ID, "cutoff", F.transform("_seen", lambda x: x["y"]).alias("demand"), F.transform("_seen", gap).alias("intervals")
    )


def _flat(df: DataFrame, h: int, model: str, y: Column, freq: str) -> DataFrame:
    steps = df.withColumn("y", y).withColumn("fh", F.explode_outer(F.sequence(F.lit(1), F.lit(h))))
    return steps.select(
        ID,
        dates.shift_date(F.col("cutoff"), F.col("fh"), freq).alias(DATE),
        "cutoff",
        F.lit(model).alias("Model"),
        "y",
        "fh",
    )


def croston(
    df: DataFrame,
    cutoffs: Column,
    h: int,
    variant: str = "classic",
    freq: str = "D",
    start: Column | None = None,
) -> DataFrame:
    """Intermittent demand: smoothed size over smoothed interval, 0 without any demand.

    `variant` is 'classic', 'sba' (times 0.95) or 'optimized' (constants from a grid).
    Rows without demand may be there or not; `start` is the first day of the calendar.
    """
    parts = demand_and_intervals(df, cutoffs, start, freq)
    demand, intervals = F.col("demand"), F.col("intervals")
    if variant == "optimized":
        size = best_ses(demand, CROSTON_GRID)["level"]
        gap = best_ses(intervals, CROSTON_GRID)["level"]
    elif variant in {"classic", "sba"}:
        alpha = F.lit(CROSTON_ALPHA)
        size, gap = ses_level(demand, alpha), ses_level(intervals, alpha)
    else:
        raise ValueError(f"unknown variant {variant!r}")
    rate = F.when(F.size(demand) > 0, F.try_divide(size, gap)).otherwise(F.lit(0.0))
    if variant == "sba":
        rate = rate * SBA_FACTOR
    label = {"classic": "CrostonClassic", "sba": "SBA", "optimized": "CrostonOptimized"}[variant]
    return _flat(parts, h, label, rate, freq)


def ses(
    df: DataFrame, cutoffs: Column, h: int, grid: Sequence[float], freq: str = "D"
) -> DataFrame:
    """Simple exponential smoothing with the constant picked from `grid`."""
    return _flat(series_arrays(df, cutoffs), h, "SES", best_ses(F.col("ys"), grid)["level"], freq)


def with_trend(arrays: DataFrame) -> DataFrame:
    """Least-squares line through the values of `ys`: `_base` at the first one, `_slope` per step."""
    sums = F.aggregate(
        F.transform("ys", lambda v, i: F.struct(v.alias("v"), i.cast("double").alias("t"))),
        F.struct(F.lit(0.0).alias("y"), F.lit(0.0).alias("ty")),
        lambda s, x: F.struct((s["y"] + x["v"]).alias("y"), (s["ty"] + x["t"] * x["v"]).alias("ty")),
    )
    return (
        arrays.withColumn("_n", F.size("ys").cast("double"))
        .withColumn("_s", sums)
        .withColumn("_tbar", (F.col("_n") - 1) / 2)
        .withColumn("_sxx", F.col("_n") * (F.col("_n") * F.col("_n") - 1) / 12)
        .withColumn(
            "_slope",
            F.coalesce(
                F.try_divide(F.col("_s.ty") - F.col("_tbar") * F.col("_s.y"), F.col("_sxx")),
                F.lit(0.0),
            ),
        )
        .withColumn("_base", F.col("_s.y") / F.col("_n") - F.col("_slope") * F.col("_tbar"))
    )


def theta(
    df: DataFrame, cutoffs: Column, h: int, alpha: float = 0.5, freq: str = "D"
) -> DataFrame:
    """Mean of the trend line and the smoothed line of doubled curvature."""
    fitted = with_trend(series_arrays(df, cutoffs))
    line = lambda t: F.col("_base") + F.col("_slope") * t
    curved = F.transform("ys", lambda v, i: 2.0 * v - line(i.cast("double")))
    level = fitted.withColumn("_curved", curved).withColumn(
        "_level", ses_level(F.col("_curved"), F.lit(alpha))
    )
    steps = level.withColumn("fh", F.explode_outer(F.sequence(F.lit(1), F.lit(h))))
    ahead = F.col("_n") - 1 + F.col("fh")
    return steps.select(
        ID,
        dates.shift_date(F.col("cutoff"), F.col("fh"), freq).alias(DATE),
        "cutoff",
        F.lit("Theta").alias("Model"),
        (0.5 * line(ahead) + 0.5 * F.col("_level")).alias("y"),
        "fh",
    )


def _holt_winters_fit(season: int) -> Column:
    """Fold of additive level, trend and season; parameters of the row in `_p`."""
    a, b, g = F.col("_p.alpha"), F.col("_p.beta"), F.col("_p.gamma")
    has_season = F.col("_p.seasonal")
    first = F.slice("ys", 1, season)
    mean = F.aggregate(first, F.lit(0.0), lambda s, v: s + v) / season
    zeros = F.array_repeat(F.lit(0.0), season)
    start = F.struct(
        F.when(has_season, mean).otherwise(F.get("ys", F.lit(0))).alias("level"),
        F.lit(0.0).alias("trend"),
        F.when(has_season, F.transform(first, lambda v: v - mean)).otherwise(zeros).alias("cycle"),
        F.lit(0.0).alias("sse"),
    )

    def step(s: Column, value: Column) -> Column:
        old = F.get(s["cycle"], F.lit(0))
        error = value - (s["level"] + s["trend"] + old)
        level = s["level"] + s["trend"] + a * error
        trend = s["trend"] + a * b * error
        new = old + g * error
        return F.struct(
            level.alias("level"),
            trend.alias("trend"),
            F.concat(F.slice(s["cycle"], 2, season - 1), F.array(new)).alias("cycle"),
            (s["sse"] + error * error).alias("sse"),
        )

    rest = F.slice("ys", F.when(has_season, season + 1).otherwise(2), F.size("ys"))
    return F.aggregate(rest, start, step)


def exponential_smoothing(
    df: DataFrame,
    cutoffs: Column,
    h: int,
    *,
    season: int = 7,
    alphas: Sequence[float] = (0.1, 0.3, 0.5),
    betas: Sequence[float] = (0.0, 0.1),
    gammas: Sequence[float] = (0.1, 0.3),
    freq: str = "D",
) -> DataFrame:
    """Level, trend and seasonal forms tried on a grid, the best by AIC per series."""
    level_only = [(a, 0.0, 0.0, False, 2) for a in alphas]
    trended = [(a, b, 0.0, False, 4) for a in alphas for b in betas if b > 0]
    seasonal = [(a, b, g, True, 3 + season + (2 if b > 0 else 0)) for a in alphas for b in betas for g in gammas]
    grid = F.array(
        *[
            F.struct(
                F.lit(float(a)).alias("alpha"),
                F.lit(float(b)).alias("beta"),
                F.lit(float(g)).alias("gamma"),
                F.lit(s).alias("seasonal"),
                F.lit(k).alias("size"),
            )
            for a, b, g, s, k in [*level_only, *trended, *seasonal]
        ]
    )
    tried = (
        series_arrays(df, cutoffs)
        .withColumn("_p", F.explode_outer(grid))
        .where(~F.col("_p.seasonal") | (F.size("ys") >= 2 * season))
        .withColumn("_fit", _holt_winters_fit(season))
    )
    n = F.greatest(F.size("ys") - F.when(F.col("_p.seasonal"), season).otherwise(1), F.lit(1))
    # A perfect fit has no error; the floor keeps its logarithm finite.
    aic = n * F.log(F.greatest(F.col("_fit.sse") / n, F.lit(1e-12))) + 2 * F.col("_p.size")
    best = (
        tried.withColumn("_aic", aic)
        .groupBy(ID, "cutoff")
        .agg(F.min_by(F.col("_fit"), F.struct("_aic", "_p")).alias("_fit"))
    )
    steps = best.withColumn("fh", F.explode_outer(F.sequence(F.lit(1), F.lit(h))))
    ahead = (
        F.col("_fit.level")
        + F.col("fh") * F.col("_fit.trend")
        + F.get(F.col("_fit.cycle"), (F.col("fh") - 1) % season)
    )
    return steps.select(
        ID,
        dates.shift_date(F.col("cutoff"), F.col("fh"), freq).alias(DATE),
        "cutoff",
        F.lit("ETS").alias("Model"),
        ahead.alias("y"),
        "fh",
    )


#: Days of one block of a series; a block is one row and one fold.
BLOCK = 64


def _blocks(df: DataFrame, block: int) -> DataFrame:
    """Rows of a series gathered by stretches of the calendar, each a short array in date order."""
    number = F.floor(dates.day_index(F.col(DATE)) / block)
    return df.groupBy(ID, number.alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct(DATE, F.col("y").cast("double").alias("y")))).alias("_rows")
    )


def with_block_starts(df: DataFrame, alpha: Column, n_blocks: int, block: int = BLOCK) -> DataFrame:
    """Per block of a series its rows and the level, date and row number before them.

    A row maps the level l to (1 - alpha) * l + alpha * y, and maps compose to
    maps, so a block is one pair (a, b). Pairs are composed over 1, 2, 4, ...
    blocks back, which gives every block's start in as many steps as the number
    of blocks has binary digits; no series is gathered and no step is longer
    than a block. `n_blocks` bounds the blocks of a series.
    """
    order = Window.partitionBy(ID).orderBy("_block")
    size = F.size("_rows")
    shift = F.aggregate("_rows", F.lit(0.0), lambda s, x: alpha * x["y"] + (1 - alpha) * s)
    rows = _blocks(df, block).withColumns({"_a": F.pow(1 - alpha, size), "_b": shift, "_n": size.cast("bigint")})
    step = 1
    while step < n_blocks:
        a, b, n = (F.lag(c, step).over(order) for c in ("_a", "_b", "_n"))
        rows = rows.withColumns(
            {
                "_b": F.col("_a") * F.coalesce(b, F.lit(0.0)) + F.col("_b"),
                "_a": F.col("_a") * F.coalesce(a, F.lit(1.0)),
                "_n": F.col("_n") + F.coalesce(n, F.lit(0)),
            }
        )
        step *= 2
    first = F.first(F.get("_rows", F.lit(0))["y"]).over(order)
    before = F.lag(F.struct("_a", "_b", "_n", F.get("_rows", size - 1)[DATE].alias("last"))).over(order)
    # The first row itself is the first level, which its own map leaves as it is.
    return rows.withColumns({"_first": first, "_before": before}).select(
        ID,
        "_block",
        "_rows",
        F.coalesce(F.col("_before._a") * F.col("_first") + F.col("_before._b"), F.col("_first")).alias("_level"),
        F.col("_before.last").alias("_last"),
        F.coalesce(F.col("_before._n"), F.lit(0)).alias("_done"),
    )


def block_count(df: DataFrame, block: int = BLOCK) -> int:
    """Stretches of the calendar from the first to the last date of the panel."""
    day = dates.day_index(F.col(DATE))
    found = df.agg(F.min(F.floor(day / block)).alias("lo"), F.max(F.floor(day / block)).alias("hi")).first()
    return 1 if found["lo"] is None else found["hi"] - found["lo"] + 1


def ses_residuals(df: DataFrame, alpha: float, n_blocks: int | None = None, block: int = BLOCK) -> DataFrame:
    """One-step errors of simple exponential smoothing with a fixed constant.

    `cv` numbers the forecasts of a series in date order. `n_blocks` bounds the
    stretches of the calendar; without it they are counted first.
    """
    a = F.lit(float(alpha))
    started = with_block_starts(df, a, block_count(df, block) if n_blocks is None else n_blocks, block)
    kind = "struct<level:double,last:date,trace:array<struct<date:date,cutoff:date,y_true:double,y_pred:double>>>"
    empty = F.array().cast("array<struct<date:date,cutoff:date,y_true:double,y_pred:double>>")
    start = F.struct(F.col("_level").alias("level"), F.col("_last").alias("last"), empty.alias("trace")).cast(kind)

    def step(s: Column, x: Column) -> Column:
        row = F.struct(x[DATE].alias("date"), s["last"].alias("cutoff"), x["y"].alias("y_true"), s["level"].alias("y_pred"))
        return F.struct(
            (a * x["y"] + (1 - a) * s["level"]).alias("level"),
            x[DATE].alias("last"),
            F.concat(s["trace"], F.array(row)).alias("trace"),
        )

    traced = started.select(ID, "_done", F.posexplode_outer(F.aggregate("_rows", start, step)["trace"]).alias("_i", "_row"))
    rows = traced.select(ID, "_row.*", (F.col("_done") + F.col("_i")).cast("int").alias("cv"))
    return rows.where(F.col("cutoff").isNotNull()).select(
        ID,
        DATE,
        "cutoff",
        "y_true",
        "y_pred",
        F.lit("SES").alias("Model"),
        (F.col("y_true") - F.col("y_pred")).alias("residual"),
        F.lit(1).alias("fh"),
        "cv",
    )
