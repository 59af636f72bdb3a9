"""Tables behind the report pages and the data exploration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.operators.panel import DATE, ID, last_date, recent_weeks
from shelfcast.operators.histogram import value_histogram
from shelfcast.operators.quantiles import histogram_quantiles
from shelfcast.operators.ranking import with_rank

# Names of the four newest weeks.
WEEK_NAMES = ("Current Week", "Last Week", "Two Weeks Ago", "Three Weeks Ago")


def scores_over_time(scores: DataFrame) -> DataFrame:
    return scores.groupBy(DATE, "Model").agg(
        F.avg("mae").alias("mae"), F.avg(F.abs("bias")).alias("abs_bias")
    )


def item_map(scores: DataFrame, metric: str = "mae", overall: bool = True) -> DataFrame:
    """Items by descending metric on a near-square grid.

    Overall the metric is averaged over all models and dates, otherwise the
    rows of the newest date are placed.
    """
    if overall:
        items = scores.groupBy(ID).agg(F.avg(metric).alias(metric))
        order = [F.col(metric).desc_nulls_last(), F.col(ID)]
    else:
        items = scores.where(F.col(DATE) == last_date(scores)).select(ID, "Model", metric)
        order = [F.col(metric).desc_nulls_last(), F.col(ID), F.col("Model")]
    width = F.ceil(F.sqrt(F.col("_items"))).cast("bigint")
    ranked = with_rank(items, order, "place")
    total = ranked.agg(F.count("*")).scalar()
    place = F.col("place") - 1
    return (
        ranked.withColumn("_items", total)
        .withColumn("grid_row", F.floor(place / width).cast("int"))
        .withColumn("grid_col", (place % width).cast("int"))
        .drop("_items")
    )


def weekday_totals(df: DataFrame, weeks: int = 4) -> DataFrame:
    """Sales per day name for the newest weeks, by distance between week starts."""
    newest = F.date_trunc("week", last_date(df)).cast("date")
    start = F.date_trunc("week", F.col(DATE)).cast("date")
    relative = (F.datediff(newest, start) / 7).cast("int") + 1
    grouped = (
        recent_weeks(df, weeks)
        .groupBy(relative.alias("Week"), F.date_format(DATE, "EEEE").alias("day_name"))
        .agg(F.sum("y").alias("y"))
    )
    names = F.array(*[F.lit(n) for n in WEEK_NAMES])
    older = F.concat((F.col("Week") - 1).cast("string"), F.lit(" weeks ago"))
    return grouped.withColumn("Week", F.coalesce(F.get(names, F.col("Week") - 1), older))


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(DATE).agg(F.sum("y").alias("y"))


def hierarchy_totals(df: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Totals per date for several key sets in one pass."""
    columns = list(dict.fromkeys(c for level in levels for c in level))
    spark_sets = [[F.col(c) for c in [*level, DATE]] for level in levels]
    return df.groupingSets(spark_sets, *columns, DATE).agg(
        F.sum("y").alias("y"), F.grouping_id().alias("level_id")
    )


def distinct_items(df: DataFrame, by: str, item: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(item) if approximate else F.count_distinct(item)
    return df.groupBy(by).agg(count.alias("items"))


def top_store(df: DataFrame, store: str = "store_id") -> DataFrame:
    """The store with the largest total over all days."""
    totals = df.groupBy(store).agg(F.sum("y").alias("y"))
    return totals.orderBy(F.col("y").desc(), store).limit(1)


def seasonal_boxes(df: DataFrame) -> DataFrame:
    """Quartiles and whiskers of non-zero sales per weekday and season.

    The 28 groups hold the whole table. Its values are counted once; quartiles
    and whiskers are both read from the counts.
    """
    rows = df.where(F.col("y") > 0).select(
        F.weekday(DATE).alias("dayofweek"), dates.season_of(F.col(DATE)).alias("season"), "y"
    )
    keys = ["dayofweek", "season"]
    counts = value_histogram(rows, keys, "y")
    quartiles = histogram_quantiles(counts, keys, "y", [0.25, 0.5, 0.75], bins=256).select(
        *keys,
        *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))],
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("y").between(F.col("q1") - reach, F.col("q3") + reach)
    whiskers = (
        counts.join(F.broadcast(quartiles), keys)  # at most 28 rows
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, F.col("y"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("y"))).alias("whisker_high"),
        )
    )
    return quartiles.join(F.broadcast(whiskers), keys)


def calendar_heat(df: DataFrame, key: str = "store_id") -> DataFrame:
    """Mean standardised sales per year, weekday and month, months as columns.

    Each series is standardised within its year (population deviation, 1 when
    constant); such a window holds at most 366 rows.
    """
    window = Window.partitionBy(key, "year")
    deviation = F.stddev_pop("y").over(window)
    z = (F.col("y") - F.avg("y").over(window)) / F.when(deviation == 0, 1.0).otherwise(deviation)
    return (
        df.withColumn("year", F.year(DATE))
        .withColumn("_z", z)
        .groupBy("year", F.weekday(DATE).alias("dayofweek"))
        .agg(*[F.avg(F.when(F.month(DATE) == m, F.col("_z"))).alias(f"m{m}") for m in range(1, 13)])
    )


def moving_averages(df: DataFrame, key: str, windows: Sequence[int] = (7, 30, 90)) -> DataFrame:
    """Trailing means over full windows of the daily totals of a group."""
    totals = df.groupBy(key, DATE).agg(F.sum("y").alias("y"))
    order = Window.partitionBy(key).orderBy(DATE)
    position = F.row_number().over(order)

    def trailing(size: int) -> Column:
        mean = F.avg("y").over(order.rowsBetween(-(size - 1), 0))
        return F.when(position >= size, mean)

    return totals.withColumns({f"ma_{size}": trailing(size) for size in windows})


def worst_items(
    scores: DataFrame, focus: str, benchmark: str, metric: str = "mae", limit: int = 40
) -> DataFrame:
    """The worst items of the focus model on the newest date, with the benchmark next to them."""
    newest = scores.where(F.col(DATE) == last_date(scores))
    top = (
        newest.where(F.col("Model") == focus)
        .orderBy(F.col(metric).desc_nulls_last(), ID, "cv")
        .limit(limit)
        .select(ID, "cv", F.col(metric).alias("focus"))
    )
    other = newest.where(F.col("Model") == benchmark).select(
        ID, "cv", F.col(metric).alias("benchmark")
    )
    # The `limit` listed items are broadcast to thin out the benchmark before the outer join.
    listed = F.broadcast(top.select(ID, "cv"))
    other = other.join(listed, [ID, "cv"], "left_semi")
    return top.join(other, [ID, "cv"], "left").orderBy("focus", ID, "cv")


def confirmed_errors(scores: DataFrame, name: str, limit: int = 40) -> DataFrame:
    """Items with the largest errors of the confirmed orders, above 0.5 in red."""
    return (
        scores.where(F.col("Model") == name)
        .orderBy(F.col("mae").desc_nulls_last(), ID, "cv")
        .limit(limit)
        .withColumn("flag", F.when(F.col("mae") > 0.5, "red").otherwise("green"))
    )
