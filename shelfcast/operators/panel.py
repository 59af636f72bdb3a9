"""Calendar construction, reshaping, filtering and splitting of series tables.

The core table is long: unique_id, date, y and covariates. All fills work on
one window per series: each row is expanded up to the day before the next one,
so a filled panel costs a single exchange on the series key, and everything
after it that is keyed by the series reuses that exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.operators.histogram import modes, value_histogram, value_histograms

ID = "unique_id"
DATE = "date"
# Partitions that a panel of many series has at least.
SPREAD = 200


def calendar_span(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """One row with the first and last date."""
    return df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def date_span(df: DataFrame, date_col: str = DATE) -> tuple[date, date]:
    """First and last date, fetched as one row.

    As literals they reach the scans as pushed filters and keep plans small,
    which subqueries repeated in every window expression would not.
    """
    row = calendar_span(df, date_col).first()
    return row["first_date"], row["last_date"]


def last_date(df: DataFrame, date_col: str = DATE) -> Column:
    """The newest date as a scalar subquery."""
    return df.agg(F.max(date_col)).scalar()


def panel_bounds(df: DataFrame, span: tuple | None, date_col: str = DATE) -> tuple[Column, Column]:
    """First and last date as columns: literals when known, else subqueries."""
    if span is not None:
        return F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date")
    bounds = calendar_span(df, date_col)
    return bounds.select("first_date").scalar(), bounds.select("last_date").scalar()


def distinct_dates(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """One row holding the sorted distinct dates; its size is that of the calendar."""
    return df.select(date_col).distinct().agg(F.sort_array(F.collect_list(date_col)).alias("dates"))


def calendar_index(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """Distinct dates with their 0-based position."""
    return distinct_dates(df, date_col).select(F.posexplode_outer("dates").alias("position", date_col))


def spread_series(df: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Rows by series in a fixed number of partitions, for fills of many series.

    Adaptive merging judges a partition by its bytes before the fill, which then
    multiplies the rows of a task; a number that was asked for is left alone.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(SPREAD, count), *keys)


def _expand(
    df: DataFrame,
    first: Column | None,
    final: Column | None,
    unit: str,
    keys: Sequence[str],
    date_col: str,
    fill_value,
    value_col: str,
) -> DataFrame:
    # A row without a date joins no calendar day.
    df = df.where(F.col(date_col).isNotNull())
    step = F.expr(dates.PERIODS[unit][1])
    window = Window.partitionBy(*keys).orderBy(date_col)
    here = F.col(date_col)
    following = F.lead(date_col).over(window)
    until = (following - step).cast("date")
    until = F.coalesce(until, here if final is None else final)
    start = here if first is None else F.when(F.lag(date_col).over(window).isNull(), first).otherwise(here)
    extra = [c for c in df.columns if c not in {*keys, date_col, value_col}]
    spread = df.withColumn("_days", F.sequence(start, F.greatest(here, until), step)).withColumn(
        "_day", F.explode_outer("_days")
    )
    observed = F.col("_day") == here
    filled = F.lit(fill_value).cast(df.schema[value_col].dataType)
    value = F.when(observed, F.coalesce(F.col(value_col), filled)).otherwise(filled)
    return spread.select(
        *keys,
        F.col("_day").alias(date_col),
        value.alias(value_col),
        *[F.when(observed, F.col(c)).alias(c) for c in extra],
    )


def _tail(df: DataFrame, since: date, values: Sequence[str], date_col: str) -> DataFrame:
    """Rows before `since` moved to the day before it, without their values."""
    recent = F.col(date_col) >= F.lit(since)
    edge = F.lit(since - timedelta(days=1))
    emptied = {c: F.when(recent, F.col(c)) for c in values}
    return df.withColumns(emptied | {date_col: F.when(recent, F.col(date_col)).otherwise(edge)})


def observed_rows(
    df: DataFrame,
    *,
    covars: Sequence[str] = (),
    business_days: bool = False,
    keys: Sequence[str] = (ID,),
    date_col: str = DATE,
    value_col: str = "y",
) -> DataFrame:
    """The rows that `fill_calendar` keeps, before it adds any."""
    rows = df.select(*keys, date_col, value_col, *covars).distinct().where(F.col(date_col).isNotNull())
    return rows.where(F.weekday(date_col) < 5) if business_days else rows


def fill_calendar(
    df: DataFrame,
    *,
    covars: Sequence[str] = (),
    fill_value=0.0,
    business_days: bool = False,
    unit: str = "D",
    span: tuple | None = None,
    since: date | None = None,
    scope: Sequence[str] = (),
    spread: bool = False,
    keys: Sequence[str] = (ID,),
    date_col: str = DATE,
    value_col: str = "y",
) -> DataFrame:
    """Put every series on the whole calendar of the table.

    Exact duplicates collapse; rows of one series and date with different
    values all stay. Covariates keep their values on observed dates and are
    null on added ones. With `business_days` weekends are left out, together
    with rows observed there. `span` gives known (first, last) dates and saves
    the pass that looks for them. `since` builds the newest days only: older rows
    shrink to one per series before the exchange. Columns in `scope` (such as a client) get a
    calendar each. `spread` is for many series (`spread_series`).
    """
    if since is not None:
        if span is None:
            raise ValueError("since needs a known span")
        if since > span[0]:
            df = _tail(df, since, [value_col, *covars], date_col)
            span = (since - timedelta(days=1), span[1])
    # The distinct rows are then found within the partitions of the fill.
    raw = spread_series(df, keys) if spread else df
    rows = observed_rows(raw, covars=covars, keys=keys, date_col=date_col, value_col=value_col)
    if scope:
        bounds = df.groupBy(*scope).agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
        rows = rows.join(bounds, list(scope))
        first, final = F.col("_a"), F.col("_b")
    else:
        # Unknown bounds are read from the raw rows: a scan of the date column only.
        first, final = panel_bounds(df, span, date_col)
    panel = _expand(rows, first, final, unit, keys, date_col, fill_value, value_col)
    panel = panel.drop("_a", "_b")
    if since is not None:
        panel = panel.where(F.col(date_col) >= F.lit(since))
    return panel.where(F.weekday(date_col) < 5) if business_days else panel


def fill_series(
    df: DataFrame,
    *,
    fill_value=0.0,
    covariates: dict[str, tuple[DataFrame, str]] | None = None,
    fill_covars=None,
    spread: bool = False,
    keys: Sequence[str] = (ID,),
    date_col: str = DATE,
    value_col: str = "y",
) -> DataFrame:
    """Fill gaps between the first and last date of each series itself.

    `covariates` maps a column to (table, key): the column is attached again
    by that key, rows left without one are dropped, and one row per series and
    date is kept. `spread` is for many series (`spread_series`).
    """
    raw = spread_series(df, keys) if spread else df
    rows = raw.select(*keys, date_col, value_col).distinct()
    panel = _expand(rows, None, None, "D", keys, date_col, fill_value, value_col)
    for column, (table, key) in (covariates or {}).items():
        panel = panel.join(table.select(key, column).distinct(), key, "left")
        if fill_covars is not None:
            panel = panel.fillna(fill_covars, subset=[column])
    return panel.na.drop().dropDuplicates([*keys, date_col])


def reindex_daily(df: DataFrame, *, fill_value=None, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Every series on the global daily range, gaps null or `fill_value`."""
    return fill_calendar(df, fill_value=fill_value, keys=keys)


def most_frequent(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest among ties.

    Values are counted first, so a key that holds most of the rows is reduced
    on the map side and never gathered.
    """
    return modes(value_histogram(df, keys, column), keys, column, alias)


def fill_most_frequent(
    df: DataFrame,
    *,
    item_covars: Sequence[str] = (),
    item_time_covars: Sequence[str] = (),
    time_covars: Sequence[str] = (),
    date_col: str = DATE,
    observed: DataFrame | None = None,
) -> DataFrame:
    """Null covariates take the mode of their series, date or the whole table.

    All modes come from one pass over the rows: those of `df`, or of `observed`,
    its rows before a calendar fill, which adds only nulls.
    """
    wanted = [((ID,), c) for c in item_covars] + [((date_col,), c) for c in item_time_covars]
    wanted += [((), c) for c in time_covars]
    if not wanted:
        return df
    out = df
    counted = value_histograms(df if observed is None else observed, wanted)
    for (keys, column), histogram in zip(wanted, counted, strict=True):
        found = modes(histogram, keys, column, "_mode")
        if not keys:
            out = out.withColumn(column, F.coalesce(F.col(column), found.scalar()))
            continue
        if keys == (date_col,):
            found = F.broadcast(found)  # one row per calendar day
        out = out.join(found, list(keys), "left").withColumn(column, F.coalesce(column, "_mode")).drop("_mode")
    return out.select(*df.columns)


def fill_constant(df: DataFrame, value, columns: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def resample(
    df: DataFrame,
    unit: str,
    how: str = "sum",
    *,
    fill: bool = True,
    keys: Sequence[str] = (ID,),
    value_col: str = "y",
) -> DataFrame:
    """Series per week, month, quarter or year; 'sum' for flows, 'last' for stock.

    Periods are labelled by their last day. Series without any value vanish,
    empty periods become 0 when `fill` is set.
    """
    if how not in {"sum", "last"}:
        raise ValueError("how must be 'sum' or 'last'")
    known = df.where(F.col(value_col).isNotNull())
    value = F.sum(value_col) if how == "sum" else F.max_by(value_col, DATE)
    grouped = known.groupBy(*keys, dates.period_start(F.col(DATE), unit).alias(DATE)).agg(
        value.alias(value_col)
    )
    if fill:
        grouped = fill_calendar(grouped, unit=unit, keys=keys, value_col=value_col)
    return grouped.withColumn(DATE, dates.period_end(F.col(DATE), unit))


def to_wide(
    df: DataFrame,
    column_values: Sequence[str],
    *,
    keys: Sequence[str] = (ID,),
    value_col: str = "y",
    fill_value=None,
) -> DataFrame:
    """One row per series and one column per listed date, first value wins."""
    wide = (
        df.groupBy(*keys, F.col(DATE).cast("string").alias("_label"))
        .agg(F.first(value_col, ignorenulls=True).alias("_value"))
        .groupBy(*keys)
        .pivot("_label", list(column_values))
        .agg(F.first("_value"))
    )
    return wide if fill_value is None else wide.fillna(fill_value)


def to_long(
    df: DataFrame,
    *,
    keys: Sequence[str] = (ID,),
    name: str = DATE,
    value: str = "y",
    drop_zeros: bool = False,
    as_date: bool = True,
) -> DataFrame:
    """Wide table back to one row per series and column."""
    values = [c for c in df.columns if c not in keys]
    long = df.unpivot(list(keys), values, name, value)
    if as_date:
        long = long.withColumn(name, F.col(name).cast("date"))
    return long.where(F.col(value) != 0) if drop_zeros else long


def melt_day_columns(wide: DataFrame, calendar: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns d_1 … d_n to rows, dated through the (d, date) calendar."""
    days = [c for c in wide.columns if c not in keys]
    return (
        wide.unpivot(list(keys), days, "d", "y")
        .join(F.broadcast(calendar.select("d", DATE)), "d")  # one row per calendar day
        .select(*keys, DATE, "y")
    )


def drop_first_dates(
    df: DataFrame, threshold: int = 180, span: tuple | None = None, business_days: bool = False
) -> DataFrame:
    """Rows after the first `threshold` distinct dates of the table.

    On a filled panel with a known `span` the date follows from the calendar
    and reaches the scan as a literal.
    """
    if span is None:
        keep_from = distinct_dates(df).select(F.get("dates", F.lit(threshold))).scalar()
        return df.where(F.col(DATE) >= keep_from)
    days = (span[0] + timedelta(days=i) for i in range((span[1] - span[0]).days + 1))
    kept = [d for d in days if not business_days or d.weekday() < 5][threshold:]
    return df.where(F.col(DATE) >= F.lit(kept[0])) if kept else df.limit(0)


def split_last_dates(df: DataFrame, days: int = 56) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows, the latter on the last `days` distinct dates."""
    position = F.greatest(F.size("dates") - days, F.lit(0))
    start = distinct_dates(df).select(F.get("dates", position)).scalar()
    return df.where(F.col(DATE) < start), df.where(F.col(DATE) >= start)


def keep_last_days(df: DataFrame, days: int = 730, last: date | None = None) -> DataFrame:
    """Rows of the last `days` days; a known `last` date saves the pass that looks for it."""
    newest = last_date(df) if last is None else F.lit(last)
    return df.where(F.col(DATE) > F.date_sub(newest, days))


def recent_weeks(df: DataFrame, weeks: int = 4) -> DataFrame:
    """From the Monday of the newest week, `weeks` - 1 weeks earlier."""
    monday = F.date_trunc("week", last_date(df)).cast("date")
    return df.where(F.col(DATE) >= F.date_sub(monday, 7 * (weeks - 1)))


def with_min_history(df: DataFrame, minimum: int, value_col: str = "y") -> DataFrame:
    """Series with at least `minimum` non-null values (zeros count).

    A panel holds one row per series and day, so the window is as long as the
    calendar; it shares the exchange that the lag features need anyway.
    """
    known = F.count(value_col).over(Window.partitionBy(ID))
    return df.withColumn("_known", known).where(F.col("_known") >= minimum).drop("_known")


def week_batches(df: DataFrame, size: int = 7) -> DataFrame:
    """Rows tagged with `week_end`, the last date of their run of `size` distinct dates."""
    buckets = Window.partitionBy("_bucket")
    calendar = (
        calendar_index(df)
        .withColumn("_bucket", F.floor(F.col("position") / size))
        .withColumn("week_end", F.max(DATE).over(buckets))
        .select(DATE, "week_end")
    )
    return df.join(F.broadcast(calendar), DATE)  # one row per calendar day


def price_calendar(prices: DataFrame, calendar: DataFrame, week: str = "wm_yr_wk") -> DataFrame:
    """Weekly prices on every day of their week."""
    return prices.join(F.broadcast(calendar), week)  # one row per calendar day


def rename_for_library(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(DATE, "ds")


def profile(df: DataFrame, price_col: str, keys: Sequence[str]) -> DataFrame:
    """Null counts, price range, day and series counts and the date span in one pass."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    span = F.datediff(F.max(DATE), F.min(DATE)) + 1
    return df.agg(
        *nulls,
        F.min(price_col).alias("lowest_price"),
        F.max(price_col).alias("highest_price"),
        F.count_distinct(DATE).alias("total_days"),
        F.count_distinct(*keys).alias("total_series"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        F.round(span / 365, 2).alias("total_years"),
        F.round(span / 365 * 52, 2).alias("total_weeks"),
    )
