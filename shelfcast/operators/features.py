"""Model inputs: lags, rolling statistics, scaling, calendar parts, category codes.

Every window here is partitioned by the series and ordered by date, so one
exchange and one sort serve all of them. A series is as long as the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import LagTransform
from shelfcast.functions import dates
from shelfcast.functions.rules import joined_key, without_trailing_letter
from shelfcast.operators.panel import DATE, ID
from shelfcast.operators.ranking import with_rank


def series_window():
    return Window.partitionBy(ID).orderBy(DATE)


def add_lags(df: DataFrame, lags: Sequence[int], drop_missing: bool = True) -> DataFrame:
    """lag1 … lagL per series; rows without a full set are dropped."""
    window = series_window()
    names = [f"lag{i}" for i in lags]
    out = df.withColumns({name: F.lag("y", i).over(window) for name, i in zip(names, lags)})
    return out.na.drop(subset=names) if drop_missing else out


def rolling_column(transform: LagTransform) -> Column:
    """A rolling statistic over full windows only."""
    window = series_window()
    lag, size, season = transform.lag, transform.window, transform.season
    if season > 1:
        values = F.array(*[F.lag("y", lag + season * j).over(window) for j in range(size)])
        return when_full(values, size, transform.kind)
    frame = window.rowsBetween(-(lag + size - 1), -lag)
    aggregate = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}[transform.kind]
    return F.when(F.count("y").over(frame) == size, aggregate("y").over(frame))


def when_full(values: Column, size: int, kind: str) -> Column:
    """The statistic of an array of `size` values, null when any is missing."""
    full = F.forall(values, lambda v: v.isNotNull()) & (F.size(values) == size)
    return F.when(full, array_statistic(values, size, kind))


def array_statistic(values: Column, size: int, kind: str) -> Column:
    if kind == "max":
        return F.array_max(values)
    if kind == "min":
        return F.array_min(values)
    mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / size
    if kind == "mean":
        return mean
    # Two passes, since squaring raw values first loses digits.
    centred = F.aggregate(
        F.transform(values, lambda v: v - mean), F.lit(0.0), lambda s, v: s + v * v
    )
    return F.sqrt(centred / (size - 1))


def add_rolling(df: DataFrame, transforms: Sequence[LagTransform]) -> DataFrame:
    return df.withColumns({t.name: rolling_column(t) for t in transforms})


def add_calendar(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: dates.calendar_part(F.col(DATE), name) for name in names})


def scale_stats(df: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Mean and population deviation per series; a constant series gets deviation 1."""
    deviation = F.stddev_pop("y")
    return df.groupBy(*keys).agg(
        F.avg("y").alias("y_mean"),
        F.when(deviation == 0, 1.0).otherwise(deviation).alias("y_std"),
    )


def scale(df: DataFrame, stats: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    return (
        df.join(stats, list(keys))
        .withColumn("y", (F.col("y") - F.col("y_mean")) / F.col("y_std"))
        .drop("y_mean", "y_std")
    )


def unscale(df: DataFrame, stats: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    return (
        df.join(stats, list(keys))
        .withColumn("y", F.col("y") * F.col("y_std") + F.col("y_mean"))
        .drop("y_mean", "y_std")
    )


class TargetTransform(Protocol):
    """What a target transform offers: its statistics, the way there and back."""

    def stats(self, df: DataFrame) -> DataFrame: ...

    def forward(self, df: DataFrame, stats: DataFrame) -> DataFrame: ...

    def inverse(self, df: DataFrame, stats: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class StandardScale:
    """Standardise y per key; the statistics stay a small table for the way back."""

    keys: tuple[str, ...] = (ID,)

    def stats(self, df: DataFrame) -> DataFrame:
        return scale_stats(df, self.keys)

    def forward(self, df: DataFrame, stats: DataFrame) -> DataFrame:
        return scale(df, stats, self.keys)

    def inverse(self, df: DataFrame, stats: DataFrame) -> DataFrame:
        return unscale(df, stats, self.keys)


def scale_in_place(df: DataFrame) -> DataFrame:
    """Standardised y next to its statistics, without a join."""
    window = Window.partitionBy(ID)
    deviation = F.stddev_pop("y").over(window)
    return df.withColumns(
        {
            "y_mean": F.avg("y").over(window),
            "y_std": F.when(deviation == 0, 1.0).otherwise(deviation),
        }
    ).withColumn("y", (F.col("y") - F.col("y_mean")) / F.col("y_std"))


def naive_at_lag(df: DataFrame, lag: int = 1) -> DataFrame:
    """The value `lag` steps earlier as a forecast."""
    return df.withColumn("naive", F.lag("y", lag).over(series_window()))


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their 0-based position in sorted order."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return with_rank(values, [F.col(column).asc()], "code").withColumn("code", (F.col("code") - 1).cast("int"))


def categorise(df: DataFrame, columns: Sequence[str], as_number: Sequence[str] = ("Holiday",)) -> DataFrame:
    """Each column replaced by its category code; a missing value has code -1.

    The columns named in `as_number` are read as numbers first, so that two
    spellings of one number are one category and the codes follow the numbers.
    """
    df = df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in as_number})
    out = df
    for column in columns:
        codes = category_codes(df, column).withColumnRenamed("code", "_code")
        # No hint: the size of the code table decides at run time, and the
        # skew handling of the sort-merge form splits a hot value.
        out = (
            out.join(codes, column, "left")
            .withColumn(column, F.coalesce("_code", F.lit(-1)))
            .drop("_code")
        )
    return out.select(*df.columns)


def categorical_columns(df: DataFrame) -> list[str]:
    """Covariates that are not numeric, as the category step picks them."""
    plain = {"double", "bigint", "float", "int"}
    return [c for c, t in df.dtypes if t not in plain and c not in {ID, DATE, "y"}]


def add_item_parts(df: DataFrame) -> DataFrame:
    """School, Size and Type from the id, Meal from the three groups."""
    parts = F.split(ID, "_")
    return df.withColumns(
        {
            "School": without_trailing_letter(F.get(parts, F.lit(0))),
            "Size": F.get(parts, F.lit(1)),
            "Type": F.get(parts, F.lit(2)),
            "Meal": joined_key(F.col("ProteinGroup"), F.col("VegetablesGroup"), F.col("StarchGroup")),
        }
    )


def drop_all_zero_rows(df: DataFrame, target: str = "y") -> DataFrame:
    """Leave out rows whose first lag is 0 and whose lags and target hold nothing but 0."""
    columns = [c for c in df.columns if "lag" in c]
    if not columns:
        return df
    first = F.coalesce(F.col(columns[0]) == 0, F.lit(False))
    others = [F.coalesce(F.col(c) == 0, F.lit(True)) for c in [*columns, target]]
    all_zero = first
    for test in others:
        all_zero = all_zero & test
    return df.where(~all_zero)
