"""Date columns: parsing, business-day arithmetic and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Monday, so that day counts from it split into whole weeks.
EPOCH_MONDAY = "1970-01-05"

# Resample unit -> (date_trunc unit, sequence step).
PERIODS = {
    "D": ("day", "interval 1 day"),
    "W": ("week", "interval 7 days"),
    "M": ("month", "interval 1 month"),
    "Q": ("quarter", "interval 3 months"),
    "Y": ("year", "interval 1 year"),
}


def parse_date(column: Column) -> Column:
    """yyyy.MM.dd first, ISO second; anything else is null."""
    return F.coalesce(
        F.try_to_date(column, "yyyy.MM.dd"),
        F.try_to_date(column, "yyyy-MM-dd"),
    )


def parse_file_date(digits: Column) -> Column:
    """ddMMyyyy or ddMMyy digits of a file name; impossible dates are null.

    Two-digit years from 69 on belong to the last century.
    """
    year = F.substring(digits, 5, 2)
    century = F.when(year >= "69", "19").otherwise("20")
    long = F.when(F.length(digits) == 6, F.concat(F.substring(digits, 1, 4), century, year)).otherwise(
        digits
    )
    return F.when(F.length(long) == 8, F.try_to_date(long, "ddMMyyyy"))


def day_index(date: Column, freq: str = "D") -> Column:
    """Dense position of a date on the daily, weekday or weekly calendar."""
    days = F.datediff(date, F.lit(EPOCH_MONDAY).cast("date"))
    if freq == "D":
        return days
    weeks = F.floor(days / 7).cast("int")
    if freq == "W":
        return weeks
    if freq == "B":
        return weeks * 5 + F.least(F.weekday(date), F.lit(4))
    raise ValueError(f"no dense index for frequency {freq!r}")


def shift_date(date: Column, steps: Column | int, freq: str = "D") -> Column:
    """The date `steps` calendar positions after `date`."""
    steps = F.lit(steps) if isinstance(steps, int) else steps
    if freq == "D":
        return F.date_add(date, steps.cast("int"))
    if freq == "W":
        return F.date_add(date, (steps * 7).cast("int"))
    if freq == "B":
        target = day_index(date, "B") + steps
        week = F.floor(target / 5).cast("int")
        offset = week * 7 + F.pmod(target, F.lit(5)).cast("int")
        return F.date_add(F.lit(EPOCH_MONDAY).cast("date"), offset)
    raise ValueError(f"no shift for frequency {freq!r}")


def period_start(date: Column, unit: str) -> Column:
    return F.date_trunc(PERIODS[unit][0], date).cast("date")


def period_end(start: Column, unit: str) -> Column:
    """Last day of the period that begins at `start`; weeks end on Sunday."""
    if unit == "D":
        return start
    if unit == "W":
        return F.date_add(start, 6)
    months = {"M": 1, "Q": 3, "Y": 12}[unit]
    return F.date_sub(F.add_months(start, months), 1)


def calendar_part(date: Column, name: str) -> Column:
    """Calendar features with Monday as day 0."""
    if name in {"dayofweek", "day_of_week"}:
        return F.weekday(date)
    if name == "month":
        return F.month(date)
    if name == "day":
        return F.dayofmonth(date)
    if name == "year":
        return F.year(date)
    if name == "week":
        return F.weekofyear(date)
    if name == "quarter":
        return F.quarter(date)
    raise ValueError(f"unknown calendar feature {name!r}")


def season_of(date: Column) -> Column:
    """Meteorological season, Winter from December."""
    quarter = F.floor(F.pmod(F.month(date), F.lit(12)) / 3)
    return (
        F.when(quarter == 0, "Winter")
        .when(quarter == 1, "Spring")
        .when(quarter == 2, "Summer")
        .otherwise("Autumn")
    )
