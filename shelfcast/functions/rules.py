"""Scalar rules shared by the publishing operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def clip_at_zero(column: Column) -> Column:
    """max(y, 0) that keeps nulls; a bare greatest() would turn them into 0."""
    return F.when(column.isNotNull(), F.greatest(column, F.lit(0.0)))


def round_half_even(column: Column) -> Column:
    return F.bround(column, 0).cast("int")


def traffic_light(column: Column) -> Column:
    """Below 20 green, below 40 yellow, everything else (null too) red."""
    return F.when(column < 20, "green").when(column < 40, "yellow").otherwise("red")


def joined_key(*columns: Column) -> Column:
    """Columns joined by '_'; a null part makes the key null."""
    parts = []
    for column in columns:
        if parts:
            parts.append(F.lit("_"))
        parts.append(column.cast("string"))
    return F.concat(*parts)


def without_trailing_letter(column: Column) -> Column:
    """The value itself when all digits, else without its last character."""
    return F.when(column.rlike("^[0-9]+$"), column).otherwise(
        F.substring(column, F.lit(1), F.length(column) - 1)
    )
