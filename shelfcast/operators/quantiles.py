"""Exact quantiles of groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.histogram import value_histogram


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], bins: int = 64
) -> DataFrame:
    """Linear-interpolation quantiles per key as the array column `quantiles`.

    Equal values are counted first, in a histogram that is written once.
    """
    return histogram_quantiles(value_histogram(df, keys, value), keys, value, probabilities, bins)


def histogram_quantiles(
    histogram: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], bins: int = 64
) -> DataFrame:
    """The same from (keys, value, n) rows.

    A sketch cuts each group into bins, the bin counts say which bins hold the
    wanted positions, and only those bins are ranked. No task sees more than one
    bin of a group.
    """
    keys = list(keys)
    counts = histogram.select(*keys, F.col(value).cast("double").alias("_v"), F.col("n").alias("_n"))
    # Cuts over the distinct values, so that bins are even in what a task ranks.
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("_v", [i / bins for i in range(1, bins)], 20 * bins).alias("_cuts")
    )
    binned = counts.join(cuts, keys).withColumn(
        "_bin", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    )
    running = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    sizes = (
        binned.groupBy(*keys, "_bin")
        .agg(F.sum("_n").alias("_size"))
        .withColumn("_upto", F.sum("_size").over(running))
        .withColumn("_total", F.sum("_size").over(whole))
    )
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("i"), ((F.col("_total") - 1) * F.lit(float(q))).alias("at"))
            for i, q in enumerate(probabilities)
        ]
    )
    # A bin is needed when it covers the position below or above a quantile.
    needed = (
        sizes.select(
            *keys,
            "_bin",
            (F.col("_upto") - F.col("_size")).alias("_before"),
            "_upto",
            F.inline_outer(wanted).alias("_i", "_at"),
        )
        .where((F.ceil("_at") >= F.col("_before")) & (F.floor("_at") < F.col("_upto")))
        .groupBy(*keys, "_bin", "_before")
        .agg(F.collect_list(F.struct("_i", "_at")).alias("_wanted"))
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        binned.drop("_cuts")
        .join(needed, [*keys, "_bin"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .select(*keys, "_v", "_start", "_end", F.explode("_wanted").alias("_w"))
    )
    at = F.col("_w._at")
    covers = lambda p: (F.col("_start") <= p) & (p < F.col("_end"))
    picked = ranked.groupBy(*keys, F.col("_w._i").alias("_i"), at.alias("_at")).agg(
        F.max(F.when(covers(F.floor(at)), F.col("_v"))).alias("_low"),
        F.max(F.when(covers(F.ceil(at)), F.col("_v"))).alias("_high"),
    )
    share = F.col("_at") - F.floor("_at")
    value_at = F.col("_low") + (F.col("_high") - F.col("_low")) * share
    return (
        picked.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_i", value_at.alias("q")))).alias("_all"))
        .select(*keys, F.transform("_all", lambda x: x["q"]).alias("quantiles"))
    )
