"""Error metrics as named aggregates with a finishing step.

A metric is split in two: plain aggregates that combine map-side, and a
`finish` expression that may use the in-sample scale of the series. The scale
is joined to the already aggregated table, so it never widens the shuffle.
`a` and `p` are the first and second argument of the metric; scoring passes
the forecast first and the truth second.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = sys.float_info.epsilon

Aggregates = Callable[[Column, Column], Mapping[str, Column]]


@dataclass(frozen=True)
class Metric:
    name: str
    aggregates: Aggregates
    finish: Callable[[Callable[[str], Column]], Column]
    needs_scale: bool = False


def _plain(name: str, build: Callable[[Column, Column], Column]) -> Metric:
    return Metric(name, lambda a, p: {name: build(a, p)}, lambda col: col(name))


def squared_error(a: Column, p: Column) -> Column:
    return (a - p) * (a - p)


def relative_error(a: Column, p: Column) -> Column:
    """(a - p) / a, null when a is zero."""
    return F.try_divide(a - p, a)


def symmetric_error(a: Column, p: Column) -> Column:
    return 2.0 * F.abs(a - p) / (F.abs(a) + F.abs(p) + F.lit(EPSILON))


def _scaled_mse(col) -> Column:
    scale = col("naive_mse")
    return F.when(scale == 0, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(col("mse"), scale)))


_ALL = [
    _plain("bias", lambda a, p: F.avg(a - p)),
    _plain("mse", lambda a, p: F.avg(squared_error(a, p))),
    _plain("mae", lambda a, p: F.avg(F.abs(a - p))),
    _plain("mape", lambda a, p: F.avg(F.abs(relative_error(a, p)))),
    _plain("smape", lambda a, p: F.avg(symmetric_error(a, p))),
    _plain("wmape", lambda a, p: F.avg(F.try_divide(F.abs(a - p), F.abs(a)))),
    Metric(
        "rmse",
        lambda a, p: {"mse": F.avg(squared_error(a, p))},
        lambda col: F.sqrt(col("mse")),
    ),
    Metric(
        "scaled_error",
        lambda a, p: {"bias": F.avg(a - p)},
        lambda col: F.try_divide(col("bias"), col("naive_mse")),
        needs_scale=True,
    ),
    Metric(
        "mase",
        lambda a, p: {"mae": F.avg(F.abs(a - p))},
        lambda col: F.try_divide(col("mae"), col("naive_mae")),
        needs_scale=True,
    ),
    Metric(
        "rmsse",
        lambda a, p: {"mse": F.avg(squared_error(a, p))},
        _scaled_mse,
        needs_scale=True,
    ),
]

METRICS: dict[str, Metric] = {metric.name: metric for metric in _ALL}


def register_metric(metric: Metric) -> None:
    """Make a metric of the caller available by name."""
    METRICS[metric.name] = metric


def resolve(names) -> list[Metric]:
    return [name if isinstance(name, Metric) else METRICS[name] for name in names]
