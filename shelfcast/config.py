"""Run settings as frozen dataclasses, with the two shipped profiles."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

# Periods per year or cycle for each base frequency.
SEASONAL_PERIODS: dict[str, tuple[int, ...]] = {
    "Y": (1,),
    "A": (1,),
    "Q": (4,),
    "M": (12,),
    "W": (52,),
    "D": (7, 30, 364),
    "H": (24, 168, 720, 8760),
    "B": (5,),
}


def seasonal_periods(freq: str) -> tuple[int, ...]:
    """Season lengths of a frequency; '2M' halves the monthly period."""
    match = re.fullmatch(r"(\d*)([A-Za-z]+)", freq)
    if not match:
        raise ValueError(f"unknown frequency {freq!r}")
    multiple = int(match.group(1) or 1)
    base = match.group(2).upper()
    for candidate in (base, base.removesuffix("E").removesuffix("S"), base[-1], base[0]):
        if candidate in SEASONAL_PERIODS:
            return tuple(period // multiple for period in SEASONAL_PERIODS[candidate])
    raise ValueError(f"unknown frequency {freq!r}")


@dataclass(frozen=True)
class Labels:
    """Model names as they appear in published tables."""

    primary: str = "Primary"
    benchmark: str = "SeasonalNaive"
    ensemble: str = "SeasonalEnsemble"
    client: str = "Client"
    confirmed: str = "Confirmed"


@dataclass(frozen=True)
class ForecastConfig:
    h: int = 7
    freq: str = "D"
    seasonal_length: int = 7
    remove_weekends: bool = False
    holdout: bool = False
    cv: int = 0
    step_size: int = 1
    warm_up: int = 180
    item_covars: tuple[str, ...] = ()
    time_covars: tuple[str, ...] = ()
    item_time_covars: tuple[str, ...] = ()
    static_features: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.h < 1:
            raise ValueError("h must be at least 1")
        seasonal_periods(self.freq)
        if not self.holdout and self.cv > 1:
            raise ValueError("cross validation needs holdout")


@dataclass(frozen=True)
class LagTransform:
    """A rolling statistic at a lag; season > 1 steps whole seasons back."""

    kind: str
    window: int
    lag: int = 1
    season: int = 1

    def __post_init__(self) -> None:
        if self.kind not in {"mean", "max", "min", "std"}:
            raise ValueError(f"unknown rolling statistic {self.kind!r}")

    @property
    def name(self) -> str:
        prefix = "seasonal_rolling" if self.season > 1 else "rolling"
        suffix = f"_season{self.season}" if self.season > 1 else ""
        return f"{prefix}_{self.kind}_lag{self.lag}_window{self.window}{suffix}"

    @property
    def depth(self) -> int:
        return self.lag + self.season * (self.window - 1)


@dataclass(frozen=True)
class ModelConfig:
    lags: int = 21
    loss: str = "fair"
    date_features: tuple[str, ...] = ("dayofweek", "month", "day")
    lag_transforms: tuple[LagTransform, ...] = ()
    scale: bool = True
    covariates: tuple[str, ...] = ()
    static_features: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    transforms: tuple = ()
    benchmarks: tuple[str, ...] = ("SeasonalNaive",)
    fit_benchmarks: bool = True
    ensemble: bool = False
    seed: int = 42
    trees: int = 20
    depth: int = 5
    learning_rate: float = 0.1
    min_leaf: int = 1

    def __post_init__(self) -> None:
        if self.lags < 1:
            raise ValueError("lags must be at least 1")
        if self.fit_benchmarks and not self.benchmarks:
            raise ValueError("benchmark models are missing")


@dataclass(frozen=True)
class Profile:
    name: str
    forecast: ForecastConfig
    model: ModelConfig
    metrics: tuple[str, ...] = ("rmsse", "mae", "bias")
    labels: Labels = field(default_factory=Labels)

    def with_model(self, **changes) -> Profile:
        return replace(self, model=replace(self.model, **changes))


# Rolling statistics of the weekday profile as (kind, window, deepest lag, season).
WEEKDAY_ROLLING = (
    ("mean", 3, 5, 1),
    ("max", 1, 4, 1),
    ("min", 3, 4, 1),
    ("std", 2, 5, 5),
    ("max", 3, 5, 5),
    ("mean", 3, 5, 5),
)


def expand_rolling(entries) -> tuple[LagTransform, ...]:
    """One transform per lag from 1 to the deepest lag of each entry."""
    return tuple(
        LagTransform(kind, window, lag, season)
        for kind, window, deepest, season in entries
        for lag in range(1, deepest + 1)
    )


DAILY_RETAIL = Profile(
    name="daily_retail",
    forecast=ForecastConfig(
        h=7,
        freq="D",
        seasonal_length=7,
        item_time_covars=("sell_price", "event_type_1", "event_type_2", "snap"),
    ),
    model=ModelConfig(lags=21, loss="fair", date_features=("dayofweek", "month", "day")),
)

WEEKDAY_ORDERS = Profile(
    name="weekday_orders",
    forecast=ForecastConfig(
        h=5,
        freq="B",
        seasonal_length=5,
        remove_weekends=True,
        item_covars=("School", "Size", "Type", "Customer"),
        item_time_covars=("ProteinGroup", "VegetablesGroup", "StarchGroup"),
        static_features=("School", "Size", "Type", "Customer"),
    ),
    model=ModelConfig(
        lags=15,
        loss="fair",
        date_features=("dayofweek",),
        covariates=("ProteinGroup", "VegetablesGroup", "StarchGroup"),
        static_features=("School", "Size", "Type", "Customer"),
        categorical=("ProteinGroup", "VegetablesGroup", "StarchGroup", "School", "Size", "Type", "Customer"),
        benchmarks=("SeasonalNaive", "SeasonalWindowAverage"),
        trees=570,
        depth=12,
        learning_rate=0.05,
        min_leaf=45,
    ),
)


# Candidate lists and [low, high, step] ranges of the daily model's search.
LOSS_CANDIDATES = ("mae", "mse", "rmse", "mape", "huber", "fair", "poisson", "tweedie")
LAG_CANDIDATES = (7, 34, 1)
TREE_RANGES = {
    "n_estimators": (120, 300, 10),
    "learning_rate": (0.005, 0.2, 0.005),
}


@dataclass(frozen=True)
class Range:
    """Values from `low` to `high`, both included, `sample` of them (0: all)."""

    low: float
    high: float
    step: float
    sample: int = 0

    def __post_init__(self) -> None:
        if self.step <= 0 or self.high < self.low:
            raise ValueError("a range needs a positive step and low <= high")


@dataclass(frozen=True)
class SearchSpace:
    """What each model family is tried with: its window, number of seasons or smoothing constant."""

    ranges: tuple[tuple[str, Range], ...] = (
        ("WindowAverage", Range(LAG_CANDIDATES[0], LAG_CANDIDATES[1], LAG_CANDIDATES[2], 8)),
        ("SeasonalWindowAverage", Range(1, 8, 1, 5)),
        ("SES", Range(0.05, 0.95, 0.05, 6)),
        ("Croston", Range(0.05, 0.4, 0.05, 4)),
        ("SBA", Range(0.05, 0.4, 0.05, 4)),
        ("Theta", Range(0.1, 0.9, 0.1, 4)),
    )
    seed: int = 42
