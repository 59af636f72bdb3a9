from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from conftest import SERIES, day
from pyspark.sql import functions as F

from shelfcast.catalog import calendars, filters
from shelfcast.operators import histogram, panel


def values(df):
    return {(r["unique_id"], r["date"]): r["y"] for r in df.collect()}


def test_fill_uses_the_global_span_and_zeros(series):
    df = series({"a": {0: 1.0, 4: 5.0}, "b": {2: 7.0}})
    got = values(panel.fill_calendar(df))
    assert len(got) == 10
    assert [got["a", day(i)] for i in range(5)] == [1, 0, 0, 0, 5]
    assert [got["b", day(i)] for i in range(5)] == [0, 0, 7, 0, 0]


def test_fill_is_idempotent(series):
    df = series({"a": {0: 1.0, 4: 5.0}, "b": {2: None}})
    once = panel.fill_calendar(df)
    assert values(panel.fill_calendar(once)) == values(once)


def test_exact_duplicates_collapse_and_others_stay(spark):
    rows = [("a", day(0), 1.0), ("a", day(0), 1.0), ("a", day(2), 2.0), ("a", day(2), 3.0)]
    got = panel.fill_calendar(spark.createDataFrame(rows, SERIES)).collect()
    assert sorted((r["date"], r["y"]) for r in got) == [
        (day(0), 1.0),
        (day(1), 0.0),
        (day(2), 2.0),
        (day(2), 3.0),
    ]


def test_business_calendar_loses_weekend_rows_but_keeps_the_series(series):
    df = series({"a": {0: 1.0, 5: 9.0, 7: 2.0}, "b": {6: 4.0}})
    got = values(panel.fill_calendar(df, business_days=True))
    assert {d for _, d in got} == {day(i) for i in (0, 1, 2, 3, 4, 7)}
    assert got["a", day(7)] == 2 and sum(v for (n, _), v in got.items() if n == "b") == 0


def test_scoped_calendars(spark):
    rows = [("x", "a", day(0), 1.0), ("x", "b", day(1), 1.0), ("y", "c", day(5), 1.0)]
    df = spark.createDataFrame(rows, "client string, unique_id string, date date, y double")
    got = panel.fill_calendar(df, keys=["client", "unique_id"], scope=["client"]).collect()
    assert len(got) == 5


def test_series_fill_keeps_each_span(series):
    df = series({"a": {0: 1.0, 2: 5.0}, "b": {5: 7.0}})
    assert len(values(panel.fill_series(df))) == 4


def test_mode_takes_the_smallest_among_ties_and_skips_nulls(spark):
    rows = [("a", "x"), ("a", "y"), ("b", None), ("c", "z"), ("c", "z"), ("c", "k")]
    df = spark.createDataFrame(rows, "unique_id string, v string")
    got = {r["unique_id"]: r["m"] for r in panel.most_frequent(df, ["unique_id"], "v", "m").collect()}
    assert got == {"a": "x", "c": "z"}


def test_weekly_bins_end_on_sunday(series):
    df = series({"a": {0: 1.0, 6: 2.0, 7: 4.0, 22: 8.0}})
    got = values(panel.resample(df, "W", "sum"))
    assert got == {
        ("a", day(6)): 3,
        ("a", day(13)): 4,
        ("a", day(20)): 0,
        ("a", day(27)): 8,
    }


def test_all_null_series_vanish_from_resampling(series):
    df = series({"a": {0: 1.0}, "b": {0: None}})
    assert {r["unique_id"] for r in panel.resample(df, "M").collect()} == {"a"}


def test_wide_and_long_round_trip(series):
    df = series({"a": {0: 1.0, 1: 4.0}, "b": {0: 2.0, 1: 5.0}})
    wide = panel.to_wide(df, [str(day(0)), str(day(1))])
    assert wide.columns == ["unique_id", "2024-01-01", "2024-01-02"]
    assert values(panel.to_long(wide)) == values(df)


def test_weekly_batches_cover_the_input(series):
    df = series({"a": {i: float(i) for i in range(16)}})
    tagged = panel.week_batches(df)
    sizes = {r["week_end"]: r["count"] for r in tagged.groupBy("week_end").count().collect()}
    assert sizes == {day(6): 7, day(13): 7, day(15): 2}


def test_last_dates_split(series):
    df = series({"a": {i: 1.0 for i in range(10)}})
    train, validation = panel.split_last_dates(df, 3)
    assert (train.count(), validation.count()) == (7, 3)
    train, validation = panel.split_last_dates(df, 30)
    assert (train.count(), validation.count()) == (0, 10)


def test_warm_up_longer_than_the_table_leaves_nothing(series):
    assert panel.drop_first_dates(series({"a": {0: 1.0, 1: 2.0}}), 5).count() == 0


def test_history_counts_zeros_but_not_nulls(series):
    df = series({"a": {0: 0.0, 1: 0.0}, "b": {0: 1.0, 1: None}})
    assert {r["unique_id"] for r in panel.with_min_history(df, 2).collect()} == {"a"}


def test_recent_weeks_cross_a_year_end(spark):
    rows = [("a", date(2024, 12, 9), 1.0), ("a", date(2024, 12, 16), 2.0), ("a", date(2025, 1, 6), 3.0)]
    df = spark.createDataFrame(rows, SERIES)
    assert sorted(r["y"] for r in panel.recent_weeks(df).collect()) == [2.0, 3.0]


def test_fill_needs_no_second_exchange(series):
    filled = panel.fill_calendar(series({"a": {0: 1.0, 3: 2.0}}), span=(day(0), day(3)))
    from pyspark.sql import Window

    lagged = filled.withColumn("l", F.lag("y").over(Window.partitionBy("unique_id").orderBy("date")))
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(unique_id#") <= 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fill_drops_rows_without_a_date(spark, series):
    from shelfcast.operators.panel import fill_calendar

    panel = series({"a": {0: 1.0, 2: 3.0}})
    broken = panel.unionByName(spark.createDataFrame([("a", None, 9.0)], panel.schema))
    key = lambda df: sorted((r.unique_id, r.date, r.y) for r in df.collect())
    assert key(fill_calendar(broken)) == key(fill_calendar(panel))


def test_modes_of_observed_rows_fill_the_calendar(spark):
    """One pass gives the modes of series, dates and the table; the same as from the filled panel."""
    days = [date(2024, 1, d) for d in (1, 2, 5, 6)]
    rows = [
        ("a", days[0], 1.0, "x", 1, None), ("a", days[1], 2.0, "x", None, "lo"), ("a", days[2], 3.0, "y", 2, "hi"),
        ("a", days[2], 3.0, "y", 2, "hi"), ("b", days[0], 4.0, None, 1, "hi"), ("b", days[1], 4.0, None, 3, "lo"),
        ("b", days[3], 4.0, None, 2, "hi"), ("c", days[2], 1.0, "z", None, None), ("c", None, 1.0, "q", 7, "no"),
    ]
    df = spark.createDataFrame(rows, "unique_id string, date date, y double, k string, s int, w string")
    covars = ["k", "s", "w"]
    groups = {"item_covars": ["k"], "item_time_covars": ["s"], "time_covars": ["w"]}
    for weekdays in (False, True):
        filled = panel.fill_calendar(df, covars=covars, business_days=weekdays)
        observed = panel.observed_rows(df, covars=covars, business_days=weekdays)
        got = panel.fill_most_frequent(filled, **groups, observed=observed).collect()
        assert sorted(map(str, got)) == sorted(map(str, panel.fill_most_frequent(filled, **groups).collect()))
        found = {(r.unique_id, r.date.day): (r.k, r.s, r.w) for r in got}
        # A tie goes to the smaller value; a series without any value keeps its nulls.
        assert found["a", 1] == ("x", 1, "hi") and found["b", 2] == (None, 3, "lo")
        assert found["c", 2] == ("z", 3, "hi") and found["c", 3] == ("z", None, "hi")


def test_histograms_of_empty_and_null_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("b", 2.0), (None, 2.0)], "g string, v double")
    rows = {(r.g, r.v): r.n for r in histogram.value_histogram(df, ["g"], "v").collect()}
    assert rows == {("b", 2.0): 2, (None, 2.0): 1}
    whole, by = histogram.value_histograms(df, [((), "v"), (("g",), "v")])
    assert [tuple(r) for r in whole.collect()] == [(2.0, 3)]
    assert {(r.g, r.v): r.n for r in by.collect()} == rows
    assert histogram.value_histograms(df.limit(0), [(("g",), "v")])[0].collect() == []


@pytest.fixture
def many_suppliers(spark, tmp_path):
    """Tables of 300 suppliers with sales on four days of 60, one of them twice."""
    days = [datetime(2024, 1, 1) + timedelta(days=d) for d in (0, 2, 3, 59, 59)]
    lines = [(s, float(s % 7 + 1), d) for s in range(1, 301) for d in days]
    spark.createDataFrame(lines, "l_suppkey bigint, l_quantity double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(s, s % 5) for s in range(1, 301)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    orders = [(datetime(2024, 1, 1) + timedelta(days=d), "a") for d in range(60)]
    spark.createDataFrame(orders, "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def tasks_and_rows(df):
    """How many tasks hold rows, the largest share of one, and the rows."""
    rows = df.withColumn("_task", F.spark_partition_id()).collect()
    sizes = Counter(r["_task"] for r in rows)
    return len(sizes), max(sizes.values()) / len(rows), sorted(tuple(r)[:-1] for r in rows)


def test_p13_spreads_the_filled_rows_of_many_series(spark, many_suppliers):
    tasks, share, rows = tasks_and_rows(filters.p13_drop_all_zero_rows(spark, many_suppliers))
    assert tasks > 100 and share < 0.05
    # These days have a sale on themselves or on one of the three days before.
    assert len(rows) == 300 * 5 and {r[1] for r in rows} == {day(i) for i in (3, 4, 5, 6, 59)}


def test_p24_spreads_the_filled_rows_of_many_series(spark, many_suppliers):
    tasks, _, rows = tasks_and_rows(filters.p24_drop_zero_sales(spark, many_suppliers))
    assert tasks > 100 and len(rows) == 300 * 4
    assert all(r[2] == (int(r[0][1:]) % 7 + 1) * (2 if r[1] == day(59) else 1) for r in rows)


def test_g4_spreads_the_filled_rows_of_many_series(spark, many_suppliers):
    tasks, share, rows = tasks_and_rows(
        calendars.g4_series_fill(spark, many_suppliers).select("unique_id", "date", "y", "nation", "day_class")
    )
    assert tasks > 100 and share < 0.05
    assert len(rows) == 300 * 60 and {r[1] for r in rows} == {day(i) for i in range(60)}
    assert all(r[3] == int(r[0][1:]) % 5 and r[4] == "a" and (r[2] > 0) == (r[1] in {day(0), day(2), day(3), day(59)}) for r in rows)
