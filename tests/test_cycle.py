"""The weekly cycle: split weeks, corrections, restarts, and dates that never come."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
import pytest
from conftest import day
from pyspark.sql import functions as F

from shelfcast.operators import models, panel
from shelfcast.streaming import cycle


def value(name, i):
    return float((3 if name == "a" else 5) * (i % 7) + 1)


def sold(lo, hi):
    """Series a sells every day, b not on every fifth."""
    return [(s, day(i), value(s, i)) for s in "ab" for i in range(lo, hi) if s == "a" or i % 5]


def make(history):
    last = history.agg(F.max("date").alias("d")).first()["d"]
    recent = panel.fill_calendar(history)
    return models.window_forecasts(recent, F.array(F.lit(last)), 7, season=7, models=("SeasonalNaive",))


@pytest.fixture
def turn(spark, tmp_path):
    folder, store = tmp_path / "landing", cycle.Store(str(tmp_path / "store"))
    folder.mkdir()

    def land(stamp, rows, name=None):
        file = name or (day(0) + timedelta(days=stamp)).strftime("%d%m%y") + ".csv"
        pd.DataFrame(rows, columns=["unique_id", "date", "y"]).to_csv(folder / file, index=False)

    def run(**options):
        return cycle.run(spark, store, str(folder), make, **options)

    def scored():
        return {(r.unique_id, r.forecast): (r.mae, r.complete) for r in cycle.scores(spark, store).collect()}

    land(29, sold(0, 30))
    assert run() and scored() == {}
    return land, run, scored, store, str(folder)


def error(name, start, n=7, shift=0.0):
    truth = {r[1]: r[2] for r in sold(0, 100) if r[0] == name}
    past = [truth.get(day(start - 6 + k), 0.0) for k in range(7)]
    return sum(abs(past[k] - truth.get(day(start + 1 + k), 0.0) - (shift if k == 0 else 0)) for k in range(n)) / n


def test_split_week_correction_and_repeated_turns(turn):
    land, run, scored, store, _ = turn
    land(33, sold(30, 34))
    assert run() and scored() == {}
    assert not run()  # nothing new: no second forecast
    land(36, sold(34, 37))
    land(1, [("a", day(31), 99.0)], name="note.csv")
    assert run()
    got = scored()
    assert got == {(s, day(29)): (pytest.approx(error(s, 29)), True) for s in "ab"}
    # A later file corrects one day of one series; the other series keeps its scores.
    land(43, [*sold(37, 44), ("a", day(30), value("a", 30) + 70)])
    run()
    again = scored()
    assert again["b", day(29)] == got["b", day(29)]
    assert again["a", day(29)] == (pytest.approx(error("a", 29, shift=70.0)), True)
    assert {f for _, f in again} == {day(29), day(33), day(36)}


def test_a_turn_that_ended_early_is_made_up(spark, turn):
    land, run, scored, store, folder = turn
    land(36, sold(30, 37))
    cycle.ingest(spark, store, folder).awaitTermination()
    assert scored() == {}
    assert run() and set(scored()) == {("a", day(29)), ("b", day(29))}


def test_dates_that_never_come(turn):
    land, run, scored, *_ = turn
    land(33, sold(30, 34))
    run(grace=3)
    land(60, sold(60, 61))
    run(grace=3)
    got = scored()
    assert got["a", day(29)] == (pytest.approx(error("a", 29, n=4)), False)
    # Sales of the lost week come after the days of grace and change nothing.
    land(36, sold(34, 37))
    run(grace=3)
    assert scored()["a", day(29)] == got["a", day(29)]
