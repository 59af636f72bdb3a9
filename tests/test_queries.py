"""A few registered queries against their SQL on the smallest tables; tools/check.py runs all."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_statement_belongs_to_a_query(db):
    queries, statements = entry.queries(), entry.oracle_sql()
    assert set(statements) <= set(queries)
    for name, statement in statements.items():
        db.execute(f"explain {statement}")
        assert "limit" not in statement.lower() or name in {
            "a18_top_store",
            "a23_worst_items",
            "a24_confirmed_errors",
            "l2_top_suppliers",
            "p6_drop_warm_up",
            "p23_validation_split",
        }


@pytest.mark.parametrize(
    "name", ["a8_scores", "g2_most_frequent_fill", "m16_backtest", "m27_postprocess", "a19_seasonal_boxes"]
)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = check.table([tuple(r) for r in df.collect()], df.columns)
    assert got == check.table(cursor.fetchall(), columns)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
