"""Picks of columns over made lines: one exchange, and DuckDB's rows with nulls and ties."""

import random

import duckdb
import pytest

from boxloom import catalog

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """400 orders of 1 to 9 lines, a third of them without nulls, with prices that tie; every 50th without a key."""
    draw, rows = random.Random(3), []
    for order in range(400):
        some = lambda *values: None if order % 3 and draw.random() < 0.2 else draw.choice(values)  # noqa: B023, E731
        for _ in range(draw.choice([1, 2, 2, 3, 4, 5, 9])):
            key = order if order % 50 else None
            rows.append((key, some(0, 1, 2), some(0, 1), some(1, 2), some(1.0, 2.0, 3.0), some(100.0, 200.0, 300.5, 1e15), some(0.0, -0.0, 0.05, 0.1), some(0.0, 0.02)))
    folder = tmp_path_factory.mktemp("made")
    spark.createDataFrame(rows, LINES).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def plan(data):
    return data._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["column_picks", "column_picks_scaled"])
def test_picks_exchange_lines_once(spark, made, name):
    assert plan(catalog.QUERIES[name](spark, str(made))).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["column_picks", "column_picks_scaled"])
def test_picks_hold_one_set_at_a_time(spark, made, name):
    steps = plan(catalog.QUERIES[name](spark, str(made)))
    assert "HashAggregate" not in steps and steps.count("- Sort [") == 1


@pytest.mark.parametrize("name", ["column_picks", "column_picks_scaled"])
def test_picks_with_nulls_equal_sql(spark, made, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{made}/lineitem.parquet/*.parquet')")
    wanted = con.sql(catalog.ORACLE_SQL[name]).select("l_orderkey, nth, col").fetchall()
    found = catalog.QUERIES[name](spark, str(made)).select("l_orderkey", "nth", "col").collect()
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in found)
