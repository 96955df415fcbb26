"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from boxloom import catalog

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.9g}"
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_rows(spark, duck, name):
    found = catalog.QUERIES[name](spark, str(DATA))
    columns = sorted(found.columns)
    rows = sorted(tuple(plain(row[c]) for c in columns) for row in found.collect())
    if name not in catalog.ORACLE_SQL:
        assert rows
        return
    wanted = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    places = [wanted.columns.index(c) for c in columns]
    assert rows == sorted(tuple(plain(row[i]) for i in places) for row in wanted.fetchall())
