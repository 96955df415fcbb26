"""Predicate scans: a range specification becomes a filter that reaches the Parquet reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds(spec: object) -> tuple[object, object] | None:
    """(lo, hi) of a scalar (equality), a pair, or a dict with min/low and max/high; None for no condition."""
    if spec is None:
        return None
    if isinstance(spec, dict):
        first = lambda *names: next((spec[n] for n in names if spec.get(n) is not None), None)
        return first("min", "low"), first("max", "high")
    if isinstance(spec, (list, tuple)):
        lo, hi = spec
        return lo, hi
    return spec, spec


def condition(columns: list[str], ranges: dict[str, object]) -> Column:
    """The conjunction of all ranges on columns that exist; others are skipped. No ranges at all are an error."""
    if not ranges:
        raise ValueError("no ranges given")
    tests = [F.lit(True)]
    for name, spec in ranges.items():
        if name in columns and (sides := bounds(spec)):
            lo, hi = sides
            tests += [F.col(name) >= F.lit(lo)] * (lo is not None) + [F.col(name) <= F.lit(hi)] * (hi is not None)
    return reduce(lambda a, b: a & b, tests)


def range_search(pool: DataFrame, ranges: dict[str, object], most: int, order: str) -> DataFrame:
    """Up to `most` + 1 rows inside all ranges; the one more tells that there are more."""
    return pool.where(condition(pool.columns, ranges)).orderBy(order).limit(most + 1)
