"""Constraint boxes as Column builders: distance, satisfaction, gaps, scores and buckets.

A bound may be null (open). A missing or NaN value satisfies nothing and is infinitely far: Spark
orders NaN above every number, so it is turned into null first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def clean(value: Column) -> Column:
    """NaN as null."""
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def inside(value: Column, lo: Column, hi: Column) -> Column:
    """Closed-interval test, false for a missing value."""
    v = clean(value)
    return v.isNotNull() & F.coalesce(v >= lo, F.lit(True)) & F.coalesce(v <= hi, F.lit(True))


def undecided(value: Column, lo: Column, hi: Column) -> Column:
    """Three-valued test: null where the value is missing; equal bounds mean equality within 1e-9."""
    v = clean(value)
    point = F.abs(v - lo) < 1e-9
    return F.when(v.isNotNull(), F.when(lo == hi, point).otherwise(inside(v, lo, hi)))


def distance(value: Column, lo: Column, hi: Column) -> Column:
    """How far outside the box, 0 inside, infinite for a missing value. `greatest` skips null bounds."""
    v = clean(value)
    return F.when(v.isNull(), F.lit(INF)).otherwise(F.greatest(F.lit(0.0), lo - v, v - hi))


def width(lo: Column, hi: Column) -> Column:
    return F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))


def total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def norm_gap(boxes: list[tuple[Column, Column, Column, float]]) -> Column:
    """Sum over (value, lo, hi, scale) of distance / scale."""
    return total([distance(v, lo, hi) / F.lit(scale) for v, lo, hi, scale in boxes])


def satisfied_share(boxes: list[tuple[Column, Column, Column]]) -> Column:
    """Boxes satisfied over boxes asked; a missing value stays in the denominator."""
    return total([inside(*b).cast("double") for b in boxes]) / F.lit(float(len(boxes)))


def score(boxes: list[tuple[Column, Column, Column]], mode: str, weights: list[float] | None = None, penalty: float = 1e6) -> Column:
    """1 where all boxes hold, else 0; but for mode `hard`, less the weighted violations.

    `l1` and `l2` sum distances over widths (squared for l2); a missing value costs `penalty`. Inverted
    bounds are swapped.
    """
    swap = lambda lo, hi: (F.when(hi < lo, hi).otherwise(lo), F.when(hi < lo, lo).otherwise(hi))
    ordered = [(v, *swap(lo, hi)) for v, lo, hi in boxes]
    held = F.when(reduce(lambda a, b: a & b, [inside(*b) for b in ordered]), F.lit(1.0)).otherwise(F.lit(0.0))
    if mode == "hard":
        return held
    power = {"l1": 1.0, "l2": 2.0}[mode]
    each = [F.when(clean(v).isNull(), F.lit(penalty)).otherwise(F.pow(distance(v, lo, hi) / width(lo, hi), F.lit(power))) for v, lo, hi in ordered]
    return held - total([F.lit(w) * e for w, e in zip(weights or [1.0] * len(each), each)])


def bucket(value: Column, lo: Column, hi: Column, sigma: Column, k: float = 1.0, before: Column | None = None) -> Column:
    """Where an uncertain value lies: holds, at risk, within reach or misses; `misses*` where `before` was inside."""
    d, reach = distance(value, lo, hi), sigma * F.lit(k)
    margin = F.least(F.coalesce(value - lo, F.lit(INF)), F.coalesce(hi - value, F.lit(INF)))
    out = F.lit("misses") if before is None else F.when(inside(before, lo, hi), F.lit("misses*")).otherwise(F.lit("misses"))
    return (
        F.when(clean(value).isNull(), out)
        .when((d == 0) & (margin >= reach), F.lit("holds"))
        .when(d == 0, F.lit("at risk"))
        .when(d <= reach, F.lit("within reach"))
        .otherwise(out)
    )
