"""The standard normal distribution function, to an error below 1e-7."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published coefficients of a polynomial in 1 / (1 + STEP |x|) for the upper tail.
STEP = 0.2316419
COEFFICIENTS = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
DENSITY = 0.3989422804014327


def phi(x: Column) -> Column:
    """P(Z <= x). Written with functions that any SQL engine has; `phi_sql` is the same text."""
    t = 1.0 / (1.0 + F.lit(STEP) * F.abs(x))
    series = F.lit(0.0)
    for c in reversed(COEFFICIENTS):
        series = t * (F.lit(c) + series)
    tail = F.lit(DENSITY) * F.exp(F.lit(-0.5) * x * x) * series
    return F.when(x >= 0, 1.0 - tail).otherwise(tail)


def phi_sql(x: str) -> str:
    t, series = f"(1.0 / (1.0 + {STEP} * abs({x})))", "0.0"
    for c in reversed(COEFFICIENTS):
        series = f"{t} * ({c} + {series})"
    tail = f"{DENSITY} * exp(-0.5 * ({x}) * ({x})) * {series}"
    return f"(CASE WHEN ({x}) >= 0 THEN 1.0 - {tail} ELSE {tail} END)"
