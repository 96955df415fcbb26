"""Scales, index quantiles, samples, quotas and encodings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import md5_uniform


def cumulative(rows: DataFrame, by: list[str], value: str, parts: int = 64) -> DataFrame:
    """(by, value, _n, _upto, _all): each distinct value with its number, the rows up to it and all rows of its group.

    `by` has few values (names of properties, languages). No task orders a whole group: distinct values are
    dealt to ranges between their approximate quantiles, counted up within each, and shifted by the totals
    of the ranges before. Where the cuts lie does not change the result.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    shares = F.array(*(F.lit(i / parts) for i in range(1, parts)))
    cuts = counts.groupBy(*by).agg(F.percentile_approx(value, shares, 1000).alias("_cuts"))
    dealt = counts.join(F.broadcast(cuts), by) if by else counts.crossJoin(F.broadcast(cuts))
    dealt = dealt.withColumn("_part", F.size(F.filter("_cuts", lambda c: c <= F.col(value)))).drop("_cuts")
    totals = dealt.groupBy(*by, "_part").agg(F.sum("_n").alias("_t"))  # at most `parts` rows a group
    order = Window.partitionBy(*by)
    shifts = totals.select(
        *by, "_part", F.coalesce(F.sum("_t").over(order.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"), F.sum("_t").over(order).alias("_all")
    )
    within = F.sum("_n").over(Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("_upto", within).join(F.broadcast(shifts), [*by, "_part"]).withColumn("_upto", F.col("_upto") + F.col("_shift")).drop("_part", "_shift")


def value_at(place: Column, value: str) -> Column:
    """Aggregate over `cumulative`: the value of the row at `place` (from 0) in order."""
    return F.min(F.when(F.col("_upto") > place, F.col(value)))


def index_quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Elements of the sorted values at place int(share * (n - 1)), not interpolated."""
    picked = [value_at(F.floor(F.lit(share) * (F.col("_all") - 1)), value).alias(name) for name, share in shares.items()]
    return cumulative(rows, by, value).groupBy(*by).agg(F.sum("_n").alias("n"), *picked)


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float], *more: Column) -> DataFrame:
    """Exact quantiles by linear interpolation between neighbours, and `more` aggregates over `cumulative`."""
    out = []
    for name, share in shares.items():
        place = F.lit(share) * (F.col("_all") - 1)
        low, high = value_at(F.floor(place), value), value_at(F.ceil(place), value)
        rest = F.max(place - F.floor(place))
        out.append((low + rest * (high - low)).alias(name))
    return cumulative(rows, by, value).groupBy(*by).agg(F.sum("_n").alias("n"), *out, *more)


def scales(rows: DataFrame, name: str, value: str, least: int = 10) -> DataFrame:
    """(name, std, median, mad, iqr): population deviation, median, median absolute deviation and quartile range by index
    (places n/4 and 3n/4, rounded down); names with fewer than `least` values are left out, so that they keep what they have."""
    basic = rows.groupBy(name).agg(F.stddev_pop(value).alias("std"))
    iqr = value_at(F.floor(F.col("_all") * 3 / 4), value) - value_at(F.floor(F.col("_all") / 4), value)
    middle = quantiles(rows, [name], value, {"median": 0.5}, iqr.alias("iqr")).where(F.col("n") >= least)
    off = rows.join(F.broadcast(middle.select(name, "median")), name).select(name, F.abs(F.col(value) - F.col("median")).alias("_off"))  # one row a name
    return basic.join(middle, name).join(quantiles(off, [name], "_off", {"mad": 0.5}).select(name, "mad"), name).select(name, "std", "median", "mad", "iqr")


def robust_scale(rows: DataFrame, names: list[str], floor: float = 1e-3) -> DataFrame:
    """(name, centre, scale): median and interquartile range; (0, 1) for columns of two values at most out of -1, 0, 1."""
    long = rows.select(*(F.col(c).cast("double").alias(c) for c in names)).unpivot([], names, "name", "value").where("value IS NOT NULL")
    flags = (F.count("*") <= 2) & (F.min("value") >= -1) & (F.max("value") <= 1) & F.every(F.col("value").isin(-1.0, 0.0, 1.0))
    each = quantiles(long, ["name"], "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, flags.alias("flag"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(floor))
    return each.select("name", F.when(F.col("flag"), 0.0).otherwise(F.col("q2")).alias("centre"), F.when(F.col("flag"), 1.0).otherwise(spread).alias("scale"))


def hash_sample(rows: DataFrame, key: Column, seed: str, n: int) -> DataFrame:
    """Exactly `n` rows (or all), the same ones on every run: those of smallest hash."""
    return rows.withColumn("_u", F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))).orderBy("_u").limit(n).drop("_u")


def admitted(rows: DataFrame, shard: str, order: str, buckets: str, quota: int) -> DataFrame:
    """Greedy admission in order: a record enters only while all its buckets have room in its shard.

    Order-dependent, so each shard is one group; shards must be small enough for one task each, as
    those that records are worked on in are.
    """

    def run(shard_rows: pd.DataFrame) -> pd.DataFrame:
        used: dict = {}
        kept = []
        for place, wanted in shard_rows.sort_values(order)[[order, buckets]].itertuples(index=False):
            if all(used.get(b, 0) < quota for b in wanted):
                kept.append(place)
                for b in wanted:
                    used[b] = used.get(b, 0) + 1
        return pd.DataFrame({shard: shard_rows[shard].iloc[0], order: kept})

    kinds = dict(rows.dtypes)
    return rows.select(shard, order, buckets).groupBy(shard).applyInPandas(run, f"{shard} {kinds[shard]}, {order} {kinds[order]}")


def instances(pool: DataFrame, key: str, ints: list[str], conts: dict[str, int], seed: int, width: float = 0.1) -> DataFrame:
    """(id, property, lo, hi) boxes around reference rows, all draws from hashes of seed, row and property.

    Of the whole-number properties one to all are taken, each closed on both sides, exact or from
    below; of the continuous ones likewise, with a window of shares around the row's own, rounded
    outwards to the property's decimals so that the row stays inside.
    """
    draw = lambda what: md5_uniform(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.lit(what)))
    parts = []
    for p in ints:
        mode, v = draw(f"mode {p}"), F.col(p).cast("double")
        lo = F.when(mode < 2 / 3, v - F.when(mode < 1 / 3, 2.0).otherwise(0.0)).otherwise(v)
        hi = F.when(mode < 1 / 3, v + 2.0).when(mode < 2 / 3, v)
        parts.append(pool.select(F.col(key).alias("id"), F.lit(p).alias("property"), lo.alias("lo"), hi.alias("hi"), draw(f"take {p}").alias("u")))
    for p, decimals in conts.items():
        unit, v, half = 10.0**decimals, F.col(p), F.lit(width) * (draw(f"width {p}") + 0.5)
        lo, hi = F.floor(v * (1 - half) * unit) / unit, F.ceil(v * (1 + half) * unit) / unit
        parts.append(pool.select(F.col(key).alias("id"), F.lit(p).alias("property"), lo.alias("lo"), hi.alias("hi"), draw(f"take {p}").alias("u")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    first = F.row_number().over(Window.partitionBy("id").orderBy("u", "property"))
    return out.withColumn("nth", first).where("nth = 1 OR u < 0.7").drop("nth", "u")


def dense(features: Column, names: list[str]) -> tuple[Column, Column]:
    """(values in the order of names, mask): a missing feature is 0 and masked."""
    keys = F.array(*(F.lit(n) for n in names))
    value = F.transform(keys, lambda n: F.coalesce(F.try_element_at(features, n), F.lit(0.0)))
    return value, F.transform(keys, lambda n: F.try_element_at(features, n).isNotNull().cast("int"))
