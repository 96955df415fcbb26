"""Range joins: boxes sampled from a pool, and how many pool rows each box holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unique together, unlike (l_orderkey, l_linenumber).
KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def sample_boxes(pool: DataFrame, modulus: int, most: int) -> DataFrame:
    """Boxes around reference rows picked by their key; bounds are rounded outwards, so the row stays inside.

    Quantity on both sides, price on both sides, discount from below. At most `most` boxes: that is
    the sampling bound, and what makes a broadcast of the boxes safe.
    """
    picked = F.pmod(F.expr("l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber"), F.lit(modulus)) == 0
    refs = pool.where(picked).orderBy(*KEY).limit(most)
    return refs.select(
        F.concat_ws("-", *KEY).alias("id"),
        (F.col("l_quantity") - 5).alias("q_lo"),
        (F.col("l_quantity") + 5).alias("q_hi"),
        F.floor(F.col("l_extendedprice") * 0.9).cast("double").alias("p_lo"),
        F.ceil(F.col("l_extendedprice") * 1.1).cast("double").alias("p_hi"),
        F.col("l_discount").alias("d_lo"),
    )


def hit_counts(boxes: DataFrame, pool: DataFrame, bounds: dict[str, tuple[str | None, str | None]], grid: tuple[str, float]) -> DataFrame:
    """Per box: rows of `pool` inside it, their share, and the pool's size.

    `bounds` names each property's bound columns, None for an open side. `grid` = (property, step)
    turns the range join into an equi-join: a box is listed under each grid cell it touches, a pool
    row under its own, so no pair outside a shared cell is looked at. The boxes' side is bounded by
    the sample, so it is broadcast and the pool is never shuffled.
    """
    prop, step = grid
    lo, hi = bounds[prop]
    cell = lambda c: F.floor(F.col(c) / step)
    listed = boxes.withColumn("_cell", F.explode(F.sequence(cell(lo), cell(hi))))
    tests = [F.col(p) >= F.col(b[0]) for p, b in bounds.items() if b[0]] + [F.col(p) <= F.col(b[1]) for p, b in bounds.items() if b[1]]
    held = (
        pool.select(*bounds).withColumn("_cell", cell(prop))
        .join(F.broadcast(listed), "_cell").where(reduce(lambda a, b: a & b, tests))
        .groupBy("id").agg(F.count("*").alias("hit_count"))
    )
    size = pool.agg(F.count("*").alias("pool_size"))
    return held.crossJoin(F.broadcast(size)).select(
        "id", "hit_count", (F.col("hit_count") / F.col("pool_size")).alias("hit_rate"), "pool_size"
    )
