"""Matched pairs that share a constant part, and the statistics of what changes between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matched(items: DataFrame, constant: list[str], key: str, variable: str, value: str) -> DataFrame:
    """All ordered pairs of items with equal `constant` and different `variable`, listed: (from, to, delta).

    The list is quadratic in a constant's items; where only statistics are wanted, see `moments`.
    """
    a = items.select(*constant, F.col(key).alias("from_key"), F.col(variable).alias("from"), F.col(value).alias("from_value"))
    b = items.select(*constant, F.col(key).alias("to_key"), F.col(variable).alias("to"), F.col(value).alias("to_value"))
    return a.join(b, constant).where("`from` <> `to`").withColumn("delta", F.col("to_value") - F.col("from_value"))


def moments(items: DataFrame, constant: list[str], variable: str, value: str) -> DataFrame:
    """(constant, from, to, n, s, q, sources): number, sum and sum of squares of the changes of all such pairs, and the items
    that they start from, without listing them.

    Items are counted by constant and variable first; only these counts meet, so a constant that holds a
    third of all items costs the square of its distinct variables. Values are taken off their mean.
    """
    centre = items.agg(F.avg(value).alias("_c"))  # one row
    x = F.col(value) - F.col("_c")
    sums = items.crossJoin(F.broadcast(centre)).groupBy(*constant, variable).agg(F.count(value).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    a = sums.select(*constant, F.col(variable).alias("from"), *(F.col(c).alias(f"a{c}") for c in "nsq"))
    b = sums.select(*constant, F.col(variable).alias("to"), *(F.col(c).alias(f"b{c}") for c in "nsq"))
    return a.join(b, constant).where("`from` <> `to`").select(
        *constant, "from", "to", F.expr("an * bn").alias("n"), F.expr("an * bs - bn * as").alias("s"), F.expr("an * bq + bn * aq - 2 * as * bs").alias("q"), F.col("an").alias("sources")
    )


def rules(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Support, mean and sample deviation of the change for each rule, from `moments`; a single pair has deviation 0."""
    total = pairs.groupBy(*by).agg(F.sum("n").alias("support"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    var = (F.col("q") - F.col("s") * F.col("s") / F.col("support")) / (F.col("support") - 1)
    std = F.when(F.col("support") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).otherwise(F.lit(0.0))
    return total.select(*by, "support", (F.col("s") / F.col("support")).alias("avg"), std.alias("std"))


def pooled(partials: DataFrame, by: list[str], n: str = "n", avg: str = "avg", std: str = "std") -> DataFrame:
    """Merge (n, avg, std) partials exactly: sums of squares within and between. n <= 0 gives 0, n = 1 deviation 0."""
    total = partials.groupBy(*by).agg(
        F.sum(n).alias("n"), F.sum(F.col(n) * F.col(avg)).alias("sx"), F.sum(F.col(n) * F.col(avg) * F.col(avg)).alias("sxx"),
        F.sum(F.when(F.col(n) > 1, F.col(std) * F.col(std) * (F.col(n) - 1)).otherwise(0.0)).alias("ss"),
    )
    mean = F.when(F.col("n") > 0, F.col("sx") / F.col("n")).otherwise(0.0)
    var = (F.col("ss") + F.col("sxx") - F.col("n") * mean * mean) / (F.col("n") - 1)
    dev = F.when(F.col("n") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).otherwise(0.0)
    return total.select(*by, "n", F.round(mean, 4).alias("avg"), F.round(dev, 4).alias("std"))


def ladder(pairs: DataFrame, transform: list[str], contexts: dict[int, Column], least: int, top: int) -> DataFrame:
    """Rules at every radius of context: radius 0 has none, others the given column.

    Transforms are ranked by their support without context, the `top` are kept, and of their rows
    those with at least `least` pairs.
    """
    ranks = pairs.groupBy(*transform).agg(F.sum("n").alias("all"))
    ranks = ranks.orderBy(F.desc("all"), *transform).limit(top)
    kept = pairs.join(ranks, transform)
    levels = F.array(*(F.struct(F.lit(r).alias("radius"), c.cast("string").alias("context")) for r, c in contexts.items()))
    rows = kept.withColumn("level", F.explode(levels)).withColumns({"radius": F.col("level.radius"), "context": F.col("level.context")})
    return rules(rows, [*transform, "radius", "context"]).where(F.col("support") >= least)


def deepest(rules_: DataFrame, wanted: DataFrame, transform: list[str]) -> DataFrame:
    """For each wanted (transform, context) its rule of largest radius whose context matches, radius 0 else."""
    joined = wanted.join(rules_, transform).where((F.col("radius") == 0) | (F.col("context") == F.col("wanted_context")))
    best = Window.partitionBy("wanted_key", *transform).orderBy(F.desc("radius"), F.desc("support"))
    return joined.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")
