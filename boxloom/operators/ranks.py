"""Ranks, margins and metrics within sets of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def average_rank(by: list[str], value: str) -> Column:
    """The rank from 1 within a set, ties sharing the mean of their places."""
    place = F.rank().over(Window.partitionBy(*by).orderBy(value))
    peers = F.count("*").over(Window.partitionBy(*by, value))
    return place + (peers - 1) / 2.0


def margins(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """`rows` with the margin to the best other of the set, z-score, spread, size, and whether it alone is best."""
    own = Window.partitionBy(*by)
    ordered = own.orderBy(F.desc(value))
    second = F.max(F.when(F.col("_nth") == 2, F.col(value))).over(own)
    other = F.when(F.col("_nth") == 1, second).otherwise(F.max(value).over(own))
    std = F.stddev_pop(value).over(own)
    return (
        rows.withColumn("_nth", F.row_number().over(ordered))
        .withColumns({
            "margin": F.col(value) - other,
            "z": F.when(std > 0, (F.col(value) - F.avg(value).over(own)) / std).otherwise(F.lit(0.0)),
            "spread": F.max(value).over(own) - F.min(value).over(own),
            "n": F.count("*").over(own),
        })
        .withColumn("unique_best", F.coalesce(F.col("margin") > 0, F.lit(True))).drop("_nth")
    )


def correlations(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """(set, n, rho): Spearman's correlation within each set, null where one side is flat."""
    placed = rows.withColumns({"_rx": average_rank(by, x), "_ry": average_rank(by, y)})
    rho = F.covar_pop("_rx", "_ry") / F.nullif(F.stddev_pop("_rx") * F.stddev_pop("_ry"), F.lit(0.0))
    return placed.groupBy(*by).agg(F.count("*").alias("n"), rho.alias("rho"))


def auc(rows: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Rank AUC with tied scores sharing ranks; the label is 1 or 0.

    Ranks come from counts per distinct score, so no window gathers all rows: scores are counted, and
    the running sum is over distinct scores.
    """
    by = by or []
    counts = rows.groupBy(*by, score).agg(F.count("*").alias("n"), F.sum(label).alias("p"))
    before = Window.partitionBy(*by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("rank", F.coalesce(F.sum("n").over(before), F.lit(0)) + (F.col("n") + 1) / 2.0)
    total = placed.groupBy(*by) if by else placed.groupBy()
    sums = total.agg(F.sum(F.col("rank") * F.col("p")).alias("r"), F.sum("p").alias("pos"), F.sum(F.col("n") - F.col("p")).alias("neg"))
    area = F.when((F.col("pos") > 0) & (F.col("neg") > 0), (F.col("r") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * F.col("neg")))
    return sums.select(*by, "pos", "neg", area.alias("auc"))


def set_metrics(rows: DataFrame, by: str, order: str, score: str, label: str, base: str | None = None) -> DataFrame:
    """Per set of two or more: top-1 hit, best, mean, regret, random regret, pair accuracies, NDCG at 1, Spearman; with `base`, a baseline's hit and regret.

    The pick is the highest score, the first by `order` among ties. Pair accuracies (plain and weighted by the
    gap of the labels), NDCG and Spearman are null for sets without two different labels. Pairs are within a
    set, which is a handful of candidates.
    """
    first = lambda c: F.max_by(label, F.struct(F.col(c), (-F.col(order)).alias("o")))
    picks = [first(score).alias("picked"), *([first(base).alias("base_pick")] if base else [])]
    each = rows.groupBy(by).agg(F.count("*").alias("n"), F.max(label).alias("best"), F.avg(label).alias("mean"), *picks).where("n > 1")
    a, b = rows.select(by, F.col(score).alias("s"), F.col(label).alias("l")), rows.select(by, F.col(score).alias("t"), F.col(label).alias("m"))
    gap, won = F.col("l") - F.col("m"), (F.col("s") > F.col("t")).cast("double")
    pairs = a.join(b, by).where("l - m > 1e-9").groupBy(by).agg(F.avg(won).alias("pair_acc"), (F.sum(won * gap) / F.sum(gap)).alias("pair_acc_w"))
    ndcg = F.when(F.col("pair_acc").isNull(), None).when(F.col("best") > 0, F.col("picked") / F.col("best")).otherwise(F.lit(1.0))
    hit = lambda c: (F.col(c) >= F.col("best") - 1e-9).cast("double")
    extra = [hit("base_pick").alias("top1_baseline"), (F.col("best") - F.col("base_pick")).alias("regret_baseline")] if base else []
    return each.join(pairs, by, "left").join(correlations(rows, [by], score, label).select(by, "rho"), by).select(
        by, "n", "picked", "best", hit("picked").alias("top1"), (F.col("best") - F.col("picked")).alias("regret"), (F.col("best") - F.col("mean")).alias("regret_random"),
        "pair_acc", "pair_acc_w", ndcg.alias("ndcg1"), F.when(F.col("pair_acc").isNotNull(), F.col("rho")).alias("rho"), *extra,
    )


def losses(rows: DataFrame, by: str, score: str, label: str) -> DataFrame:
    """(value_loss, ranking_loss): the mean squared error of the score, and the mean over ordered pairs of a set of
    -log sigmoid of the score difference, weighted by the label gap. Scores are chances or logits of moderate size."""
    value = rows.where(F.col(label).isNotNull()).agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias("value_loss"))
    a, b = rows.select(by, F.col(score).alias("s"), F.col(label).alias("l")), rows.select(by, F.col(score).alias("t"), F.col(label).alias("m"))
    gap = F.col("l") - F.col("m")
    pairs = a.join(b, by).where("l - m > 1e-6").agg((F.sum(gap * F.log1p(F.exp(F.col("t") - F.col("s")))) / F.sum(gap)).alias("ranking_loss"))
    return value.crossJoin(F.broadcast(pairs))  # one row each


def calibration(rows: DataFrame, chance: str, label: str, bins: int) -> DataFrame:
    """Expected calibration error over equal-width bins of the predicted chance."""
    cell = F.least(F.greatest(F.floor(F.col(chance) * bins), F.lit(0)), F.lit(bins - 1))
    each = rows.groupBy(cell.alias("bin")).agg(F.count("*").alias("n"), F.avg(chance).alias("q"), F.avg(label).alias("y"))
    return each.agg((F.sum(F.col("n") * F.abs(F.col("q") - F.col("y"))) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))
