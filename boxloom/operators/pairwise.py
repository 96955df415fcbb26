"""Which feature decides among siblings: logistic regression on differences within sets, refitted without each feature."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(rows: DataFrame, by: str, label: str, features: list[str], most: int | None, seed: str) -> DataFrame:
    """(set, fold key, y, differences): of each pair of a set with different labels both orders, at most `most` pairs by hash."""
    side = lambda p: rows.select(F.col(by).alias("set"), F.col(label).alias(f"{p}_y"), *(F.col(f).cast("double").alias(f"{p}_{f}") for f in features))
    pairs = side("a").join(side("b"), "set").where("a_y > b_y")
    if most is not None:
        key = F.md5(F.to_json(F.struct(F.lit(seed).alias("seed"), *pairs.columns)).cast("binary"))
        pairs = pairs.withColumn("_d", key).orderBy("_d").limit(most).drop("_d")
    gap = [(F.col(f"a_{f}") - F.col(f"b_{f}")).alias(f) for f in features]
    there = pairs.select("set", F.lit(1.0).alias("y"), *gap)
    return there.unionByName(there.select("set", F.lit(0.0).alias("y"), *((-F.col(f)).alias(f) for f in features)))


def out_of_fold(pairs: DataFrame, features: list[str], folds: int) -> float:
    """The share of pairs told right by models that did not see their set; sets are dealt by hash. No intercept, so constants drop out."""
    data = VectorAssembler(inputCols=features, outputCol="x").transform(pairs).withColumn("fold", F.pmod(F.xxhash64("set"), F.lit(folds)))
    right = total = 0
    for k in range(folds):
        train, held = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
        model = LogisticRegression(featuresCol="x", labelCol="y", fitIntercept=False, regParam=1e-3, maxIter=25).fit(train)
        hit, n = model.transform(held).agg(F.count_if(F.col("prediction") == F.col("y")), F.count("*")).first()
        right, total = right + hit, total + n
    return right / total if total else float("nan")


def importance(rows: DataFrame, by: str, label: str, features: list[str], folds: int = 3, most: int | None = 120_000, seed: str = "0") -> list[tuple[str, float, float]]:
    """(feature, accuracy without it, loss of accuracy) for each feature, the most decisive first; `all` is the model with all."""
    pairs = differences(rows, by, label, features, most, seed).persist()
    try:
        if pairs.isEmpty():
            return []
        whole = out_of_fold(pairs, features, folds)
        each = [(f, out_of_fold(pairs, [g for g in features if g != f], folds)) for f in features if len(features) > 1]
    finally:
        pairs.unpersist()
    return [("all", whole, 0.0), *sorted(((f, a, whole - a) for f, a in each), key=lambda x: (-x[2], x[0]))]
