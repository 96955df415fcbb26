"""Ranking and calibration queries: the lines of an order are a set of candidates, price the score, discount the label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ranks, samples
from ..sources.tables import table

KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_quantity", "l_extendedprice", "l_discount")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity"))
    return lines.withColumn("pos", place)


def dense_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line's place by discount within its order, and whether it shares it."""
    own = Window.partitionBy("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(*KEY, "l_discount")
    rank, most = F.dense_rank().over(own.orderBy("l_discount")), F.max("rank").over(own)
    tied = F.count("*").over(Window.partitionBy("l_orderkey", "l_discount")) > 1
    word = F.when(F.col("rank") == 1, "tightest").when(F.col("rank") == F.col("most"), "widest").otherwise(F.concat(F.lit("rank "), F.col("rank")))
    placed = lines.withColumn("rank", rank).withColumn("most", most).withColumn("tied", tied)
    return placed.select(*KEY, "rank", F.concat(F.when(F.col("tied"), "tied ").otherwise(""), word).alias("label"))


def margin_to_best_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranks.margins(table(spark, sf_dir, "lineitem").select(*KEY, "l_extendedprice"), ["l_orderkey"], "l_extendedprice")
    return found.select(*KEY, *((F.round(c, 4) + 0.0).alias(c) for c in ("margin", "z", "spread")), "n", "unique_best")


def tie_averaged_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*KEY, ranks.average_rank(["l_orderkey"], "l_discount").alias("avg_rank"))


def group_mean_centring(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.avg("l_quantity").over(Window.partitionBy("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select(*KEY, F.round(F.col("l_quantity") - mean, 6).alias("centred"))


def history_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Along a customer's orders: last price, whether it rose, whether the status repeats, the step, by how many thousands the change differs from the one foretold (0 at first)."""
    path = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    before = F.lag("o_totalprice").over(path)
    foretold = (F.pmod("o_orderkey", F.lit(7)) - 3) * 1000.0
    missed = F.abs(F.col("o_totalprice") - before - foretold) / 1000.0
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", before.alias("last_price"), (F.col("o_totalprice") > before).alias("improved"),
        (F.lag("o_orderstatus").over(path) == F.col("o_orderstatus")).alias("same_status"), F.row_number().over(path).alias("step"),
        F.round(F.coalesce(missed, F.lit(0.0)), 6).alias("missed_by"),
    )


def within_set_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations of price and discount within orders, pooled as mean, median and by Fisher's z."""
    each = ranks.correlations(_candidates(spark, sf_dir), ["l_orderkey"], "l_extendedprice", "l_discount").where("rho IS NOT NULL AND n > 2")
    clipped = F.atanh(F.least(F.greatest("rho", F.lit(-0.999)), F.lit(0.999)))
    fisher = F.tanh(F.sum((F.col("n") - 1) * clipped) / F.sum(F.col("n") - 1))
    pooled = each.agg(F.count("*").alias("sets"), F.round(F.avg("rho"), 6).alias("mean"), F.round(fisher, 6).alias("fisher"))
    middle = samples.quantiles(each, [], "rho", {"median": 0.5}).select(F.round("median", 6).alias("median"))
    return pooled.crossJoin(F.broadcast(middle)).select("sets", "mean", "median", "fisher")  # one row each


def rank_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does a document's length tell its quality? By language."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    found = ranks.auc(rows, "n_chars", "quality", ["lang"])
    return found.select("lang", "pos", "neg", F.round("auc", 6).alias("auc"))


def top1_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean label of the cheapest and the dearest line, of any line, and of the best."""
    rows = _candidates(spark, sf_dir)
    each = rows.groupBy("l_orderkey").agg(
        F.min_by("l_discount", F.struct("l_extendedprice", "pos")).alias("low"), F.max_by("l_discount", F.struct(F.col("l_extendedprice"), -F.col("pos"))).alias("high"),
        F.avg("l_discount").alias("random"), F.max("l_discount").alias("oracle"),
    )
    return each.agg(*(F.round(F.avg(c), 6).alias(c) for c in ("low", "high", "random", "oracle")), F.count("*").alias("sets"))


def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price as the score, quantity as the baseline's, discount as the label."""
    found = ranks.set_metrics(_candidates(spark, sf_dir), "l_orderkey", "pos", "l_extendedprice", "l_discount", base="l_quantity")
    names = ("picked", "best", "top1", "regret", "regret_random", "pair_acc", "pair_acc_w", "ndcg1", "rho", "top1_baseline", "regret_baseline")
    return found.agg(F.count("*").alias("sets"), *(F.round(F.avg(c), 6).alias(c) for c in names))


def ranking_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price over 100,000 as the score, discount times ten as the label."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_extendedprice") / 1e5).alias("s"), (F.col("l_discount") * 10).alias("y"))
    return ranks.losses(rows, "l_orderkey", "s", "y").select(F.round("value_loss", 6).alias("value_loss"), F.round("ranking_loss", 6).alias("ranking_loss"))


def rank_auc_centred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all documents, with each language's mean length taken off."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    mean = rows.groupBy("lang").agg((F.sum("n_chars") / F.count("*")).alias("mean"))  # one row a language
    centred = rows.join(mean, "lang").select("quality", F.round(F.col("n_chars") - F.col("mean"), 6).alias("x"))
    return ranks.auc(centred, "x", "quality").select("pos", "neg", F.round("auc", 6).alias("auc"))


def ece_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount over 0.1 as a chance of a return flag of R."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10).alias("q"), (F.col("l_returnflag") == "R").cast("double").alias("y"))
    return ranks.calibration(rows, "q", "y", 10).select(F.round("ece", 6).alias("ece"), "n")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over all orders: totals, success rate, mean value, errors."""
    return table(spark, sf_dir, "orders").agg(
        F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"),
        F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("success_rate"),
        F.round(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 4).alias("mean_done"), F.count_if(F.col("o_orderstatus") == "P").alias("errors"),
    )


def tiered_column_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order's lines the two of lowest tier, then largest price, then first."""
    tier = F.when(F.col("l_discount") >= 0.05, 0).otherwise(1)
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("tier", F.desc("l_extendedprice"), "pos"))
    return _candidates(spark, sf_dir).withColumn("tier", tier).withColumn("nth", nth).where("nth <= 2").select("l_orderkey", "pos", "tier", "nth")


def cascade_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners by (largest quantity, smallest discount, largest price), and the first key that decided."""
    rows = _candidates(spark, sf_dir)
    own = Window.partitionBy("l_orderkey")
    first = F.col("l_quantity") == F.max("l_quantity").over(own)
    a = rows.withColumn("w1", first)
    b = a.withColumn("w2", F.col("w1") & (F.col("l_discount") == F.min(F.when(F.col("w1"), F.col("l_discount"))).over(own)))
    c = b.withColumn("w3", F.col("w2") & (F.col("l_extendedprice") == F.max(F.when(F.col("w2"), F.col("l_extendedprice"))).over(own)))
    counts = c.groupBy("l_orderkey").agg(F.count("*").alias("n"), *(F.count_if(F.col(w)).alias(w) for w in ("w1", "w2", "w3")))
    key = F.when(F.col("w1") < F.col("n"), "quantity").when(F.col("w2") < F.col("w1"), "discount").when(F.col("w3") < F.col("w2"), "price").otherwise("none")
    return counts.select("l_orderkey", F.col("w3").alias("winners"), key.alias("decided_by"))


def elimination_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rivals of the dearest line, cheapest first."""
    own = Window.partitionBy("l_orderkey")
    best = F.row_number().over(own.orderBy(F.desc("l_extendedprice"), "pos"))
    rivals = _candidates(spark, sf_dir).withColumn("best", best).where("best > 1")
    return rivals.select("l_orderkey", "pos", F.row_number().over(own.orderBy("l_extendedprice", "pos")).alias("out"))


QUERIES = {
    f.__name__: f for f in (dense_rank_ties, margin_to_best_other, tie_averaged_ranks, group_mean_centring, history_lag, within_set_spearman, rank_auc,
                            top1_by_score, ranking_metrics, ranking_losses, rank_auc_centred, ece_calibration, run_summary, tiered_column_pick, cascade_verdict, elimination_order)
}

_K = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
_C = "WITH c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_discount, l_quantity)::INT AS pos FROM lineitem)"
_RHO = """r AS (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_orderkey, l_extendedprice) - 1) / 2.0 AS rx,
                 rank() OVER (PARTITION BY l_orderkey ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_orderkey, l_discount) - 1) / 2.0 AS ry FROM c),
        e AS (SELECT l_orderkey, count(*) AS n, CASE WHEN min(l_extendedprice) <> max(l_extendedprice) AND min(l_discount) <> max(l_discount) THEN corr(rx, ry) END AS rho
              FROM r GROUP BY 1)"""

ORACLE_SQL = {
    "dense_rank_ties": f"""
        WITH r AS (SELECT {_K}, l_discount, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_discount)::INT AS rank,
                          count(*) OVER (PARTITION BY l_orderkey, l_discount) > 1 AS tied FROM lineitem),
        m AS (SELECT *, max(rank) OVER (PARTITION BY l_orderkey) AS most FROM r)
        SELECT {_K}, rank, CASE WHEN tied THEN 'tied ' ELSE '' END || CASE WHEN rank = 1 THEN 'tightest' WHEN rank = most THEN 'widest' ELSE 'rank ' || rank END AS label FROM m""",
    "margin_to_best_other": f"""
        WITH r AS (SELECT {_K}, l_extendedprice AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS nth FROM lineitem),
        o AS (SELECT *, CASE WHEN nth = 1 THEN max(CASE WHEN nth = 2 THEN v END) OVER w ELSE max(v) OVER w END AS other,
                     stddev_pop(v) OVER w AS sd, avg(v) OVER w AS mean, max(v) OVER w - min(v) OVER w AS spread, count(*) OVER w AS n FROM r WINDOW w AS (PARTITION BY l_orderkey))
        SELECT {_K}, round(v - other, 4) + 0.0 AS margin, round(CASE WHEN sd > 0 THEN (v - mean) / sd ELSE 0 END, 4) + 0.0 AS z, round(spread, 4) AS spread, n,
               coalesce(v - other > 0, true) AS unique_best FROM o""",
    "tie_averaged_ranks": f"""
        SELECT {_K}, (rank() OVER (PARTITION BY l_orderkey ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_orderkey, l_discount) - 1) / 2.0)::DOUBLE AS avg_rank FROM lineitem""",
    "group_mean_centring": f"SELECT {_K}, round(l_quantity - avg(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS centred FROM lineitem",
    "history_lag": """
        SELECT o_orderkey, lag(o_totalprice) OVER w AS last_price, o_totalprice > lag(o_totalprice) OVER w AS improved,
               lag(o_orderstatus) OVER w = o_orderstatus AS same_status, (row_number() OVER w)::INT AS step,
               round(coalesce(abs(o_totalprice - lag(o_totalprice) OVER w - (o_orderkey % 7 - 3) * 1000.0::DOUBLE) / 1000.0::DOUBLE, 0), 6) AS missed_by
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "within_set_spearman": f"""{_C}, {_RHO}
        SELECT count(*) AS sets, round(avg(rho), 6) AS mean, round(median(rho), 6) AS median,
               round(tanh(sum((n - 1) * atanh(least(greatest(rho, -0.999), 0.999))) / sum(n - 1)), 6) AS fisher FROM e WHERE rho IS NOT NULL AND n > 2""",
    "rank_auc": """
        WITH r AS (SELECT lang, quality, rank() OVER (PARTITION BY lang ORDER BY n_chars) + (count(*) OVER (PARTITION BY lang, n_chars) - 1) / 2.0 AS rk
                   FROM labels JOIN documents USING (doc_id)),
        s AS (SELECT lang, sum(quality)::BIGINT AS pos, sum(1 - quality)::BIGINT AS neg, sum(CASE WHEN quality = 1 THEN rk END)::DOUBLE AS r FROM r GROUP BY 1)
        SELECT lang, pos, neg, CASE WHEN pos > 0 AND neg > 0 THEN round((r - pos * (pos + 1) / 2) / (pos * neg), 6) END AS auc FROM s""",
    "top1_by_score": f"""{_C},
        e AS (SELECT l_orderkey, arg_min(l_discount, (l_extendedprice, pos)) AS low, arg_max(l_discount, (l_extendedprice, -pos)) AS high,
                     avg(l_discount) AS random, max(l_discount) AS oracle FROM c GROUP BY 1)
        SELECT round(avg(low), 6) AS low, round(avg(high), 6) AS high, round(avg(random), 6) AS random, round(avg(oracle), 6) AS oracle, count(*) AS sets FROM e""",
    "ranking_metrics": f"""{_C}, {_RHO},
        s AS (SELECT l_orderkey, count(*) AS n, max(l_discount) AS best, avg(l_discount) AS mean, arg_max(l_discount, (l_extendedprice, -pos)) AS picked,
                     arg_max(l_discount, (l_quantity, -pos)) AS base FROM c GROUP BY 1 HAVING count(*) > 1),
        p AS (SELECT a.l_orderkey, avg((a.l_extendedprice > b.l_extendedprice)::INT::DOUBLE) AS pair_acc,
                     sum((a.l_extendedprice > b.l_extendedprice)::INT * (a.l_discount - b.l_discount)) / sum(a.l_discount - b.l_discount) AS pair_acc_w
              FROM c a JOIN c b ON a.l_orderkey = b.l_orderkey AND a.l_discount - b.l_discount > 1e-9 GROUP BY 1)
        SELECT count(*) AS sets, round(avg(picked), 6) AS picked, round(avg(best), 6) AS best, round(avg((picked >= best - 1e-9)::INT::DOUBLE), 6) AS top1,
               round(avg(best - picked), 6) AS regret, round(avg(best - mean), 6) AS regret_random, round(avg(pair_acc), 6) AS pair_acc, round(avg(pair_acc_w), 6) AS pair_acc_w,
               round(avg(CASE WHEN pair_acc IS NULL THEN NULL WHEN best > 0 THEN picked / best ELSE 1.0 END), 6) AS ndcg1,
               round(avg(CASE WHEN pair_acc IS NOT NULL THEN rho END), 6) AS rho,
               round(avg((base >= best - 1e-9)::INT::DOUBLE), 6) AS top1_baseline, round(avg(best - base), 6) AS regret_baseline
        FROM s LEFT JOIN p USING (l_orderkey) JOIN e USING (l_orderkey)""",
    "ranking_losses": """
        WITH r AS (SELECT l_orderkey, l_extendedprice / 1e5 AS s, l_discount * 10 AS y FROM lineitem),
        p AS (SELECT a.y - b.y AS gap, ln(1 + exp(b.s - a.s)) AS loss FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.y - b.y > 1e-6)
        SELECT round((SELECT avg(power(s - y, 2)) FROM r), 6) AS value_loss, round((SELECT sum(gap * loss) / sum(gap) FROM p), 6) AS ranking_loss""",
    "rank_auc_centred": """
        WITH j AS (SELECT quality, lang, n_chars FROM labels JOIN documents USING (doc_id)),
        x AS (SELECT quality AS y, round(n_chars - sum(n_chars) OVER (PARTITION BY lang) / (count(*) OVER (PARTITION BY lang))::DOUBLE, 6) AS x FROM j),
        r AS (SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r FROM x)
        SELECT sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg,
               round((sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6)::DOUBLE AS auc FROM r""",
    "ece_calibration": """
        WITH r AS (SELECT l_discount * 10 AS q, (l_returnflag = 'R')::INT::DOUBLE AS y FROM lineitem),
        b AS (SELECT least(greatest(floor(q * 10), 0), 9) AS bin, count(*) AS n, avg(q) AS q, avg(y) AS y FROM r GROUP BY 1)
        SELECT round(sum(n * abs(q - y)) / sum(n), 6) AS ece, sum(n)::BIGINT AS n FROM b""",
    "run_summary": """
        SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, round(avg((o_orderstatus = 'F')::INT::DOUBLE), 6) AS success_rate,
               round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS mean_done, count(*) FILTER (o_orderstatus = 'P') AS errors FROM orders""",
    "tiered_column_pick": f"""{_C},
        t AS (SELECT *, CASE WHEN l_discount >= 0.05 THEN 0 ELSE 1 END AS tier FROM c),
        n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY tier, l_extendedprice DESC, pos)::INT AS nth FROM t)
        SELECT l_orderkey, pos, tier, nth FROM n WHERE nth <= 2""",
    "cascade_verdict": f"""{_C},
        a AS (SELECT *, l_quantity = max(l_quantity) OVER (PARTITION BY l_orderkey) AS w1 FROM c),
        b AS (SELECT *, w1 AND l_discount = min(CASE WHEN w1 THEN l_discount END) OVER (PARTITION BY l_orderkey) AS w2 FROM a),
        d AS (SELECT *, w2 AND l_extendedprice = max(CASE WHEN w2 THEN l_extendedprice END) OVER (PARTITION BY l_orderkey) AS w3 FROM b),
        g AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (w1) AS w1, count(*) FILTER (w2) AS w2, count(*) FILTER (w3) AS w3 FROM d GROUP BY 1)
        SELECT l_orderkey, w3 AS winners, CASE WHEN w1 < n THEN 'quantity' WHEN w2 < w1 THEN 'discount' WHEN w3 < w2 THEN 'price' ELSE 'none' END AS decided_by FROM g""",
    "elimination_order": f"""{_C},
        b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, pos) AS best FROM c)
        SELECT l_orderkey, pos, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, pos)::INT AS out FROM b WHERE best > 1""",
}
