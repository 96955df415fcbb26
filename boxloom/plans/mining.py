"""Edit rules from matched pairs: `part` items that share brand and type, size as the variable part, price as the value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pairs
from ..sources.tables import table

CONSTANT = ["p_brand", "p_type"]


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").withColumn("band", F.floor((F.col("p_size") - 1) / 10).cast("int"))
    return pairs.moments(items, CONSTANT, "band", "p_retailprice")


def matched_pair_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pairs.rules(_pairs(spark, sf_dir), ["from", "to"])
    return found.select("from", "to", "support", F.round("avg", 4).alias("avg"), F.round("std", 4).alias("std"))


def pooled_variance_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials by return flag, merged to the statistics of each line status."""
    shards = table(spark, sf_dir, "lineitem").groupBy("l_linestatus", "l_returnflag").agg(
        F.count("*").alias("n"), F.avg("l_quantity").alias("avg"), F.stddev_samp("l_quantity").alias("std")
    )
    return pairs.pooled(shards, ["l_linestatus"])


def rule_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    contexts = {0: F.lit(""), 1: F.col("p_brand"), 2: F.concat_ws("|", "p_brand", "p_type")}
    found = pairs.ladder(_pairs(spark, sf_dir), ["from", "to"], contexts, least=5, top=10)
    return found.select("from", "to", "radius", "context", "support", (F.round("avg", 4) + 0.0).alias("avg"), F.round("std", 4).alias("std"))


def deepest_context_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change expected of every transform at every part, by the most specific rule that fits."""
    contexts = {0: F.lit(""), 1: F.col("p_brand")}
    found = pairs.ladder(_pairs(spark, sf_dir), ["from", "to"], contexts, least=40, top=30)
    asked = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("wanted_key"), F.col("p_brand").alias("wanted_context"))
    best = pairs.deepest(found, asked.crossJoin(found.select("from", "to").distinct()), ["from", "to"])
    return best.select("wanted_key", "from", "to", "radius", "support", (F.round("avg", 4) + 0.0).alias("avg"))


def attach_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target band: pairs and distinct sources, the commonest first."""
    counted = _pairs(spark, sf_dir).groupBy("to").agg(F.sum("n").alias("pairs"), F.sum("sources").alias("sources"))
    return counted.orderBy(F.desc("sources"), F.desc("pairs"), "to").limit(4)


def pair_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pairs of a customer's and a supplier's nation, with names: several joins and self-joined dimensions."""
    nation = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows
    a = nation.select(F.col("n_nationkey").alias("a_key"), F.col("n_name").alias("a_name"), F.col("r_name").alias("a_region"))
    b = nation.select(F.col("n_nationkey").alias("b_key"), F.col("n_name").alias("b_name"))
    flow = (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("pairs"), F.sum("l_quantity").alias("quantity"))
    )
    named = flow.join(F.broadcast(a), F.col("c_nationkey") == F.col("a_key")).join(F.broadcast(b), F.col("s_nationkey") == F.col("b_key"))
    return named.where("a_key <> b_key").select("a_name", "a_region", "b_name", "pairs", F.round("quantity", 2).alias("quantity"))


def eav_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties as (key, name, value) rows, and back to one column each."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    long = rows.unpivot(["p_partkey"], ["size", "price"], "name", "value")
    return long.groupBy("p_partkey").pivot("name", ["price", "size"]).agg(F.first("value"))


QUERIES = {f.__name__: f for f in (matched_pair_selfjoin, pooled_variance_merge, rule_ladder, deepest_context_lookup, attach_library, pair_export, eav_pivot)}

_PAIRS_SQL = """
        WITH i AS (SELECT *, floor((p_size - 1) / 10)::INT AS band FROM part),
        p AS (SELECT a.p_brand, a.p_type, a.p_partkey AS from_key, a.band AS "from", b.band AS "to", b.p_retailprice - a.p_retailprice AS delta
              FROM i a JOIN i b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.band <> b.band)"""
_LADDER_SQL = """
        t AS (SELECT "from", "to" FROM p GROUP BY ALL ORDER BY count(*) DESC, "from", "to" LIMIT {top}),
        x AS (SELECT p.*, radius, context FROM p JOIN t USING ("from", "to"), LATERAL (SELECT * FROM (VALUES {levels}) v(radius, context))),
        l AS (SELECT "from", "to", radius, context, count(*) AS support, avg(delta) AS avg, coalesce(stddev_samp(delta), 0) AS std
              FROM x GROUP BY ALL HAVING count(*) >= {least})"""

ORACLE_SQL = {
    "matched_pair_selfjoin": f"""{_PAIRS_SQL}
        SELECT "from", "to", count(*) AS support, round(avg(delta), 4) AS avg, round(coalesce(stddev_samp(delta), 0), 4) AS std FROM p GROUP BY ALL""",
    "pooled_variance_merge": """
        SELECT l_linestatus, count(*) AS n, round(avg(l_quantity), 4) AS avg, round(stddev_samp(l_quantity), 4) AS std FROM lineitem GROUP BY 1""",
    "rule_ladder": f"""{_PAIRS_SQL},{_LADDER_SQL.format(top=10, least=5, levels="(0, ''), (1, p_brand), (2, p_brand || '|' || p_type)")}
        SELECT "from", "to", radius, context, support, round(avg, 4) + 0.0 AS avg, round(std, 4) AS std FROM l""",
    "deepest_context_lookup": f"""{_PAIRS_SQL},{_LADDER_SQL.format(top=30, least=40, levels="(0, ''), (1, p_brand)")},
        w AS (SELECT p_partkey AS wanted_key, p_brand AS wanted_context FROM part)
        SELECT wanted_key, "from", "to", radius, support, round(avg, 4) + 0.0 AS avg FROM w, l WHERE radius = 0 OR context = wanted_context
        QUALIFY row_number() OVER (PARTITION BY wanted_key, "from", "to" ORDER BY radius DESC, support DESC) = 1""",
    "attach_library": f"""{_PAIRS_SQL}
        SELECT "to", count(*) AS pairs, count(DISTINCT from_key) AS sources FROM p GROUP BY 1 ORDER BY sources DESC, pairs DESC, "to" LIMIT 4""",
    "pair_export": """
        SELECT a.n_name AS a_name, r_name AS a_region, b.n_name AS b_name, count(*) AS pairs, round(sum(l_quantity), 2) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation a ON c_nationkey = a.n_nationkey JOIN region ON a.n_regionkey = r_regionkey JOIN nation b ON s_nationkey = b.n_nationkey
        WHERE a.n_nationkey <> b.n_nationkey GROUP BY 1, 2, 3""",
    "eav_pivot": "SELECT p_partkey, p_retailprice AS price, p_size::DOUBLE AS size FROM part",
}
