"""Scales, quantiles, splits, samples and encodings over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import samples
from ..sources.tables import table

_PROPS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_PROPS).unpivot([], _PROPS, "name", "value")


def scale_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population deviation, median, median deviation and index quartile range of each property."""
    return samples.scales(_long(spark, sf_dir), "name", "value").select("name", *(F.round(c, 6).alias(c) for c in ("std", "median", "mad", "iqr")))


def population_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = samples.quantiles(_long(spark, sf_dir), ["name"], "value", {"p1": 0.01, "p99": 0.99})
    return found.select("name", F.round("p1", 6).alias("p1"), F.round("p99", 6).alias("p99"))


def robust_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    found = samples.robust_scale(rows, ["l_quantity", "l_discount", "returned"])
    return found.select("name", F.round("centre", 6).alias("centre"), F.round("scale", 6).alias("scale"))


def index_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.index_quantiles(table(spark, sf_dir, "documents"), ["lang"], "n_chars", {"p50": 0.5, "p90": 0.9, "most": 1.0})


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = hashing.split_of("7", F.col("o_orderkey"), 0.1, 0.1)
    return table(spark, sf_dir, "orders").select("o_orderkey", split.alias("split"))


def split_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders always train, pending ones only evaluate (and go where they would train), others are split."""
    policy = F.when(F.col("o_orderstatus") == "O", "train").when(F.col("o_orderstatus") == "P", "eval").otherwise("hash")
    rows = table(spark, sf_dir, "orders").withColumn("policy", policy).withColumn("drawn", hashing.split_of("7", F.col("o_orderkey"), 0.1, 0.1))
    rows = rows.withColumn("split", F.when(F.col("policy") == "train", "train").otherwise(F.col("drawn"))).where("policy <> 'eval' OR split <> 'train'")
    return rows.groupBy("policy", "split").agg(F.count("*").alias("n"))


def authored_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = hashing.md5_uniform(F.concat(F.lit("task"), F.col("conv_id"), F.lit("|"), F.col("turn"), F.lit("|authored")))
    rows = table(spark, sf_dir, "conversations").withColumn("u", u).withColumn("fails", F.pmod("conv_id", F.lit(4)))
    return rows.where("fails > 0 AND fails <= 2 AND u < 0.4").select("conv_id", "turn")


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", hashing.stable_id(F.col("p_name")).alias("id"))


def exact_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("o_orderkey"), "s1", 100)


def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th row, then 30 of these by hash."""
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 97 = 0").select("o_orderkey")
    return samples.hash_sample(rows, F.col("o_orderkey"), "s2", 30)


def quota_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders enter while neither their status nor their priority has had 40 in their shard."""
    rows = table(spark, sf_dir, "orders").select(F.pmod("o_orderkey", F.lit(16)).alias("shard"), "o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("buckets"))
    return samples.admitted(rows, "shard", "o_orderkey", "buckets", 40)


def quota_admission_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 of each shard and status."""
    rows = table(spark, sf_dir, "orders").select(F.pmod("o_orderkey", F.lit(16)).alias("shard"), "o_orderkey", "o_orderstatus")
    nth = F.row_number().over(Window.partitionBy("shard", "o_orderstatus").orderBy("o_orderkey"))
    return rows.withColumn("nth", nth).where("nth <= 40").select("shard", "o_orderkey")


def instance_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.instances(table(spark, sf_dir, "part"), "p_partkey", ["p_size"], {"p_retailprice": 1}, seed=5)


def dense_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse features as arrays with masks; the tax is missing for every fifth part."""
    feats = F.map_filter(
        F.create_map(F.lit("qty"), F.col("l_quantity"), F.lit("disc"), F.col("l_discount"), F.lit("tax"), F.when(F.pmod("l_partkey", F.lit(5)) != 0, F.col("l_tax"))),
        lambda _, v: v.isNotNull(),
    )
    value, mask = samples.dense(feats, ["disc", "qty", "tax", "absent"])
    rows = table(spark, sf_dir, "lineitem")
    key = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return rows.select(*key, F.concat_ws(",", F.transform(value, lambda v: F.round(v * 100).cast("bigint").cast("string"))).alias("value"), F.concat_ws("", mask.cast("array<string>")).alias("mask"))


def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that differ among the lines of an order: in how many orders does each vary, by how much?"""
    key = "l_orderkey"
    long = table(spark, sf_dir, "lineitem").select(key, *_PROPS).unpivot([key], _PROPS, "name", "value")
    each = long.groupBy(key, "name").agg((F.max("value") - F.min("value")).alias("spread"))
    return each.where("spread > 1e-9").groupBy("name").agg(F.count("*").alias("orders"), F.round(F.avg("spread"), 4).alias("spread"))


def tanimoto_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five most similar sign patterns of every 50th vector: common over all set bits."""
    bits = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", bits.alias("bits"))
    asked = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("bits").alias("asked"))
    share = F.bit_count(F.col("bits").bitwiseAND(F.col("asked"))) / F.bit_count(F.col("bits").bitwiseOR(F.col("asked")))
    # queries and rows are dealt to blocks of bounded size; each pair of blocks is one key
    n = rows.count()
    blocks = {"q": max(1, -(-n // (50 * 2048))), "r": max(8, -(-n // 65536))}
    deal = lambda key, k: F.pmod(F.xxhash64(key), F.lit(blocks[k]))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks[k] - 1).cast("bigint")))
    held = rows.withColumn("r", deal("vec_id", "r")).withColumn("q", every("q"))
    met = held.join(asked.withColumn("q", deal("query_id", "q")).withColumn("r", every("r")), ["q", "r"]).where("vec_id <> query_id").withColumn("share", F.round(share, 6))
    best = lambda *by: F.row_number().over(Window.partitionBy("query_id", *by).orderBy(F.desc("share"), "vec_id"))
    some = met.withColumn("nth", best("r")).where("nth <= 5").drop("nth")
    return some.withColumn("nth", best()).where("nth <= 5").select("query_id", "nth", "vec_id", "share")


def sibling_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean similarity of each vector of a small set (ten neighbours by id) to the others of it."""
    bits = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 10).alias("set"), bits.alias("bits"))
    other = rows.select("set", F.col("vec_id").alias("o"), F.col("bits").alias("b"))
    share = F.bit_count(F.col("bits").bitwiseAND(F.col("b"))) / F.bit_count(F.col("bits").bitwiseOR(F.col("b")))
    return rows.join(other, "set").where("vec_id <> o").groupBy("vec_id").agg(F.round(F.avg(share), 6).alias("mean"))


def column_gap_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order the property whose value at the dearest line stands out most from the others' mean, in deviations."""
    key = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), *key))
    props = ["l_quantity", "l_discount", "l_tax"]
    long = table(spark, sf_dir, "lineitem").withColumn("nth", nth).select("l_orderkey", "nth", *props).unpivot(["l_orderkey", "nth"], props, "name", "value")
    each = long.groupBy("l_orderkey", "name").agg(
        F.max(F.when(F.col("nth") == 1, F.col("value"))).alias("own"), F.avg(F.when(F.col("nth") > 1, F.col("value"))).alias("others"), F.stddev_pop("value").alias("std")
    )
    each = each.where("others IS NOT NULL").withColumn("z", F.round(F.when(F.col("std") > 1e-12, F.abs(F.col("own") - F.col("others")) / F.col("std")).otherwise(0.0), 6))
    best = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("z"), "name"))
    return each.withColumn("best", best).where("best = 1").select("l_orderkey", "name", "z")


QUERIES = {
    f.__name__: f for f in (scale_basis, population_range, robust_scaling, index_percentiles, hash_split, split_policy, authored_draw, stable_ids, exact_hash_sample,
                            systematic_sample, quota_admission, quota_admission_relaxed, instance_sampler, dense_encode, constant_columns, tanimoto_topk, sibling_similarity, column_gap_pick)
}

_LONG = "l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS value FROM lineitem" for c in _PROPS) + ")"
_U = "((('0x' || substr(sha256('7::' || o_orderkey), 1, 16))::UBIGINT) % 10000)::DOUBLE / 10000.0"
_DRAWN = f"CASE WHEN {_U} < 0.1 THEN 'test' WHEN {_U} < 0.1 + 0.1 THEN 'val' ELSE 'train' END"
_M = "('0x' || substr(md5({0}), 1, 8))::BIGINT / 4294967296.0"


def _sampler_sql() -> str:
    draw = lambda what: _M.format(f"'5:' || p_partkey || ':{what}'")
    return f"""
        WITH p AS (SELECT *, {draw("mode p_size")} AS m, {draw("width p_retailprice")} AS w, {draw("take p_size")} AS u1, {draw("take p_retailprice")} AS u2 FROM part),
        b AS (SELECT p_partkey AS id, 'p_size' AS property, CASE WHEN m < 1/3.0::DOUBLE THEN p_size - 2.0 ELSE p_size END::DOUBLE AS lo,
                     CASE WHEN m < 1/3.0::DOUBLE THEN p_size + 2.0 WHEN m < 2/3.0::DOUBLE THEN p_size END::DOUBLE AS hi, u1 AS u FROM p
              UNION ALL SELECT p_partkey, 'p_retailprice', floor(p_retailprice * (1 - 0.1 * (w + 0.5)) * 10.0) / 10.0, ceil(p_retailprice * (1 + 0.1 * (w + 0.5)) * 10.0) / 10.0, u2 FROM p)
        SELECT id, property, lo, hi FROM b QUALIFY u < 0.7 OR row_number() OVER (PARTITION BY id ORDER BY u, property) = 1"""


ORACLE_SQL = {
    "scale_basis": f"""
        WITH {_LONG}, b AS (SELECT name, stddev_pop(value) AS std, median(value) AS median, list(value ORDER BY value) AS xs, count(*) AS n FROM l GROUP BY 1),
        m AS (SELECT name, median(abs(value - median)) AS mad FROM l JOIN b USING (name) GROUP BY 1)
        SELECT name, round(std, 6) AS std, round(median, 6) AS median, round(mad, 6) AS mad, round(xs[3 * n // 4 + 1] - xs[n // 4 + 1], 6) AS iqr FROM b JOIN m USING (name)""",
    "population_range": f"WITH {_LONG} SELECT name, round(quantile_cont(value, 0.01), 6) AS p1, round(quantile_cont(value, 0.99), 6) AS p99 FROM l GROUP BY 1",
    "robust_scaling": """
        WITH l AS (SELECT 'l_quantity' AS name, l_quantity AS v FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem)
        SELECT name, round(median(v), 6) AS centre, round(greatest(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 1e-3), 6) AS scale FROM l GROUP BY 1
        UNION ALL SELECT 'returned', 0.0, 1.0""",
    "index_percentiles": """
        WITH s AS (SELECT lang, list(n_chars ORDER BY n_chars) AS x, count(*) AS n FROM documents GROUP BY 1)
        SELECT lang, n, x[floor(0.5 * (n - 1))::INT + 1] AS p50, x[floor(0.9 * (n - 1))::INT + 1] AS p90, x[n] AS most FROM s""",
    "hash_split": f"SELECT o_orderkey, {_DRAWN} AS split FROM orders",
    "split_policy": f"""
        WITH r AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'train' WHEN 'P' THEN 'eval' ELSE 'hash' END AS policy, {_DRAWN} AS drawn FROM orders),
        s AS (SELECT policy, CASE WHEN policy = 'train' THEN 'train' ELSE drawn END AS split FROM r)
        SELECT policy, split, count(*) AS n FROM s WHERE policy <> 'eval' OR split <> 'train' GROUP BY 1, 2""",
    "authored_draw": f"""
        SELECT conv_id, turn FROM conversations WHERE conv_id % 4 BETWEEN 1 AND 2 AND {_M.format("'task' || conv_id || '|' || turn || '|authored'")} < 0.4""",
    "stable_ids": "SELECT p_partkey, substr(sha256(p_name), 1, 16) AS id FROM part",
    "exact_hash_sample": "SELECT o_orderkey FROM orders ORDER BY md5('s1:' || o_orderkey) LIMIT 100",
    "systematic_sample": "SELECT o_orderkey FROM orders WHERE o_orderkey % 97 = 0 ORDER BY md5('s2:' || o_orderkey) LIMIT 30",
    "quota_admission_relaxed": """
        SELECT o_orderkey % 16 AS shard, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey % 16, o_orderstatus ORDER BY o_orderkey) <= 40""",
    "instance_sampler": _sampler_sql(),
    "dense_encode": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               concat_ws(',', round(l_discount * 100)::BIGINT, round(l_quantity * 100)::BIGINT, CASE WHEN l_partkey % 5 <> 0 THEN round(l_tax * 100)::BIGINT ELSE 0 END, 0) AS value,
               '11' || (l_partkey % 5 <> 0)::INT || '0' AS mask FROM lineitem""",
    "constant_columns": "WITH " + "e AS (" + " UNION ALL ".join(f"SELECT l_orderkey, '{c}' AS name, max({c}) - min({c}) AS spread FROM lineitem GROUP BY 1" for c in _PROPS)
        + ") SELECT name, count(*) AS orders, round(avg(spread), 4) AS spread FROM e WHERE spread > 1e-9 GROUP BY 1",
    "tanimoto_topk": """
        WITH b AS (SELECT vec_id, list_reduce(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN (1::UBIGINT << (i - 1)::UBIGINT) ELSE 0::UBIGINT END), lambda a, b: a | b) AS bits FROM embeddings),
        m AS (SELECT q.vec_id AS query_id, r.vec_id, round(bit_count(q.bits & r.bits) / bit_count(q.bits | r.bits)::DOUBLE, 6) AS share FROM b q, b r WHERE q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
        SELECT query_id, nth, vec_id, share FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY share DESC, vec_id)::INT AS nth FROM m) WHERE nth <= 5""",
    "sibling_similarity": """
        WITH b AS (SELECT vec_id, vec_id // 10 AS s, list_reduce(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN (1::UBIGINT << (i - 1)::UBIGINT) ELSE 0::UBIGINT END), lambda a, b: a | b) AS bits FROM embeddings)
        SELECT a.vec_id, round(avg(bit_count(a.bits & b.bits) / bit_count(a.bits | b.bits)::DOUBLE), 6) AS mean FROM b a JOIN b ON a.s = b.s AND a.vec_id <> b.vec_id GROUP BY 1""",
    "column_gap_pick": """
        WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax) AS nth FROM lineitem),
        l AS (SELECT l_orderkey, nth, 'l_quantity' AS name, l_quantity AS v FROM n UNION ALL SELECT l_orderkey, nth, 'l_discount', l_discount FROM n UNION ALL SELECT l_orderkey, nth, 'l_tax', l_tax FROM n),
        e AS (SELECT l_orderkey, name, max(CASE WHEN nth = 1 THEN v END) AS own, avg(CASE WHEN nth > 1 THEN v END) AS others, stddev_pop(v) AS std FROM l GROUP BY 1, 2),
        z AS (SELECT l_orderkey, name, round(CASE WHEN std > 1e-12 THEN abs(own - others) / std ELSE 0 END, 6) AS z FROM e WHERE others IS NOT NULL)
        SELECT l_orderkey, name, z FROM z QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY z DESC, name) = 1""",
}
