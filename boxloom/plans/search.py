"""Tree and search queries: region > nation > customer > order as a tree, parts as instances that move towards a size box."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import corpus, pairwise, trees
from ..sources.tables import table


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of status P, customers with a low balance and the nation of key 7 are satisfied."""
    row = lambda i, p, level, sat: [i.alias("id"), p.cast("string").alias("parent"), F.lit(level).alias("level"), sat.cast("int").alias("sat")]
    root = spark.range(1).select(*row(F.lit("root"), F.lit(None), 0, F.lit(0)))
    regions = table(spark, sf_dir, "region").select(*row(F.concat(F.lit("r"), "r_regionkey"), F.lit("root"), 1, F.lit(0)))
    nations = table(spark, sf_dir, "nation").select(*row(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), 2, F.col("n_nationkey") == 7))
    customers = table(spark, sf_dir, "customer").select(*row(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"), 3, F.col("c_acctbal") < 0))
    orders = table(spark, sf_dir, "orders").select(*row(F.concat(F.lit("o"), "o_orderkey"), F.concat(F.lit("c"), "o_custkey"), 4, F.col("o_orderstatus") == "P"))
    return root.unionByName(regions).unionByName(nations).unionByName(customers).unionByName(orders)


def tree_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trees.rollup(_tree(spark, sf_dir), 4).where("level < 4")
    return found.select("id", "n_children", "n_leaf", "n_sat", "min_depth", F.round("sat_ratio", 6).alias("sat_ratio"))


def depth_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trees.rollup(_tree(spark, sf_dir), 4)
    return found.groupBy("level").agg(F.count("*").alias("nodes"), F.round(F.avg("sat_ratio"), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp("sat_ratio"), F.lit(0.0)), 6).alias("std"))


def icc_by_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order values: how much of their variance lies between customers, by status."""
    found = trees.between_within(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", ["o_orderstatus"])
    return found.select("o_orderstatus", "n", "groups", F.round("icc", 6).alias("icc"))


def parent_child_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision sets: nations of two or more customers of which some are satisfied, with their region."""
    tree = _tree(spark, sf_dir)
    sets = tree.where("level = 3").groupBy("parent").agg(F.count("*").alias("n"), F.avg("sat").alias("share")).where("n >= 2 AND share > 0")
    parents = tree.where("level = 2").select(F.col("id").alias("state"), F.col("parent").alias("region"))
    return sets.join(parents, F.col("parent") == F.col("state")).select("state", "region", "n", F.round("share", 6).alias("share"))


def decision_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States down to level 2 with two or more children, of which one at least reaches a satisfied leaf."""
    nodes = trees.rollup(_tree(spark, sf_dir), 4)
    found = trees.decisions(nodes, least=2, deepest=2)
    return found.select("state", "level", "n", F.round("best", 6).alias("best"))


_EDITS = [("a", 7.0), ("b", -5.0), ("c", 3.0)]


def _instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part")
    return rows.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("value"), F.lit(24.0).alias("lo"), F.lit(24.5).alias("hi"))


def search(width: int | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    finder = trees.Search(spark.createDataFrame(_EDITS, "edit string, delta double"))
    found = finder.run(_instances(spark, sf_dir), 3, width)
    return found.select("id", "value", "gap", F.size("path").alias("steps"), F.array_join("path", ">").alias("path"), "cost")


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    finder = trees.Search(spark.createDataFrame(_EDITS, "edit string, delta double"))
    found = finder.hybrid(_instances(spark, sf_dir), 3, 2)
    return found.select("id", "value", "gap", F.size("path").alias("steps"), F.array_join("path", ">").alias("path"), "cost")


def search_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random walk of three edits, its best prefix."""
    finder = trees.Search(spark.createDataFrame(_EDITS, "edit string, delta double"))
    found = finder.run(_instances(spark, sf_dir), 3, 1, draw="4")
    return found.select("id", "value", "gap", F.size("path").alias("steps"), F.array_join("path", ">").alias("path"), "cost")


def candidate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each first edit leads to within three."""
    finder = trees.Search(spark.createDataFrame(_EDITS, "edit string, delta double"))
    return finder.labels(_instances(spark, sf_dir), 3)


def pairwise_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of price, tax and line number tells the larger discount of two lines of an order."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_discount", (F.col("l_extendedprice") / 1e5).alias("price"), (F.col("l_tax") * 10).alias("tax"), F.col("l_linenumber").alias("line"))
    found = pairwise.importance(rows, "l_orderkey", "l_discount", ["price", "tax", "line"], folds=2, most=20_000)
    return spark.createDataFrame(found, "feature string, accuracy double, loss double")


def repaired_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made stored and recomputed replies: kept where the recomputed one is empty or lacks what was committed."""
    old, fresh = F.array("p_brand"), F.slice(F.array("p_type", "p_brand"), 1, F.pmod("p_size", F.lit(3)).cast("int"))
    committed = F.when(F.pmod("p_partkey", F.lit(4)) == 0, F.col("p_brand")).when(F.pmod("p_partkey", F.lit(4)) == 1, F.col("p_type"))
    kept, why = corpus.repaired(old, fresh, committed)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(kept, ",").alias("reply"), why.alias("why"))


def accepted_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made revisions with their numbers of violations: taken while each has strictly fewer than the one before."""
    step = lambda i, m: F.struct(F.concat(F.lit("v"), i.cast("string")).alias("text"), F.pmod(F.col("p_partkey") * i + F.col("p_size"), F.lit(m)).cast("int").alias("violations"))
    revisions = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: step(i, 5))
    best = corpus.accepted_revision(F.lit("v0"), F.pmod("p_size", F.lit(5)).cast("int"), revisions)
    return table(spark, sf_dir, "part").select("p_partkey", best["text"].alias("text"), best["violations"].alias("violations"))


def beam_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pruning: of each customer's orders the two nearest to a price of 150,000."""
    gap = F.abs(F.col("o_totalprice") - 150000.0)
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("gap", "o_orderkey"))
    return table(spark, sf_dir, "orders").withColumn("gap", gap).withColumn("nth", nth).where("nth <= 2").select("o_custkey", "o_orderkey", "nth", F.round("gap", 4).alias("gap"))


def trajectory_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's orders the one of best status, ties to the lower price."""
    rank = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    best = F.max_by("o_orderkey", F.struct(rank, -F.col("o_totalprice"), -F.col("o_orderkey")))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(best.alias("o_orderkey"))


def trajectory_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's orders one, drawn evenly by a seeded hash."""
    drawn = F.min_by("o_orderkey", F.struct(F.md5(F.concat_ws(":", F.lit("9"), "o_custkey", "o_orderkey").cast("binary")), "o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(drawn.alias("o_orderkey"))


def trajectory_most_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's orders the one that holds most boxes, ties to the smaller gap of its price, then to the smaller key."""
    price = F.col("o_totalprice")
    held = price.between(100000, 200000).cast("int") + (F.col("o_orderstatus") == "F").cast("int") + F.col("o_orderpriority").startswith("1").cast("int")
    gap = F.greatest(F.lit(0.0), 100000.0 - price, price - 200000.0)
    best = F.min_by(F.struct("o_orderkey", held.alias("held")), F.struct(-held, gap, "o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(best.alias("b")).select("o_custkey", "b.o_orderkey", "b.held")


QUERIES = {f.__name__: f for f in (tree_rollup, depth_summary, icc_by_depth, parent_child_states, decision_sets, trajectory_random, trajectory_most_boxes, hybrid_search, search_random, candidate_labels, pairwise_importance, repaired_replies, accepted_revisions, beam_step,
                               trajectory_select)} | {
    "search_greedy": partial(search, 1), "search_beam": partial(search, 2), "search_exhaustive": partial(search, None),
}

def _level_sql(name: str, below: str, level: int) -> str:
    """`name` (id, parent, sat) with the sums of its children in `below`."""
    return f"""SELECT x.id, any_value(x.parent) AS parent, {level} AS level, count(b.id) AS n_children,
               CASE WHEN any_value(x.sat) = 1 OR count(b.id) = 0 THEN 1 ELSE sum(b.n_leaf) END AS n_leaf,
               CASE WHEN any_value(x.sat) = 1 OR count(b.id) = 0 THEN any_value(x.sat) ELSE sum(b.n_sat) END AS n_sat,
               CASE WHEN any_value(x.sat) = 1 THEN {level} ELSE min(b.min_depth) END AS min_depth
               FROM {name} x LEFT JOIN {below} b ON b.parent = x.id GROUP BY x.id"""


_TREE = f"""o4 AS (SELECT 'o' || o_orderkey AS id, 'c' || o_custkey AS parent, 4 AS level, 0 AS n_children, 1 AS n_leaf, (o_orderstatus = 'P')::INT AS n_sat,
                     CASE WHEN o_orderstatus = 'P' THEN 4 END AS min_depth FROM orders),
        c AS (SELECT 'c' || c_custkey AS id, 'n' || c_nationkey AS parent, (c_acctbal < 0)::INT AS sat FROM customer),
        n AS (SELECT 'n' || n_nationkey AS id, 'r' || n_regionkey AS parent, (n_nationkey = 7)::INT AS sat FROM nation),
        r AS (SELECT 'r' || r_regionkey AS id, 'root' AS parent, 0 AS sat FROM region),
        z AS (SELECT 'root' AS id, NULL::VARCHAR AS parent, 0 AS sat),
        c3 AS ({_level_sql("c", "o4", 3)}), n2 AS ({_level_sql("n", "c3", 2)}), r1 AS ({_level_sql("r", "n2", 1)}), z0 AS ({_level_sql("z", "r1", 0)}),
        t AS (SELECT * FROM o4 UNION ALL SELECT * FROM c3 UNION ALL SELECT * FROM n2 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM z0)"""


_START = "SELECT p_partkey AS id, p_size::DOUBLE AS value, greatest(0.0, 24.0 - p_size, p_size - 24.5) AS gap, '' AS path, 0 AS steps, [p_size::DOUBLE] AS seen FROM part"
_EDITS_SQL = "(VALUES ('a', 7.0::DOUBLE), ('b', -5.0::DOUBLE), ('c', 3.0::DOUBLE)) e(edit, delta)"


def _levels(w: int | None, name: str, start: str = _START, depth: int = 3, draw: str | None = None) -> str:
    """Searches level by level: `<name>b` has the best state and the cost of each instance."""
    out = [f"{name}0 AS ({start})"]
    for k in range(depth):
        front = f"SELECT * FROM {name}{k} WHERE gap > 0" + (f" AND id NOT IN (SELECT id FROM {name}l{k - 1} WHERE gap = 0)" if k else "")
        before = " UNION ALL ".join(f"SELECT id, value FROM {name}l{j}" for j in range(k))
        again = f"SELECT * FROM {name}x{k} x WHERE NOT EXISTS (SELECT 1 FROM ({before}) y WHERE y.id = x.id AND y.value = x.value)" if k and w and w > 1 else f"SELECT * FROM {name}x{k}"
        once = "QUALIFY row_number() OVER (PARTITION BY id, value ORDER BY gap, steps, path) = 1" if w is not None else ""
        order = f"md5('{draw}:' || id || ':' || path)" if draw else "gap, steps, path"
        drawn = f"SELECT * FROM ({again} {once}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1" if draw else f"{again} {once}"
        out.append(f"""{name}x{k} AS (SELECT id, value + delta AS value, greatest(0.0, 24.0 - (value + delta), value + delta - 24.5) AS gap,
               CASE WHEN path = '' THEN edit ELSE path || '>' || edit END AS path, steps + 1 AS steps, list_append(seen, value + delta) AS seen
               FROM ({front}), {_EDITS_SQL} WHERE NOT list_contains(seen, value + delta)),
               {name}l{k} AS ({drawn})""")
        cut = f"QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) <= {w}" if w is not None else ""
        out.append(f"{name}{k + 1} AS (SELECT * FROM {name}l{k} {cut})")
    union = " UNION ALL ".join([f"SELECT * FROM {name}0", *(f"SELECT * FROM {name}l{k}" for k in range(depth))])
    out.append(f"{name}u AS ({union}), {name}b AS (SELECT *, count(*) OVER (PARTITION BY id) AS cost FROM {name}u QUALIFY row_number() OVER (PARTITION BY id ORDER BY gap, steps, path) = 1)")
    return ", ".join(out)


def _search_sql(width: int | None, draw: str | None = None) -> str:
    return f"WITH {_levels(width, 's', draw=draw)} SELECT id, value, gap, steps, path, cost FROM sb"


_HYBRID_SQL = f"""WITH {_levels(1, "g")}, {_levels(2, "b")}, u AS (SELECT * FROM gb UNION ALL SELECT * FROM bb WHERE id IN (SELECT id FROM gb WHERE gap > 0))
        SELECT id, value, gap, steps, path, (sum(cost) OVER (PARTITION BY id))::BIGINT AS cost FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY gap, steps, path) = 1"""
_CHILDREN = f"""SELECT id || '|' || edit AS id, value + delta AS value, greatest(0.0, 24.0 - (value + delta), value + delta - 24.5) AS gap, '' AS path, 0 AS steps, [value + delta] AS seen
        FROM ({_START}), {_EDITS_SQL} WHERE gap > 0"""
_LABELS_SQL = f"""WITH {_levels(None, "f", _CHILDREN, 2)}, {_levels(1, "g", _CHILDREN, 2)}
        SELECT split_part(fb.id, '|', 1)::BIGINT AS id, split_part(fb.id, '|', 2) AS edit, fb.gap = 0 AS y_success, CASE WHEN fb.gap = 0 THEN fb.steps + 1 END AS y_short, gb.gap = 0 AS y_greedy
        FROM fb JOIN gb ON fb.id = gb.id"""


ORACLE_SQL = {
    "tree_rollup": f"""WITH {_TREE} SELECT id, n_children::BIGINT AS n_children, n_leaf::BIGINT AS n_leaf, n_sat::BIGINT AS n_sat, min_depth,
        round(n_sat / n_leaf::DOUBLE, 6) AS sat_ratio FROM t WHERE level < 4""",
    "depth_summary": f"""WITH {_TREE} SELECT level, count(*) AS nodes, round(avg(n_sat / n_leaf::DOUBLE), 6) AS mean, round(coalesce(stddev_samp(n_sat / n_leaf::DOUBLE), 0), 6) AS std FROM t GROUP BY 1""",
    "icc_by_depth": """
        WITH e AS (SELECT o_orderstatus, o_custkey, count(*) AS n, sum(o_totalprice) AS s, sum(o_totalprice * o_totalprice) AS q FROM orders GROUP BY 1, 2),
        t AS (SELECT o_orderstatus, sum(n)::BIGINT AS n, count(*) AS groups, sum(s) AS s, sum(s * s / n) AS m, sum(q) AS q FROM e GROUP BY 1)
        SELECT o_orderstatus, n, groups, round((m - s * s / n) / (q - s * s / n), 6) AS icc FROM t""",
    "parent_child_states": """
        SELECT 'n' || n_nationkey AS state, 'r' || n_regionkey AS region, count(*) AS n, round(avg((c_acctbal < 0)::INT), 6) AS share
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 HAVING count(*) >= 2 AND avg((c_acctbal < 0)::INT) > 0""",
    "decision_sets": f"""WITH {_TREE} SELECT p.id AS state, p.level, count(*) AS n, round(max(k.n_sat / k.n_leaf::DOUBLE), 6) AS best
        FROM t k JOIN t p ON k.parent = p.id WHERE p.level <= 2 GROUP BY 1, 2 HAVING count(*) >= 2 AND max(k.n_sat) > 0""",
    "trajectory_random": """
        SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY md5('9:' || o_custkey || ':' || o_orderkey), o_orderkey) = 1""",
    "trajectory_most_boxes": """
        WITH h AS (SELECT o_custkey, o_orderkey, greatest(0.0, 100000.0 - o_totalprice, o_totalprice - 200000.0) AS gap,
                          (o_totalprice BETWEEN 100000 AND 200000)::INT + (o_orderstatus = 'F')::INT + (o_orderpriority LIKE '1%')::INT AS held FROM orders)
        SELECT o_custkey, o_orderkey, held FROM h QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY held DESC, gap, o_orderkey) = 1""",
    "hybrid_search": _HYBRID_SQL,
    "search_random": _search_sql(1, draw="4"),
    "candidate_labels": _LABELS_SQL,
    "repaired_replies": """
        WITH p AS (SELECT p_partkey, p_brand AS old, ([p_type, p_brand])[1:p_size % 3] AS fresh, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_type END AS c FROM part),
        w AS (SELECT *, CASE WHEN c IS NOT NULL AND NOT list_contains(fresh, c) THEN 'still_missing' WHEN len(fresh) = 0 THEN 'still_empty'
                             WHEN fresh = [old] THEN 'identical' ELSE 'rewritten' END AS why FROM p)
        SELECT p_partkey, CASE WHEN why IN ('still_missing', 'still_empty') THEN old ELSE array_to_string(fresh, ',') END AS reply, why FROM w""",
    "accepted_revisions": """
        WITH r AS (SELECT p_partkey, [p_size % 5] || list_transform(range(1, 5), lambda i: (p_partkey * i + p_size) % 5) AS v FROM part),
        n AS (SELECT p_partkey, v, CASE WHEN v[1] > 0 AND v[2] < v[1] THEN CASE WHEN v[2] > 0 AND v[3] < v[2] THEN CASE WHEN v[3] > 0 AND v[4] < v[3] THEN
                     CASE WHEN v[4] > 0 AND v[5] < v[4] THEN 4 ELSE 3 END ELSE 2 END ELSE 1 END ELSE 0 END AS k FROM r)
        SELECT p_partkey, 'v' || k AS text, v[k + 1]::INT AS violations FROM n""",
    "beam_step": """
        SELECT o_custkey, o_orderkey, nth, round(gap, 4) AS gap FROM (SELECT *, abs(o_totalprice - 150000.0) AS gap,
            row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_totalprice - 150000.0), o_orderkey)::INT AS nth FROM orders) WHERE nth <= 2""",
    "trajectory_select": """
        SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END DESC, o_totalprice, o_orderkey) = 1""",
    "search_greedy": _search_sql(1), "search_beam": _search_sql(2), "search_exhaustive": _search_sql(None),
}
