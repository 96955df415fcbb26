"""Filters and selections over the supplied tables: lines of an order are candidates, their numbers the columns."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import box
from ..functions.hashing import blake_uniform, md5_uniform
from ..operators import selection
from ..sources.tables import table

COLUMNS = {"a_qty": "l_quantity", "b_price": "l_extendedprice / 1000", "c_disc": "l_discount * 100", "d_tax": "l_tax * 100"}


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, pos, best, worst, col, v): best is the dearest line of an order, worst the cheapest other one."""
    lines = table(spark, sf_dir, "lineitem")
    own = Window.partitionBy("l_orderkey")
    ties = ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity", "l_tax")
    place = F.row_number().over(own.orderBy(*ties))
    rows = lines.select("l_orderkey", "l_extendedprice", place.alias("pos"), *(F.round(F.expr(e), 6).alias(c) for c, e in COLUMNS.items()))
    rows = rows.withColumn("best", F.row_number().over(own.orderBy(F.desc("l_extendedprice"), "pos")) == 1)
    rows = rows.withColumn("worst", F.row_number().over(own.orderBy("best", "l_extendedprice", "pos")) == 1)
    rows = rows.withColumn("n", F.count("*").over(own)).where("n > 1")
    return rows.unpivot(["l_orderkey", "pos", "best", "worst", "n"], list(COLUMNS), "col", "v")


def column_picks(scaled: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns that set the best candidate apart and don't say the same."""
    ties = ("l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_quantity", "l_tax")
    order = [F.desc_nulls_last("l_extendedprice"), *(F.asc_nulls_last(c) for c in ties)]
    return selection.separated_picks(table(spark, sf_dir, "lineitem"), "l_orderkey", {c: F.round(F.expr(e), 6) for c, e in COLUMNS.items()}, order, k=2, scaled=scaled)


def gate_picks(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns by their gates: the largest, or those of largest spread."""
    rows = _long(spark, sf_dir)
    return selection.distinct_picks(selection.gate(rows, "l_orderkey", "col", "v", mode), rows, "l_orderkey", "pos", "col", "v", k=2)


def visible_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many orders each column that isn't hidden varies."""
    return selection.live(_long(spark, sf_dir), "l_orderkey", "col", "v", hidden=("d_",)).groupBy("col").agg(F.count_distinct("l_orderkey").alias("orders"))


def axis_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column in which the worst candidate is smallest, and that in which the best is largest among those that stay."""
    rows = selection.live(_long(spark, sf_dir), "l_orderkey", "col", "v")
    sift = selection.axis(rows, "l_orderkey", "col", "v", F.col("worst"), largest=False).withColumnRenamed("col", "sift")
    weigh = selection.axis(rows, "l_orderkey", "col", "v", F.col("best"), largest=True).withColumnRenamed("col", "weigh")
    return sift.join(weigh, "l_orderkey")


def moved_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three columns that most lines of an order move."""
    return selection.moved(_long(spark, sf_dir), "l_orderkey", "col", "v", most=3).select("l_orderkey", "place", "col", "n", "total")


def absolute_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute correlation of any two columns over an order's lines, 0 where one is flat; summed by pair."""
    each = selection.resemblance(_long(spark, sf_dir), "l_orderkey", "pos", "col", "v").where("col < other")
    return each.groupBy("col", "other").agg(F.count("*").alias("orders"), F.round(F.avg("rho"), 5).alias("mean"))


def random_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edits of each brand that pass the guard, uniformly."""
    allowed = table(spark, sf_dir, "part").where("p_size >= 5").select("p_partkey", "p_brand")
    return selection.drawn(allowed, ["p_brand"], F.col("p_partkey"), "7", 4)


def random_rivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rival of the best line of each order, and one column, uniformly."""
    rivals = _long(spark, sf_dir).where("NOT best")
    return selection.drawn(rivals, ["l_orderkey"], F.concat_ws(":", "l_orderkey", "pos", "col"), "3", 1).select("l_orderkey", "pos", "col")


def pair_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 5,000 of all pairs of lines within orders, by hash."""
    lines = _long(spark, sf_dir).where("col = 'a_qty'")
    a, b = lines.select("l_orderkey", F.col("pos").alias("a")), lines.select("l_orderkey", F.col("pos").alias("b"))
    pairs = a.join(b, "l_orderkey").where("a < b")
    draw = F.md5(F.concat_ws(":", F.lit("1"), "l_orderkey", "a", "b").cast("binary"))
    return pairs.withColumn("draw", draw).orderBy("draw").limit(5000).drop("draw")


GROUPS = {"comma": ",", "digit": "[0-9]", "stop": "[.]", "ask": "[?]"}


def _counts():
    return F.create_map(*(x for name, pattern in GROUPS.items() for x in (F.lit(name), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(pattern)))))


def group_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of groups against queries: at least, exactly, and one that names an unknown group."""
    known = set(GROUPS)
    return table(spark, sf_dir, "documents").select(
        "doc_id", selection.holds(_counts(), [("comma", ">=", 3), ("stop", ">=", 2)], known).alias("at_least"),
        selection.holds(_counts(), [("digit", "==", 0)], known).alias("exactly"), selection.holds(_counts(), [("comma", ">=", 1), ("none", "==", 0)], known).alias("unresolved"),
    )


def group_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's groups by count, and the two rarest, most common and drawn ones."""
    rate = {"comma": 0.9, "digit": 0.2, "stop": 0.95}
    pick = lambda how: F.array_join(selection.chosen_groups(F.col("counts"), how, rate, 2, "5", F.col("doc_id")), ",")
    ordered = F.array_join(F.transform(selection.sorted_groups(F.col("counts")), lambda e: F.concat(e["name"], F.lit(":"), e["count"])), ",")
    docs = table(spark, sf_dir, "documents").select("doc_id", _counts().alias("counts"))
    return docs.select("doc_id", ordered.alias("ordered"), pick("rarest").alias("rarest"), pick("common").alias("common"), pick("random").alias("random"))


def group_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean length of documents by group that they contain, of groups with 30 documents at least."""
    docs = table(spark, sf_dir, "documents").select("n_chars", F.explode(_counts()).alias("name", "count")).where("count > 0")
    return docs.groupBy("name").agg(F.count("*").alias("docs"), F.round(F.avg("n_chars"), 4).alias("mean_chars"), F.sum("count").cast("bigint").alias("total")).where("docs >= 30")


def task_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose properties parse, of some kinds, with a key below 50."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase", "error") & (F.col("event_type") != "") & k.isNotNull() & (k < 50)).select("event_id", "event_type")


def failed_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that are no failures: no flag is false, no violation is stated."""
    scaffold = F.when(F.pmod("p_partkey", F.lit(3)) == 0, F.pmod("p_partkey", F.lit(2)) == 0)
    group = F.when(F.pmod("p_partkey", F.lit(5)) == 0, F.col("p_size") > 10)
    violations = F.when(F.pmod("p_partkey", F.lit(7)) == 0, F.filter(F.array("p_type", "p_brand"), lambda s: s.endswith("3")))
    return table(spark, sf_dir, "part").where(~selection.failed([scaffold, group], violations)).select("p_partkey")


def empty_reply_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations none of whose questions has a reply of under 150 characters."""
    turns = selection.followed(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", "turn", {"text": "reply", "role": "replier"})
    bad = F.count_if((F.col("role") == "user") & (F.col("replier") == "assistant") & (F.length("reply") < 150))
    return turns.groupBy("conv_id").agg(F.count("*").alias("turns"), bad.alias("bad")).where("bad = 0").select("conv_id", "turns")


def authored_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of few words that follow a question, with what was asked."""
    turns = selection.followed(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", "turn", {"text": "asked", "role": "asker"}, -1)
    few = F.size(F.split(F.trim("text"), " ")) <= 30
    return turns.where((F.col("role") == "assistant") & (F.col("asker") == "user") & few).select("conv_id", "turn", F.md5(F.col("asked").cast("binary")).alias("asked"))


def strict_or_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that hold strictly, or loosely where nothing strict is known, in hash order."""
    strict = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    ok = F.coalesce(strict, F.col("o_totalprice") > 200000, F.lit(False))
    return table(spark, sf_dir, "orders").where(ok).select("o_orderkey", F.round(md5_uniform(F.concat(F.lit("9:"), "o_orderkey")), 9).alias("place"))


def oversize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents short enough for a model call."""
    return table(spark, sf_dir, "documents").where(F.length("text") <= 4000).select("doc_id")


def reply_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th call of a message (here each word before a comma) is answered by the message k + 1 places later."""
    turns = table(spark, sf_dir, "conversations")
    calls = turns.where("role = 'assistant'").select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit("([a-z]+),"), F.lit(1))).alias("k", "call"))
    replies = turns.select("conv_id", (F.col("turn")).alias("at"), F.col("role").alias("replier"))
    found = calls.withColumn("at", F.col("turn") + 1 + F.col("k")).join(replies, ["conv_id", "at"])
    return found.groupBy("replier", "k").agg(F.count("*").alias("n"), F.count_distinct("call").alias("calls"))


def max_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far outside each part's own box (price within 5 %) the population gets."""
    part = table(spark, sf_dir, "part")
    pool = part.agg(F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))  # one row
    far = F.greatest(F.col("p_retailprice") * 0.95 - F.col("low"), F.col("high") - F.col("p_retailprice") * 1.05, F.lit(1e-9))
    return part.crossJoin(F.broadcast(pool)).select("p_partkey", F.round(far, 6).alias("deviation"))


def safe_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values to three places; those that aren't finite are null."""
    odd = F.when(F.pmod("event_id", F.lit(11)) == 0, F.lit(float("nan"))).when(F.pmod("event_id", F.lit(13)) == 0, F.lit(float("inf"))).otherwise(F.col("value") / 7)
    return table(spark, sf_dir, "events").select("event_id", selection.safe_round(odd, 3).alias("value"))


def landing_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each edit lands: boxes held safely, held, broken, overshoot past the far edge, share of the gap closed."""
    now, boxes = {"size": 25.0, "price": 1500.0}, {"size": (20.0, 30.0), "price": (1200.0, 1400.0)}
    after = {"size": F.col("p_size").cast("double"), "price": 1500.0 + (F.col("p_retailprice") - 1000.0)}
    std = {"size": F.pmod("p_partkey", F.lit(5)) + 1.0, "price": F.pmod("p_partkey", F.lit(7)) * 10 + 5.0}
    inside = {p: (after[p] >= lo) & (after[p] <= hi) for p, (lo, hi) in boxes.items()}
    safe = [inside[p] & (F.least(after[p] - lo, F.lit(hi) - after[p]) >= std[p]) for p, (lo, hi) in boxes.items()]
    broken = [~inside[p] for p, (lo, hi) in boxes.items() if lo <= now[p] <= hi]
    over = [F.greatest(F.lit(0.0), F.lit(lo) - after[p]) if now[p] > hi else F.greatest(F.lit(0.0), after[p] - hi) for p, (lo, hi) in boxes.items() if not lo <= now[p] <= hi]
    off = [box.distance(after[p], F.lit(lo), F.lit(hi)) / (hi - lo) for p, (lo, hi) in boxes.items()]
    before = sum(max(0.0, lo - now[p], now[p] - hi) / (hi - lo) for p, (lo, hi) in boxes.items())
    number = lambda tests: box.total([t.cast("int") for t in tests])
    return table(spark, sf_dir, "part").select(
        "p_partkey", number(safe).alias("safe"), number(list(inside.values())).alias("held"), number(broken).alias("breaks"),
        F.round(box.total(over), 6).alias("overshoot"), F.round((before - box.total(off)) / before, 6).alias("closed"),
    )


def attach_library_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support and distinct sources of each brand, pooled over shards (return flags) of which each gives partial sums."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    partial_ = lines.join(brands, "l_partkey").groupBy("l_returnflag", "p_brand", "p_type").agg(F.count("*").alias("pairs"))
    pooled = partial_.groupBy("p_brand").agg(F.sum("pairs").alias("support"), F.count_distinct("p_type").alias("sources"), F.count_distinct("l_returnflag").alias("shards"))
    return pooled.orderBy(F.desc("sources"), F.desc("support"), "p_brand").limit(20)


def rule_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part and supplier, for a list of brands: statistics by brand and nation."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf_dir, "part").where(F.col("p_brand").isin("Brand#13", "Brand#5", "Brand#21")).select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("p_brand", "s_nationkey").agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("avg"))


def targets_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of each customer as their target; customers without one have none."""
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("target"))
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "target")


def catalog_subsumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a brand, without the narrow ones whose broader type the brand has, too."""
    pairs = [("SMALL", "STANDARD"), ("MEDIUM", "STANDARD"), ("ECONOMY", "PROMO")]
    covers = F.broadcast(spark.createDataFrame(pairs, "p_type string, broad string"))
    has = table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()
    covered = has.join(covers, "p_type").join(has.select("p_brand", F.col("p_type").alias("broad")), ["p_brand", "broad"], "left_semi").select("p_brand", "p_type")
    return has.join(covered, ["p_brand", "p_type"], "left_anti")


def restoration_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 largest parts of each brand, the order in which they are tried."""
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("p_size"), F.desc("p_retailprice"), "p_partkey"))
    return table(spark, sf_dir, "part").withColumn("place", place).where("place <= 25").select("p_brand", "place", "p_partkey")


def blake_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test, then val, then train, by 64 bits of a BLAKE2b of seed and customer; and a wording and its parity by the same hash."""
    u = blake_uniform("11", F.col("c_custkey"))
    split = F.when(u < 0.1, "test").when(u < 0.2, "val").otherwise("train")
    wording = F.floor(blake_uniform("wording", F.col("c_custkey")) * 8).cast("int")
    return table(spark, sf_dir, "customer").select("c_custkey", split.alias("split"), wording.alias("wording"), F.pmod(wording, F.lit(2)).alias("style"))


QUERIES = {
    "column_picks": partial(column_picks, False), "column_picks_scaled": partial(column_picks, True),
    "gate_picks_max": partial(gate_picks, "max"), "gate_picks_spread": partial(gate_picks, "spread"),
    **{f.__name__: f for f in (visible_pool, axis_choice, moved_groups, absolute_correlation, random_edits, random_rivals, pair_subsample, group_predicate, group_selection,
                               group_statistics, task_filter, failed_instances, empty_reply_chains, authored_rounds, strict_or_loose, oversize_keys, reply_alignment,
                               max_deviation, safe_rounding, landing_safety, attach_library_sharded, rule_environment, targets_lookup, catalog_subsumption,
                               restoration_order, blake_split)},
}

_LONG = f"""
        WITH z AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_discount, l_quantity, l_tax) AS pos FROM lineitem),
        y AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, pos) = 1 AS best, count(*) OVER (PARTITION BY l_orderkey) AS n FROM z),
        x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY best, l_extendedprice, pos) = 1 AS worst FROM y),
        l AS ({" UNION ALL ".join(f"SELECT l_orderkey, pos::INT AS pos, best, worst, n, '{c}' AS col, round({e}, 6) AS v FROM x WHERE n > 1" for c, e in COLUMNS.items())}),
        live AS (SELECT * FROM l WHERE (l_orderkey, col) IN (SELECT (l_orderkey, col) FROM l GROUP BY l_orderkey, col HAVING max(v) - min(v) > 1e-9))"""


def _picks_sql(pool: str, score: str) -> str:
    return f"""{_LONG},
        s AS (SELECT l_orderkey, col, round({score}, 9) AS score FROM {pool} GROUP BY 1, 2),
        f AS (SELECT l_orderkey, col FROM s QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, col) = 1),
        r AS (SELECT a.l_orderkey, b.col, round(abs(coalesce(CASE WHEN min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN corr(a.v, b.v) END, 0)), 9) AS rho, any_value(a.n) AS n
              FROM {pool} a JOIN f ON a.l_orderkey = f.l_orderkey AND a.col = f.col JOIN {pool} b ON a.l_orderkey = b.l_orderkey AND a.pos = b.pos AND a.col <> b.col GROUP BY 1, 2),
        g AS (SELECT s.l_orderkey, s.col FROM s JOIN r USING (l_orderkey, col) WHERE n <= 2 OR rho < 0.8
              QUALIFY row_number() OVER (PARTITION BY s.l_orderkey ORDER BY score DESC, s.col) = 1)
        SELECT l_orderkey, 1 AS nth, col FROM f UNION ALL SELECT l_orderkey, 2, col FROM g"""


_GAP = "max(CASE WHEN best THEN v END) - avg(CASE WHEN NOT best THEN v END)"
_CNT = "SELECT doc_id, n_chars, " + ", ".join(f"len(regexp_extract_all(coalesce(text, ''), '{p}')) AS {n}" for n, p in GROUPS.items()) + " FROM documents"
_ENTRIES = " UNION ALL ".join(f"SELECT doc_id, n_chars, '{n}' AS name, {n} AS c, {({'comma': 0.9, 'digit': 0.2, 'stop': 0.95}).get(n, 1.0)} AS rate FROM t WHERE {n} > 0" for n in GROUPS)

ORACLE_SQL = {
    "column_picks": _picks_sql("live", _GAP),
    "column_picks_scaled": _picks_sql("live", f"CASE WHEN stddev_pop(v) > 1e-12 THEN ({_GAP}) / stddev_pop(v) ELSE 0 END"),
    "gate_picks_max": _picks_sql("l", "max(v)"),
    "gate_picks_spread": _picks_sql("l", "max(v) - min(v)"),
    "visible_pool": f"{_LONG} SELECT col, count(DISTINCT l_orderkey) AS orders FROM live WHERE NOT starts_with(col, 'd_') GROUP BY 1",
    "axis_choice": f"""{_LONG}
        SELECT l_orderkey, arg_min(col, (v, col)) FILTER (worst) AS sift, arg_min(col, (-v, col)) FILTER (best) AS weigh FROM live GROUP BY 1""",
    "moved_groups": f"""{_LONG},
        g AS (SELECT l_orderkey, col, count(*) AS n, round(sum(abs(v)), 6) AS total FROM l WHERE v <> 0 GROUP BY 1, 2),
        p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, total DESC, col)::INT AS place FROM g)
        SELECT l_orderkey, place, col, n, total FROM p WHERE place <= 3""",
    "absolute_correlation": f"""{_LONG},
        r AS (SELECT a.l_orderkey, a.col, b.col AS other, round(abs(coalesce(CASE WHEN min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN corr(a.v, b.v) END, 0)), 9) AS rho
              FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.pos = b.pos AND a.col < b.col GROUP BY 1, 2, 3)
        SELECT col, other, count(*) AS orders, round(avg(rho), 5) AS mean FROM r GROUP BY 1, 2""",
    "random_edits": "SELECT p_partkey, p_brand FROM part WHERE p_size >= 5 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY md5('7:' || p_partkey)) <= 4",
    "random_rivals": f"{_LONG} SELECT l_orderkey, pos, col FROM l WHERE NOT best QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY md5('3:' || l_orderkey || ':' || pos || ':' || col)) = 1",
    "pair_subsample": f"""{_LONG}
        SELECT a.l_orderkey, a.pos AS a, b.pos AS b FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.pos < b.pos AND a.col = 'a_qty' AND b.col = 'a_qty'
        ORDER BY md5('1:' || a.l_orderkey || ':' || a.pos || ':' || b.pos) LIMIT 5000""",
    "group_predicate": f"WITH t AS ({_CNT}) SELECT doc_id, comma >= 3 AND stop >= 2 AS at_least, digit = 0 AS exactly, NULL::BOOLEAN AS unresolved FROM t",
    "group_selection": f"""
        WITH t AS ({_CNT}), e AS ({_ENTRIES}),
        p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5('5:' || doc_id || ':' || name)) AS d, row_number() OVER (PARTITION BY doc_id ORDER BY rate, name) AS r,
                     row_number() OVER (PARTITION BY doc_id ORDER BY rate DESC, name DESC) AS o FROM e),
        g AS (SELECT doc_id, string_agg(name || ':' || c, ',' ORDER BY c DESC, name) AS ordered, string_agg(name, ',' ORDER BY r) FILTER (r <= 2) AS rarest,
                     string_agg(name, ',' ORDER BY o) FILTER (o <= 2) AS common, string_agg(name, ',' ORDER BY c DESC, name) FILTER (d <= 2) AS random FROM p GROUP BY 1)
        SELECT doc_id, coalesce(ordered, '') AS ordered, coalesce(rarest, '') AS rarest, coalesce(common, '') AS common, coalesce(random, '') AS random FROM documents LEFT JOIN g USING (doc_id)""",
    "group_statistics": f"WITH t AS ({_CNT}), e AS ({_ENTRIES}) SELECT name, count(*) AS docs, round(avg(n_chars), 4) AS mean_chars, sum(c)::BIGINT AS total FROM e GROUP BY 1 HAVING count(*) >= 30",
    "task_filter": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase', 'error') AND try_cast(json_extract_string(props, '$.k') AS INT) < 50",
    "failed_instances": """
        SELECT p_partkey FROM part WHERE NOT coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 2 <> 0 END, false)
          AND NOT coalesce(CASE WHEN p_partkey % 5 = 0 THEN p_size <= 10 END, false)
          AND NOT (p_partkey % 7 = 0 AND (ends_with(p_type, '3') OR ends_with(p_brand, '3')))""",
    "empty_reply_chains": """
        WITH j AS (SELECT a.conv_id, a.role = 'user' AND b.role = 'assistant' AND length(b.text) < 150 AS bad
                   FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
        SELECT conv_id, count(*) AS turns FROM j GROUP BY 1 HAVING count(*) FILTER (bad) = 0""",
    "authored_rounds": """
        SELECT b.conv_id, b.turn, md5(a.text) AS asked FROM conversations b JOIN conversations a ON a.conv_id = b.conv_id AND a.turn = b.turn - 1
        WHERE b.role = 'assistant' AND a.role = 'user' AND len(string_split(trim(b.text), ' ')) <= 30""",
    "strict_or_loose": """
        SELECT o_orderkey, round(('0x' || substr(md5('9:' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 9) AS place FROM orders
        WHERE CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' ELSE o_totalprice > 200000 END""",
    "oversize_keys": "SELECT doc_id FROM documents WHERE length(text) <= 4000",
    "reply_alignment": """
        WITH c AS (SELECT conv_id, turn, regexp_extract_all(text, '([a-z]+),', 1) AS calls FROM conversations WHERE role = 'assistant'),
        e AS (SELECT conv_id, turn, unnest(calls) AS call, unnest(range(len(calls))) AS k FROM c)
        SELECT r.role AS replier, k::INT AS k, count(*) AS n, count(DISTINCT call) AS calls FROM e JOIN conversations r ON r.conv_id = e.conv_id AND r.turn = e.turn + 1 + k GROUP BY 1, 2""",
    "max_deviation": """
        SELECT p_partkey, round(greatest(p_retailprice * 0.95 - (SELECT min(p_retailprice) FROM part), (SELECT max(p_retailprice) FROM part) - p_retailprice * 1.05, 1e-9), 6) AS deviation FROM part""",
    "safe_rounding": "SELECT event_id, CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN round(value / 7, 3) END AS value FROM events",
    "landing_safety": """
        WITH a AS (SELECT p_partkey, p_size::DOUBLE AS s, 1500.0 + (p_retailprice - 1000.0) AS p, p_partkey % 5 + 1.0 AS ss, p_partkey % 7 * 10 + 5.0 AS sp FROM part),
        b AS (SELECT *, s BETWEEN 20 AND 30 AS si, p BETWEEN 1200 AND 1400 AS pi FROM a)
        SELECT p_partkey, (si AND least(s - 20, 30 - s) >= ss)::INT + (pi AND least(p - 1200, 1400 - p) >= sp)::INT AS safe, si::INT + pi::INT AS held, (NOT si)::INT AS breaks,
               round(greatest(0.0, 1200.0 - p), 6)::DOUBLE AS overshoot,
               round((0.5 - greatest(0.0, 20 - s, s - 30) / 10.0 - greatest(0.0, 1200 - p, p - 1400) / 200.0) / 0.5, 6)::DOUBLE AS closed FROM b""",
    "attach_library_sharded": """
        SELECT p_brand, count(*) AS support, count(DISTINCT p_type) AS sources, count(DISTINCT l_returnflag) AS shards
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY sources DESC, support DESC, p_brand LIMIT 20""",
    "rule_environment": """
        SELECT p_brand, s_nationkey, count(*) AS n, round(avg(l_quantity), 6) AS avg FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        WHERE p_brand IN ('Brand#13', 'Brand#5', 'Brand#21') GROUP BY 1, 2""",
    "targets_lookup": "SELECT c_custkey, (SELECT arg_max(o_totalprice, (o_orderdate, o_orderkey)) FROM orders WHERE o_custkey = c_custkey) AS target FROM customer",
    "catalog_subsumption": """
        WITH h AS (SELECT DISTINCT p_brand, p_type FROM part), m(narrow, broad) AS (VALUES ('SMALL', 'STANDARD'), ('MEDIUM', 'STANDARD'), ('ECONOMY', 'PROMO'))
        SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM m JOIN h o ON o.p_type = broad WHERE narrow = h.p_type AND o.p_brand = h.p_brand)""",
    "restoration_order": """
        SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_retailprice DESC, p_partkey)::INT AS place, p_partkey FROM part QUALIFY place <= 25""",
}
