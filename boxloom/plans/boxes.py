"""Box constraints and edit ranking over the supplied tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import box
from ..functions.normal import phi_sql
from ..operators import moves, ranges
from ..sources import search
from ..sources.tables import table


def box_hit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled reference rows become boxes; how many pool rows does each box hold?"""
    pool = table(spark, sf_dir, "lineitem").select(*ranges.KEY, "l_quantity", "l_extendedprice", "l_discount")
    boxes = ranges.sample_boxes(pool, modulus=997, most=200)
    return ranges.hit_counts(
        boxes,
        pool,
        {"l_quantity": ("q_lo", "q_hi"), "l_extendedprice": ("p_lo", "p_hi"), "l_discount": ("d_lo", None)},
        grid=("l_quantity", 11.0),
    )


def sampled_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate from a tenth of the pool (by key), scaled up, one hit at least."""
    pool = table(spark, sf_dir, "lineitem").select(*ranges.KEY, "l_quantity", "l_extendedprice", "l_discount")
    boxes = ranges.sample_boxes(pool, modulus=997, most=200)
    tenth = pool.where(F.pmod(F.col("l_orderkey") * 7 + F.col("l_partkey"), F.lit(10)) == 0)
    some = ranges.hit_counts(boxes, tenth, {"l_quantity": ("q_lo", "q_hi"), "l_extendedprice": ("p_lo", "p_hi")}, grid=("l_quantity", 11.0))
    size = pool.agg(F.count("*").alias("whole"))
    scaled = F.greatest(F.round(F.col("hit_count") / F.col("pool_size") * F.col("whole")), F.lit(1.0)).cast("bigint")
    return some.crossJoin(F.broadcast(size)).select("id", F.col("hit_count").alias("sample_hits"), scaled.alias("estimated_hits"))


def parquet_range_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range specification as a pushed-down filter, with one row more than the limit to show there are more."""
    found = search.range_search(
        table(spark, sf_dir, "part"), {"p_size": [10, 20], "p_retailprice": {"min": 950.0}, "p_type": None, "unknown": 3}, most=50, order="p_partkey"
    )
    return found.select("p_partkey", "p_size", F.round("p_retailprice", 2).alias("p_retailprice"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a missing size for every 13th and a price that isn't a number for every 17th."""
    size = F.when(F.pmod("p_partkey", F.lit(13)) != 0, F.col("p_size").cast("double"))
    price = F.when(F.pmod("p_partkey", F.lit(17)) == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select("p_partkey", size.alias("size"), price.alias("price"))


_BOXES = [("size", 10.0, 30.0), ("price", 980.0, 940.0), ("price", 930.0, None)]


def _terms() -> list:
    return [(F.col(c), F.lit(lo).cast("double"), F.lit(hi).cast("double")) for c, lo, hi in _BOXES]


def violation_score(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Penalty of each part; the second box has its bounds inverted on purpose, the third is open above."""
    terms = _terms()
    return _parts(spark, sf_dir).select("p_partkey", F.round(box.score(terms, mode), 6).alias("score"))


def weighted_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a weight for each box, best first: all boxes held, then by score."""
    terms = _terms()
    held = F.coalesce(box.inside(terms[0][0], F.lit(10.0), F.lit(30.0)) & box.inside(terms[1][0], F.lit(940.0), F.lit(980.0)) & box.inside(terms[2][0], F.lit(930.0), None), F.lit(False))
    scored = _parts(spark, sf_dir).select("p_partkey", held.alias("all_ok"), F.round(box.score(terms, "l1", [2.0, 0.5, 0.25]), 6).alias("score"))
    return scored.orderBy(F.desc("all_ok"), F.desc("score"), "p_partkey").limit(100)


def satisfied_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tri-state tests and the share of boxes held; a missing value counts in the denominator."""
    first, _, third = _terms()
    return _parts(spark, sf_dir).select(
        "p_partkey",
        box.undecided(*first).alias("decided"),
        F.round(box.satisfied_share([first, third]), 6).alias("sat_ratio"),
        (box.inside(*first) & box.inside(*third)).alias("all_ok"),
    )


def interval_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each price lies, given a spread of 15, with `k` = 1; before, it was higher by the part's number modulo 100."""
    price, before = F.col("price"), F.col("price") + F.pmod("p_partkey", F.lit(100))
    label = box.bucket(price, F.lit(940.0), F.lit(980.0), F.lit(15.0), before=before)
    return _parts(spark, sf_dir).groupBy(label.alias("bucket")).agg(F.count("*").alias("n"))


_TARGET = moves.Target({"size": (5.0, 20.0, 30.0, 10.0), "price": (1500.0, 1200.0, 1400.0, 100.0)})


def _moves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict, dict]:
    """Each part as an edit: what it does to size and price, and how surely."""
    edits = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", (F.col("p_size") - 25.0).alias("d_size"), ((F.col("p_retailprice") - 1000.0) / 10).alias("d_price"),
        (F.pmod("p_partkey", F.lit(5)) + 1.0).alias("s_size"), (F.pmod("p_partkey", F.lit(7)) * 10 + 5.0).alias("s_price"),
    )
    return edits, {"size": F.col("d_size"), "price": F.col("d_price")}, {"size": F.col("s_size"), "price": F.col("s_price")}


_POPULATION = {"size": (1.0, 50.0), "price": (900.0, 2000.0)}


def ranked(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    edits, delta, std = _moves(spark, sf_dir)
    reach = moves.farthest(_TARGET, _POPULATION)
    return moves.top(edits, moves.objective(_TARGET, delta, std, kind, reach), "p_partkey", 50).select("p_partkey", "score")


def suggested_edits(kind: str, gate: str, tie: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole suggestion: screened by the gate, guarded (no widgets' `JUMBO` types), refined in the brand's context, ranked again, two variants of a rule."""
    edits, delta, std = _moves(spark, sf_dir)
    own = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.avg("p_size").alias("mean"), F.count("*").alias("n")).where("n >= 5")
    context = own.select("p_brand", F.round((F.col("mean") - 25.0) / 2, 6).alias("ctx_size"))
    refined = {"size": F.when(F.pmod("p_partkey", F.lit(3)) == 0, F.col("ctx_size"))}
    best = moves.suggested(
        edits.join(context, "p_brand", "left"), _TARGET, delta, std, ["p_brand", "p_type"], "p_partkey", k=100, kind=kind, gate=gate, tie=tie,
        allowed=~F.col("p_type").startswith("JUMBO"), refined=refined, reach=moves.farthest(_TARGET, _POPULATION),
    )
    return best.select("p_partkey", "p_brand", "p_type", "variant", "score")


def variant_cap_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two variants of a rule at most, best of each rule first."""
    edits, delta, std = _moves(spark, sf_dir)
    best = moves.capped(edits, ["p_brand", "p_type"], moves.objective(_TARGET, delta, std, "gap"), "p_partkey", cap=2, k=200)
    return best.select("p_partkey", "p_brand", "p_type", "variant", "score")


def best_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest reduction for each brand, and its edit."""
    edits, delta, std = _moves(spark, sf_dir)
    scored = edits.withColumn("score", F.round(moves.objective(_TARGET, delta, std, "gap"), 6))
    best = F.max(F.struct("score", (-F.col("p_partkey")).alias("key"))).alias("best")
    return scored.groupBy("p_brand").agg(best).select("p_brand", F.col("best.score").alias("score"), (-F.col("best.key")).alias("p_partkey"))


QUERIES = {
    "box_hit_count": box_hit_count,
    "sampled_hit_rate": sampled_hit_rate,
    "parquet_range_search": parquet_range_search,
    **{f"violation_score_{m}": partial(violation_score, m) for m in ("l1", "l2", "hard")},
    "satisfied_ratio": satisfied_ratio,
    "interval_bucket": interval_bucket,
    "norm_gap_topk": partial(ranked, "gap"),
    **{f"objective_{k}": partial(ranked, k) for k in ("count", "minmax", "worst", "gapstd", "prob", "joint", "weakest")},
    "weighted_violation": weighted_violation,
    "suggested_edits_gap": partial(suggested_edits, "gap", "strict", "key"),
    "suggested_edits_count_lex": partial(suggested_edits, "count", "lex", "gap"),
    "suggested_edits_count_random": partial(suggested_edits, "count", "strict", "random"),
    "variant_cap_topk": variant_cap_topk,
    "best_per_rule": best_per_rule,
}

_BOX_SQL = """
        WITH refs AS (
            SELECT * FROM lineitem
            WHERE (l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber) % 997 = 0
            ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 200),
        boxes AS (
            SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id,
                   l_quantity - 5 AS q_lo, l_quantity + 5 AS q_hi,
                   floor(l_extendedprice * 0.9) AS p_lo, ceil(l_extendedprice * 1.1) AS p_hi, l_discount AS d_lo
            FROM refs),
        n AS (SELECT count(*) AS pool_size FROM lineitem)"""

_PARTS_SQL = """
        WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_size::DOUBLE END AS size,
                          CASE WHEN p_partkey % 17 <> 0 THEN p_retailprice END AS price FROM part)"""


def _score_sql(mode: str, weights: tuple[float, ...] = (1.0, 1.0, 1.0)) -> str:
    def one(c: str, lo: float, hi: float | None) -> str:
        low, high = (min(lo, hi), max(lo, hi)) if hi is not None else (lo, None)
        off = f"greatest(0.0, {low} - {c}" + (f", {c} - {high})" if high is not None else ")")
        size = high - low if high is not None and high > low else 1.0
        return f"CASE WHEN {c} IS NULL THEN 1e6 ELSE " + {"l1": f"{off} / {size}", "l2": f"power({off} / {size}, 2)"}[mode] + " END"

    ok = " AND ".join(f"coalesce({c} >= {min(lo, hi or lo)}" + (f" AND {c} <= {max(lo, hi)}" if hi else "") + ", false)" for c, lo, hi in _BOXES)
    loss = "0.0" if mode == "hard" else " + ".join(f"{w} * ({one(*b)})" for w, b in zip(weights, _BOXES))
    return f"{_PARTS_SQL} SELECT p_partkey, {ok} AS all_ok, round(CASE WHEN {ok} THEN 1.0 ELSE 0.0 END - ({loss}), 6)::DOUBLE AS score FROM p"


_MOVES_SQL = """
        WITH m AS (SELECT p_partkey, p_brand, p_type, 5.0 + (p_size - 25.0) AS size, 1500.0 + (p_retailprice - 1000.0) / 10 AS price,
                          p_partkey % 5 + 1.0 AS ss, p_partkey % 7 * 10 + 5.0 AS sp FROM part),
        g AS (SELECT *, greatest(0.0, 20.0 - size, size - 30.0) / 10.0 AS gs, greatest(0.0, 1200.0 - price, price - 1400.0) / 100.0 AS gp FROM m)"""
def _chance_sql(value: str, spread: str, lo: float, hi: float) -> str:
    at = lambda edge: phi_sql(f"({edge} - {value}) / greatest({spread}, 1e-6)")
    return f"least(greatest({at(hi)} - {at(lo)}, 0.0), 1.0)"


_CHANCES = (_chance_sql("size", "ss", 20.0, 30.0), _chance_sql("price", "sp", 1200.0, 1400.0))
_OFF = lambda value, lo, hi: f"greatest(0.0, {lo} - ({value}), ({value}) - {hi})"
_SCORES_SQL = {
    "gap": "round(2.5 - (gs + gp), 6)",
    "count": "round((gs = 0)::INT::DOUBLE + (gp = 0)::INT::DOUBLE, 6)",
    "minmax": "round(-(gs * 10.0 / 20.0 + gp * 100.0 / 600.0), 6)",
    "worst": "round(-greatest(gs, gp, 0.0), 6)",
    "gapstd": f"""round(-(({_OFF("size + ss", 20.0, 30.0)} + {_OFF("size - ss", 20.0, 30.0)}) / 2 / 10.0
                 + ({_OFF("price + sp", 1200.0, 1400.0)} + {_OFF("price - sp", 1200.0, 1400.0)}) / 2 / 100.0), 6)""",
    "prob": f"round({_CHANCES[0]} + {_CHANCES[1]}, 6)",
    "joint": f"round({_CHANCES[0]} * {_CHANCES[1]}, 6)",
    "weakest": f"round(least({_CHANCES[0]}, {_CHANCES[1]}), 6)",
}


def _suggested_sql(kind: str, gate: str, tie: str) -> str:
    """The state now: size 5 (gap 1.5), price 1500 (gap 1)."""
    now = {"gap": 0.0, "count": 0.0}[kind]
    better = f"({_SCORES_SQL[kind]} > {now} + 1e-9)" + (f" OR ({_SCORES_SQL[kind]} = {now} AND 2.5 - (gs + gp) > 1e-9)" if gate == "lex" else "")
    ties = {"gap": "-(2.5 - (gs + gp))", "random": "md5('0:' || p_partkey)", "key": "0"}[tie]
    return f"""{_MOVES_SQL},
        b AS (SELECT p_brand, round((avg(p_size) - 25.0) / 2, 6) AS ctx FROM part GROUP BY 1 HAVING count(*) >= 5),
        s AS (SELECT * FROM g WHERE ({better}) AND NOT starts_with(p_type, 'JUMBO')),
        x AS (SELECT s.* EXCLUDE (size, gs), {ties} AS tie, CASE WHEN p_partkey % 3 = 0 AND ctx IS NOT NULL THEN 5.0 + ctx ELSE size END AS size FROM s LEFT JOIN b USING (p_brand)),
        h AS (SELECT *, greatest(0.0, 20.0 - size, size - 30.0) / 10.0 AS gs FROM x),
        r AS (SELECT *, {_SCORES_SQL[kind]} AS score FROM h WHERE {better}),
        v AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY score DESC, tie, p_partkey)::INT AS variant FROM r)
        SELECT p_partkey, p_brand, p_type, variant, score FROM v WHERE variant <= 2 ORDER BY variant, score DESC, tie, p_partkey LIMIT 100"""


def _ranked_sql(kind: str) -> str:
    return f"{_MOVES_SQL}, s AS (SELECT p_partkey, {_SCORES_SQL[kind]} AS score FROM g) SELECT p_partkey, score FROM s ORDER BY score DESC, p_partkey LIMIT 50"


ORACLE_SQL = {
    "box_hit_count": f"""{_BOX_SQL}
        SELECT id, count(*) AS hit_count, count(*) / any_value(pool_size)::DOUBLE AS hit_rate, any_value(pool_size) AS pool_size
        FROM boxes, lineitem, n
        WHERE l_quantity BETWEEN q_lo AND q_hi AND l_extendedprice BETWEEN p_lo AND p_hi AND l_discount >= d_lo
        GROUP BY id""",
    "sampled_hit_rate": f"""{_BOX_SQL},
        t AS (SELECT * FROM lineitem WHERE (l_orderkey * 7 + l_partkey) % 10 = 0), tn AS (SELECT count(*) AS c FROM t)
        SELECT id, count(*) AS sample_hits, greatest(round(count(*) / any_value(c)::DOUBLE * any_value(pool_size)), 1)::BIGINT AS estimated_hits
        FROM boxes, t, n, tn WHERE l_quantity BETWEEN q_lo AND q_hi AND l_extendedprice BETWEEN p_lo AND p_hi GROUP BY id""",
    "parquet_range_search": """
        SELECT p_partkey, p_size, round(p_retailprice, 2) AS p_retailprice FROM part
        WHERE p_size BETWEEN 10 AND 20 AND p_retailprice >= 950 ORDER BY p_partkey LIMIT 51""",
    **{f"violation_score_{m}": f"SELECT p_partkey, score FROM ({_score_sql(m)})" for m in ("l1", "l2", "hard")},
    "weighted_violation": f"SELECT * FROM ({_score_sql('l1', (2.0, 0.5, 0.25))}) ORDER BY all_ok DESC, score DESC, p_partkey LIMIT 100",
    "suggested_edits_gap": _suggested_sql("gap", "strict", "key"),
    "suggested_edits_count_lex": _suggested_sql("count", "lex", "gap"),
    "suggested_edits_count_random": _suggested_sql("count", "strict", "random"),
    "satisfied_ratio": f"""{_PARTS_SQL}
        SELECT p_partkey, size BETWEEN 10 AND 30 AS decided,
               round((coalesce(size BETWEEN 10 AND 30, false)::INT + coalesce(price >= 930, false)::INT) / 2.0, 6)::DOUBLE AS sat_ratio,
               coalesce(size BETWEEN 10 AND 30, false) AND coalesce(price >= 930, false) AS all_ok FROM p""",
    "interval_bucket": f"""{_PARTS_SQL},
        d AS (SELECT price, coalesce(price + p_partkey % 100 BETWEEN 940 AND 980, false) AS was, greatest(0.0, 940 - price, price - 980) AS d, least(price - 940, 980 - price) AS m FROM p)
        SELECT CASE WHEN price IS NULL THEN 'misses' WHEN d = 0 AND m >= 15 THEN 'holds' WHEN d = 0 THEN 'at risk'
                    WHEN d <= 15 THEN 'within reach' WHEN was THEN 'misses*' ELSE 'misses' END AS bucket, count(*) AS n FROM d GROUP BY 1""",
    "norm_gap_topk": _ranked_sql("gap"),
    **{f"objective_{k}": _ranked_sql(k) for k in ("count", "minmax", "worst", "gapstd", "prob", "joint", "weakest")},
    "variant_cap_topk": f"""{_MOVES_SQL},
        s AS (SELECT p_partkey, p_brand, p_type, {_SCORES_SQL["gap"]} AS score FROM g),
        r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY score DESC, p_partkey)::INT AS variant FROM s)
        SELECT p_partkey, p_brand, p_type, variant, score FROM r WHERE variant <= 2 ORDER BY variant, score DESC, p_partkey LIMIT 200""",
    "best_per_rule": f"""{_MOVES_SQL},
        s AS (SELECT p_partkey, p_brand, {_SCORES_SQL["gap"]} AS score FROM g)
        SELECT p_brand, score, p_partkey FROM s QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) = 1""",
}
