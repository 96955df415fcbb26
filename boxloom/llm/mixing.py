"""Mixing sources to target weights: budgets down a domain-language-source tree, token prefixes of seeded epochs.

A node's capacity is the tokens of its leaves times the epochs allowed. The budget enters at the root
and is shared among children by weight; a child whose capacity is below its share gets its capacity,
and what it lacks goes to its siblings by their weights, until all of them are full. Only what a whole
family cannot take is left to the siblings of its parent: the share of a full parent is its capacity.
With children sorted by capacity over weight this needs no iteration: the level at which the budget is
used up is the largest of the levels that running sums give, one window a tree level.

A leaf's budget is whole epochs plus a prefix of the next one: documents in the order of a seeded hash
of epoch and id, as long as their running sum of tokens is within the budget. The sum is taken per
2**16 ranges of the hash first and per document only in the one range that holds the cut, so no task
sorts a leaf. A document's number of uses then follows from its own hash and its leaf's cut.

Defined results: null and empty texts have no tokens and are taken with what stands before them; a
null domain, language or source is a node of its own. Rows that repeat an id share its place in the
order, and are taken or left together. A node without a weight has `other`; a weight of 0 takes
nothing. An empty table gives no rows. Columns of the same names as the tree's are untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL, fresh, materialise

WORD = "[^\\x20\\x09-\\x0D]+"
LEVELS = ("domain", "lang", "source")

#: Production parameters: weights by level; a source's domain is the remainder of its number by 4.
WEIGHTS = {
    "domain": {"d0": 40, "d1": 30, "d2": 20, "d3": 10},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
    "source": {},
}
OTHER = 5


def domain_of(source: Column) -> Column:
    number = F.try_element_at(F.regexp_extract_all(source, F.lit("([0-9]+)$"), F.lit(1)), F.lit(1)).cast("bigint")
    return F.coalesce(F.concat(F.lit("d"), F.pmod(number, F.lit(4))), F.lit("other"))


def key_of(name: Column) -> Column:
    """A node's name as a key that is never null: `=name`, or empty for null."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit(""))


def weight_of(level: str, name: Column, weights: dict[str, dict[str, int]], other: int) -> Column:
    known = weights.get(level, {})
    cases = reduce(lambda c, kv: c.when(name == f"={kv[0]}", F.lit(kv[1])), known.items(), F.when(F.lit(False), F.lit(0)))
    return cases.otherwise(F.lit(other)).cast("bigint")


def leaves(rows: DataFrame, budget: float, epochs: int, weights: dict[str, dict[str, int]], other: int) -> DataFrame:
    """(domain, lang, source, supply, quota): each leaf's whole number of tokens; `budget` is a share of all tokens."""
    table = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply")).withColumn("capacity", F.col("supply") * F.lit(epochs))
    table = materialise(table, "mixing-leaves")
    quota = table.agg(F.floor(F.sum("supply") * F.lit(budget)).alias("quota"))
    for depth, level in enumerate(LEVELS):
        parent, own = LEVELS[:depth], LEVELS[: depth + 1]
        weight = weight_of(level, F.col(level), weights, other)
        nodes = table.groupBy(*own).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight).where("weight > 0")
        nodes = nodes.join(quota, list(parent)) if parent else nodes.crossJoin(F.broadcast(quota))  # one row
        order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), F.col(level))
        before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("height", (F.col("quota") - before) / rest)
        height = F.max("height").over(Window.partitionBy(*parent))
        share = F.least(F.col("capacity"), F.floor(height * F.col("weight")).cast("bigint"))
        quota = nodes.withColumn("share", share).select(*own, F.col("share").alias("quota"))
    return table.join(quota, list(LEVELS)).select(*LEVELS, "supply", "quota")


def place(seed: int, epoch: Column, ident: Column) -> Column:
    """Where a document stands in an epoch: 60 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(ident.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def cuts(rows: DataFrame, table: DataFrame, seed: int, small: bool) -> DataFrame:
    """(domain, lang, source, whole, at, last): epochs taken whole, and the place and id up to which the next one is taken."""
    near = F.broadcast if small else lambda df: df
    keys, supply = list(LEVELS), F.greatest("supply", F.lit(1))
    table = table.withColumn("whole", F.floor(F.col("quota") / supply).cast("bigint")).withColumn("rest", F.col("quota") - F.col("whole") * supply)
    placed = rows.join(near(table), keys).withColumn("at", place(seed, F.col("whole"), F.col("id"))).withColumn("range", F.shiftright("at", 44))
    sums = placed.groupBy(*keys, "rest", "range").agg(F.sum("tokens").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    over = sums.withColumn("total", F.sum("n").over(upto)).where("total > rest")
    cut = over.groupBy(*keys).agg(F.min("range").alias("cut"), F.min_by(F.col("total") - F.col("n"), "range").alias("before"))
    cut = materialise(cut, "mixing-ranges")
    inside = placed.join(near(cut.withColumnRenamed("cut", "range")), [*keys, "range"])
    running = F.sum("tokens").over(Window.partitionBy(*keys).orderBy("at", "id")) + F.col("before")
    last = inside.withColumn("running", running).where("running <= rest").groupBy(*keys).agg(F.max(F.struct("at", "id")).alias("last"))
    table = table.join(cut, keys, "left").join(last, keys, "left")
    at = F.coalesce(F.col("last.at"), F.shiftleft("cut", 44) - 1, F.lit((1 << 60) - 1))
    return table.select(*keys, "supply", "quota", "whole", at.alias("at"), F.col("last.id").alias("last"), F.col("last").isNotNull().alias("exact"))


def uses(docs: DataFrame, budget: float = 1.0, epochs: int = 2, weights: dict[str, dict[str, int]] | None = None, other: int = OTHER, seed: int = 17,
         id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
         with_text: bool = True) -> DataFrame:
    """`docs` with `tokens`, `domain`, `quota` (of the leaf) and `times` (how often the mix uses the document).

    `with_text` False leaves the text out, which is then read once only.
    """
    names = {c: fresh(docs, c) for c in ("_domain", "_lang", "_source", "_tokens", "_id", "_quota", "_times")}
    keyed = docs.withColumns({
        names["_domain"]: key_of(domain_of(F.col(source_col))), names["_lang"]: key_of(F.col(lang_col)), names["_source"]: key_of(F.col(source_col)),
        names["_tokens"]: F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("bigint"),
        names["_id"]: F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))),
    })
    if not with_text:
        keyed = materialise(keyed.drop(text_col), "mixing-documents")
    light = keyed.select(*(F.col(names[f"_{c}"]).alias(c) for c in LEVELS), F.col(names["_tokens"]).alias("tokens"), F.col(names["_id"]).alias("id"))
    if with_text:
        light = materialise(light, "mixing-rows")
    table = materialise(leaves(light, budget, epochs, weights or WEIGHTS, other), "mixing-quotas")
    small = table.count() <= SMALL
    found = materialise(cuts(light, table, seed, small), "mixing-cuts").select(*(F.col(c).alias(f"leaf_{c}") for c in (*LEVELS, "supply", "quota", "whole", "at", "last", "exact")))
    match = reduce(lambda a, b: a & b, [F.col(names[f"_{c}"]) == F.col(f"leaf_{c}") for c in LEVELS])
    own = place(seed, F.col("leaf_whole"), F.col(names["_id"]))
    taken = (own < F.col("leaf_at")) | ((own == F.col("leaf_at")) & (~F.col("leaf_exact") | (F.col(names["_id"]) <= F.col("leaf_last"))))
    times = F.coalesce(F.col("leaf_whole") + taken.cast("bigint"), F.lit(0)).cast("int")
    out = keyed.join(F.broadcast(found) if small else found, match, "left")
    return out.select(
        *(c for c in docs.columns if with_text or c != text_col), F.col(names["_tokens"]).alias("tokens"), domain_of(F.col(source_col)).alias("domain"),
        F.coalesce("leaf_quota", F.lit(0)).alias("quota"), times.alias("times"),
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix: the rows of `docs`, each as often as it is used, with the columns of `docs`."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    roles = {k: plain[docs.columns.index(how.pop(f"{k}_col", d))] for k, d in (("id", "doc_id"), ("text", "text"), ("lang", "lang"), ("source", "source"))}
    counted = uses(docs.toDF(*plain), **how, **{f"{k}_col": c for k, c in roles.items()})
    each = counted.where("times > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), "times")))
    return each.select(*(F.col(p).alias(c) for p, c in zip(plain, docs.columns)))


def uses_sql(budget: float = 1.0, epochs: int = 2, seed: int = 17) -> str:
    """The same rows in DuckDB SQL, for the `documents` view."""
    weigh = lambda level: "CASE " + " ".join([f"WHEN {level} = '{k}' THEN {w}" for k, w in WEIGHTS[level].items()] + ["WHEN false THEN 0"]) + f" ELSE {OTHER} END"
    steps, parent = [], "root"
    for depth, level in enumerate(LEVELS):
        own, up = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        part = f"PARTITION BY {up}" if up else ""
        source = f"n{depth}a JOIN {parent} USING ({up})" if up else f"n{depth}a, root"
        steps.append(f"""
        n{depth}a AS (SELECT {own}, sum(capacity) AS capacity, {weigh(level)} AS weight FROM leaf GROUP BY {own}),
        n{depth}b AS (SELECT {own}, capacity, weight,
                 (quota - coalesce(sum(capacity) OVER ({part} ORDER BY capacity / weight::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / (sum(weight) OVER ({part} ORDER BY capacity / weight::DOUBLE, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS height
                 FROM {source}),
        n{depth} AS (SELECT {own}, least(capacity, floor(max(height) OVER ({part}) * weight)::BIGINT) AS quota FROM n{depth}b)""")  # fmt: skip
        parent = f"n{depth}"
    return f"""
        WITH d AS (SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens,
                     coalesce('d' || (try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT) % 4), 'other') AS domain FROM documents),
        leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply, sum(tokens)::BIGINT * {epochs} AS capacity FROM d GROUP BY ALL),
        root AS (SELECT floor(sum(supply) * {budget})::BIGINT AS quota FROM leaf),{",".join(steps)},
        q AS (SELECT domain, lang, source, quota::BIGINT AS quota, quota // greatest(supply, 1) AS whole, quota - quota // greatest(supply, 1) * greatest(supply, 1) AS rest
              FROM leaf JOIN n2 USING (domain, lang, source)),
        p AS (SELECT d.*, quota, whole, rest, ('0x' || substr(md5('{seed}:' || whole || ':' || doc_id), 1, 15))::BIGINT AS spot FROM d JOIN q USING (domain, lang, source))
        SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, quota,
               (whole + (sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY spot, doc_id) <= rest)::INT)::INT AS times FROM p"""
