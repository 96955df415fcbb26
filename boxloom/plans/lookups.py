"""Lookups that keep what they can't resolve, merges of several sources, candidate features, text helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import table


def catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments by a catalog that lacks some: unknown names stay, unresolved."""
    known = spark.createDataFrame([("BUILDING", "b1"), ("MACHINERY", "m1"), ("NOWHERE", "n1")], "name string, code string")
    named = table(spark, sf_dir, "customer").join(F.broadcast(known), F.col("c_mktsegment") == F.col("name"), "left")  # three rows
    return named.groupBy("c_mktsegment", "code").agg(F.count("*").alias("n"), F.every(F.col("code").isNotNull()).alias("resolved"))


def embedding_row_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's row among the vectors, -1 if it has none."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), "label")
    found = table(spark, sf_dir, "documents").join(rows, F.col("doc_id") == F.col("row"), "left")
    return found.select("doc_id", F.coalesce("row", F.lit(-1)).alias("row"), "label")


def multi_source_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two measurements and labels side by side, missing ones null."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    words = table(spark, sf_dir, "documents").where("doc_id % 3 <> 0").select("doc_id", F.size(F.split("text", " ")).alias("n_words"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    merged = docs.join(words, "doc_id", "left").join(labels, "doc_id", "left")
    return merged.groupBy("quality").agg(F.count("*").alias("n"), F.count("n_words").alias("measured"), F.sum("n_words").alias("words"), F.sum("n_chars").alias("chars"))


def replaced_stub_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that a longer turn of the same conversation replaces go, unless they end with a period."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"), F.endswith("text", F.lit(".")).alias("ends"))
    longest = turns.groupBy("conv_id", "role").agg(F.max("n").alias("most"))
    return turns.join(longest, ["conv_id", "role"]).where("ends OR n = most").select("conv_id", "turn")


def preferred_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every order a line of its own supplier nation if there is one, else its first line."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    own = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    met = lines.join(own, F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    exact = F.col("s_nationkey") == F.col("c_nationkey")
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("exact"), "l_linenumber", "l_partkey", "l_suppkey"))
    return met.withColumn("exact", exact).withColumn("nth", nth).where("nth = 1").select("l_orderkey", "l_partkey", "l_suppkey", "exact")


def candidate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line as an edit of its order's mean line: cosine with the wanted change, coverage, overshoot, helped and hurt."""
    own = Window.partitionBy("l_orderkey")
    rows = table(spark, sf_dir, "lineitem").withColumns({
        "dq": (F.col("l_quantity") - F.avg("l_quantity").over(own)) / 14.0, "dd": (F.col("l_discount") - F.avg("l_discount").over(own)) / 0.03,
    })
    wq, wd = F.lit(1.0), F.lit(-0.5)
    norm = F.sqrt(F.col("dq") * F.col("dq") + F.col("dd") * F.col("dd"))
    cosine = F.when(norm > 1e-12, (F.col("dq") * wq + F.col("dd") * wd) / (norm * F.sqrt(F.lit(1.25)))).otherwise(0.0)
    part = lambda d, w: F.least(F.greatest(d / w, F.lit(0.0)), F.lit(1.0))
    over = lambda d, w: F.greatest(d / w - 1, F.lit(0.0))
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (F.round(cosine, 5) + 0.0).alias("cosine"),
        F.round((part(F.col("dq"), wq) + part(F.col("dd"), wd)) / 2, 5).alias("coverage"), F.round(over(F.col("dq"), wq) + over(F.col("dd"), wd), 5).alias("overshoot"),
        ((F.col("dq") > 1e-9).cast("int") + (F.col("dd") < -1e-9).cast("int")).alias("helped"), ((F.col("dq") < -1e-9).cast("int") + (F.col("dd") > 1e-9).cast("int")).alias("hurt"),
    )


def union_with_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpora of different columns as one, with a tag; missing columns are null."""
    docs = table(spark, sf_dir, "documents").select(F.lit(0).alias("ci"), F.col("doc_id").alias("id"), "lang")
    items = table(spark, sf_dir, "benchmark").select(F.lit(1).alias("ci"), F.col("item_id").alias("id"))
    both = docs.unionByName(items, allowMissingColumns=True)
    return both.groupBy("ci", "lang").agg(F.count("*").alias("n"), F.max("id").alias("last"))


def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachment points, markers, ring digits, numbers, lists and punctuation."""
    rows = table(spark, sf_dir, "part")
    made = F.concat(F.lit("C1CC[2*:1]c"), F.col("p_size"), F.lit("[nH3]2*#note"))
    return rows.select(
        "p_partkey", text.bare_attachments(made).alias("bare"), text.cut_at(made, "#note").alias("cut"), text.ring_digits(made).alias("rings"),
        text.number(F.col("p_retailprice") / 4).alias("price"), text.signed(F.col("p_size") - F.lit(25)).alias("change"),
        text.listed(F.slice(F.array("p_brand", "p_type", "p_name"), 1, F.pmod("p_partkey", F.lit(3)).cast("int") + 1)).alias("names"),
        text.folded(F.concat(F.lit(" “a” –  "), F.col("p_size"))).alias("plain"),
    )


QUERIES = {f.__name__: f for f in (catalog_lookup, embedding_row_lookup, multi_source_merge, replaced_stub_antijoin, preferred_match, candidate_features, union_with_tags, text_helpers)}

_D = "(SELECT *, (l_quantity - avg(l_quantity) OVER (PARTITION BY l_orderkey)) / 14.0 AS dq, (l_discount - avg(l_discount) OVER (PARTITION BY l_orderkey)) / 0.03 AS dd FROM lineitem)"

ORACLE_SQL = {
    "catalog_lookup": """
        WITH k(name, code) AS (VALUES ('BUILDING', 'b1'), ('MACHINERY', 'm1'), ('NOWHERE', 'n1'))
        SELECT c_mktsegment, code, count(*) AS n, bool_and(code IS NOT NULL) AS resolved FROM customer LEFT JOIN k ON c_mktsegment = name GROUP BY 1, 2""",
    "embedding_row_lookup": "SELECT doc_id, coalesce(vec_id, -1) AS row, label FROM documents LEFT JOIN embeddings ON doc_id = vec_id",
    "multi_source_merge": """
        SELECT quality, count(*) AS n, count(*) FILTER (doc_id % 3 <> 0) AS measured, sum(CASE WHEN doc_id % 3 <> 0 THEN len(string_split(text, ' ')) END)::BIGINT AS words, sum(n_chars)::BIGINT AS chars
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "replaced_stub_antijoin": """
        WITH m AS (SELECT conv_id, turn, ends_with(text, '.') AS e, length(text) AS n, max(length(text)) OVER (PARTITION BY conv_id, role) AS most FROM conversations)
        SELECT conv_id, turn FROM m WHERE e OR n = most""",
    "preferred_match": """
        SELECT l_orderkey, l_partkey, l_suppkey, s_nationkey = c_nationkey AS exact
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY (s_nationkey = c_nationkey) DESC, l_linenumber, l_partkey, l_suppkey) = 1""",
    "candidate_features": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               round(CASE WHEN sqrt(dq * dq + dd * dd) > 1e-12 THEN (dq - 0.5 * dd) / (sqrt(dq * dq + dd * dd) * sqrt(1.25)) ELSE 0 END, 5) + 0.0 AS cosine,
               round((least(greatest(dq, 0.0), 1.0) + least(greatest(dd / -0.5, 0.0), 1.0)) / 2, 5) AS coverage, round(greatest(dq - 1, 0.0) + greatest(dd / -0.5 - 1, 0.0), 5) AS overshoot,
               (dq > 1e-9)::INT + (dd < -1e-9)::INT AS helped, (dq < -1e-9)::INT + (dd > 1e-9)::INT AS hurt FROM {_D}""",
    "union_with_tags": """
        SELECT 0 AS ci, lang, count(*) AS n, max(doc_id) AS last FROM documents GROUP BY 2
        UNION ALL SELECT 1, NULL, count(*), max(item_id) FROM benchmark""",
    "text_helpers": """
        SELECT p_partkey, 'C1CC*c' || p_size || '[nH3]2*#note' AS bare, 'C1CC[2*:1]c' || p_size || '[nH3]2*' AS cut, '1' || p_size || '2' AS rings,
               regexp_replace(printf('%.3f', p_retailprice / 4), '\\.?0+$', '') AS price, CASE WHEN p_size > 25 THEN '+' ELSE '' END || (p_size - 25) AS change,
               CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || ' and ' || p_type ELSE p_brand || ', ' || p_type || ' and ' || p_name END AS names,
               '"a" - ' || p_size AS plain FROM part""",
}
