"""Corpus queries: conversations as training records, documents and benchmark as corpus and test set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import corpus
from ..sources.tables import table


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with group ids `c<id>__<part>__<turn>`."""
    ident = F.concat(F.lit("c"), F.col("conv_id"), F.lit("__"), F.pmod("conv_id", F.lit(3)), F.lit("__"), F.col("turn"))
    return table(spark, sf_dir, "conversations").withColumn("group_id", ident)


def ref_exclusion_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts no order line uses of a high discount, while shares are of all parts."""
    parts = table(spark, sf_dir, "part")
    used = table(spark, sf_dir, "lineitem").where("l_discount >= 0.1").select(F.col("l_partkey").alias("p_partkey")).distinct()
    total = parts.groupBy("p_brand").agg(F.count("*").alias("pool"))
    left = parts.join(used, "p_partkey", "left_anti").groupBy("p_brand").agg(F.count("*").alias("left"))
    return total.join(left, "p_brand", "left").select("p_brand", "pool", F.coalesce("left", F.lit(0)).alias("left"))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.containing(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def leak_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a whole benchmark passage, with how many."""
    return _leaks(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("passages"))


def leak_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean documents by language."""
    clean = table(spark, sf_dir, "documents").select("doc_id", "lang").join(_leaks(spark, sf_dir), "doc_id", "left_anti")
    return clean.groupBy("lang").agg(F.count("*").alias("clean"))


def leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many passages leak into at least so many documents."""
    counts = _leaks(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n"))
    steps = F.explode(F.array(*(F.lit(x) for x in (0, 1, 2, 3, 5))))
    return counts.withColumn("threshold", steps).groupBy("threshold").agg(
        F.count_if(F.col("n") > F.col("threshold")).alias("passages"), F.sum(F.when(F.col("n") > F.col("threshold"), F.col("n")).otherwise(0)).alias("documents")
    )


def leak_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 passages that leak into most documents, ties to the smaller id."""
    counts = _leaks(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"))
    return counts.orderBy(F.desc("documents"), "item_id").limit(15)


def polluted_group_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations without any very long turn; conversations divisible by 11 lose their id first."""
    turns = table(spark, sf_dir, "conversations").withColumn("gid", F.when(F.pmod("conv_id", F.lit(11)) != 0, F.col("conv_id")))
    kept = corpus.drop_polluted(turns, "gid", F.length("text") > 1500)
    return kept.groupBy("gid").agg(F.count("*").alias("turns"))


def rekey_delta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns take the group id of their task's first user turn."""
    turns = _turns(spark, sf_dir).withColumn("task", corpus.task_of(F.col("group_id")))
    found = corpus.rekey(turns.where("role = 'assistant'").select("task", "conv_id", "turn"), turns.where("role = 'user'"), "task", "group_id", ["turn"])
    return found.select("conv_id", "turn", "task", "base_id")


def coverage_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in which every role that the corpus has speaks (system aside), with their turns."""
    turns = table(spark, sf_dir, "conversations").where("role <> 'system'")
    roles = turns.agg(F.count_distinct("role").alias("wanted"))
    each = turns.groupBy("conv_id").agg(F.count_distinct("role").alias("roles"), F.count("*").alias("turns"))
    return each.crossJoin(F.broadcast(roles)).where("roles = wanted").select("conv_id", "turns")


def mismatch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of `x/y satisfied.` that an answer follows although x < y: the last claim counts."""
    text = F.concat(
        F.lit("state 3/3 satisfied. then "), F.pmod("doc_id", F.lit(4)), F.lit("/3 satisfied."),
        F.when(F.pmod("doc_id", F.lit(2)) == 0, " <ANSWER> done").otherwise(" more"),
    )
    claims = F.regexp_extract_all("content", F.lit("(\\d+)/(\\d+)\\s+satisfied\\."), F.lit(0))
    last = F.element_at("claims", -1)
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("content")).withColumn("claims", claims).withColumn("last", last)
    x, y = F.split_part("last", F.lit("/"), F.lit(1)).cast("int"), F.regexp_extract("last", "/(\\d+)", 1).cast("int")
    wrong = (x < y) & F.contains(F.substring_index("content", "satisfied.", -1), F.lit("<ANSWER>"))
    return rows.where(wrong).select("doc_id", x.alias("x"), y.alias("y"))


_AUDITS = {"shouting": "[A-Z]{6,}", "digits": "[0-9]{5,}", "tags": "<[a-z]+>", "table": "\\|.*\\|", "symbols": "[#$%&*]{3,}"}


def regex_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with and number of hits of each audit pattern."""
    counts = [F.struct(F.lit(k).alias("audit"), F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias("hits")) for k, p in _AUDITS.items()]
    rows = table(spark, sf_dir, "documents").select(F.explode(F.array(*counts)).alias("a")).select("a.*").where("hits > 0")
    return rows.groupBy("audit").agg(F.count("*").alias("documents"), F.sum("hits").alias("hits"))


def violation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules that a text breaks, as one list; an empty list passes."""
    rules = [F.when(F.col("text").rlike(p), F.lit(k)) for k, p in _AUDITS.items()]
    rows = table(spark, sf_dir, "documents").select("doc_id", F.array_compact(F.array(*rules)).alias("v"))
    return rows.groupBy(F.concat_ws(",", "v").alias("violations")).agg(F.count("*").alias("documents"))


def grounded_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a reply that its prompt does not have; whole ones up to 10 are exempt."""
    spans = Window.partitionBy("conv_id").orderBy("turn")
    numbers = lambda c: F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0)), lambda x: x.cast("decimal(38,0)"))
    rows = table(spark, sf_dir, "conversations").withColumn("before", F.lag("text").over(spans)).where("role = 'assistant' AND before IS NOT NULL")
    extra = F.array_except(F.filter(numbers(F.col("text")), lambda x: x > 10), numbers(F.col("before")))
    return rows.select("conv_id", "turn", F.size(extra).alias("ungrounded"))


def json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON string, with the raw text where it isn't JSON."""
    raw = F.when(F.pmod("event_id", F.lit(50)) == 0, F.lit("{broken")).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").withColumn("raw", raw).withColumn("k", F.get_json_object("raw", "$.k").cast("int"))
    return rows.groupBy("event_type").agg(F.count("k").alias("parsed"), F.sum("k").alias("sum_k"), F.count_if(F.col("k").isNull()).alias("broken"))


def sessionise_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns up to each assistant turn are a round."""
    found = corpus.sessions(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], F.col("role") == "assistant")
    return found.groupBy("conv_id", "round").agg(F.count("*").alias("turns"), F.max("turn").alias("last_turn"))


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed edits keep the last state: every third turn has none."""
    turns = table(spark, sf_dir, "conversations")
    state = F.when(F.pmod("turn", F.lit(3)) != 2, F.length("text"))
    return turns.select("conv_id", "turn", corpus.carried(turns, "conv_id", ["turn"], state).alias("state"))


def lead_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns that an assistant turn and then another user turn follow."""
    path = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumns({"r1": F.lead("role", 1).over(path), "r2": F.lead("role", 2).over(path)})
    return rows.where("role = 'user' AND r1 = 'assistant' AND r2 = 'user'").select("conv_id", "turn")


def keep_first_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.keep_first(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["text"], [F.col("doc_id")]).select("doc_id", "source")


def merge_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in order as one record, the first without its opening words, and its prefix of three turns."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("n"))))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(ordered.alias("m"))
    return rows.select(
        "conv_id", F.size("m").alias("turns"), F.concat_ws(">", F.transform("m", lambda x: F.substring(x["role"], 1, 1))).alias("shape"),
        F.aggregate(F.slice("m", 1, 3), F.lit(0), lambda a, x: a + x["n"]).alias("seed_chars"),
    )


def doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of documents that hold each word, of the words in 30 documents or more."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.col("text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    total = docs.agg(F.count("*").alias("total"))
    counts = words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 30")
    return counts.crossJoin(F.broadcast(total)).select("word", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def profile_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several frequency tables of the corpus in one scan."""
    table(spark, sf_dir, "documents").createOrReplaceTempView("_profile_documents")
    return spark.sql("""
        SELECT coalesce(lang, '*') AS lang, coalesce(source, '*') AS source, count(*) AS n, round(avg(n_chars), 4) AS mean, max(n_chars) AS most,
               CAST(grouping_id(lang, source) AS INT) AS level
        FROM _profile_documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())""")


def verification_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of failures with their number and three first examples."""
    kind = F.when(F.length("text") < 100, "short").when(F.col("n_chars") != F.length("text"), "count").when(F.col("text").rlike("[A-Z]{6,}"), "shouting")
    rows = table(spark, sf_dir, "documents").withColumn("kind", kind).where("kind IS NOT NULL")
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("doc_id"))
    total = rows.groupBy("kind").agg(F.count("*").alias("n"))
    some = rows.select("kind", "doc_id").withColumn("nth", nth).where("nth <= 3").groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("examples"))
    return total.join(some, "kind")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations by the first reason to reject them, or accepted as a whole."""
    why = F.when(F.length("text") < 30, "short").when(F.col("role") == "system", "system").when(F.length("text") > 1200, "long")
    rows = table(spark, sf_dir, "conversations").withColumn("why", why)
    first = rows.groupBy("conv_id").agg(F.min_by("why", F.when(F.col("why").isNotNull(), F.col("turn"))).alias("why"))
    return first.groupBy(F.coalesce("why", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("conversations"))


def group_count_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words created and destroyed from a turn to the next, as multisets."""
    turns = table(spark, sf_dir, "conversations").withColumn("next", F.lead("turn").over(Window.partitionBy("conv_id").orderBy("turn")))
    counts = turns.select("conv_id", "turn", "next", F.explode(F.split("text", " ")).alias("word")).groupBy("conv_id", "turn", "next", "word").agg(F.count("*").alias("n"))
    now = counts.select("conv_id", "turn", "word", "n")
    before = counts.where("next IS NOT NULL").select("conv_id", F.col("next").alias("turn"), "word", F.col("n").alias("m"))
    later = turns.where("next IS NOT NULL").select("conv_id", F.col("next").alias("turn"))
    change = now.join(before, ["conv_id", "turn", "word"], "full").withColumn("d", F.coalesce("n", F.lit(0)) - F.coalesce("m", F.lit(0)))
    sums = change.groupBy("conv_id", "turn").agg(F.sum(F.greatest("d", F.lit(0))).alias("created"), F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("destroyed"))
    return sums.join(later, ["conv_id", "turn"], "left_semi")


def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union with tags, intersection and difference of the users of three event kinds."""
    events = table(spark, sf_dir, "events")
    of = {k: events.where(F.col("event_type") == k).select("user_id") for k in ("click", "purchase", "error")}
    parts = {
        "union_all": reduce(DataFrame.unionByName, of.values()), "intersect": of["click"].intersect(of["purchase"]).intersect(of["error"]),
        "except": of["click"].distinct().exceptAll(of["purchase"].distinct()),
    }
    return reduce(DataFrame.unionByName, [df.agg(F.lit(k).alias("op"), F.count("*").alias("n"), F.sum("user_id").alias("users")) for k, df in parts.items()])


QUERIES = {
    f.__name__: f for f in (
        ref_exclusion_antijoin, leak_semijoin, leak_antijoin, leak_report, leak_top, polluted_group_drop, rekey_delta_join, coverage_intersection, mismatch_filter,
        regex_audit, violation_list, grounded_numbers, json_props_extract, sessionise_rounds, carry_forward, lead_adjacency, keep_first_dedup, merge_segments,
        doc_freq, profile_grouping_sets, verification_counters, reject_reasons, group_count_diff, set_operations)
}

_LEAKS = "l AS (SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) > 0)"
_A = {k: p.replace("'", "''") for k, p in _AUDITS.items()}

ORACLE_SQL = {
    "ref_exclusion_antijoin": """
        SELECT p_brand, count(*) AS pool, count(*) FILTER (p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1)) AS left FROM part GROUP BY 1""",
    "leak_semijoin": f"WITH {_LEAKS} SELECT doc_id, count(*) AS passages FROM l GROUP BY 1",
    "leak_antijoin": f"WITH {_LEAKS} SELECT lang, count(*) AS clean FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l) GROUP BY 1",
    "leak_report": f"""WITH {_LEAKS}, c AS (SELECT item_id, count(*) AS n FROM l GROUP BY 1)
        SELECT threshold, count(*) FILTER (n > threshold) AS passages, coalesce(sum(n) FILTER (n > threshold), 0)::BIGINT AS documents
        FROM c, (VALUES (0), (1), (2), (3), (5)) t(threshold) GROUP BY 1""",
    "leak_top": f"WITH {_LEAKS} SELECT item_id, count(*) AS documents FROM l GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "polluted_group_drop": """
        WITH t AS (SELECT CASE WHEN conv_id % 11 <> 0 THEN conv_id END AS gid, text FROM conversations),
        g AS (SELECT gid, count(*) AS turns, bool_or(length(text) > 1500) AS bad FROM t GROUP BY 1) SELECT gid, turns FROM g WHERE NOT bad""",
    "rekey_delta_join": """
        WITH t AS (SELECT *, 'c' || conv_id || '__' || conv_id % 3 || '__' || turn AS gid, 'c' || conv_id || '__' || conv_id % 3 AS task FROM conversations),
        b AS (SELECT task, arg_min(gid, turn) AS base_id FROM t WHERE role = 'user' GROUP BY 1)
        SELECT conv_id, turn, t.task, base_id FROM t JOIN b USING (task) WHERE role = 'assistant'""",
    "coverage_intersection": """
        WITH w AS (SELECT count(DISTINCT role) AS n FROM conversations WHERE role <> 'system')
        SELECT conv_id, count(*) AS turns FROM conversations, w WHERE role <> 'system' GROUP BY conv_id, n HAVING count(DISTINCT role) = n""",
    "mismatch_filter": "SELECT doc_id, (doc_id % 4)::INT AS x, 3 AS y FROM documents WHERE doc_id % 4 < 3 AND doc_id % 2 = 0",
    "regex_audit": "WITH a AS (" + " UNION ALL ".join(f"SELECT '{k}' AS audit, len(regexp_extract_all(text, '{p}')) AS hits FROM documents" for k, p in _A.items())
        + ") SELECT audit, count(*) AS documents, sum(hits)::BIGINT AS hits FROM a WHERE hits > 0 GROUP BY 1",
    "violation_list": "SELECT concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in _A.items())
        + ") AS violations, count(*) AS documents FROM documents GROUP BY 1",
    "grounded_numbers": """
        WITH t AS (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations),
        n AS (SELECT conv_id, turn, list_filter(list_transform(regexp_extract_all(text, '[0-9]+'), lambda x: x::DECIMAL(38, 0)), lambda x: x > 10) AS a,
                     list_transform(regexp_extract_all(before, '[0-9]+'), lambda x: x::DECIMAL(38, 0)) AS b FROM t WHERE role = 'assistant' AND before IS NOT NULL)
        SELECT conv_id, turn, len(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x))))::INT AS ungrounded FROM n""",
    "json_props_extract": """
        WITH t AS (SELECT event_type, CASE WHEN event_id % 50 <> 0 THEN (props::JSON ->> '$.k')::INT END AS k FROM events)
        SELECT event_type, count(k) AS parsed, sum(k)::BIGINT AS sum_k, count(*) FILTER (k IS NULL) AS broken FROM t GROUP BY 1""",
    "sessionise_rounds": """
        WITH t AS (SELECT *, coalesce(sum((role = 'assistant')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS round FROM conversations)
        SELECT conv_id, round, count(*) AS turns, max(turn) AS last_turn FROM t GROUP BY 1, 2""",
    "carry_forward": """
        SELECT conv_id, turn, last_value(CASE WHEN turn % 3 <> 2 THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::INT AS state FROM conversations""",
    "lead_adjacency": """
        WITH t AS (SELECT *, lead(role) OVER w AS r1, lead(role, 2) OVER w AS r2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id, turn FROM t WHERE role = 'user' AND r1 = 'assistant' AND r2 = 'user'""",
    "keep_first_dedup": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "merge_segments": """
        WITH m AS (SELECT conv_id, list(struct_pack(t := turn, r := role, n := length(text)) ORDER BY turn) AS m FROM conversations GROUP BY 1)
        SELECT conv_id, len(m)::INT AS turns, array_to_string(list_transform(m, lambda x: substr(x.r, 1, 1)), '>') AS shape,
               list_sum(list_transform(m[1:3], lambda x: x.n))::INT AS seed_chars FROM m""",
    "doc_freq": """
        WITH w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[a-z]+'))) AS word FROM documents), n AS (SELECT count(*) AS total FROM documents)
        SELECT word, count(*) AS n, round(count(*) / any_value(total)::DOUBLE, 6) AS share FROM w, n GROUP BY 1 HAVING count(*) >= 30""",
    "profile_grouping_sets": """
        SELECT coalesce(lang, '*') AS lang, coalesce(source, '*') AS source, count(*) AS n, round(avg(n_chars), 4) AS mean, max(n_chars) AS most, grouping(lang, source)::INT AS level
        FROM documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())""",
    "verification_counters": """
        WITH t AS (SELECT doc_id, CASE WHEN length(text) < 100 THEN 'short' WHEN n_chars <> length(text) THEN 'count' WHEN regexp_matches(text, '[A-Z]{6,}') THEN 'shouting' END AS kind FROM documents)
        SELECT kind, count(*) AS n, array_to_string(list(doc_id ORDER BY doc_id)[1:3], ',') AS examples FROM t WHERE kind IS NOT NULL GROUP BY 1""",
    "reject_reasons": """
        WITH t AS (SELECT conv_id, turn, CASE WHEN length(text) < 30 THEN 'short' WHEN role = 'system' THEN 'system' WHEN length(text) > 1200 THEN 'long' END AS why FROM conversations),
        f AS (SELECT conv_id, arg_min(why, turn) FILTER (why IS NOT NULL) AS why FROM t GROUP BY 1)
        SELECT coalesce(why, 'accepted') AS reason, count(*) AS conversations FROM f GROUP BY 1""",
    "group_count_diff": """
        WITH p AS (SELECT conv_id, turn, text, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations),
        n AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w FROM conversations) GROUP BY ALL),
        k AS (SELECT DISTINCT p.conv_id, p.turn, p.before, w FROM p JOIN n ON p.conv_id = n.conv_id AND n.turn IN (p.turn, p.before) WHERE p.before IS NOT NULL),
        d AS (SELECT k.conv_id, k.turn, coalesce(a.n, 0) - coalesce(b.n, 0) AS d
              FROM k LEFT JOIN n a ON a.conv_id = k.conv_id AND a.turn = k.turn AND a.w = k.w LEFT JOIN n b ON b.conv_id = k.conv_id AND b.turn = k.before AND b.w = k.w)
        SELECT conv_id, turn, sum(greatest(d, 0))::BIGINT AS created, sum(greatest(-d, 0))::BIGINT AS destroyed FROM d GROUP BY 1, 2""",
    "set_operations": """
        WITH k AS (SELECT user_id, event_type FROM events), c AS (SELECT DISTINCT user_id FROM k WHERE event_type = 'click'),
        p AS (SELECT DISTINCT user_id FROM k WHERE event_type = 'purchase'), e AS (SELECT DISTINCT user_id FROM k WHERE event_type = 'error')
        SELECT 'union_all' AS op, count(*) AS n, sum(user_id)::BIGINT AS users FROM k WHERE event_type IN ('click', 'purchase', 'error')
        UNION ALL SELECT 'intersect', count(*), sum(user_id)::BIGINT FROM (SELECT * FROM c INTERSECT SELECT * FROM p INTERSECT SELECT * FROM e)
        UNION ALL SELECT 'except', count(*), sum(user_id)::BIGINT FROM (SELECT * FROM c EXCEPT SELECT * FROM p)""",
}
