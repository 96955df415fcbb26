"""String, array and record functions over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, text
from ..sources.tables import table


def label_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from descriptions made of a document's words."""
    words = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("([a-z]+s)[ .,]"), F.lit(1)))).alias("w")
    rows = table(spark, sf_dir, "documents").select(words).distinct()
    made = F.concat(F.lit("Number of big "), F.col("w"), F.when(F.length("w") % 2 == 0, " groups").otherwise(""))
    return rows.select("w", text.label(made).alias("label"), text.singular(F.col("w")).alias("one"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of sentences of a document, its longest one, and the hash of its last."""
    rows = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    longest = F.aggregate("s", F.lit(0), lambda a, x: F.greatest(a, F.length(x)))
    return rows.select("doc_id", F.size("s").alias("n"), longest.alias("longest"), F.md5(F.element_at("s", -1).cast("binary")).alias("last"))


def nfkc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' texts in NFKC and with plain punctuation; signs that this changes are put before every third."""
    made = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat(F.lit("ﬁne ① ２\u00a0− “x” "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.normalised(made).alias("plain"))


def attachment_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit("*C"), F.when(F.pmod("p_partkey", F.lit(3)) == 0, "[*]N*").when(F.pmod("p_partkey", F.lit(3)) == 1, "[*:2]").otherwise("O"), F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", text.numbered_attachments(made).alias("mapped"))


def atom_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The atom that carries a part's size as its map number, out of one made structure."""
    mapped = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("["), F.element_at(F.array(*map(F.lit, ("C", "NH", "O", "Cl"))), F.pmod(i, F.lit(4)) + 1), F.lit(":"), i.cast("string"), F.lit("]"))), "")
    return table(spark, sf_dir, "part").select("p_partkey", text.atom_at(mapped, F.col("p_size")).alias("atom"))


def clean_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a control tag, trailing structure lines and a meta phrase added, cleaned again."""
    tail = F.when(F.pmod("doc_id", F.lit(2)) == 0, "\nCCO(=O)N1CC\n  c1ccccc1O").otherwise(" </ANSWER>")
    made = F.concat(F.lit("<ANSWER>"), F.col("text"), tail)
    cleaned = text.stripped(made)
    cut = text.without_meta(F.concat(F.lit("It holds. So it is. "), F.col("source"), F.lit(" as an AI model, I go on.")), "as an AI")
    return table(spark, sf_dir, "documents").select("doc_id", F.length(cleaned).alias("n"), F.md5(cleaned.cast("binary")).alias("cleaned"), cut.alias("cut"))


def span_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What spans made of lines drop and take."""
    n = lambda c: F.col(c).cast("int").cast("string")
    made = F.concat(
        F.lit("I set aside Edit "), n("l_linenumber"), F.lit(" because Edit 9 is better. "), F.lit("Edit "), n("l_quantity"),
        F.lit(" is discarded. I drop Edit 2 too. Taking Edit "), n("l_suppkey"), F.lit(": done."),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity", "l_suppkey").distinct()
    return lines.select("l_linenumber", "l_quantity", "l_suppkey", F.array_join(text.dropped(made).cast("array<string>"), ",").alias("drops"), text.committed(made).alias("takes"))


def verification_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rendered block of two constraints a part, and how the numbers are worded."""
    one = lambda name, v, lo, hi: F.struct(F.lit(name).alias("name"), v.cast("double").alias("value"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), v.between(lo, hi).alias("ok"))
    rows = F.array(one("size", F.col("p_size"), 10.0, 30.5), one("price", F.col("p_retailprice"), 950.25, 1100.0))
    return table(spark, sf_dir, "part").select("p_partkey", text.verification(rows).alias("block"), text.counted(F.pmod("p_size", F.lit(13)).cast("int"), "ring").alias("rings"))


def port_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = F.concat_ws(",", F.concat_ws("-", "p_size", F.col("p_size") + 3), F.lit(" 7"), F.lit(""))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.expanded(spec).cast("array<string>"), " ").alias("ports"))


def negation_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clauses of a document with a word, and those in which nothing negates it; a negation is put before every other one."""
    made = F.regexp_replace("text", "\\bthe\\b", F.lit("not the"))
    return table(spark, sf_dir, "documents").select("doc_id", text.unnegated(F.col("text"), "\\bthe\\b").alias("plain"), text.unnegated(made, "\\bthe\\b").alias("negated"))


def bounds_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as a map, as records, and as a map again."""
    side = lambda lo, hi: F.struct(lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))
    bounds = F.create_map(F.lit("size"), side(F.col("p_size") - 1, F.col("p_size") + 1), F.lit("price"), side(F.floor("p_retailprice"), F.ceil("p_retailprice")))
    rows = table(spark, sf_dir, "part").select("p_partkey", arrays.bounds_list(bounds).alias("records"))
    back = arrays.bounds_map(F.col("records"))
    return rows.select("p_partkey", F.col("records")[0]["name"].alias("first"), F.size("records").alias("n"), back["size"]["lo"].alias("size_lo"), back["price"]["hi"].alias("price_hi"))


def calls_with_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made calls with fewer replies than calls: nested, paired, exploded again, and whether a chain has a call without an answer."""
    words = F.filter(F.split("p_name", " "), lambda w: w != "")
    replies = F.transform(F.sequence(F.lit(1), F.greatest(F.pmod("p_size", F.lit(3)).cast("int"), F.lit(1))), lambda i: F.slice(F.array("p_brand", "p_type"), 1, F.pmod(F.col("p_size") + i, F.lit(3)).cast("int")))
    rows = table(spark, sf_dir, "part").select("p_partkey", arrays.answered(words, replies).alias("pairs"))
    steps = rows.select("p_partkey", arrays.empty_replies(F.col("pairs"), "widget").alias("empty"), F.posexplode("pairs").alias("step", "pair"))
    out = steps.select("p_partkey", "empty", "step", F.col("pair.call").alias("call"), F.explode_outer("pair.reply").alias("candidate"))
    return out.where("call IS NOT NULL")


def feature_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by prefix; global ones that vary within an order are demoted to candidates' features."""
    features = F.create_map(F.lit("s_qty"), F.col("l_quantity"), F.lit("g_tax"), F.col("l_tax"), F.lit("r_disc"), F.col("l_discount"))
    shared, own = arrays.by_prefix(features, ("s_", "g_"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", shared.alias("g"), own.alias("c"))
    each = rows.select("l_orderkey", F.explode("g").alias("name", "v")).groupBy("l_orderkey", "name").agg(F.count_distinct("v").alias("values"))
    return each.groupBy("name").agg(F.count_if(F.col("values") == 1).alias("constant"), F.count_if(F.col("values") > 1).alias("demoted"))


def record_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with fields put over theirs, and a nested key lifted where there is none."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("user_id") % 2 == 0, F.col("user_id")).alias("k"), "props")
    put = arrays.merged(rows, {"event_type": F.upper("event_type"), "seen": F.lit(1)})
    return arrays.lifted(put, "k", F.get_json_object("props", "$.k").cast("bigint")).select("event_id", "event_type", "seen", "k")


def segment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of three turns, each with the same two header messages, as one record; and its prefix."""
    turns = table(spark, sf_dir, "conversations").where("turn < 30")
    body = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda m: F.concat_ws("", F.substring(m["role"], 1, 1), m["turn"]))
    parts = turns.groupBy("conv_id", F.floor(F.col("turn") / 3).cast("int").alias("index")).agg(body.alias("body"))
    whole = F.concat(F.array(F.lit("H"), F.lit("h")), F.col("body")).alias("messages")
    records = parts.select("conv_id", F.struct("index", whole).alias("s")).groupBy("conv_id").agg(arrays.joined_segments(F.collect_list("s"), 2).alias("m"))
    return records.select("conv_id", F.array_join("m", " ").alias("merged"), F.array_join(arrays.prefix(F.col("m"), 4), " ").alias("seed"))


QUERIES = {f.__name__: f for f in (label_normalisation, sentence_split, attachment_numbers, atom_labels, clean_reasoning, span_parsing, verification_block, port_ranges,
                                   negation_guard, bounds_round_trip, calls_with_replies, feature_split, record_merge, segment_merge, nfkc_text)}

_ONE = """CASE WHEN {0} LIKE '%ies' THEN left({0}, -3) || 'y' WHEN regexp_matches({0}, '(ses|xes|zes|ches|shes)$') THEN left({0}, -2)
          WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ss' THEN left({0}, -1) ELSE {0} END"""
_SENTENCES = rf"""list_filter(list_transform(string_split(regexp_replace(regexp_replace(trim(text, ' '), '(?i)({'|'.join(text.ABBREVIATIONS)})\.[ \t\r\n]+', '\1.' || chr(1), 'g'),
                '([.!?])[ \t\r\n]+', '\1' || chr(2), 'g'), chr(2)), lambda s: replace(s, chr(1), ' ')), lambda s: trim(s, ' ') <> '')"""
_NUMBER = r"regexp_replace(printf('%.3f', {0}::DOUBLE), '\.?0+$', '')"
_GUARD = r"""len(list_filter(regexp_split_to_array({0}, '[,;.!?]'), lambda c: regexp_matches(c, '\bthe\b') AND NOT regexp_matches(
             right(regexp_extract(c, '^(.*?)\bthe\b', 1, 's'), 42), '(?:^|[^a-z])(?:no|not|without|never)(?:[^a-z]|$)')))::INT"""

ORACLE_SQL = {
    "label_normalisation": f"""
        WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '([a-z]+s)[ .,]', 1)) AS w FROM documents)
        SELECT w, 'big ' || {_ONE.format("w")} AS label, {_ONE.format("w")} AS one FROM w""",
    "sentence_split": f"""
        WITH s AS (SELECT doc_id, {_SENTENCES} AS s FROM documents)
        SELECT doc_id, len(s)::INT AS n, coalesce(list_max(list_transform(s, lambda x: length(x))), 0)::INT AS longest, md5(s[-1]) AS last FROM s""",
    "attachment_numbers": """
        SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '[*:1]C[*:2]N[*:3]' || p_size WHEN 1 THEN '*C[*:2]' || p_size ELSE '[*:1]CO' || p_size END AS mapped FROM part""",
    "atom_labels": """
        SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 30 THEN (['C', 'NH', 'O', 'Cl'])[p_size % 4 + 1] ELSE '' END AS atom FROM part""",
    "clean_reasoning": """
        WITH p AS (SELECT doc_id, source, '<ANSWER>' || text || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'CCO(=O)N1CC' || chr(10) || '  c1ccccc1O' ELSE ' </ANSWER>' END AS t FROM documents),
        q AS (SELECT doc_id, regexp_replace(regexp_replace(t, '</?ANSWER>', '', 'g'), '(\\n[ \\t]*[A-Za-z0-9@+\\[\\]()=#\\\\/%.\\-]{5,}[ \\t]*)+[ \\t\\r\\n]*$', '') AS t FROM p),
        c AS (SELECT doc_id, trim(regexp_replace(t, '[ \\t]{2,}', ' ', 'g'), ' ') AS t FROM q)
        SELECT doc_id, length(t)::INT AS n, md5(t) AS cleaned, 'It holds. So it is.' AS cut FROM c""",
    "span_parsing": """
        SELECT DISTINCT l_linenumber, l_quantity, l_suppkey,
               (l_linenumber - 1) || ',' || CASE WHEN l_quantity::INT <> l_linenumber THEN l_quantity::INT - 1 ELSE 1 END AS drops, (l_suppkey - 1)::INT AS takes
        FROM lineitem WHERE NOT (l_linenumber = 2 AND l_quantity = 2)
        UNION ALL SELECT DISTINCT l_linenumber, l_quantity, l_suppkey, '1', (l_suppkey - 1)::INT FROM lineitem WHERE l_linenumber = 2 AND l_quantity = 2""",
    "verification_block": f"""
        WITH p AS (SELECT *, p_size BETWEEN 10 AND 30.5 AS a, p_retailprice BETWEEN 950.25 AND 1100 AS b, p_size % 13 AS r FROM part)
        SELECT p_partkey, 'Verification:' || chr(10) || '- size: ' || p_size || ' in [10, 30.5] ' || CASE WHEN a THEN 'ok' ELSE 'off' END || chr(10)
               || '- price: ' || {_NUMBER.format("p_retailprice")} || ' in [950.25, 1100] ' || CASE WHEN b THEN 'ok' ELSE 'off' END || chr(10)
               || (a::INT + b::INT) || '/2 satisfied.' AS block,
               coalesce((['no', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten'])[r + 1], r::VARCHAR) || ' ring' || CASE WHEN r = 1 THEN '' ELSE 's' END AS rings FROM p""",
    "port_ranges": "SELECT p_partkey, p_size || ' ' || (p_size + 1) || ' ' || (p_size + 2) || ' ' || (p_size + 3) || ' 7' AS ports FROM part",
    "negation_guard": f"""
        SELECT doc_id, {_GUARD.format("text")} AS plain, {_GUARD.format("regexp_replace(text, '" + chr(92) + "bthe" + chr(92) + "b', 'not the', 'g')")} AS negated FROM documents""",
    "bounds_round_trip": "SELECT p_partkey, 'price' AS first, 2 AS n, p_size - 1.0::DOUBLE AS size_lo, ceil(p_retailprice) AS price_hi FROM part",
    "calls_with_replies": """
        WITH p AS (SELECT p_partkey, p_size, p_brand, p_type, list_filter(string_split(p_name, ' '), lambda w: w <> '') AS w, greatest(p_size % 3, 1) AS k FROM part),
        s AS (SELECT *, unnest(range(len(w))) AS step FROM p),
        r AS (SELECT p_partkey, step, w[step + 1] AS call, CASE WHEN step < k THEN ([p_brand, p_type])[1:(p_size + step + 1) % 3] END AS reply FROM s),
        e AS (SELECT p_partkey, bool_or(call = 'widget' AND coalesce(len(reply), 0) = 0) AS empty FROM r GROUP BY 1)
        SELECT p_partkey, empty, step::INT AS step, call, unnest(CASE WHEN coalesce(len(reply), 0) = 0 THEN [NULL] ELSE reply END) AS candidate FROM r JOIN e USING (p_partkey)""",
    "feature_split": """
        WITH l AS (SELECT l_orderkey, 's_qty' AS name, l_quantity AS v FROM lineitem UNION ALL SELECT l_orderkey, 'g_tax', l_tax FROM lineitem),
        e AS (SELECT l_orderkey, name, count(DISTINCT v) AS n FROM l GROUP BY 1, 2)
        SELECT name, count(*) FILTER (n = 1) AS constant, count(*) FILTER (n > 1) AS demoted FROM e GROUP BY 1""",
    "record_merge": "SELECT event_id, upper(event_type) AS event_type, 1 AS seen, CASE WHEN user_id % 2 = 0 THEN user_id ELSE json_extract_string(props, '$.k')::BIGINT END AS k FROM events",
    "segment_merge": """
        WITH t AS (SELECT conv_id, turn, left(role, 1) || turn AS m FROM conversations WHERE turn < 30),
        g AS (SELECT conv_id, ['H', 'h'] || list(m ORDER BY turn) AS m FROM t GROUP BY 1)
        SELECT conv_id, array_to_string(m, ' ') AS merged, array_to_string(m[1:4], ' ') AS seed FROM g""",
}
