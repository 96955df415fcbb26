"""URL filters: a template tree per host, learned from labelled pages, and explicit rules that overrule it.

A path's segments are walked level by level. At each node (host and template so far) a branch stays
apart if its labels tell it from the rest of the node, however few of the pages it has: by a likelihood
ratio test whose limit grows with the number of branches tested at the level. Where labels are too few
for that, a branch with at least `share` of the node's pages stays if a two-proportion z-test on smoothed
counts finds it different. All others are merged into the wildcard `*`. Of the branches that stay,
those like each other are merged, too: in order of their purity, each is tested against the one before,
and those that are not told apart are one template, `first#number` (no path holds a `#`). Below `depth`
levels only the first test is made, for as long as any node's labels could pass it; what lies below the
last branch kept becomes `**`. A template is rejected when its share of good labelled pages, smoothed
towards its host's and that towards the whole corpus', is below `purity`.

All of it is aggregation and equi-joins: counts are taken before the shuffle, so a host with a third
of all pages costs a few partial rows a task. A node's totals meet its branches in `SALTS` tasks, dealt
by segment; a window sees only the branches of a node that stay apart.

Defined results: a null url, or one without `://`, has an empty host and path, and belongs to the
empty template of the empty host. Repeated pages count as often as they occur. Several labels of one
page count as good only if all are. Without labels nothing is rejected unless `prior` is below
`purity`. Only the id and the url are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, joinable, materialise

#: The branches of a node are dealt to as many tasks.
SALTS = 16

#: Fixed by the query's contract: (verdict, host and path prefix).
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#`; then up to `?`, `#`. Both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent domain of it, and the path's beginning."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, prefix = rule.partition("/")
        fits.append((((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{prefix}"), rule, verdict))
    return tuple(F.coalesce(*[F.when(test, F.lit(x[i])) for test, *x in fits]) for i in (0, 1))


def surprise(pairs: list[tuple[str, str]]) -> Column:
    """Twice the sum of o x ln(o / e) over (o, e) of SQL expressions: the likelihood ratio statistic."""
    return F.lit(2.0) * sum((F.when(F.expr(o) > 0, F.expr(f"({o}) * ln(({o}) / nullif({e}, 0))")).otherwise(F.lit(0.0)) for o, e in pairs), F.lit(0.0))


#: Good and bad labels of a branch and of the rest of its node, each with what the node's purity leads to expect.
AGAINST_REST = [
    ("g", "m * (node_g / double(node_m))"),
    ("m - g", "m * ((node_m - node_g) / double(node_m))"),
    ("node_g - g", "(node_m - m) * (node_g / double(node_m))"),
    ("node_m - node_g - (m - g)", "(node_m - m) * ((node_m - node_g) / double(node_m))"),
]


def proportions(m: str, g: str, other_m: str, other_g: str) -> str:
    """SQL of the two-proportion z statistic of two smoothed shares, g of m each."""
    both = f"(({g} + {other_g} + 2) / double({m} + {other_m} + 4))"
    apart = f"abs(({g} + 1) / double({m} + 2) - ({other_g} + 1) / double({other_m} + 2))"
    return f"{apart} / sqrt({both} * (1 - {both}) * (1 / double({m} + 2) + 1 / double({other_m} + 2)))"


def named(fixed: DataFrame, z: float) -> DataFrame:
    """(host, template, segment, name): branches that stay apart, those like each other under one name."""
    node = ["host", "template"]
    order = Window.partitionBy(*node).orderBy("p", "segment")
    chain = (
        fixed.withColumn("p", F.expr("(g + 1) / double(m + 2)")).withColumns({"last_m": F.lag("m").over(order), "last_g": F.lag("g").over(order)})
        .withColumn("part", F.sum(F.coalesce(F.expr(proportions("m", "g", "last_m", "last_g")) >= z, F.lit(True)).cast("int")).over(order))
    )
    alike = Window.partitionBy(*node, "part")
    size = F.count("*").over(alike)
    return chain.select(*node, "segment", F.when(size > 1, F.concat(F.min("segment").over(alike), F.lit("#"), size)).otherwise(F.col("segment")).alias("name"))


def templates(rows: DataFrame, depth: int, share: float, z: float) -> DataFrame:
    """`rows` (host, segments, good: 1, 0 or null) with `template`, level by level."""
    rows = rows.withColumn("template", F.lit(""))
    seen = [F.count("*").alias("n"), F.count("good").alias("m"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")]
    level = 0
    while level < depth or divisible(rows, level, z):
        rows = rows.withColumn("segment", F.get("segments", F.lit(level)))
        branches = rows.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(*seen)
        branches = materialise(branches.withColumn("salt", F.pmod(F.xxhash64("segment"), F.lit(SALTS))), f"url-branches{level}")
        nodes = branches.groupBy("host", "template").agg(*(F.sum(c).alias(f"node_{c}") for c in "nmg"))
        tests = branches.agg(F.greatest(F.count_if(F.col("m") > 0), F.lit(2)).alias("tests"))  # one row
        nodes = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        told = (F.col("node_m") > 0) & (surprise(AGAINST_REST) >= F.lit(z * z) + 2 * F.ln("tests"))
        common = (F.col("n") >= F.lit(share) * F.col("node_n")) & (F.expr(proportions("m", "g", "(node_m - m)", "(node_g - g)")) >= F.lit(z))
        fixed = branches.join(nodes, ["host", "template", "salt"]).crossJoin(F.broadcast(tests)).where(told | common if level < depth else told)
        fixed = joinable(named(fixed, z), f"url-fixed{level}")
        grown = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), F.coalesce("name", F.lit("*"))))
        rows = rows.join(fixed, ["host", "template", "segment"], "left").withColumn("template", grown).drop("name", "segment")
        rows = materialise(rows, f"url-level{level}")
        level += 1
    last = F.regexp_replace("template", rf"(?s)\A((?:/[^/]*){{{depth}}}.*?)(?:/\*)*\z", "$1")  # wildcards below `depth` and the last branch
    deeper = F.size("segments") > F.size(F.split(last, "/")) - 1
    return rows.withColumn("template", F.when(F.size("segments") > depth, F.concat(last, F.when(deeper, F.lit("/**")).otherwise(F.lit("")))).otherwise(F.col("template")))


def divisible(rows: DataFrame, level: int, z: float) -> bool:
    """Whether labels of any node's pages that go on below `level` could tell a branch, were it to part them wholly."""
    nodes = rows.where((F.size("segments") > level) & F.col("good").isNotNull()).groupBy("host", "template").agg(F.count("good").alias("m"), F.sum("good").alias("g"))
    parted = surprise([("g", "g * (g / double(m))"), ("m - g", "(m - g) * ((m - g) / double(m))")])
    return not nodes.where(parted >= F.lit(z * z) + 2 * F.ln(F.lit(2))).isEmpty()


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, depth: int = 3, share: float = 0.05,
          z: float = 1.96, prior: float = 20.0, purity: float = 0.6) -> DataFrame:
    """(page_id, host, path, template, purity, rule, verdict) per page; `labels` has doc_id (the page), quality, toxic."""
    good = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rows = urls.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != "")).join(good, "page_id", "left")
    placed = templates(materialise(rows, "url-rows"), depth, share, z)
    by_template = placed.groupBy("host", "template").agg(F.count("good").alias("m"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"))
    by_template = materialise(by_template, "url-templates")
    by_host = by_template.groupBy("host").agg(F.sum("m").alias("host_m"), F.sum("g").alias("host_g"))
    m, g = by_host.agg(F.sum("host_m"), F.sum("host_g")).first()
    overall = (g or 0) / m if m else 1.0
    host_purity = (F.col("host_g") + F.lit(prior * overall)) / (F.col("host_m") + F.lit(prior))
    smoothed = (F.col("g") + F.lit(prior) * host_purity) / (F.col("m") + F.lit(prior))
    scored = by_template.join(by_host, "host").select("host", "template", smoothed.alias("purity"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("purity") < purity, F.lit("block")).otherwise(F.lit("allow"))
    return placed.join(scored, ["host", "template"]).select(
        "page_id", "host", "path", "template", "purity", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict")
    )


def judge_sql(depth: int = 3, share: float = 0.05, z: float = 1.96, prior: float = 20.0, purity: float = 0.6) -> str:
    """The same in DuckDB SQL, for the `pages` and `labels` views, whose paths have at most `depth` segments."""
    plain = lambda test: test.replace("double(", "(1.0::DOUBLE * ")
    terms = [f"(CASE WHEN ({o}) > 0 THEN ({o}) * ln((({o}) / nullif({plain(e)}, 0))::DOUBLE) ELSE 0 END)" for o, e in AGAINST_REST]
    levels = []
    for k in range(depth):
        levels.append(f"""
        b{k} AS (SELECT host, template, segments[{k + 1}] AS segment, count(*) AS n, count(good) AS m, coalesce(sum(good), 0)::BIGINT AS g
                 FROM r{k} WHERE len(segments) > {k} GROUP BY ALL),
        n{k} AS (SELECT host, template, sum(n)::BIGINT AS node_n, sum(m)::BIGINT AS node_m, sum(g)::BIGINT AS node_g FROM b{k} GROUP BY ALL),
        t{k} AS (SELECT greatest(count(*) FILTER (WHERE m > 0), 2) AS tests FROM b{k}),
        f{k} AS (SELECT host, template, segment, m, g, (g + 1) / (m + 2)::DOUBLE AS p FROM b{k} JOIN n{k} USING (host, template), t{k}
                 WHERE (n >= {share} * node_n AND {plain(proportions("m", "g", "(node_m - m)", "(node_g - g)"))} >= {z})
                    OR (node_m > 0 AND 2.0 * ({" + ".join(terms)}) >= {z * z} + 2 * ln(tests::DOUBLE))),
        c{k} AS (SELECT *, lag(m) OVER w AS last_m, lag(g) OVER w AS last_g FROM f{k} WINDOW w AS (PARTITION BY host, template ORDER BY p, segment)),
        d{k} AS (SELECT *, sum(coalesce({plain(proportions("m", "g", "last_m", "last_g"))} >= {z}, true)::INT)
                             OVER (PARTITION BY host, template ORDER BY p, segment) AS part FROM c{k}),
        e{k} AS (SELECT host, template, segment, CASE WHEN count(*) OVER w > 1 THEN min(segment) OVER w || '#' || count(*) OVER w ELSE segment END AS name
                 FROM d{k} WINDOW w AS (PARTITION BY host, template, part)),
        r{k + 1} AS (SELECT page_id, r.host, path, good, segments,
                 CASE WHEN len(segments) <= {k} THEN r.template
                      ELSE r.template || '/' || coalesce(e.name, '*') END AS template
                 FROM r{k} r LEFT JOIN e{k} e ON r.host = e.host AND r.template = e.template AND r.segments[{k + 1}] = e.segment)""")  # fmt: skip
    fits = []
    for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        domain, _, prefix = rule.partition("/")
        fits.append((f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{prefix}')", rule, verdict))
    case = lambda i: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + " END"
    return f"""
        WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
        v AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        lab AS (SELECT doc_id, min((quality = 1 AND toxic = 0)::INT) AS good FROM labels GROUP BY doc_id),
        r0 AS (SELECT page_id, host, path, good, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template
               FROM v LEFT JOIN lab ON page_id = doc_id),{",".join(levels)},
        t AS (SELECT page_id, host, path, good, template || CASE WHEN len(segments) > {depth} THEN '/**' ELSE '' END AS template FROM r{depth}),
        bt AS (SELECT host, template, count(good) AS m, coalesce(sum(good), 0) AS g FROM t GROUP BY ALL),
        bh AS (SELECT host, sum(m) AS hm, sum(g) AS hg FROM bt GROUP BY host),
        o AS (SELECT coalesce(sum(hg) / nullif(sum(hm), 0)::DOUBLE, 1.0) AS p FROM bh),
        s AS (SELECT bt.host, template, (g + {prior} * ((hg + {prior} * p) / (hm + {prior}))) / (m + {prior}) AS purity
              FROM bt JOIN bh ON bt.host = bh.host, o)
        SELECT page_id, t.host AS host, path, {case(1).replace("host", "t.host")} AS rule,
               coalesce({case(2).replace("host", "t.host")}, CASE WHEN purity < {purity} THEN 'block' ELSE 'allow' END) AS verdict
        FROM t JOIN s ON t.host = s.host AND t.template = s.template"""
