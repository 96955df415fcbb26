"""URL templates, mixing, the thin queries against SQL, and the pipeline's stages."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from boxloom.llm import mixing, queries, url_filter

DATA = Path("/root/testdata/sf0.001")
PAGES = "page_id long, url string, host string"


def test_urls_and_rules(spark):
    urls = {
        1: "HTTP://A.Example.COM/en/7/x?q#f", 2: "http://example.com/en/8", 3: "https://example.net", 4: "x://example.net/de/81#t", 5: "//no", 6: None, 7: "http://h?/en/",
        8: "http://com/en/", 9: "http://notcom/en/", 10: "a://b://c/d", 11: "http://x.net/de/", 12: "http://É.org/es/Ä",
    }
    pages = spark.createDataFrame([(i, u, "z") for i, u in urls.items()] + [(1, urls[1], "z")], PAGES)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, labels).collect()}
    assert found == {
        1: ("a.example.com", "/en/7/x", "example.com/en/7", "allow"), 2: ("example.com", "/en/8", "com/en/", "block"), 3: ("example.net", "", None, "allow"),
        4: ("example.net", "/de/81", "example.net/de/8", "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("h", "", None, "allow"),
        8: ("com", "/en/", "com/en/", "block"), 9: ("notcom", "/en/", None, "allow"), 10: ("b:", "//c/d", None, "allow"), 11: ("x.net", "/de/", "net/de/", "allow"),
        12: ("É.org", "/es/Ä", "org/es/", "block"),
    }


def test_templates(spark):
    """Two sections differ in purity and stay apart; a third that is like the rest, and all numbers, become wildcards."""
    rows = [(i, f"http://h/{'spam' if i % 3 == 0 else 'news' if i % 3 == 1 else 'blog'}/{i}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(300)] + [(1, None, None)], "doc_id long, quality int, toxic int")
    found = url_filter.judge(spark.createDataFrame([(i, u, "") for i, u in rows], PAGES), labels).collect()
    by = {r.template: r.verdict for r in found}
    assert by["/spam/*"] == "block" and all(v == "allow" for t, v in by.items() if t != "/spam/*") and len(by) <= 4
    assert url_filter.judge(spark.createDataFrame([], PAGES), labels).count() == 0


def test_small_and_deep_branches_with_evidence_stay_apart(spark):
    """A bad section with 2 % of a host's pages, and one at the fifth level, are blocked; the rest is not."""
    rows = [(i, f"http://h/s{i % 50}/{i}") for i in range(3000)]
    rows += [(9000 + i, f"http://g/a/b/c/d/{'bad' if i % 4 == 0 else 'fine'}/{i}/x") for i in range(400)]
    bad = {i for i, _ in rows if i < 3000 and i % 50 == 7 or i >= 9000 and i % 4 == 0}
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    found = url_filter.judge(spark.createDataFrame([(i, u, "") for i, u in rows], PAGES), labels, rules=(("block", "none/"),)).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == bad
    assert any(r.template == "/s7/*" for r in found) and any(r.template.endswith("/bad/**") for r in found)


def test_branches_like_each_other_are_merged_as_in_sql(spark, duck, tmp_path):
    """Six sections: two bad, two fair, two good ones; each pair is one template, and only the bad ones are blocked. SQL agrees."""
    share = {"ads": 9, "spam": 9, "shop": 2, "misc": 2, "news": 0, "blog": 0}  # bad pages of ten
    pages, labels = [], []
    for k, (section, bad) in enumerate(share.items()):
        for i in range(400):
            pages.append((k * 1000 + i, f"http://{'H' if i % 2 else 'h'}/{section}/{i}", ""))
            labels.append((k * 1000 + i, int(i % 10 >= bad), 0))
    pages += [(90_000 + i, f"http://other/a/{i}/", "") for i in range(2000)]
    labels += [(90_000 + i, 1, 0) for i in range(2000)]
    pages += [(95_000, "http://h/" + "/".join("x" * 3000), ""), (95_001, "http://h/" + "y" * 200_000, "")]
    frames = {"pages": spark.createDataFrame(pages, PAGES), "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int")}
    found = url_filter.judge(frames["pages"], frames["labels"]).collect()
    by = {}
    for r in found:
        by.setdefault((r.host, r.template), set()).add(r.path.split("/")[1])
    groups = {frozenset(v) for (h, t), v in by.items() if h == "h" and "#" in t}
    assert {frozenset({"ads", "spam"}), frozenset({"shop", "misc"}), frozenset({"news", "blog"})} == groups
    assert {r.path.split("/")[1] for r in found if r.verdict == "block"} == {"ads", "spam"}
    for name, frame in frames.items():
        rows = frame.where("page_id < 95000") if name == "pages" else frame  # the SQL walks three levels
        rows.write.parquet(str(tmp_path / name))
        duck.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS SELECT * FROM '{tmp_path / name}/*.parquet'")
    wanted = {r[0]: r[1:] for r in duck.sql(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.judge_sql()})").fetchall()}
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found if r.page_id < 95_000} == wanted


MIX = "doc_id long, text string, lang string, source string, tokens string, quota string"


def test_shortage_goes_to_siblings_before_ancestors(spark):
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(10), "en", "src0") for i in range(100)] + [(1000 + i, text(10), "de", "src0") for i in range(2)] + [(2000 + i, text(10), "en", "src1") for i in range(100)]
    rows += [(3000, None, None, None), (3001, "", "fr", "odd")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], MIX)
    found = mixing.uses(docs.drop("tokens", "quota"), budget=0.5, epochs=1, weights={"domain": {"d0": 50, "d1": 50}, "lang": {"en": 50, "de": 50}, "source": {}}, other=0).collect()
    assert len(found) == len(rows) and not any(r.times for r in found)  # the source level has weight 0 for all
    weights = {"domain": {"d0": 50, "d1": 50}, "lang": {"en": 50, "de": 50}, "source": {"src0": 1, "src1": 1}}
    used = {}
    for r in mixing.mixed(docs, budget=0.5, epochs=1, weights=weights, other=0).collect():
        used[r.source, r.lang] = used.get((r.source, r.lang), 0) + len(r.text.split())
    # 1010 tokens: 505 for each domain; German has 20 only, which its English sibling makes up for
    assert used == {("src0", "de"): 20, ("src0", "en"): 480, ("src1", "en"): 500}


def test_upsampling_is_bounded_by_epochs(spark):
    rows = [(i, "a b c d e", "en", "src0", "", "") for i in range(40)] + [(100 + i, "a b c d e", "en", "src1", "", "") for i in range(4)] + [(100, "a b c d e", "en", "src1", "", "")]
    docs = spark.createDataFrame(rows, MIX)
    mix = mixing.mixed(docs, budget=1.0, epochs=3, weights={"domain": {"d0": 1, "d1": 1}, "lang": {}, "source": {}}, other=1)
    assert mix.columns == docs.columns
    times = {}
    for r in mix.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times[101] == 3 and times[100] == 6 and max(n for i, n in times.items() if i < 100) == 1
    assert mixing.mixed(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, str(DATA))
    wanted = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    places = [wanted.columns.index(c) for c in columns]
    rows = lambda data, get: sorted(tuple(str(x) for x in get(r)) for r in data)
    assert rows(found.collect(), lambda r: [r[c] for c in columns]) == rows(wanted.fetchall(), lambda r: [r[i] for i in places])


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_stages_handle_odd_documents(spark, tmp_path):
    """Nulls in every column, repeated rows, an extra column: each stage keeps the columns; the last gives whole sequences."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string"
    plain = [(i, f"the cat sat on mat number {i} and then ran far away home", "en", f"src{i % 3}", 9, "k") for i in range(30)]
    odd = [(None, None, None, None, None, None), (50, None, "en", "src1", 0, "k"), (51, "", None, None, 0, "k"), (None, "lonely words", "en", "src1", 2, "k"), plain[0], plain[0],
           (60, plain[5][1].upper(), "en", "src0", 9, "k"), (61, "w " * 5000, "en", "src2", 9, "k")]
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(plain + odd, schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"stage{number}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{number}"))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert docs.count() and docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_stages_take_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert all(stage(spark, empty, str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)
