"""Operators on small tables made for their corner cases."""

import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from boxloom.functions import box, text
from boxloom.operators import corpus, pairs, ranks, samples, trees
from boxloom.sources import files, search
from boxloom.streaming import events


def test_pooled_merge_equals_direct(spark):
    rows = spark.range(1000).select(F.pmod("id", F.lit(7)).alias("shard"), F.lit("g").alias("g"), (F.pmod(F.col("id") * 37, F.lit(101)) / 3.0).alias("x"))
    partial = rows.groupBy("g", "shard").agg(F.count("*").alias("n"), F.avg("x").alias("avg"), F.stddev_samp("x").alias("std"))
    merged = pairs.pooled(partial, ["g"]).first()
    direct = rows.agg(F.round(F.avg("x"), 4), F.round(F.stddev_samp("x"), 4)).first()
    assert (merged.avg, merged.std) == tuple(direct) and merged.n == 1000


def test_pooled_single_row_has_no_deviation(spark):
    one = spark.createDataFrame([("g", 1, 4.0, None)], "g string, n long, avg double, std double")
    assert pairs.pooled(one, ["g"]).first()[1:] == (1, 4.0, 0.0)


def test_polluted_null_group_goes_as_a_group(spark):
    rows = spark.createDataFrame([(None, "bad"), (None, "fine"), ("a", "fine"), ("b", "bad"), ("b", "fine")], "g string, t string")
    assert [r.g for r in corpus.drop_polluted(rows, "g", F.col("t") == "bad").collect()] == ["a"]


def test_prefix_and_task_of_ids(spark):
    row = spark.createDataFrame([("m__1__2",), ("plain",)], "i string").select(corpus.prefix_of(F.col("i")).alias("p"), corpus.task_of(F.col("i")).alias("t")).collect()
    assert [tuple(r) for r in row] == [("m", "m__1"), ("", None)]


def test_containing_short_and_long_passages(spark):
    texts = spark.createDataFrame([(1, "say the quick brown fox ran"), (2, "xx"), (3, None)], "i int, t string")
    wanted = spark.createDataFrame([(1, "quick brown fox"), (2, "x"), (3, ""), (4, "brown  fox")], "k int, p string")
    found = corpus.containing(texts, "i", "t", wanted, "k", "p").collect()
    assert sorted(tuple(r) for r in found) == [(1, 1), (1, 2), (2, 2)]


def test_auc_with_ties(spark):
    rows = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 1), (0.0, 0)], "s double, y int")
    assert ranks.auc(rows, "s", "y").first().auc == pytest.approx(0.875)


def test_metrics_leave_out_single_candidates(spark):
    rows = spark.createDataFrame([("a", 1, 1.0, 1.0), ("b", 1, 2.0, 0.0), ("b", 2, 2.0, 1.0)], "g string, o int, s double, l double")
    found = ranks.set_metrics(rows, "g", "o", "s", "l").collect()
    assert [(r.g, r.picked, r.regret, r.rho) for r in found] == [("b", 0.0, 1.0, None)]


def test_rollup_counts_a_satisfied_node_once(spark):
    rows = [("r", None, 0, 0), ("a", "r", 1, 1), ("b", "r", 1, 0), ("c", "a", 2, 0), ("d", "a", 2, 1), ("e", "b", 2, 0)]
    found = {r.id: r for r in trees.rollup(spark.createDataFrame(rows, "id string, parent string, level int, sat int"), 2).collect()}
    assert (found["a"].n_leaf, found["a"].n_sat, found["a"].min_depth) == (1, 1, 1)
    assert (found["r"].n_leaf, found["r"].n_sat, found["r"].sat_ratio, found["r"].n_children) == (2, 1, 0.5, 2)


def test_admission_is_greedy(spark):
    rows = spark.createDataFrame([(0, 1, ["a", "b"]), (0, 2, ["a"]), (0, 3, ["b"]), (0, 4, ["c"])], "s int, o int, b array<string>")
    assert sorted(r.o for r in samples.admitted(rows, "s", "o", "b", 1).collect()) == [1, 4]


def test_index_quantile_is_an_element(spark):
    rows = spark.createDataFrame([("a", float(x)) for x in (1, 2, 2, 9)], "g string, v double")
    row = samples.index_quantiles(rows, ["g"], "v", {"p50": 0.5, "top": 1.0}).first()
    assert (row.p50, row.top, row.n) == (2.0, 9.0, 4)


def test_range_specs():
    assert search.bounds(3) == (3, 3) and search.bounds([1, 2]) == (1, 2) and search.bounds({"low": 1, "max": 5}) == (1, 5) and search.bounds(None) is None
    with pytest.raises(ValueError):
        search.condition(["a"], {})


def test_ordered_shards(spark, tmp_path):
    rows = spark.range(25).select((F.lit(25) - F.col("id")).alias("k"))
    files.write_shards(rows, str(tmp_path / "out"), ["k"], 10)
    back = spark.read.json(str(tmp_path / "out"))
    assert [(r.shard, r.n, r.lo) for r in back.groupBy("shard").agg(F.count("*").alias("n"), F.min("k").alias("lo")).orderBy("shard").collect()] == [(0, 10, 1), (1, 10, 11), (2, 5, 21)]


def test_broken_lines_are_kept_as_text(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    rows = files.read_jsonl(spark, str(tmp_path / "x.jsonl"), StructType([StructField("a", IntegerType())])).cache()
    assert [r.a for r in rows.orderBy("_place").collect()] == [1, None, 3] and rows.where("_corrupt IS NOT NULL").count() == 1


def test_read_any_and_missing_marks(spark, tmp_path):
    (tmp_path / "x.smi").write_text("CCO ethanol\n\nC methane\n")
    assert [r.smiles for r in files.read_any(spark, str(tmp_path / "x.smi"), "smiles").collect()] == ["CCO", "C"]
    (tmp_path / "t.tsv").write_text("id\tv\na\t*\nb\t2\n")
    schema = StructType([StructField("id", StringType()), StructField("v", IntegerType())])
    assert [tuple(r) for r in files.read_table(spark, str(tmp_path / "t.tsv"), schema).collect()] == [("a", None), ("b", 2)]


def test_resume(spark, tmp_path):
    done = spark.createDataFrame([("a", 0, 2), ("a", 1, 2), ("b", 0, 2)], "g string, i int, n int")
    assert {r.g for r in files.complete_groups(done, "g", "i", "n").collect()} == {"a"}
    todo = spark.createDataFrame([("a",), ("c",)], "g string")
    assert [r.g for r in files.pending(todo, done, "g").collect()] == ["c"]
    files.write_mode(spark, str(tmp_path / "m"), {"filter": 1})
    assert files.same_mode(spark, str(tmp_path / "m"), {"filter": 1}) and not files.same_mode(spark, str(tmp_path / "m"), {"filter": 2})


def test_closed_sessions_of_a_stream_equal_the_batch(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.write.parquet(str(tmp_path / "in"))
    stream = events.sessions(events.read_events(spark, str(tmp_path / "in")), "10 minutes", late="1 hour")
    live = {tuple(r) for r in events.run_to_end(stream, "closed_sessions", "append", str(tmp_path / "cp")).select("user_id", "first", "n").collect()}
    batch = {tuple(r) for r in events.sessions(source.withColumn("ts", F.col("ts").cast("timestamp")), "10 minutes").select("user_id", "first", "n").collect()}
    assert live <= batch and len(batch) - len(live) < 0.1 * len(batch)


def test_capped_batches(spark):
    rows = spark.createDataFrame([(i, 7, i * 40) for i in range(6)], "event_id long, user_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    found = events.capped_batches(rows, gap_s=60, wait_s=100, most=10).orderBy("event_id").collect()
    assert [r.batch for r in found] == [0, 0, 0, 1, 1, 1]


def test_hybrid_search_is_no_worse_than_greedy(spark):
    finder = trees.Search(spark.createDataFrame([("a", 7.0), ("b", -5.0)], "edit string, delta double"))
    asked = spark.createDataFrame([(i, float(i), 11.0, 11.0) for i in range(12)], "id long, value double, lo double, hi double")
    greedy = {r.id: r.gap for r in finder.run(asked, 4, 1).collect()}
    assert all(r.gap <= greedy[r.id] for r in finder.hybrid(asked, 4, 3).collect())


def test_nfkc_equals_python(spark):
    texts = ["", None, "plain  text ", "ﬁne ① ２", "e\u0301 ½ Å ㎏ ﷺ", "a\u00a0\u2003b", "“x” − y ― z", "日本 ｶﾞ"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.normalised(F.col("t")).alias("o")).orderBy("i").collect()
    plain = str.maketrans("‘’“”‐‑‒–—―−", "''\"\"-------")
    assert [r.o for r in rows] == [None if t is None else " ".join(unicodedata.normalize("NFKC", t).translate(plain).split()) for t in texts]


def test_a_miss_is_marked_where_the_value_was_inside(spark):
    rows = spark.createDataFrame([(5.0, 12.0), (5.0, 30.0), (None, 15.0), (5.0, None), (15.0, 15.0)], "v double, b double")
    found = rows.select(box.bucket(F.col("v"), F.lit(10.0), F.lit(20.0), F.lit(1.0), before=F.col("b")).alias("x")).collect()
    assert [r.x for r in found] == ["misses*", "misses", "misses*", "misses", "holds"]


def test_decisions_need_a_state_two_children_and_a_way(spark):
    rows = [("a", None, 0, 0), ("b", "a", 1, 0), ("c", "a", 1, 0), ("d", "b", 2, 1), ("e", "b", 2, 0), ("f", "c", 2, 0), ("g", "c", 2, 0), ("h", "d", 3, 1),
            ("i", "e", 3, 1), ("j", "e", 3, 0), ("k", "none", 3, 1), ("l", "none", 3, 1)]
    nodes = trees.rollup(spark.createDataFrame(rows, "id string, parent string, level int, sat int"), 3)
    assert {(r.state, r.n) for r in trees.decisions(nodes, 2, 1).collect()} == {("a", 2), ("b", 2)}
    assert {r.state for r in trees.decisions(nodes, 2, 2).collect()} == {"a", "b", "e"}
