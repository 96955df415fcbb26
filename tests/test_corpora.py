"""Ordered reads, rechunking, resume, markers and samples of corpus files; text and array functions on corner cases."""

import hashlib
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from boxloom.functions import arrays, text
from boxloom.functions.hashing import blake_uniform
from boxloom.operators import selection
from boxloom.sources import corpora, files


@pytest.fixture()
def folder(tmp_path):
    home = tmp_path / "in"
    home.mkdir()
    for part, n in ((2, 3), (10, 4), (1, 5)):
        (home / f"part-{part}.jsonl").write_text("".join(json.dumps({"id": part * 100 + i, "key": i // 2}) + "\n" for i in range(n)))
    return home


def test_files_in_natural_order_and_rows_numbered(spark, folder):
    found = corpora.listing(spark, f"file://{folder}", ".jsonl")
    assert [f.rpartition("/")[2] for f in found] == ["part-1.jsonl", "part-2.jsonl", "part-10.jsonl"]
    plan = corpora.file_plan(corpora.lines(spark, found)).orderBy("file_place").collect()
    assert [(r["lines"], r.start) for r in plan] == [(5, 0), (3, 5), (4, 8)]
    rows = corpora.ordered(spark, found, start=4, limit=3).orderBy("row").collect()
    assert [(r.row, json.loads(r.value)["id"]) for r in rows] == [(4, 104), (5, 200), (6, 201)]


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n{bad\n\n{"id": 2}\n{"id": 3, "te')
    rows = corpora.lines(spark, [f"file://{tmp_path}/a.jsonl"])
    kept, counts = corpora.parsed(rows, "id int")
    assert sorted(r.record.id for r in kept.collect()) == [1, 2] and tuple(counts.first()) == (2, 1, 1)
    assert corpora.parsed(rows, "id int", "keep")[0].where("record IS NULL").count() == 2
    with pytest.raises(Exception, match="malformed line 1"):
        corpora.parsed(rows, "id int", "torn")[0].collect()
    (tmp_path / "b.jsonl").write_text('{"id": 1}\n{"id": 3, "te')
    assert corpora.parsed(corpora.lines(spark, [f"file://{tmp_path}/b.jsonl"]), "id int", "torn")[0].count() == 1


def test_contiguous_runs(spark, folder):
    rows = corpora.lines(spark, corpora.listing(spark, f"file://{folder}")).withColumn("key", F.get_json_object("value", "$.key"))
    found = corpora.runs(rows, "key", "line").groupBy("file", "run").count().collect()
    assert sorted(r["count"] for r in found) == [1, 1, 2, 2, 2, 2, 2]


def test_rechunk_and_merge(spark, folder, tmp_path):
    out = f"file://{tmp_path}/out"
    sizes = corpora.merge_parts(spark, [f"file://{folder}"], out, per_chunk=5).orderBy("chunk").collect()
    assert [(r.chunk, r["lines"]) for r in sizes] == [(0, 5), (1, 5), (2, 2)]
    back = [json.loads(line)["id"] for chunk in sorted((tmp_path / "out").glob("name=*")) for part in sorted(chunk.glob("*.txt")) for line in part.read_text().splitlines()]
    assert back == [100, 101, 102, 103, 104, 200, 201, 202, 1000, 1001, 1002, 1003]


def test_resume(spark, tmp_path):
    home = f"file://{tmp_path}"
    for k, n in enumerate((4, 4, 3)):
        (tmp_path / f"s-{k:05d}.jsonl").write_text("{}\n" * n)
    assert corpora.complete_shards(spark, home, "s", 4, 20) == 2 and corpora.complete_shards(spark, home, "s", 4, 11) == 3
    assert corpora.read_manifest(spark, home, "s", 4) == (0, 0)
    corpora.write_manifest(spark, home, 3, 17, 4)
    corpora.write_manifest(spark, home, 3, 18, 4)
    assert corpora.read_manifest(spark, home, "s", 4) == (3, 18) and corpora.read_manifest(spark, home, "s", 5) == (0, 0)
    (tmp_path / "s-00001.jsonl").unlink()
    assert corpora.read_manifest(spark, home, "s", 4) == (0, 0)


def test_markers_and_replacement(spark, tmp_path):
    for k in (1, 2, 10):
        (tmp_path / f"p-{k}").write_text("x")
    for k in (2, 10, 11):
        corpora.mark_done(spark, f"file://{tmp_path}/p-{k}")
    assert [p.rpartition("/")[2] for p in corpora.done_parts(spark, f"file://{tmp_path}")] == ["p-2", "p-10"]
    path = f"file://{tmp_path}/table"
    spark.range(10).write.parquet(path)
    corpora.replace_folder(spark.read.parquet(path).where("id % 2 = 0"), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "table.old").exists()


def test_block_sample(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(0, 4000, 1, 8).write.parquet(path)
    one, two = (sorted(r.id for r in corpora.block_sample(spark.read.parquet(path), F.col("id"), "3", 0.5, 50).collect()) for _ in range(2))
    assert one == two and len(one) == 50 and corpora.block_sample(spark.read.parquet(path), F.col("id"), "3", 1.0, 9999).count() == 4000


def test_sqlite_shards(spark, tmp_path):
    for k in range(3):
        with sqlite3.connect(tmp_path / f"{k}.db") as base:
            base.execute("CREATE TABLE t (a INTEGER, b TEXT)")
            base.executemany("INSERT INTO t VALUES (?, ?)", [(k * 10 + i, "x") for i in range(4)])
    found = corpora.read_sqlite(spark, [str(tmp_path / f"{k}.db") for k in range(3)], "SELECT a, b FROM t WHERE a % 2 = 0", "a long, b string").collect()
    assert sorted(r.a for r in found) == [0, 2, 10, 12, 20, 22]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0, 2.0], {"MW": (0.5, 0.1)}), (2, [3.0, 4.0], {})], "id int, v array<double>, delta map<string, struct<avg: double, std: double>>")
    corpora.write_arrays(rows.select("id", "v"), f"file://{tmp_path}/a", ["v"])
    assert json.loads((tmp_path / "a/meta.json").read_text()) == {"rows": 2, "width": {"v": 2}}
    files.write_mirror(rows.select("id", "delta"), f"file://{tmp_path}/m", "delta", ["MW"])
    assert {tuple(r) for r in spark.read.option("header", True).csv(f"file://{tmp_path}/m").collect()} == {("1", "0.5", "0.1"), ("2", None, None)}
    files.write_sidecar(rows.select("id"), f"file://{tmp_path}/s", "id")
    assert {tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/s").collect()} == {('{"id":1}', 1), ('{"id":2}', 2)}
    files.write_parquet(rows.select("id").coalesce(1), f"file://{tmp_path}/p", per_file=1)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 2
    names = spark.createDataFrame([("x-10.json",), ("x-9.json",)], "f string").orderBy(files.natural("f"))
    assert [r.f for r in names.collect()] == ["x-9.json", "x-10.json"]
    assert corpora.recipe_digest({"a": 1, "b": [2]}) == corpora.recipe_digest({"b": [2], "a": 1}) != corpora.recipe_digest({"a": 2, "b": [2]})


def test_blake_equals_python(spark):
    found = spark.createDataFrame([(7,), (None,)], "k int").select(blake_uniform("s", F.col("k")).alias("u")).collect()
    assert [r.u for r in found] == [int.from_bytes(hashlib.blake2b(f"s:{k}".encode(), digest_size=8).digest(), "big") / 2.0**64 for k in (7, "")]


def test_text_corner_cases(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.sentences(F.lit("See Fig. 2. It is e.g. fine! Yes? "))) == ["See Fig. 2.", "It is e.g. fine!", "Yes?"]
    assert one(text.label(F.lit("Number of benzene rings"))) == "benzene ring" and one(text.label(F.lit("number of COO2 groups"))) == "carboxylic acid"
    assert one(text.numbered_attachments(F.lit("*C[*]N*"))) == "[*:1]C[*:2]N[*:3]" and one(text.numbered_attachments(F.lit("[*:3]C*"))) == "[*:3]C*"
    assert one(text.dropped(F.lit("Edit 4 is set aside. I drop Edit 2 as Edit 9 wins. I discard Edit 1. Taking Edit 3: ok"))) == [3, 1]
    assert one(text.committed(F.lit("Taking Edit 3: no. Taking Edit 5: yes"))) == 4 and one(text.committed(F.lit("none"))) is None
    assert one(text.without_meta(F.lit("Good. Then as an AI I"), "as an AI")) == "Good." and one(text.without_meta(F.lit("as an AI"), "as an AI")) == ""
    assert one(text.unnegated(F.lit("it has no ring, a ring; without any ring"), "ring")) == 1
    assert one(text.expanded(F.lit("8080-8082, 9000,"))) == [8080, 8081, 8082, 9000]


def test_array_corner_cases(spark):
    rows = spark.createDataFrame([(["a", "b"], [[1], []]), (["a"], None)], "c array<string>, r array<array<int>>")
    pairs = rows.select(arrays.answered(F.col("c"), F.col("r")).alias("p")).select(arrays.empty_replies(F.col("p"), "b").alias("e"), arrays.empty_replies(F.col("p"), "a").alias("f"))
    assert [tuple(r) for r in pairs.collect()] == [(True, False), (None, None)]
    counts = spark.createDataFrame([({"a": 2, "b": 0},), (None,)], "m map<string, int>")
    found = counts.select(selection.holds(F.col("m"), [("a", ">=", 2), ("b", "==", 0)], {"a", "b"}).alias("x"), selection.holds(F.col("m"), [("z", "==", 0)], {"a"}).alias("y")).collect()
    assert [tuple(r) for r in found] == [(True, None), (None, None)]
