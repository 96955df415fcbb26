"""Sharded, resumable corpus files: plans, ordered reads, rechunking, manifests, markers, samples of blocks.

Records are JSON lines. Order is a file's place among the sorted names and a line's place in its file.
Spark's text reader reads a file in blocks; `lines` numbers a file's lines by block and place in it, which
is one task's work for each file, so corpora are folders of many files.
"""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import numbered


def _store(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def listing(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Files of a folder, by the numbers in their names and then by name; only names reach the driver."""
    files, target = _store(spark, folder)
    names = [str(f.getPath().toString()) for f in files.listStatus(target) if f.isFile()] if files.exists(target) else []
    names = [n for n in names if n.endswith(suffix) and not n.rpartition("/")[2].startswith((".", "_"))]
    return sorted(names, key=natural_key)


def natural_key(name: str) -> tuple:
    """Digits compare as numbers: `part-2` before `part-10`."""
    import re

    return tuple((1, int(x), "") if x.isdigit() else (0, 0, x) for x in re.split(r"(\d+)", name.rpartition("/")[2]))


def lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, file_place, line, value): lines of text files, numbered from 0 in each."""
    if not files:
        return spark.createDataFrame([], "file string, file_place int, line bigint, value string")
    names = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "file string, file_place int")
    at = spark.read.option("lineSep", "\n").text(files).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    ordered = Window.partitionBy("file").orderBy("block", "id")
    placed = at.withColumn("line", F.row_number().over(ordered).cast("bigint") - 1).drop("block", "id")
    key = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return placed.withColumn("_k", key(F.col("file"))).drop("file").join(F.broadcast(names.withColumn("_k", key(F.col("file")))), "_k").select("file", "file_place", "line", "value")


def file_plan(rows: DataFrame) -> DataFrame:
    """(file, file_place, lines, start): how many lines a file has and the number of its first one over all files."""
    counts = rows.groupBy("file", "file_place").agg(F.count("*").alias("lines"))
    before = Window.orderBy("file_place").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return counts.withColumn("start", F.coalesce(F.sum("lines").over(before), F.lit(0)))


def ordered(spark: SparkSession, files: list[str], start: int = 0, limit: int | None = None) -> DataFrame:
    """(row, file, line, value) from row `start` on, `limit` rows at most: the order of files and lines, numbered over all."""
    rows = lines(spark, files)
    plan = file_plan(rows).select("file", "start")
    placed = rows.join(F.broadcast(plan), "file").select((F.col("start") + F.col("line")).alias("row"), "file", "line", "value")
    return placed.where((F.col("row") >= start) & (F.lit(True) if limit is None else F.col("row") < start + limit))


def parsed(rows: DataFrame, schema: str, policy: str = "skip") -> tuple[DataFrame, DataFrame]:
    """(records, counts): `rows` with `record` by a policy for lines that don't parse: `skip` them, `keep` them as null, or `torn`:
    skip only the last line of a file, and fail at any other. counts: ok, malformed, torn."""
    last = F.max("line").over(Window.partitionBy("file"))
    bad = F.try_parse_json("value").isNull()
    marked = rows.where(F.trim("value") != "").withColumns({"_bad": bad, "_last": F.col("line") == last})
    counts = marked.agg(F.count_if(~F.col("_bad")).alias("ok"), F.count_if(F.col("_bad") & ~F.col("_last")).alias("malformed"), F.count_if(F.col("_bad") & F.col("_last")).alias("torn"))
    kept = marked.withColumn("record", F.when(~F.col("_bad"), F.from_json("value", schema)))
    if policy == "skip":
        kept = kept.where("NOT _bad")
    elif policy == "torn":
        stop = F.raise_error(F.concat(F.lit("malformed line "), F.col("line"), F.lit(" of "), F.col("file"))).cast("boolean")
        kept = kept.where(F.when(~F.col("_bad"), F.lit(True)).when(F.col("_last"), F.lit(False)).otherwise(stop))
    return kept.drop("_bad", "_last", "value"), counts


def runs(rows: DataFrame, key: str, order: str) -> DataFrame:
    """`rows` with `run`: contiguous rows of equal key are one run, numbered in order within the key's file."""
    path = Window.partitionBy("file").orderBy(order)
    starts = F.coalesce(F.col(key) != F.lag(key).over(path), F.lit(True)).cast("int")
    return rows.withColumn("_start", starts).withColumn("run", F.sum("_start").over(path)).drop("_start")


def rechunk(rows: DataFrame, folder: str, order: list[str], per_chunk: int, prefix: str = "part") -> DataFrame:
    """Write `value` as chunks of `per_chunk` lines in order, under `folder/prefix-<chunk>`; returns (chunk, lines).

    A chunk is a folder with one file and a marker `.done` once it is whole, so a reader never sees half of one.
    """
    placed = numbered(rows.select("value", *order), order)
    chunked = placed.withColumn("chunk", F.floor(F.col("_nth") / per_chunk))
    chunked.repartition("chunk").sortWithinPartitions("chunk", "_nth").select(F.format_string(f"{prefix}-%05d", "chunk").alias("name"), "value").write.partitionBy("name").mode("overwrite").text(folder)
    return chunked.groupBy("chunk").agg(F.count("*").alias("lines"))


def merge_parts(spark: SparkSession, folders: list[str], target: str, per_chunk: int) -> DataFrame:
    """Parts that runs left in several folders as one folder of chunks, in order of folder, file and line."""
    files = [f for folder in folders for f in listing(spark, folder)]
    return rechunk(lines(spark, files), target, ["file_place", "line"], per_chunk)


def complete_shards(spark: SparkSession, folder: str, prefix: str, shard_size: int, total: int) -> int:
    """How many leading shards have all their lines; a resumed run goes on with the next one."""
    files = listing(spark, folder, ".jsonl")
    counts = {r.file.rpartition("/")[2]: r["lines"] for r in file_plan(lines(spark, files)).collect()} if files else {}  # one number a file
    done = 0
    while done * shard_size < total and counts.get(f"{prefix}-{done:05d}.jsonl") == min(shard_size, total - done * shard_size):
        done += 1
    return done


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and put there by a rename."""
    files, target = _store(spark, path)
    _, beside = _store(spark, f"{path}.tmp")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(beside, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    files, target = _store(spark, path)
    return "\n".join(r[0] for r in spark.read.text(path).collect()) if files.exists(target) else None


def write_manifest(spark: SparkSession, folder: str, shards: int, consumed: int, shard_size: int) -> None:
    """How many input rows the written shards consumed: rows may be dropped, so shards alone can't tell."""
    write_text(spark, f"{folder}/manifest.json", json.dumps({"shards": shards, "input_consumed": consumed, "shard_size": shard_size}))


def read_manifest(spark: SparkSession, folder: str, prefix: str, shard_size: int) -> tuple[int, int]:
    """(shards, consumed); (0, 0) if there is none, for another shard size, or if a shard that it names is missing or (but for the last) not full."""
    try:
        found = json.loads(read_text(spark, f"{folder}/manifest.json") or "{}")
    except json.JSONDecodeError:
        return 0, 0
    shards = int(found.get("shards", 0))
    if found.get("shard_size") != shard_size:
        return 0, 0
    files = listing(spark, folder, ".jsonl")
    counts = {r.file.rpartition("/")[2]: r["lines"] for r in file_plan(lines(spark, files)).collect()} if files else {}
    names = [f"{prefix}-{k:05d}.jsonl" for k in range(shards)]
    if any(n not in counts for n in names) or any(counts[n] != shard_size for n in names[:-1]):
        return 0, 0
    return shards, int(found["input_consumed"])


def mark_done(spark: SparkSession, path: str) -> None:
    write_text(spark, f"{path}.done", "done")


def done_parts(spark: SparkSession, folder: str) -> list[str]:
    """Parts with a marker: those that a reader may take."""
    files, target = _store(spark, folder)
    names = {str(f.getPath().toString()) for f in files.listStatus(target)} if files.exists(target) else set()
    return sorted((n.removesuffix(".done") for n in names if n.endswith(".done") and n.removesuffix(".done") in names), key=natural_key)


def replace_folder(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    """Rewrite what `rows` may itself be read from: written beside it, then put in its place."""
    spark = rows.sparkSession
    files, target = _store(spark, path)
    _, beside = _store(spark, f"{path}.new")
    _, before = _store(spark, f"{path}.old")
    rows.write.mode("overwrite").format(kind).save(f"{path}.new")
    files.delete(before, True)
    if files.exists(target) and not files.rename(target, before):
        raise OSError(f"cannot move {path}")
    if not files.rename(beside, target):
        files.rename(before, target)
        raise OSError(f"cannot replace {path}")
    files.delete(before, True)


def block_sample(rows: DataFrame, key: Column, seed: str, blocks: float, n: int) -> DataFrame:
    """Exactly `n` rows (or all there are) out of a share of the blocks that a scan reads: blocks are drawn by hash of file and
    offset, rows in them by hash of their key. What is not drawn is not kept, though its file is opened."""
    draw = lambda c: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    block = F.concat_ws(":", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1), F.col("_metadata.file_block_start").cast("string"))
    some = rows.withColumns({"_block": draw(block), "_row": draw(key.cast("string"))}).where(F.col("_block") < blocks)
    return some.orderBy("_row", key).limit(n).drop("_block", "_row")


def read_sqlite(spark: SparkSession, shards: list[str], query: str, schema: str) -> DataFrame:
    """Rows of a read-only query over several database files, one connection a file; the files must be where executors see them."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as base:
                    yield from pd.read_sql_query(query, base, chunksize=10_000)

    return spark.createDataFrame([(s,) for s in shards], "path string").repartition(max(1, len(shards)), "path").mapInPandas(fetch, schema)


def write_arrays(rows: DataFrame, path: str, names: list[str]) -> None:
    """Feature arrays as Parquet, with a record of their names, widths and number beside them."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows")
    widths = rows.agg(F.count("*").alias("rows"), *(F.max(F.size(n)).alias(n) for n in names)).first().asDict()
    write_text(rows.sparkSession, f"{path}/meta.json", json.dumps({"rows": widths.pop("rows"), "width": widths}, sort_keys=True))


def recipe_digest(recipe: dict) -> str:
    """A version of a recipe: twelve digits of the hash of its content, whatever the order of its keys."""
    import hashlib

    return hashlib.sha256(json.dumps(recipe, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()[:12]
