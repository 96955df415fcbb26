"""Readers and sinks for corpus files: ordered JSON lines, tolerant reads, sharded and resumable writes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with `_file`, `_place` (byte order within the folder) and `_corrupt`: a line that doesn't parse is kept as text."""
    wide = StructType([*schema.fields, StructField("_corrupt", StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("_file", F.col("_metadata.file_name")).withColumn("_place", F.monotonically_increasing_id())


def read_any(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One column `key` from Parquet, JSON lines, or text whose first word of a line it is; empty rows are left out."""
    kind = path.rstrip("/").rpartition(".")[2]
    if kind == "parquet":
        rows = spark.read.parquet(path).select(F.col(key).cast("string").alias(key))
    elif kind in ("json", "jsonl"):
        raw = spark.read.text(path)
        names = [key, "ref_smiles", "smiles", "smi"]
        rows = raw.select(F.coalesce(*(F.get_json_object("value", f"$.{n}") for n in dict.fromkeys(names))).alias(key))
    else:
        rows = spark.read.text(path).select(F.split(F.trim("value"), "\\s+")[0].alias(key))
    return rows.where(F.length(F.trim(key)) > 0)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Tab-separated values with a header, where `*` stands for a missing one."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("nullValue", "*").csv(path)


def natural(name: str) -> Column:
    """Sort key of shard names: the last number in them."""
    return F.regexp_extract(name, "(\\d+)\\D*$", 1).cast("bigint")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `_nth` from 0 in a total order, without gathering them: numbers within ranges, shifted by the ranges before."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))  # a row a partition
    within = F.col("_id") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return ranged.join(F.broadcast(shift), "_part").withColumn("_nth", F.col("_shift") + within).drop("_part", "_id", "_shift")


def write_shards(rows: DataFrame, path: str, order: list[str], per_shard: int, kind: str = "json") -> None:
    """Shards of `per_shard` rows in order, as folders shard=0, 1, ...; Spark's commit makes the write atomic."""
    placed = numbered(rows, order).withColumn("shard", F.floor(F.col("_nth") / per_shard).cast("int"))
    placed.repartition("shard").sortWithinPartitions("shard", "_nth").drop("_nth").write.partitionBy("shard").format(kind).save(path)


def write_parquet(rows: DataFrame, path: str, per_file: int = 0) -> None:
    """Parquet with zstd; `per_file` rows a file at most, if given."""
    rows.write.option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path)


def write_mirror(rows: DataFrame, path: str, delta: str, names: list[str]) -> None:
    """A CSV mirror of rules whose map `delta` holds (avg, std) by property, as columns p_avg, p_std."""
    flat = [F.try_element_at(delta, F.lit(p))[s].alias(f"{p}_{s}") for p in names for s in ("avg", "std")]
    rows.select(*(c for c in rows.columns if c != delta), *flat).write.option("header", True).csv(path)


def write_sidecar(rows: DataFrame, path: str, ident: str) -> None:
    """(json, ident): each row as one JSON text beside its id."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("json"), F.col(ident).alias(ident)).write.option("compression", "zstd").parquet(path)


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to do: rows whose key is not in what was written."""
    return rows.join(done.select(F.col(key).alias("_done")).distinct(), rows[key] == F.col("_done"), "left_anti")


def complete_groups(done: DataFrame, group: str, index: str, total: str) -> DataFrame:
    """Rows of groups of which all parts were written; a group cut off by an interruption is left out."""
    counts = done.groupBy(group).agg(F.count_distinct(index).alias("_have"), F.max(total).alias("_want"))
    return done.join(counts.where("_have = _want").select(group), group, "left_semi")


def write_mode(spark: SparkSession, path: str, mode: dict[str, object]) -> None:
    """The settings that an output was written with, so that a run with others does not add to it."""
    spark.createDataFrame([(json.dumps(mode, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_mode")


def same_mode(spark: SparkSession, path: str, mode: dict[str, object]) -> bool:
    found = spark.read.text(f"{path}/_mode").first()
    return bool(found) and json.loads(found[0]) == mode
