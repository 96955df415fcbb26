"""Structured Streaming over event files: gap-closed batches, a running tally, and their batch forms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """New files of a folder (or a file's path) as a stream, each once; event time as a timestamp in the session's zone."""
    stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 16).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tally(events: DataFrame) -> DataFrame:
    """Events and values by kind; on a stream, the running totals (complete mode)."""
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """Per user, runs of events no `gap` apart; with `late`, a watermark lets closed sessions go (append mode)."""
    timed = events.withWatermark("ts", late) if late else events
    return timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(
        "user_id", F.col("w.start").alias("first"), "n", "value"
    )


def windows(events: DataFrame, length: str, late: str) -> DataFrame:
    """Tumbling windows by kind, with late events up to `late`."""
    timed = events.withWatermark("ts", late)
    return timed.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("first"), "event_type", "n")


def run_to_end(stream: DataFrame, name: str, mode: str, checkpoint: str | None = None) -> DataFrame:
    """Process what is there now, into memory, and return the result; for checks and small results."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        query = query.option("checkpointLocation", checkpoint)
    run = query.start()
    run.awaitTermination()
    if run.exception():
        raise run.exception()
    return stream.sparkSession.table(name)


def micro_batches(events: DataFrame, by: str, gap_s: float, most: int) -> DataFrame:
    """(by, batch, part, first, n, keys): batches that close after `gap_s` without an arrival, or at `most` requests.

    `keys` counts distinct keys: equal requests of a batch are answered once.
    """
    path = Window.partitionBy(by).orderBy("ts", "event_id")
    wait = F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(path)
    opened = events.withColumn("_new", F.coalesce(wait >= int(gap_s * 1e6), F.lit(True)).cast("int"))
    numbered = opened.withColumn("batch", F.sum("_new").over(path.rowsBetween(Window.unboundedPreceding, 0)))
    nth = F.row_number().over(Window.partitionBy(by, "batch").orderBy("ts", "event_id")) - 1
    parts = numbered.withColumn("part", F.floor(nth / most).cast("int"))
    return parts.groupBy(by, "batch", "part").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n"), F.count_distinct("event_type").alias("keys"))


def decision_rows(turns: DataFrame) -> DataFrame:
    """A row for each commit (assistant turn): step, what was seen last and how it changed since the commit before."""
    path = Window.partitionBy("conv_id").orderBy("turn")
    upto = path.rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("role") == "user", F.length("text")), ignorenulls=True).over(upto)
    commits = turns.withColumn("seen", seen).where("role = 'assistant'")
    return commits.select("conv_id", "turn", F.row_number().over(path).alias("step"), "seen", (F.col("seen") - F.lag("seen").over(path)).alias("delta"))


def capped_batches(events: DataFrame, gap_s: float, wait_s: float, most: int) -> DataFrame:
    """Micro-batches that also close `wait_s` after they opened, however dense arrivals are: the absolute limit
    depends on where the batch began, so it is followed in order, a user at a time, one Arrow batch in memory."""

    def follow(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict[int, list] = {}
        for part in parts:
            out = []
            for user, at in zip(part["user_id"], part["at"]):
                now = state.get(user)
                if now is None or at - now[2] >= gap_s * 1e6 or at - now[1] >= wait_s * 1e6 or now[3] >= most:
                    now = state[user] = [0 if now is None else now[0] + 1, at, at, 0]
                    if len(state) > 1:  # rows are sorted by user: earlier users are done
                        state = {user: now}
                now[2], now[3] = at, now[3] + 1
                out.append(now[0])
            part["batch"] = out
            yield part[["event_id", "user_id", "batch"]]

    ordered = events.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at")).repartition("user_id").sortWithinPartitions("user_id", "at", "event_id")
    return ordered.mapInPandas(follow, "event_id bigint, user_id bigint, batch int")
