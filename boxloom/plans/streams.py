"""Event queries: streams run to their end, and the batch forms that they must equal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import events


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def events_tally_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running tally of a stream over all event files, at its end; the pattern stands for a file as for a folder."""
    stream = events.tally(events.read_events(spark, f"{sf_dir}/[e]vents.parquet"))
    return events.run_to_end(stream, f"tally_{uuid.uuid4().hex}", "complete")


def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = events.sessions(_events(spark, sf_dir), "30 minutes")
    return found.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"), F.sum("n").alias("events"))


def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = events.windows(_events(spark, sf_dir), "1 day", "1 hour")
    return found.select(F.date_format("first", "yyyy-MM-dd").alias("day"), "event_type", "n")


def gap_micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.micro_batches(_events(spark, sf_dir), "user_id", 3600.0, 4).select("user_id", "batch", "part", "first_id", "n", "keys")


def capped_micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.capped_batches(_events(spark, sf_dir), 3600.0, 7200.0, 4)


def conversation_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.decision_rows(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (events_tally_stream, gap_sessions, tumbling_windows, gap_micro_batches, capped_micro_batches, conversation_decisions)}

ORACLE_SQL = {
    "events_tally_stream": "SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1",
    "gap_sessions": """
        WITH g AS (SELECT user_id, coalesce(ts - lag(ts) OVER w >= INTERVAL 30 MINUTE, true)::INT AS new, ts, event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g),
        c AS (SELECT user_id, sid, count(*) AS n FROM s GROUP BY 1, 2)
        SELECT user_id, count(*) AS sessions, max(n) AS longest, sum(n)::BIGINT AS events FROM c GROUP BY 1""",
    "tumbling_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "gap_micro_batches": """
        WITH g AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 1 HOUR, true)::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        b AS (SELECT *, (sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS batch FROM g),
        p AS (SELECT *, ((row_number() OVER (PARTITION BY user_id, batch ORDER BY ts, event_id) - 1) // 4)::INT AS part FROM b)
        SELECT user_id, batch, part, min(event_id) AS first_id, count(*) AS n, count(DISTINCT event_type) AS keys FROM p GROUP BY 1, 2, 3""",
    "conversation_decisions": """
        WITH s AS (SELECT *, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS seen FROM conversations)
        SELECT conv_id, turn, (row_number() OVER w)::INT AS step, seen::INT AS seen, (seen - lag(seen) OVER w)::INT AS delta
        FROM s WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
}
