"""The thin opN queries: each applies its operator to the whole of its table and derives the columns asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, exact_dedup, jaccard, mixing, packing, quality, sharding, toxicity, url_filter, warc
from .common import scratch, table


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = exact_dedup.DigestIndex(spark, scratch(spark, "digest-index"))
    return index.ingest(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), size=2048)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = lambda ident: F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(5))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id")) != 0)
    scored = toxicity.score(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.join(table(spark, sf_dir, "documents"), width=4, num=85, den=100)
    return joined.select("doc_id", "n_shingles", "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.uses(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "domain", "lang", "source", "tokens", "quota", "times")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", F.col("n").alias("text_bytes"), "perplexity", F.col("bound").alias("limit"), "kept")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_ann": op4_ann,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
}

ORACLE_SQL = {
    "op1_warc": """
        WITH t AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM t)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM g""",
    "op5_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY h)
                 AND row_number() OVER (PARTITION BY h, doc_id) = 1 AS kept, h AS text_sha256
        FROM t""",
    "op6_url_filter": url_filter.judge_sql(),
    "op8_mixing": mixing.uses_sql(),
}
