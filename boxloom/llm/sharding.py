"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until splitters fit, one exchange.

Documents are ordered by (hash of the text, id), so equal texts lie side by side. Each round counts,
in every partition, the exact bytes below all candidate boundaries; the sums narrow the interval in
which each splitter lies, and the next candidates go into that interval. A splitter is final when a
boundary between two texts is within `tolerance` of its ideal, or no boundary lies closer. Where one
text's copies would leave it off by more than `group_tolerance`, the group is cut between ids by
further rounds; all other groups of equal texts stay whole.

Only sums per candidate reach the driver (shards x `probes` numbers a round). The law is `bytes`:
shards differ by at most the tolerance (a share of the mean shard) or, where single documents are
larger than that, by what one document makes unavoidable.

Defined results: a null text has no bytes and the hash of the empty text; a null id sorts before all
others; rows that repeat text and id share a shard. With fewer documents than shards some shards
stay empty. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, joinable, materialise, ship

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, crc, h): what the sort needs of a document; the text itself is not carried."""
    text = F.col(text_col)
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        (F.octet_length(raw) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(raw).alias("crc"),
        F.xxhash64(raw).alias("h"),
    )


def below(rows: DataFrame, column: str, probes: list[int]) -> dict[int, int]:
    """Exact bytes of the rows whose `column` is less than each probe (null: less than all)."""
    cuts = np.array(sorted(set(probes)), dtype=np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(len(cuts) + 1, dtype=np.int64)
        for batch in batches:
            cell = np.searchsorted(cuts, batch["key"].to_numpy(dtype=np.int64), side="right")
            np.add.at(sums, cell, batch["size"].to_numpy(dtype=np.int64))
        full = np.flatnonzero(sums)
        yield pd.DataFrame({"cell": full, "bytes": sums[full]})

    ship(rows.sparkSession)
    keys = rows.select(F.coalesce(F.col(column), F.lit(LOWEST)).alias("key"), "size")
    found = keys.mapInPandas(count, "cell bigint, bytes bigint").groupBy("cell").agg(F.sum("bytes").alias("bytes")).collect()
    sums = np.zeros(len(cuts) + 1, dtype=object)
    for cell, total in found:
        sums[cell] = total
    return {int(cut): int(total) for cut, total in zip(cuts, np.cumsum(sums)[:-1])}


def spread(lo: int, hi: int, probes: int) -> list[int]:
    """Up to `probes` boundaries strictly between lo and hi, evenly spread."""
    step = (hi - lo) / (probes + 1)
    return sorted({lo + int(step * (i + 1)) if hi - lo > probes + 1 else min(lo + 1 + i, hi - 1) for i in range(probes)} - {lo, hi})


def narrow(rows: DataFrame, column: str, targets: dict[int, int], total: int, tolerance: float, probes: int) -> dict[int, list]:
    """Per target (name: ideal bytes below) the closest boundaries [lo, bytes below lo, hi, bytes below hi] around it.

    Rounds stop for a target once lo or hi is within `tolerance` bytes of it, or hi = lo + 1.
    """
    known = {name: [LOWEST, 0, HIGHEST, total] for name in targets}
    while True:
        asked = {}
        for name, (lo, at_lo, hi, at_hi) in known.items():
            ideal = targets[name]
            if hi - lo > 1 and min(abs(ideal - at_lo), abs(at_hi - ideal)) > tolerance:
                asked[name] = spread(lo, hi, probes)
        if not asked:
            return known
        counts = below(rows, column, [p for cuts in asked.values() for p in cuts])
        for name, cuts in asked.items():
            for cut in cuts:
                if counts[cut] <= targets[name]:
                    known[name][:2] = [cut, counts[cut]]
                else:
                    known[name][2:] = [cut, counts[cut]]
                    break


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.01, group_tolerance: float = 0.05, probes: int = 255) -> list[tuple[int, int]]:
    """The `shards` - 1 boundaries (h, id): a row belongs below if its (h, id) is less."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    ideal = {i: total * i // shards for i in range(1, shards)}
    allowed = tolerance * total / shards
    found, cut_inside = {}, {}
    for i, (lo, at_lo, hi, at_hi) in narrow(rows, "h", ideal, total, allowed, probes).items():
        best, error = (lo, ideal[i] - at_lo) if ideal[i] - at_lo <= at_hi - ideal[i] else (hi, at_hi - ideal[i])
        found[i] = (best, LOWEST)
        if error > group_tolerance * total / shards and hi - lo == 1:  # all between are copies of one text
            cut_inside[i] = (lo, at_lo)
    for h in sorted({h for h, _ in cut_inside.values()}):
        group = rows.where(F.col("h") == h)
        size, ids = group.agg(F.sum("size"), F.count_distinct("id")).first()
        if ids > 1:
            inner = {i: ideal[i] - at for i, (x, at) in cut_inside.items() if x == h}
            for i, (lo, at_lo, hi, at_hi) in narrow(group, "id", inner, size, allowed, probes).items():
                found[i] = (h, lo if inner[i] - at_lo <= at_hi - inner[i] else hi)
    return [found[i] for i in sorted(found)]


def shard_of(cuts: list[tuple[int, int]], h: Column, ident: Column) -> Column:
    """The shard of a row: the number of boundaries that it does not lie below."""
    inside = [((h < F.lit(at)) | ((h == F.lit(at)) & (ident < F.lit(i)))) for at, i in cuts]
    return F.lit(len(cuts)) - sum((x.cast("int") for x in inside), F.lit(0))


def assign(docs: DataFrame, shards: int = 24, run: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, size, crc, h, shard, slot): one row per document, slots gapless from 0 in each shard.

    A shard is numbered in runs of about `run` rows at most, dealt by hash of the id, so that no task
    sorts a whole shard; a run's first slot is the number of rows in the runs before it.
    """
    spark = docs.sparkSession
    rows = materialise(keyed(docs, id_col, text_col), "shard-keys")
    placed = rows.withColumn("shard", shard_of(splitters(rows, shards, **how), F.col("h"), F.coalesce("id", F.lit(LOWEST))))
    runs = max(8, -(-rows.count() // (run * shards)))
    placed = placed.withColumn("run", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(runs)))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("shard", "run").count()  # about one row for each `run` documents
    first = joinable(sizes.select("shard", "run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")), "shard-runs")
    order = "row_number() OVER (PARTITION BY shard, run ORDER BY h, id) - 1"
    numbered = placed.withColumn("nth", F.expr(order)).join(first, ["shard", "run"])
    return numbered.select("id", "size", "crc", "h", "shard", (F.col("first") + F.col("nth")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, part: int = 256 << 20, id_col: str = "doc_id", text_col: str = "text",
                 **how) -> DataFrame:
    """Write `docs` as `shards` folders of Parquet under `path`, exchanging the texts once; returns the splitters (shard, h, id).

    A shard is written by several tasks, of about `part` bytes each, dealt by hash of the id.
    """
    spark = docs.sparkSession
    rows = materialise(keyed(docs, id_col, text_col), "shard-keys")
    cuts = splitters(rows, shards, **how)
    parts = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // (part * shards)))
    h, ident, shard = (fresh(docs, c) for c in ("_h", "_id", "shard"))
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keys = docs.withColumns({h: F.xxhash64(raw), ident: F.coalesce(F.col(id_col).cast("bigint"), F.lit(LOWEST))})
    placed = keys.withColumn(shard, shard_of(cuts, F.col(h), F.col(ident)))
    placed.repartition(shards * parts, F.col(shard), F.pmod(F.xxhash64(ident, F.lit(7)), F.lit(parts))).drop(h, ident).write.partitionBy(shard).parquet(path)
    return spark.createDataFrame([(i + 1, h, x) for i, (h, x) in enumerate(cuts)], "shard int, h bigint, id bigint")
