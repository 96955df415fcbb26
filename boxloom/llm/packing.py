"""Best-fit packing into sequences of a fixed number of tokens, in bulk-synchronous rounds.

A document becomes its token ids and a closing id 0; only one longer than a sequence is cut, the
first piece taking the remainder. Pieces are range-sorted by length, so a piece is known by its
length and its rank among the pieces of that length. Lengths and gaps are whole numbers up to the
sequence's size, so both sorted lists are run-length coded: however many documents there are, a round
sees at most one run a length, and runs of open sequences that have equal gaps.

Lengths are packed in bands, the largest first. A round sweeps the sizes downwards: each run of a
band's documents takes its successors, the smallest gaps that hold it, and where more documents than
gaps meet, the k-th document by rank gets the k-th gap and the rest go on to the next larger gap. A
sequence takes one document a round (several equal ones where there are more of them than open
sequences); then gaps are updated and the next round begins. When no document of the band fits, as
many new sequences are opened as the band's rest needs at least, by its largest documents.

What a round decides are runs (length, ranks, sequences, offset), at most `size` more than there were
runs before, so the plan's size depends on `size` and the number of rounds, not on the number of
documents. Finding each piece's place from its rank is done on the executors.

Defined results: null and empty texts are one token, the closing id. Repeated rows are packed each on
their own. An empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, partitions, ship

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed by the vocabulary: texts that are one token wherever they stand, and their ids.
SPECIAL = {"<|endoftext|>": 50256}
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The byte-level tokenizer of a rank file: a path, or the name of an installed public vocabulary.

    The ids are those that `tokenizers` gives with the JSON file of the same vocabulary, special tokens in
    the text included, at a quarter of the time (tests compare the two).
    """
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first has the remainder."""
    if length <= size:
        return [(0, length)]
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))]


def pieces(docs: DataFrame, size: int = 2048, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with the CRC-32 of its ids as little-endian unsigned 32-bit numbers."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoder(vocabulary)
        for batch in batches:
            rows = []
            for ident, text in zip(batch["id"], batch["text"]):
                ids = np.append(tokens.encode_to_numpy(text, allowed_special="all") if text else np.empty(0, np.uint32), 0).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    rows.append((ident, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("decimal(20,0)").alias("id"), F.col(text_col).alias("text"))
    return source.mapInPandas(encode, PIECE_SCHEMA.replace("doc_id bigint", "doc_id decimal(20,0)")).withColumn(
        "doc_id", F.col("doc_id").cast("bigint")
    )


def ranked(rows: DataFrame) -> DataFrame:
    """`rows` with `rank` (from 0) among the rows of the same length: range-sorted, numbered in each range, shifted by the ranges before."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, int] = {}
        for batch in batches:
            if len(batch):
                nth = batch.groupby("length").cumcount().to_numpy(dtype=np.int64)
                batch["nth"] = nth + batch["length"].map(lambda x: seen.get(x, 0)).to_numpy(dtype=np.int64)
                for length, n in batch["length"].value_counts().items():
                    seen[length] = seen.get(length, 0) + n
                yield batch

    n = partitions(rows.sparkSession)
    mixed = rows.withColumn("mix", F.xxhash64("doc_id", "piece")).withColumn("doc_id", F.col("doc_id").cast("decimal(20,0)"))
    ranges = mixed.repartitionByRange(n, "length", "mix").sortWithinPartitions("length", "mix").withColumn("part", F.spark_partition_id())
    schema = PIECE_SCHEMA.replace("doc_id bigint", "doc_id decimal(20,0)") + ", part int, nth bigint"
    numbered = ranges.drop("mix").mapInPandas(number, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    numbered = materialise(numbered, "pack-sorted")
    counts = numbered.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return numbered.join(shift, ["length", "part"]).select(*rows.columns, (F.col("shift") + F.col("nth")).alias("rank"))


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring runs of sequences as one."""
    out: list[tuple[int, int]] = []
    for first, n in sorted(runs):
        if out and out[-1][0] + out[-1][1] == first:
            out[-1] = (out[-1][0], out[-1][1] + n)
        else:
            out.append((first, n))
    return out


def plan(counts: dict[int, int], size: int = 2048, share: float = 0.9) -> np.ndarray:
    """Rows (length, first rank, how many, first sequence, offset) that place all documents of `counts` (length: number).

    Lengths are taken in bands, from the largest down to `share` times it, so that short documents are
    left to fill what longer ones leave.
    """
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    rank = np.zeros(size + 1, dtype=np.int64)
    places: list[tuple[int, int, int, int, int]] = []
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, how many)

    def put(length: int, n: int, first: int, gap: int) -> None:
        places.append((length, int(rank[length]), n, first, size - gap))
        rank[length] += n
        left[length] -= n

    def sweep(band: set[int]) -> bool:
        """One round over the lengths of `band`, the largest first; True if a document found a gap."""
        nonlocal gaps
        stack: list[tuple[int, int, int]] = []  # (gap, first sequence, how many), the smallest gap on top
        after: dict[int, list[tuple[int, int]]] = {}
        available, moved = 0, False
        for s in sorted({*band, *(g for g in gaps if g)}, reverse=True):
            for first, n in gaps.get(s, ()):
                stack.append((s, first, n))
                available += n
            while s in band and left[s] and stack:
                gap, first, n = stack.pop()
                times = max(1, min(gap // s, int(left[s]) // available))
                take = min(n, int(left[s]) // times)
                for t in range(times):
                    put(s, take, first, gap - t * s)
                after.setdefault(gap - times * s, []).append((first, take))
                available -= take
                if take < n:
                    stack.append((gap, first + take, n - take))
                moved = True
        for gap, first, n in stack:
            after.setdefault(gap, []).append((first, n))
        gaps = {gap: merged(runs) for gap, runs in after.items() if gap}
        return moved

    top = size
    while top:
        low = int(top * share)
        while lengths := [x for x in range(top, low, -1) if left[x]]:
            if sweep(set(lengths)):
                continue
            need = -(-sum(x * int(left[x]) for x in lengths) // size)
            for x in lengths:
                if n := min(need, int(left[x])):
                    put(x, n, opened, size)
                    gaps.setdefault(size - x, []).append((opened, n))
                    opened, need = opened + n, need - n
        top = low
    return np.array(places, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, size: int = 2048, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): each piece's place; sequences are filled from 0 without gaps."""
    spark = docs.sparkSession
    rows = ranked(materialise(pieces(docs, size, vocabulary, id_col, text_col), "pack-pieces"))
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `size` rows
    places = plan(counts, size)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    sent = spark.sparkContext.broadcast(places)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = sent.value
        keys = at[:, 0] << 48 | at[:, 1]
        for batch in batches:
            length, nth = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            found = at[np.searchsorted(keys, length << 48 | nth, side="right") - 1] if len(batch) else at[:0]
            batch["sequence_id"], batch["offset"] = found[:, 3] + nth - found[:, 1], found[:, 4]
            yield batch.drop(columns="rank")

    schema = PIECE_SCHEMA.replace("doc_id bigint", "doc_id decimal(20,0)") + ", sequence_id bigint, offset bigint"
    ready = rows.withColumn("doc_id", F.col("doc_id").cast("decimal(20,0)"))
    return ready.mapInPandas(place, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))
