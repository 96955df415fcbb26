"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over UTF-8 bytes (digits and white space folded), of order 5, so an n-gram is a whole
number and its suffixes and contexts are masks and shifts of it. It is trained on the trusted
documents of all sizes and languages together; nothing of the corpus is sampled.

1. Documents are kept as compressed byte strings, in a table bucketed by the blocks that they are read
   in, which is never shuffled; labels are joined with ids alone and come to the blocks as row numbers.
2. Each block lists its distinct n-grams with their trusted counts, split into shards by the two bytes
   before the last. All counts that the orders 3 to 5 need of an n-gram then lie in one shard.
3. Each shard sums the counts of all blocks. Counts of counts give the discounts; continuation counts
   of two bytes (at most 65,536 numbers) give the lowest orders.
4. Each shard joins the n-grams that blocks ask for with its counts and sends every block the log
   probabilities, in the order asked; blocks look them up and sum them per document.

Of the trusted texts `1 / spare` (by hash of the folded text, so with all copies) are not trained on:
their perplexities, shrunk towards their language's mean by `weight` bytes so that short texts are not
judged by chance, give each language's `high` quantile, in which each distinct text counts once. The
limit is its mean with the quantile of all languages, where the language's counts as often as it has
spared texts and that of all languages `prior` times. Documents above the limit are rejected.

Defined results: null and empty texts have their language's mean and stay. A null language is one of
its own. A language without spared texts has mean and limit of all. Without trusted text every
document stays. Rows that repeat an id are scored each; they are trusted if any label of
the id says so. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RowNumbers, fresh, in_blocks, joinable, materialise, partitions, passing, ship

ORDER = 5
SYMBOLS = 256
PIECE = 1 << 21  # bytes worked on at once


def folding() -> bytes:
    """A byte table: digits as 0, white space as blank, zero (the padding) as blank too."""
    table = bytearray(range(256))
    for b in range(256):
        if chr(b).isdigit() and b < 128:
            table[b] = ord("0")
        elif b <= 32:
            table[b] = ord(" ")
    return bytes(table)


FOLDED = folding()


def grams(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams at every byte of the bodies, one after the other; limits of the bodies)."""
    pad = bytes(ORDER - 1)
    text = np.frombuffer(pad + pad.join(bodies), np.uint8)
    size = np.array([len(b) for b in bodies], dtype=np.int64)
    code = np.zeros(len(text), np.uint64)
    for k in range(ORDER):
        code[k:] |= text[: len(text) - k].astype(np.uint64) << np.uint64(8 * k)
    real = np.ones(len(text), bool)
    first = np.cumsum(size + ORDER - 1) - size - (ORDER - 1)
    for k in range(ORDER - 1):
        real[first + k] = False
    return code[real], np.concatenate([[0], np.cumsum(size)])


def pieces(bodies: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of bodies of about PIECE bytes."""
    start = held = 0
    for i, body in enumerate(bodies):
        held += len(body)
        if held >= PIECE:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(bodies):
        yield start, len(bodies)


def distinct(bodies: list[bytes]) -> np.ndarray:
    parts = [np.unique(grams(bodies[a:b])[0]) for a, b in pieces(bodies)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def counted(bodies: list[bytes], codes: np.ndarray) -> np.ndarray:
    """How often each of the (sorted) `codes` occurs in `bodies`, which hold no others."""
    total = np.zeros(len(codes), np.int64)
    for a, b in pieces(bodies):
        found, n = np.unique(grams(bodies[a:b])[0], return_counts=True)
        total[np.searchsorted(codes, found)] += n
    return total


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    middle = (codes >> np.uint64(8)) & np.uint64(0xFFFF)
    return (((middle * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


class Lookup:
    """Places of codes in a sorted list, by a hash table with a search for the few that collide."""

    def __init__(self, codes: np.ndarray):
        bits = max(8, int(np.ceil(np.log2(max(2, 4 * len(codes))))))
        self.codes, self.shift = codes, np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, np.int32)
        self.table[self.slot(codes)] = np.arange(len(codes))

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, codes: np.ndarray) -> np.ndarray:
        at = self.table[self.slot(codes)]
        wrong = np.flatnonzero(self.codes[at] != codes)
        at[wrong] = np.searchsorted(self.codes, codes[wrong])
        return at


# The model


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) from the numbers of n-grams seen once to four times."""
    n1, n2, n3, n4 = (float(x) for x in counts_of_counts)
    if not (n1 and n2):
        return np.array([0.0, 0.5, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(float(np.clip(x, 0.05, k + 0.95)) for k, x in enumerate(d))])


def interpolated(codes: np.ndarray, counts: np.ndarray, lower: np.ndarray, d: np.ndarray) -> np.ndarray:
    """p(last byte | rest) of the (sorted) codes of one order, of which all that share a context and were seen are here."""
    context, at = np.unique(codes >> np.uint64(8), return_inverse=True)
    total = np.bincount(at, weights=counts, minlength=len(context))
    kind = np.minimum(counts, 3).astype(np.int64)
    mass = np.bincount(at, weights=np.where(counts > 0, d[kind], 0.0), minlength=len(context))
    seen = total > 0
    share = np.where(seen, mass / np.where(seen, total, 1), 1.0)
    own = np.where(counts > 0, (counts - d[kind]) / np.where(seen, total, 1)[at], 0.0)
    return own + share[at] * lower


def ladder(codes: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, counts, place of each longer code's suffix) for the orders 5, 4 and 3; below 5 counts are of distinct left neighbours."""
    out = [(codes, counts, np.empty(0, np.int64))]
    for order in (4, 3):
        longer, n, _ = out[-1]
        shorter, at = np.unique(longer & np.uint64((1 << 8 * order) - 1), return_inverse=True)
        out.append((shorter, np.bincount(at, weights=n > 0, minlength=len(shorter)), at))
    return out


def low_orders(pairs: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """p(byte | byte before) as a 256 x 256 table, from continuation counts of pairs."""
    singles = (pairs > 0).sum(axis=0).astype(float)
    ones = [(singles == k).sum() for k in (1, 2, 3, 4)]
    d1, total = discounts(np.array(ones)), singles.sum()
    if not total:
        return np.full((SYMBOLS, SYMBOLS), 1 / SYMBOLS)
    kind = np.minimum(singles, 3).astype(int)
    base = np.maximum(singles - d1[kind], 0) / total + d1[kind][singles > 0].sum() / total / SYMBOLS
    codes = np.arange(SYMBOLS * SYMBOLS, dtype=np.uint64)
    return interpolated(codes, pairs.ravel(), np.tile(base, SYMBOLS), d2).reshape(SYMBOLS, SYMBOLS)


def log_probabilities(codes: np.ndarray, counts: np.ndarray, table: np.ndarray, d: dict[int, np.ndarray]) -> np.ndarray:
    """Natural logs of p(last byte | four before) of one shard's codes."""
    steps = ladder(codes, counts)
    three = steps[2][0]
    p = table[((three >> np.uint64(8)) & np.uint64(255)).astype(np.int64), (three & np.uint64(255)).astype(np.int64)]
    for order in (3, 4, 5):
        c, n, _ = steps[5 - order]
        p = interpolated(c, n, p if order == 3 else p[steps[6 - order][2]], d[order])
    return np.log(p)


def gathered(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct codes of a shard, their counts over all blocks, each block's codes)."""
    asked = [np.frombuffer(x, np.uint64) for x in group["codes"]]
    codes, at = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]])
    return codes, np.bincount(at, weights=counts, minlength=len(codes)), asked


# The jobs


def compressed(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(block, row, id, text_hash, lang, body): documents as compressed bytes, in the blocks that they are read in."""

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        pack, numbers = zstandard.ZstdCompressor(level=3), RowNumbers()
        for batch in batches:
            bodies = [("" if t is None else t).encode().translate(FOLDED) for t in batch.pop("text")]
            batch["body"] = [pack.compress(b) for b in bodies]
            batch["row"] = [numbers.take(len(b)) for b in bodies]
            yield batch[["row", "id", "text_hash", "lang", "body"]]

    texts = docs.select(F.col(id_col).cast("bigint").cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return in_blocks(texts.mapInPandas(squeeze, "row bigint, id string, text_hash bigint, lang string, body binary"), "quality-blocks")


def body_hash(body: bytes) -> int:
    """64 bits that are the same for all copies of a text."""
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "big", signed=True)


def opened(group: pd.DataFrame, trusted: np.ndarray, spare: int) -> tuple[pd.DataFrame, list[bytes], np.ndarray, np.ndarray]:
    """(documents of a block in order, their bytes, which are trusted, which of these are spared)."""
    import zstandard

    docs, unpack = group.sort_values("row", ignore_index=True), zstandard.ZstdDecompressor()
    known = docs["row"].isin(trusted).to_numpy()
    bodies = [unpack.decompress(b) for b in docs["body"]]
    docs["body_hash"] = np.array([body_hash(b) if k else 0 for k, b in zip(known, bodies)], dtype=np.int64)
    return docs, bodies, known, known & (docs["body_hash"].to_numpy() % spare == 0)


def perplexities(docs: DataFrame, labels: DataFrame, spare: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, text_hash, body_hash, lang, nll, n, trusted, spared): the negative log likelihood of each document's n bytes; body_hash is 0 unless trusted."""
    spark = docs.sparkSession
    ship(spark)
    shards = partitions(spark)
    home = compressed(docs, id_col, text_col, lang_col)
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").cast("string").alias("id")).distinct()
    marks = materialise(home.select("id", "row", "block").join(good, "id").select("block", "row"), "quality-trusted")

    def ask(group: pd.DataFrame, marked: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"shard": [], "block": [], "codes": [], "counts": []})
        _, bodies, known, spared = opened(group, marked["row"].to_numpy(), spare)
        codes = distinct(bodies)
        counts = counted([b for b, t in zip(bodies, known & ~spared) if t], codes).astype(np.uint32)
        shard = shard_of(codes, shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = [(s, group["block"].iloc[0], codes[o].tobytes(), counts[o].tobytes())
                for s in range(shards) if len(o := order[cuts[s] : cuts[s + 1]])]
        return pd.DataFrame(rows, columns=["shard", "block", "codes", "counts"])

    by_block = home.select("block", "row", "id", "text_hash", "lang", "body").groupBy("block")
    asked = by_block.cogroup(marks.groupBy("block")).applyInPandas(ask, "shard int, block bigint, codes binary, counts binary")
    asked = materialise(asked, "quality-asked")

    def survey(group: pd.DataFrame) -> pd.DataFrame:
        codes, counts, _ = gathered(group)
        out = []
        for order, (c, n, _) in zip((5, 4, 3), ladder(codes, counts)):
            out += [(order, k, int((n == k).sum())) for k in (1, 2, 3, 4)]
        pair, many = np.unique(c[n > 0] & np.uint64(0xFFFF), return_counts=True)
        return pd.DataFrame(out + [(2, int(p), int(m)) for p, m in zip(pair, many)], columns=["kind", "key", "n"])

    found = asked.groupBy("shard").applyInPandas(survey, "kind int, key int, n bigint").groupBy("kind", "key").agg(F.sum("n")).collect()
    pairs = np.zeros(SYMBOLS * SYMBOLS)
    ones = {order: np.zeros(4) for order in (3, 4, 5)}
    for kind, key, n in found:
        if kind == 2:
            pairs[key] = n
        else:
            ones[kind][key - 1] = n
    d = {order: discounts(c) for order, c in ones.items()}
    table = low_orders(pairs.reshape(SYMBOLS, SYMBOLS), discounts(np.array([(pairs == k).sum() for k in (1, 2, 3, 4)])))

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        codes, counts, wanted = gathered(group)
        logs = log_probabilities(codes, counts, table, d).astype(np.float32)
        return pd.DataFrame({"shard": group["shard"], "block": group["block"], "logs": [logs[np.searchsorted(codes, w)].tobytes() for w in wanted]})

    answers = asked.groupBy("shard").applyInPandas(answer, "shard int, block bigint, logs binary")
    answers = answers.select("shard", "block", "logs", F.lit(None).cast("bigint").alias("row")).unionByName(
        marks.select(F.lit(-1).alias("shard"), "block", F.lit(None).cast("binary").alias("logs"), "row")
    )

    def judge(group: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"doc_id": [], "text_hash": [], "body_hash": [], "lang": [], "nll": [], "n": [], "trusted": [], "spared": []})
        marked = replies["row"][replies["shard"] < 0].to_numpy(np.int64)
        kept, bodies, known, spared = opened(group, marked, spare)
        codes = distinct(bodies)
        order = np.argsort(shard_of(codes, shards), kind="stable")
        replies = replies[replies["shard"] >= 0].sort_values("shard")
        logs = np.empty(len(codes))
        if len(codes):
            logs[order] = np.frombuffer(b"".join(replies["logs"]), np.float32)
        places, nll = Lookup(codes), []
        for a, b in pieces(bodies):
            each, limits = grams(bodies[a:b])
            running = np.concatenate([[0.0], np.cumsum(logs[places.find(each)])])
            nll.append(running[limits[:-1]] - running[limits[1:]])
        return pd.DataFrame({
            "doc_id": kept["id"], "text_hash": kept["text_hash"], "body_hash": kept["body_hash"], "lang": kept["lang"], "nll": np.concatenate(nll) if nll else np.empty(0),
            "n": np.array([len(b) for b in bodies], np.int64), "trusted": known, "spared": spared,
        })

    out = by_block.cogroup(answers.groupBy("block")).applyInPandas(
        judge, "doc_id string, text_hash bigint, body_hash bigint, lang string, nll double, n bigint, trusted boolean, spared boolean"
    )
    return materialise(out.withColumn("doc_id", F.col("doc_id").cast("bigint")), "quality-scores")


def limits(scores: DataFrame, weight: float, high: float) -> DataFrame:
    """(key, mean, bound, texts): per language (null: empty) the mean log perplexity, the quantile and the spared texts. One small row each."""
    shrunk = (F.col("nll") + F.lit(weight) * F.col("mean")) / (F.col("n") + F.lit(weight))
    key = F.coalesce("lang", F.lit("")).alias("key")
    spared = scores.where("spared AND n > 0").groupBy(key, "body_hash").agg(F.min("nll").alias("nll"), F.first("n").alias("n"))
    spared = materialise(spared, "quality-spared")
    means = joinable(spared.groupBy("key").agg((F.sum("nll") / F.sum("n")).alias("mean")), "quality-means")
    return spared.join(means, "key").groupBy("key", "mean").agg(F.percentile_approx(shrunk, high, 10000).alias("bound"), F.count("*").alias("texts"))


def classify(docs: DataFrame, labels: DataFrame, weight: float = 100.0, high: float = 0.99, prior: float = 5.0, **how) -> DataFrame:
    """(doc_id, text_hash, lang, n, perplexity, bound, kept) for every row of `docs`; `labels` has doc_id, quality."""
    scores = perplexities(docs, labels, **how)
    own = joinable(limits(scores, weight, high), "quality-limits")
    whole = limits(scores.withColumn("lang", F.lit("")), weight, high).agg(F.max("mean").alias("any_mean"), F.max("bound").alias("any_bound"))
    known = scores.withColumn("key", F.coalesce("lang", F.lit(""))).join(own, "key", "left").crossJoin(F.broadcast(whole))  # one row
    mean, texts = F.coalesce("mean", "any_mean"), F.coalesce("texts", F.lit(0))
    bound = (F.coalesce("bound", F.lit(0.0)) * texts + F.col("any_bound") * F.lit(prior)) / (texts + F.lit(prior))
    shrunk = (F.col("nll") + F.lit(weight) * mean) / (F.col("n") + F.lit(weight))
    return known.select(
        "doc_id", "text_hash", "lang", "n", F.exp(shrunk).alias("perplexity"), F.exp(bound).alias("bound"), F.coalesce(shrunk <= bound, F.lit(True)).alias("kept")
    )


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` that are kept. Rejected rows are few and are removed by (id, text hash), so copies of a text fare alike."""
    own, key, bad_id, bad_hash = (fresh(docs, c) for c in ("_own", "_key", "_bad_id", "_bad_hash"))
    with passing(docs.sparkSession):
        bad = classify(docs, labels, id_col=id_col, text_col=text_col, **how).where("NOT kept")
        bad = bad.select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
        bad = materialise(bad, "quality-rejected", keep=True)
    keyed = docs.withColumns({own: F.xxhash64(text_col), key: F.col(id_col).cast("bigint")})
    match = (F.col(own) == F.col(bad_hash)) & F.col(key).eqNullSafe(F.col(bad_id))
    return keyed.join(bad, match, "left_anti").drop(own, key)
