"""N-gram Jaccard join: token-combination prefixes over word shingles, then exact verification.

A document's set are the hashes of its distinct word shingles. Documents with equal sets are one node
from the start, so copies are never compared. Then:

1. Texts are kept, compressed, in a table bucketed by the blocks that they are read in, which is never
   shuffled. Each block sends its shingles to shards, which count the sets that hold
   each, over all blocks, and reply with the shingle's class: 0 if it occurs once, else one more than
   the logarithm of its count. The class (a function of the shingle alone) and the hash order all
   shingles, rare ones first.
2. Of two sets of Jaccard similarity `num / den` or more, the first shared shingle in that order lies
   in both prefixes of n - ceil(num n / den) + 1 shingles, the first k shared ones in both prefixes
   that are k - 1 longer. If the first shared shingle is of a rare class, single shingles find the
   pair; if not, all shared ones are frequent, and the pair is found by a combination of k = 2: one
   from the prefix, the next shared one from the extended prefix. Sets of more than `long` shingles,
   which would have too many combinations, are indexed by single shingles of all classes, and so are
   sets that are similar in size to such. Shingles that occur once are never indexed.
3. Of the nodes listed under one key, a few hubs (smallest by a hash of the round) are compared with
   all others; links join components. After `rounds` rounds, all pairs under one key that still lie
   in different components are compared, in blocks. So every pair of similar sets is compared or
   already connected, while a group of many near copies costs a multiple of its size, not its square.
   Pairs are left out where their sizes exclude the similarity, or the places of the key's shingles in
   the two sets do: what stands before the first shared shingle is not shared. In the first round the
   set that can share most is a hub too, as the text that others were copied from would be.

Similarity is exact on the sets of 64-bit shingle hashes.

Defined results: null texts and texts without words have an empty set, are linked with nothing and
are their own component. Texts with fewer words than a shingle have one, of all their words. Rows that
repeat an id are documents each. A component without any id has a null one. Only the id and the text
are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK_BITS, RowNumbers, fresh, in_blocks, materialise, partitions, passing, ship

BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ROOT = 0x9E3779B97F4A7C15 | 1
FREQUENT = 6  # the class of shingles that 32 sets or more hold; below it a shingle is rare


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ROOT and its inverse modulo 2**64, to the powers 0 .. n - 1."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, root in enumerate((ROOT, pow(ROOT, -1, 1 << 64))):
            steps = np.full(size, root, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def words(text: bytes) -> np.ndarray:
    """Hashes of the words, runs of other bytes than blanks: polynomials of their bytes, from differences of running sums."""
    raw = np.frombuffer(text, np.uint8)
    blank = np.concatenate([[True], BLANK[raw], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    first, end = edge[::2], edge[1::2]
    up, down = powers(len(raw) + 1)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=running[1:])
    return mix((running[end] - running[first]) * down[first] + (end - first).astype(np.uint64))


def shingles(text: bytes, width: int) -> np.ndarray:
    """The set of a text: sorted distinct hashes of its runs of `width` words."""
    each = words(text)
    n = len(each) - width + 1
    if not len(each):
        return np.empty(0, np.uint64)
    size = width if n > 0 else len(each)
    total = np.full(max(n, 1), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + each[k : k + len(total)]
    return np.unique(mix(total))


def code(token: np.ndarray) -> np.ndarray:
    """The 32 bits of a shingle that it is counted by."""
    return (token >> np.uint64(32)).astype(np.uint32)


def deltas(sorted_codes: np.ndarray) -> bytes:
    """Sorted distinct numbers as compressed differences, their bytes by significance."""
    import zstandard

    steps = np.diff(sorted_codes.astype(np.int64), prepend=0).astype("<u4")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def from_deltas(data: bytes) -> np.ndarray:
    import zstandard

    steps = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel().astype(np.int64)).astype(np.uint32)


def prefix_keys(tokens: np.ndarray, kinds: np.ndarray, num: int, den: int, long: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys that a set is listed under, most shingles it can share with a set that first shares this key's).

    `tokens` are in the global order, `kinds` their classes. Where a single shingle is the first shared
    one, no more than it and those after it are shared; where a combination is, one more than its last
    and those after that.
    """
    n = len(tokens)
    prefix = n - -(-num * n // den) + 1
    head = kinds[:prefix]
    rare, often = np.flatnonzero((head > 0) & (head < FREQUENT)), np.flatnonzero(head >= FREQUENT)
    keys, rest = [tokens[rare]], [n - rare]
    if len(often) and n * den >= long * num:
        keys.append(mix(tokens[often] + np.uint64(1)))
        rest.append(n - often)
    if len(often) and n <= long:
        for i in often:
            after = np.arange(i + 1, min(prefix + 1, n))
            keys.append(mix(tokens[i : i + 1] * np.uint64(3) + mix(tokens[after])))
            rest.append(1 + n - after)
    return np.concatenate(keys), np.concatenate(rest)


# The jobs


def read_sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(block, row, doc_id, text_hash, n, same, body): each document's set size, a digest of its set, and its bytes, compressed."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        pack, numbers = zstandard.ZstdCompressor(level=3), RowNumbers()
        for batch in batches:
            rows = []
            for ident, text, mark in zip(batch["id"], batch["text"], batch["text_hash"]):
                body = ("" if text is None else text).encode().translate(LOWER)
                own = shingles(body, width)
                rows.append((numbers.take(len(body)), ident, mark, len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), pack.compress(body)))
            yield pd.DataFrame(rows, columns=["row", "doc_id", "text_hash", "n", "same", "body"])

    source = docs.select(F.col(id_col).cast("bigint").cast("string").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    found = source.mapInPandas(read, "row bigint, doc_id string, text_hash bigint, n bigint, same binary, body binary")
    return in_blocks(found.withColumn("doc_id", F.col("doc_id").cast("bigint")), "jaccard-rows")


def listed(rows: DataFrame, nodes: DataFrame, width: int, num: int, den: int, long: int) -> DataFrame:
    """(node, n, keys, rest, tokens): nodes whose prefix others may share, their keys with what these leave to share, and their shingles that others have."""
    import zstandard

    shards = partitions(rows.sparkSession)
    chosen = nodes.select(F.shiftright("node", BLOCK_BITS).alias("block"), "node")
    bodies = rows.select("block", "row", "body").groupBy("block")

    def opened(group: pd.DataFrame, chosen: pd.Series) -> tuple[np.ndarray, list[np.ndarray]]:
        kept = group[group["row"].isin(chosen)].sort_values("row")
        unpack = zstandard.ZstdDecompressor()
        return kept["row"].to_numpy(), [shingles(unpack.decompress(b), width) for b in kept["body"]]

    def ask(group: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        _, sets = opened(group, chosen["node"])
        if not sets:
            return pd.DataFrame({"shard": [], "block": [], "codes": [], "counts": []})
        codes, counts = np.unique(code(np.concatenate(sets)), return_counts=True)
        cuts = np.searchsorted(codes, np.arange(shards + 1) * (1 << 32) // shards)
        block, squeeze = group["block"].iloc[0], lambda x: zstandard.compress(x, 1)
        rows = [(s, block, deltas(codes[a:b]), squeeze(counts[a:b].astype("<u4").tobytes()))
                for s, (a, b) in enumerate(itertools.pairwise(cuts)) if b > a]
        return pd.DataFrame(rows, columns=["shard", "block", "codes", "counts"])

    def classify(group: pd.DataFrame) -> pd.DataFrame:
        asked = [from_deltas(c) for c in group["codes"]]
        counts = [np.frombuffer(zstandard.decompress(c), "<u4") for c in group["counts"]]
        codes, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts))
        kinds = np.where(total < 2, 0, np.floor(np.log2(np.maximum(total, 1))) + 1).astype(np.uint8)[at]
        ends = np.cumsum([len(a) for a in asked])
        return pd.DataFrame({
            "shard": group["shard"], "block": group["block"],
            "kinds": [zstandard.compress(k.tobytes(), 1) for k in np.split(kinds, ends[:-1])],
        })

    def index(group: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        nodes, sets = opened(group, replies["node"][replies["shard"] < 0])
        rows = []
        if sets:
            codes = np.unique(code(np.concatenate(sets)))
            kinds = np.frombuffer(b"".join(zstandard.decompress(k) for k in replies[replies["shard"] >= 0].sort_values("shard")["kinds"]), np.uint8)
            of = kinds[np.searchsorted(codes, code(np.concatenate(sets)))]
            for node, own, kind in zip(nodes, sets, np.split(of, np.cumsum([len(s) for s in sets])[:-1])):
                prefix = len(own) - -(-num * len(own) // den) + 1
                if (kind == 0).sum() >= prefix:
                    continue  # the prefix holds shingles of this set alone
                order = np.lexsort((own, kind))
                keys, rest = prefix_keys(own[order], kind[order], num, den, long)
                rows.append((node, len(own), keys.view(np.int64).tolist(), rest.tolist(), own[kind > 0].tobytes()))
        return pd.DataFrame(rows, columns=["node", "n", "keys", "rest", "tokens"])

    asked = bodies.cogroup(chosen.groupBy("block")).applyInPandas(ask, "shard int, block bigint, codes binary, counts binary")
    replies = asked.groupBy("shard").applyInPandas(classify, "shard int, block bigint, kinds binary")
    replies = replies.select("shard", "block", "kinds", F.lit(None).cast("bigint").alias("node")).unionByName(
        chosen.select(F.lit(-1).alias("shard"), "block", F.lit(None).cast("binary").alias("kinds"), "node")
    )
    found = bodies.cogroup(replies.groupBy("block")).applyInPandas(index, "node bigint, n bigint, keys array<bigint>, rest array<bigint>, tokens binary")
    return materialise(found, "jaccard-listed")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) of `pairs` that are similar enough. `tokens` leaves out shingles of one set only, which are in no intersection."""

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(batch["n"], batch["m"], batch["x"], batch["y"]):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                good.append(den * both >= num * (n + m - both))
            yield batch.loc[good, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), "n", F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
    return joined.mapInPandas(test, "a bigint, b bigint")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): each node of `edges` (a, b) with the smallest node that it is connected to.

    Large-star and small-star by turns, each an aggregation and a join with its result, until neither changes anything;
    a hub's neighbours shrink to one edge each, and counts are compared, nothing is collected.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        around = both(edges)
        low = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = around.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = materialise(small.where("a <> b").distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root")))


def links(sets: DataFrame, num: int, den: int, rounds: int, hubs: int) -> DataFrame:
    """(node, root) of all nodes that are connected with another."""
    posts = sets.select("node", "n", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("rest").alias("rest"))))
    shared = posts.groupBy("key").agg(F.count("*").alias("many")).where("many > 1")
    posts = materialise(posts.join(shared.select("key"), "key"), "jaccard-posts")
    # sizes must allow the similarity, and so must what either set can share from this key on
    possible = (F.least("n", "m") * F.lit(den) >= F.greatest("n", "m") * F.lit(num)) & (
        F.least("rest", "left") * F.lit(num + den) >= (F.col("n") + F.col("m")) * F.lit(num)
    )
    roots = tested = None
    for turn in range(rounds + 1):
        placed = posts.withColumn("root", F.col("node")) if roots is None else (
            posts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        )
        member = F.struct("node", "n", "rest", "root")
        if turn < rounds:
            drawn = [F.min_by(member, F.xxhash64("node", F.lit(turn * hubs + i))) for i in range(hubs)]
            drawn += [F.max_by(member, F.struct("rest", F.xxhash64("node")))] * (turn == 0)
            held = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.array(*drawn).alias("hubs"))
            other = held.where("r0 <> r1").select("key", F.explode(F.array_distinct("hubs")).alias("o"))
            other = other.select("key", F.col("o.node").alias("b"), F.col("o.n").alias("m"), F.col("o.rest").alias("left"), F.col("o.root").alias("s"))
            some = placed
        else:
            parts = placed.groupBy("key", "root").agg(F.count("*").alias("size"))
            most = parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"), F.count("*").alias("parts"))
            most = most.where("parts > 1").select("key", F.col("most.root").alias("major"))
            some = placed.join(most, "key").where("root <> major").drop("major")
            other = placed.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("rest").alias("left"), F.col("root").alias("s"))
        met = some.join(other, (some["key"] == other["key"]) & (F.col("root") != F.col("s")) & possible)
        pairs = met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, f"jaccard-pairs{turn}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        edges = verified(pairs, sets, num, den)
        if roots is not None:
            edges = edges.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(edges, f"jaccard-roots{turn}")
    return roots


def join(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, long: int = 500, rounds: int = 1, hubs: int = 3,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, class_id, component_id, first): one row per document.

    Documents link at a Jaccard similarity of `num` / `den` or more. `class_id` is the smallest id with
    an equal set, `component_id` the smallest id that links reach, `first` marks one row of each
    component, of smallest id; `text_hash` is the xxhash64 of the text as it is.
    """
    ship(docs.sparkSession)
    rows = read_sets(docs, width, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    groups = rows.where("n > 0").groupBy("same").agg(F.min("row").alias("node"), F.min("doc_id").alias("class_id"), first)
    groups = materialise(groups, "jaccard-classes")
    roots = links(listed(rows, groups, width, num, den, long), num, den, rounds, hubs)
    placed = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = placed.groupBy("root").agg(F.min("class_id").alias("component_id"), F.min("first").alias("first"))
    known = placed.drop("first").join(lowest, "root").select("same", "class_id", "component_id", F.col("first.row").alias("stays"))
    linked = rows.where("n > 0").join(known, "same")
    alone = rows.where("n = 0").select("*", *(F.col(c).alias(a) for c, a in (("doc_id", "class_id"), ("doc_id", "component_id"), ("row", "stays"))))
    both = linked.select(*alone.columns).unionByName(alone)
    return both.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "class_id", "component_id", (F.col("row") == F.col("stays")).alias("first")
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` that stay when one document of each component does; of rows that repeat id and text one stays."""
    own, key, copy, kept_id, kept_hash = (fresh(docs, c) for c in ("_own", "_key", "_copy", "_kept_id", "_kept_hash"))
    with passing(docs.sparkSession):
        kept = join(docs, id_col=id_col, text_col=text_col, **how).where("first")
        kept = materialise(kept.select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash)), "jaccard-kept", keep=True)
    keyed = docs.withColumn(own, F.xxhash64(text_col)).withColumn(key, F.col(id_col).cast("bigint"))
    found = keyed.join(kept, (F.col(own) == F.col(kept_hash)) & F.col(key).eqNullSafe(F.col(kept_id)), "left_semi")
    nth = F.row_number().over(Window.partitionBy(own, key).orderBy(key))
    return found.withColumn(copy, nth).where(F.col(copy) == 1).drop(own, key, copy)
