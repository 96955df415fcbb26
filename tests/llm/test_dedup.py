"""Exact dedup, the persistent index and sharding."""

import hashlib
import random

import pytest

from boxloom.llm import exact_dedup, sharding
from boxloom.llm.common import scratch

SCHEMA = "doc_id long, text string, _digest string, copy string"
ROWS = [(1, "Same"), (2, "sAME"), (3, "other"), (4, None), (5, ""), (6, "É"), (7, "é"), (3, "other"), (None, "same"), (None, "alone")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def test_groups(spark):
    found = exact_dedup.DigestIndex(spark, scratch(spark, "t")).ingest(frame(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    kept = [r for r in found if r.kept]
    assert sorted((r.id is None, r.id) for r in kept) == [(False, 2), (False, 3), (False, 5), (False, 6), (False, 7), (True, None)]
    by = {(r.id, bytes(r.digest)): r for r in found}
    same = hashlib.sha256(b"same").digest()
    assert by[1, same].keep_id == 2 and by[1, same].group_size == 3 and by[None, same].keep_id == 2


def test_second_batch_against_the_index(spark):
    index = exact_dedup.DigestIndex(spark, scratch(spark, "t"))
    index.ingest(frame(spark, [(1, "a"), (2, "b")])).count()
    again = exact_dedup.DigestIndex(spark, index.path)
    found = {r.id: r for r in again.ingest(frame(spark, [(9, "A"), (10, "c")])).collect()}
    assert not found[9].kept and found[9].keep_id == 1 and found[10].kept
    assert again.read().count() == 3
    assert not any(r.kept for r in again.ingest(frame(spark, [(9, "A"), (10, "c")])).collect())
    assert again.ingest(frame(spark, [])).count() == 0 and again.read().count() == 3


def other_session(spark, partitions):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return other


@pytest.mark.parametrize("partitions", [3, 8])
def test_index_of_another_session(spark, partitions):
    """Known texts are found whatever number of partitions the session that reopens the index has."""
    path, docs = scratch(spark, "t"), [(i, f"text {i}") for i in range(400)]
    first = exact_dedup.DigestIndex(spark, path)
    first.ingest(frame(spark, docs), batch="one").count()
    other = other_session(spark, partitions)
    other.sql(f"DROP TABLE {first.name}")  # as a session with a catalog of its own
    again = exact_dedup.DigestIndex(other, path)
    assert again.buckets == first.buckets
    found = again.ingest(frame(other, [(i + 1000, t) for i, t in docs] + [(5000, "new")]), batch="two").collect()
    assert [r.id for r in found if r.kept] == [5000]
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(other, path, buckets=first.buckets + 1)


def test_repeated_batch(spark):
    """A batch whose decisions were lost, wholly or in part appended, decides the same when repeated."""
    index = exact_dedup.DigestIndex(spark, scratch(spark, "t"))
    index.ingest(frame(spark, [(1, "old")]), batch="a").count()
    docs = frame(spark, [(2, "OLD"), *((i, f"t{i // 2}") for i in range(10, 30)), (None, "none"), (None, "none")])
    key = lambda rows: sorted((str(r.id), r.digest.hex(), r.keep_id, r.copy, r.kept) for r in rows)
    once = key(index.ingest(docs, batch="b").collect())
    assert sum(k[-1] for k in once) == 11
    assert key(exact_dedup.DigestIndex(spark, index.path).ingest(docs, batch="b").collect()) == once
    assert index.read().count() == 12
    part = exact_dedup.DigestIndex(spark, scratch(spark, "t"))
    part.ingest(frame(spark, [(1, "old")]), batch="a").count()
    part.ingest(docs.where("doc_id < 20"), batch="b").count()  # the append broke off
    assert key(part.ingest(docs, batch="b").collect()) == once


def test_compacted_index(spark):
    path = scratch(spark, "t")
    index = exact_dedup.DigestIndex(spark, path, buckets=3)
    for k in range(3):
        index.ingest(frame(spark, [(i, f"text {i}") for i in range(k * 50, k * 50 + 100)]), batch=str(k)).count()
    index.compact()
    assert index.read().count() == 200
    files = [f for f in index.read().inputFiles()]
    assert len(files) == 3
    index.compact(buckets=5)
    other = other_session(spark, 2)
    again = exact_dedup.DigestIndex(other, path)
    assert again.buckets == 5 and again.read().count() == 200
    found = again.ingest(frame(other, [(900, "TEXT 7"), (901, "fresh")]), batch="x").collect()
    assert {r.id: (r.kept, r.keep_id) for r in found} == {900: (False, 7), 901: (True, 901)}


def test_hot_group(spark):
    """A group of most rows is dealt to many tasks and keeps its one row."""
    found = exact_dedup.DigestIndex(spark, scratch(spark, "t")).ingest(frame(spark, [(i, "hot" if i % 3 else f"t{i}") for i in range(3000)])).collect()
    assert len(found) == 3000
    hot = [r for r in found if r.group_size > 1]
    assert len(hot) == 2000 and [r.id for r in hot if r.kept] == [2999] and {r.keep_id for r in hot} == {2999}


def test_survivors_keep_columns(spark):
    docs = frame(spark, ROWS)
    left = exact_dedup.survivors(docs, exact_dedup.DigestIndex(spark, scratch(spark, "t")))
    assert left.columns == docs.columns and left.count() == 6


def test_empty(spark):
    assert exact_dedup.DigestIndex(spark, scratch(spark, "t")).ingest(frame(spark, [])).count() == 0


def shards(spark, rows, n, **how):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, shard int")
    found = sharding.assign(docs, shards=n, **how).collect()
    assert len(found) == len(rows)
    for s in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    sizes = [sum(r.size for r in found if r.shard == s) for s in range(n)]
    return found, sizes


def test_even_bytes_and_whole_groups(spark):
    rng = random.Random(1)
    rows = [(i, "w" * rng.randrange(20, 400) + str(i // 2)) for i in range(4000)]
    rows = [(i, rows[i - i % 2][1]) for i in range(4000)]  # pairs of equal texts
    found, sizes = shards(spark, rows, 6)
    assert max(sizes) - min(sizes) < 0.03 * sum(sizes) / 6
    home = {}
    for r in found:
        home.setdefault(r.h, set()).add(r.shard)
    assert all(len(s) == 1 for s in home.values())


def test_hot_group_is_cut(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i}") for i in range(3000)] + [(None, None), (5000, "")]
    _, sizes = shards(spark, rows, 8)
    assert max(sizes) - min(sizes) < 0.06 * sum(sizes) / 8


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(1, None), (1, None), (2, None)]])
def test_few_rows(spark, rows):
    found, _ = shards(spark, rows, 5)
    assert all(r.size == 8 + (len("a") if rows[0][1] else 0) for r in found)


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    cuts = sharding.write_shards(docs, str(tmp_path / "s"), shards=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert cuts.count() == 2 and back.count() == 300 and back.select("shard").distinct().count() == 3
