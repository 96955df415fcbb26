"""The registered queries without SQL, and the pipeline's stages, against plain versions on the smallest tables."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from boxloom.llm import mixing, queries

DATA = "/root/testdata/sf0.001"


def load(name):
    return duckdb.sql(f"SELECT * FROM '{DATA}/{name}.parquet'").df()


@pytest.fixture(scope="module")
def documents():
    return load("documents")


def rows_of(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


def token_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids, 0]


def check_packing(rows, texts, size=2048):
    """`texts`: how often each (id, ids of its tokens) is to be packed."""
    left = Counter()
    for (ident, ids), times in texts.items():
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids), size)] if len(ids) > size else [0]
        for k, start in enumerate(cuts):
            part = ids[start : cuts[k + 1] if k + 1 < len(cuts) else None]
            left[ident, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += times
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == left
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in rows)
    assert len(by) <= -(-total // size) * 1.02 + 1


def test_op2(spark, documents):
    check_packing(rows_of(spark, "op2_packing"), Counter((r.doc_id, tuple(token_ids(r.text))) for r in documents.itertuples()))


def test_op3(spark, documents):
    found = rows_of(spark, "op3_toxicity")
    assert sorted(r.doc_id for r in found) == sorted(documents["doc_id"])
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op4(spark):
    table = load("embeddings")
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in table.itertuples() if r.embedding is not None}
    vectors = {i: v for i, v in vectors.items() if np.isfinite(v).all() and v.any()}
    ids, points = np.array(list(vectors)), np.stack(list(vectors.values()))
    found = {}
    for r in rows_of(spark, "op4_ann"):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i in ids if i % 20 == 0}
    hits = wanted = 0
    for query, rows in found.items():
        rows.sort()
        assert [rank for rank, *_ in rows] == list(range(1, len(rows) + 1)) and [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        for _, i, s in rows:
            assert i != query and math.isclose(s, float(vectors[i] @ vectors[query]), rel_tol=1e-12, abs_tol=1e-12)
        scores = points @ vectors[query]
        best = [i for _, i in sorted((-s, i) for s, i in zip(scores, ids) if i != query)[:20]]
        hits, wanted = hits + len({i for _, i, _ in rows} & set(best)), wanted + len(best)
    assert hits / wanted >= 0.9


def sets_of(texts, width):
    out = []
    for text in texts:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\\x20\\x09-\\x0D]+", lowered)
        out.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def components(ids, sets, num, den):
    """The smallest id that each document reaches by links."""
    home = list(range(len(ids)))

    def root(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                home[root(a)] = root(b)
    least = {}
    for x, i in enumerate(ids):
        least[root(x)] = min(i, least.get(root(x), i))
    return [least[root(x)] for x in range(len(ids))]


def test_op7(spark, documents):
    ids, sets = list(documents["doc_id"]), sets_of(documents["text"], 4)
    wanted = sorted(zip(ids, map(len, sets), components(ids, sets, 85, 100)))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows_of(spark, "op7_jaccard_join")) == wanted


def test_op9(spark, documents):
    found = {r.doc_id: r for r in rows_of(spark, "op9_sharding")}
    assert len(found) == len(documents) and all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24 for r in found.values())
    homes = {}
    for d in documents.itertuples():
        raw = (d.text or "").encode()
        assert (found[d.doc_id].size, found[d.doc_id].text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        homes.setdefault(raw, set()).add(found[d.doc_id].shard)
    for s in {r.shard for r in found.values()}:
        assert sorted(r.slot for r in found.values() if r.shard == s) == list(range(sum(r.shard == s for r in found.values())))
    sizes = [sum(r.size for r in found.values() if r.shard == s) for s in range(24)]
    assert max(sizes) - min(sizes) <= 2 * max(max(r.size for r in found.values()), 0.05 * sum(sizes) / 24)


def test_op10(spark, documents):
    found = rows_of(spark, "op10_quality")
    assert sorted(r.doc_id for r in found) == sorted(documents["doc_id"])
    assert all(r.kept == (r.perplexity <= r.limit) for r in found) and all(r.kept for r in found if not r.text_bytes)
    labels = dict(zip(*(load("labels")[c] for c in ("doc_id", "quality"))))
    good = [r.kept for r in found if labels.get(r.doc_id) == 1]
    assert np.mean(good) > 0.9 and not all(r.kept for r in found if labels.get(r.doc_id) == 0)


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage is judged on its own input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    names, inputs = list(steps), {}
    for name in names[:-1]:
        inputs[name] = docs.toPandas()
        steps[name](spark, docs, DATA).write.parquet(str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
    after = {name: inputs[names[k + 1]] for k, name in enumerate(names[:-2])} | {names[-2]: docs.toPandas()}

    first = after["quality classifier"]
    judged = {r.doc_id: r.kept for r in rows_of(spark, "op10_quality")}
    assert set(first["doc_id"]) == {i for i, kept in judged.items() if kept}

    own, groups = inputs["exact dedup"], {}
    for r in own.itertuples():
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        groups[key] = max(r.doc_id, groups.get(key, r.doc_id))
    assert sorted(after["exact dedup"]["doc_id"]) == sorted(groups.values())

    own = inputs["n-gram jaccard join"]
    home = components(list(own["doc_id"]), sets_of(own["text"], 5), 80, 100)
    assert sorted(after["n-gram jaccard join"]["doc_id"]) == sorted(set(home))

    own = inputs["mixing sources"]
    duck = duckdb.connect()
    duck.register("documents", own)
    times = {i: t for i, t in duck.sql(f"SELECT doc_id, times FROM ({mixing.uses_sql()})").fetchall()}
    assert Counter(after["mixing sources"]["doc_id"]) == Counter({i: t for i, t in times.items() if t})

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    check_packing(packed, Counter((r.doc_id, tuple(token_ids(r.text))) for r in after["mixing sources"].itertuples()))
