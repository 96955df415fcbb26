"""The Jaccard join against brute force, and nearest neighbours against all pairs."""

import random
import re

import numpy as np
import pytest

from boxloom.llm import ann, jaccard


def brute(rows, width, num, den):
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    lowest = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            lowest[find(i)] = min(lowest.get(find(i), ident), ident)
    return [(ident, len(s), lowest.get(find(i)) if s else ident) for i, ((ident, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, n):
    """Unrelated texts, copies, copies of copies with few changes, and much shared boilerplate."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 6)))
    plate = [word() for _ in range(30)]
    base = [[word() for _ in range(rng.randrange(3, 120))] for _ in range(n // 6)]
    base[0] = [word() for _ in range(90)]
    rows = []
    for i in range(n):
        words = list(base[0] if i % 2 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.4:
            words = plate + words
        rows.append((i, rng.choice([" ", "\t", "  \n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "a b"), (3, rows[3][1]), (None, rows[5][1]), (None, "lone words here now")]


@pytest.mark.parametrize(("seed", "width", "num", "long"), [(1, 4, 85, 500), (2, 5, 80, 500), (3, 5, 80, 60), (4, 4, 85, 10)])
def test_components(spark, monkeypatch, seed, width, num, long):
    monkeypatch.setattr(jaccard, "FREQUENT", 4)  # classes are reached by small groups
    rows = corpus(seed, 260)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string").repartition(3)
    found = jaccard.join(docs, width, num, 100, long=long)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=key) == sorted(brute(rows, width, num, 100), key=key)


def test_one_stays_of_each_component(spark):
    rows = corpus(5, 200)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _key string")
    left = jaccard.survivors(docs, width=5, num=80, den=100)
    full = [r for r in brute(rows, 5, 80, 100) if r[1]]
    texts = {r.text for r in left.collect()}
    assert left.columns == docs.columns and texts <= {t for _, t in rows}
    assert left.where("text RLIKE '[^ \\t\\n]'").count() == len({c for _, _, c in full if c is not None}) + len([1 for _, _, c in full if c is None])


def test_no_documents(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def neighbours(points, ids, every, k):
    out = {}
    for i, ident in enumerate(ids):
        if ident % every == 0:
            score = points @ points[i]
            order = sorted((j for j in range(len(ids)) if ids[j] != ident), key=lambda j: (-score[j], ids[j]))[:k]
            out[ident] = [(ids[j], score[j]) for j in order]
    return out


def test_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    points = rng.standard_normal((1500, 16)).astype(np.float32)
    points[500:1000] = points[500]  # a third are one vector
    ids = list(range(1, 1501))
    rows = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in zip(ids, points)], "vec_id long, embedding array<float>")
    found = {}
    for r in ann.search(rows, every=50, k=10, block=128).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    wanted = neighbours(points.astype(float), ids, 50, 10)
    assert set(found) == set(wanted)
    hits = 0
    for query, best in found.items():
        best.sort()
        assert [b[0] for b in best] == list(range(1, 11))
        assert all(abs(s - float(points[v - 1].astype(float) @ points[query - 1].astype(float))) < 1e-9 for _, v, s in best)
        assert best == sorted(best, key=lambda b: (-b[2], b[1]))
        hits += len({v for _, v, _ in best} & {v for v, _ in wanted[query]})
    assert hits >= 0.9 * 10 * len(wanted)


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0]), (8, [2.0, 0.0]), (None, [1.0, 1.0]), (0, [0.5, 0.5])]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=5).collect()
    assert {r.query_id for r in found} == {0, 20} and {r.vec_id for r in found} == {0, 8, 20}
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 20] == [0, 0, 8]


def test_no_vectors(spark):
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
