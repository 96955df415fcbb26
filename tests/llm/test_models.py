"""The two trained models: gradients, held-out accuracy, and Kneser-Ney against a plain version."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from boxloom.llm import quality, toxicity


def test_gradient_of_the_network():
    """One step of tiny rate moves the loss as the squared gradient says, for every parameter."""
    words = ["mild", "rude", "rudest", "calm", "tea"]
    net = toxicity.Network(dim=4, hidden=3, attention=2, word_rows=64, gram_rows=64)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    net.p["word"] += np.random.default_rng(0).standard_normal(net.p["word"].shape) * 0.3
    features = toxicity.Features(words, *net.sizes)
    ids, real = np.array([[0, 1, 3], [4, 2, 0]]), np.array([[True, True, True], [True, True, False]])
    label, weight = np.array([1.0, 0.0]), np.ones(2)

    def loss():
        vectors, _ = net.inputs(features, np.arange(len(words)))
        logit = net.forward((vectors[ids.T] * real.T[:, :, None]), real.T)
        p = toxicity.sigmoid(logit)
        return float(-(label * np.log(p) + (1 - label) * np.log(1 - p)).mean())

    for name in ("o", "oc", "a", "av", "fu", "bu", "fx", "bx", "fc", "bc"):
        before = {k: v.copy() for k, v in net.p.items()}
        net.g2 = {k: 1e18 if k in ("word", "gram") else np.full_like(v, 1e18) for k, v in net.p.items()}
        net.step(features, ids, real, label, weight, rate=1e9)  # divided by 1e9: plain descent of rate 1
        gradient = before[name] - net.p[name]
        net.p = {k: v.copy() for k, v in before.items()}
        numeric = np.zeros_like(gradient)
        for place in np.ndindex(*gradient.shape):
            for sign in (1, -1):
                net.p[name][place] = before[name][place] + sign * 1e-5
                numeric[place] += sign * loss() / 2e-5
            net.p[name][place] = before[name][place]
        assert np.allclose(gradient, numeric, atol=2e-5), name


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 300))]
        bad = i % 5 == 0
        if bad:
            for _ in range(max(1, len(words) // 40)):
                words.insert(rng.randrange(len(words) + 1), "zxq" + word())
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy(spark):
    rows = toxic_corpus(700, 1)
    docs = spark.createDataFrame([(i, t, "c") for i, t, _ in rows] + [(9000, None, "c"), (9001, "", "c"), (None, "x y", "c"), (9002, "la " * 30000, "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(1, None), (None, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert len(found) == len(rows) + 4 and all(0 <= s <= 1 for s in found.values())
    assert found[9000] < 0.5 and found[9001] < 0.5
    held = [(found[i] >= 0.5, y == 1) for i, _, y in rows if i % 3 == 0]
    assert np.mean([p == y for p, y in held]) > 0.93


def test_windows_cover_and_overlap():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = list(toxicity.starts_of(n))
        assert {w for s in starts for w in range(s, min(n, s + toxicity.SPAN))} == set(range(n))
        assert all(b - a < toxicity.SPAN for a, b in zip(starts, starts[1:]))


def test_long_texts_are_sampled_whole(spark):
    """Every window of a sampled document is learned from; only whole documents are left out."""
    rows = [(1, "a " * 5000 + "zxq " + "b " * 5000, 1), (2, "c " * 4000, 0), (3, "d " * 40, 0), (4, None, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    whole = {i: len(toxicity.starts_of(len(toxicity.words_of(t)))) for i, t, _ in rows}
    sample, odds = toxicity.sample_windows(docs, labels, 10, 1000, "doc_id", "text")
    assert odds == 3 and sample.groupby("doc_id").size().to_dict() == whole and sample["window"].str.contains("zxq").any()
    sample, _ = toxicity.sample_windows(docs, labels, 10, 100, "doc_id", "text")
    assert sample.groupby("doc_id").size().to_dict() == {3: whole[3], 4: whole[4]}


def test_distinct_words_take_little_memory():
    """Hashing and scoring hold a few bytes an n-gram, not a vector each."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=40)) for _ in range(32_000)]
    net = toxicity.Network()
    ids, real = np.arange(len(words)).reshape(-1, 32), np.ones((1000, 32), bool)
    tracemalloc.start()
    try:
        features = toxicity.Features(words, *net.sizes)
        toxicity.window_logits(net, features, ids, real)
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()


def test_forgotten_words_and_groups_change_nothing():
    texts = [t.split() for _, t, _ in toxic_corpus(40, 2)] + [[]]
    net = toxicity.Network()
    net.p["word"] += np.random.default_rng(1).standard_normal(net.p["word"].shape).astype(np.float32)
    features, ids, limits = toxicity.factorised(texts, net)
    spans, real, _ = toxicity.windows_of(ids, limits)
    whole = toxicity.window_logits(net, features, spans, real)
    again, ids, same = toxicity.factorised(texts, net, most=100)
    assert len(again.word) > len(features.word) == len({w for t in texts for w in t}) and (same == limits).all()
    spans, _, _ = toxicity.windows_of(ids, limits)
    assert np.allclose(whole, toxicity.window_logits(net, again, spans, real, step=7, group=21), atol=1e-5)


def test_one_class_gives_zero(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert toxicity.score(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")).first().score == 0.0


def plain_kneser_ney(trained, text, order=5):
    """Interpolated modified Kneser-Ney over bytes, straight from its definition."""
    counts = [None] * (order + 1)
    counts[order] = Counter(t[i - order + 1 : i + 1] for t in (bytes(order - 1) + x for x in trained) for i in range(order - 1, len(t)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: quality.discounts(np.array([sum(c == n for c in counts[k].values()) for n in (1, 2, 3, 4)])) for k in range(1, order + 1)}
    follow = [None] + [defaultdict(list) for _ in range(order)]
    for k in range(1, order + 1):
        for g, c in counts[k].items():
            follow[k][g[:-1]].append(c)

    def p(g):
        if not g:
            return 1 / 256
        k, seen = len(g), follow[len(g)].get(g[:-1])
        if not seen:
            return p(g[1:])
        total = sum(seen)
        c = counts[k].get(g, 0)
        return max(c - d[k][min(c, 3)], 0) / total + sum(d[k][min(x, 3)] for x in seen) / total * p(g[1:])

    padded = bytes(order - 1) + text
    return -sum(math.log(p(padded[i - order + 1 : i + 1])) for i in range(order - 1, len(padded)))


def prose(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "ran", "far"]) for _ in range(rng.randrange(3, 60))) + f" {rng.randrange(99)}é.") for i in range(n)]


@pytest.fixture(scope="module")
def judged(spark):
    rows = prose(240, 1) + [(1000 + i, "#%&! QQXZ *** " * (i + 2)) for i in range(12)] + [(2000, None), (2001, ""), (None, "the cat"), (3, "the mat sat"), (2002, "tiny")]
    docs = spark.createDataFrame([(i, t, None if i == 7 else "en" if (i or 0) % 2 else "xx", 1) for i, t in rows], "doc_id long, text string, lang string, block int").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(160)] + [(0, 1), (1000, 0), (None, 1), (5, None)], "doc_id long, quality int")
    return rows, docs, labels


def test_scores_equal_a_plain_model(spark, judged):
    rows, docs, labels = judged
    scores = quality.perplexities(docs, labels).collect()
    assert len(scores) == len(rows)
    text = lambda t: (t or "").encode().translate(quality.FOLDED)
    by_hash = {r.h: r.text for r in docs.selectExpr("xxhash64(text) AS h", "text").collect()}
    fit = [text(by_hash[r.text_hash]) for r in scores if r.trusted and not r.spared]
    assert 100 < len(fit) < 161 and all(r.doc_id is not None and r.doc_id < 160 for r in scores if r.trusted)
    for r in scores[::9]:
        own = text(by_hash[r.text_hash])
        assert r.n == len(own) and r.nll == pytest.approx(plain_kneser_ney(fit, own), rel=1e-5, abs=1e-6)


def test_probabilities_sum_to_one():
    trained = [b"abracadabra", b"banana band"]
    for context in (b"abra", b"zzzz", b"\0\0ba"):
        base = plain_kneser_ney(trained, context)
        assert sum(math.exp(base - plain_kneser_ney(trained, context + bytes([b]))) for b in range(256)) == pytest.approx(1, abs=1e-9)


def test_junk_goes_and_prose_stays(spark, judged):
    rows, docs, labels = judged
    left = quality.accepted(docs, labels)
    kept = {r.doc_id for r in left.collect()}
    assert left.columns == docs.columns and not kept & set(range(1000, 1012))
    assert len(kept & set(range(240))) >= 235 and {2000, 2001, None} <= kept


def test_without_trusted_text_all_stay(spark, judged):
    _, docs, labels = judged
    assert quality.accepted(docs, labels.limit(0)).count() == docs.count()
    assert quality.accepted(docs.limit(0), labels).count() == 0


def test_copies_are_spared_together_and_count_once(spark):
    texts = [(i, t) for i, t in prose(40, 5)] + [(100 + i, f"copy {i % 2} of a text that is often met") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string").repartition(3)
    scores = quality.perplexities(docs, spark.createDataFrame([(i, 1) for i, _ in texts], "doc_id long, quality int"))
    copies = {r.spared for r in scores.where("doc_id >= 100").collect()}
    assert len(copies) == 1  # equal but for a digit, which the model doesn't see
    rows = [("en", 1, 50.0, 100, True)] * 500 + [("en", 2 + i, 200.0 + i, 100, True) for i in range(10)]
    made = spark.createDataFrame(rows, "lang string, body_hash long, nll double, n long, spared boolean")
    bound = quality.limits(made, 0.0, 0.5).first()
    assert bound.texts == 11 and bound.bound == pytest.approx(2.04)


def test_texts_without_words_are_clean_at_any_length():
    """Even where the network itself would call an empty window toxic."""
    net = toxicity.Network()
    net.p["oc"][:] = 5.0
    for text in (None, "", "!" * 63, "!" * 64, "? " * 10_000):
        logit, wordless = toxicity.document_logits(net, [text])
        assert wordless.tolist() == [True] and logit[0] > 0
    assert toxicity.document_logits(net, ["word", "!!", "a " * 100])[1].tolist() == [False, True, False]


def test_scores_of_odd_tables(spark):
    schema, marks = "doc_id long, text string, score string, label int", "doc_id long, toxic int"
    rows = toxic_corpus(60, 4)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], marks)
    assert toxicity.score(spark.createDataFrame([], schema), labels).count() == 0
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t, _ in rows] + [(900, "!" * 5000, "x", 0), (901, None, None, None), (None, "tea", "", 1), (900, "!" * 5000, "x", 0)], schema)
    found = toxicity.score(docs, labels).collect()
    assert len(found) == 64 and all(r.score < 0.5 for r in found if r.doc_id in (900, 901)) and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in toxicity.score(docs, spark.createDataFrame([], marks)).collect()} == {0.0}
