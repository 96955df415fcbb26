"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is its lower-cased words. Windows of `span` words, each overlapping the next, cover all of it
and all are scored; the document's score is that of its worst window. A word enters as the sum of a
hashed word embedding and the mean of hashed embeddings of its character 3- to 5-grams, so unseen
forms of a seen stem are near it. Two gated recurrent layers read the window in both directions, and
the states are pooled by a learned attention.

Labels are of documents, not of windows, so training is in two parts: first each window has its
document's label (windows of clean documents are surely clean), then, of a toxic document, only the
windows that the network itself finds toxic, its worst at least. A round goes over the windows as
often as it takes to see 25,000 of them, at most 8 times. A sixth of the documents, one of each class at
least, are not trained on and place the decision at 0.5.

Fitting uses a bounded sample of whole documents: at most `rows` labelled ones of each class, in order
of hash, of which those are left out that would take the class above `most` windows. All windows of a
sampled document are learned from and count for the decision, as all windows of all documents are
scored, one Arrow batch at a time.

Defined results: null texts, empty ones and those without a word have the score of an empty window, held
below 0.5. Several labels of
one document count as toxic if any is. Without labels of both classes every score is 0. Repeated rows
are scored each. Only the id, the text and the labels are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import configured, materialise, passing, ship

WORDS = re.compile(r"\w+")
SPAN, STRIDE = 32, 24
EDGE = (2, 3)  # bytes that mark a word's ends; no text has them inside a word
PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def starts_of(n: int) -> range:
    """First words of the windows that cover `n` words; one window for none."""
    return range(0, max(1, n - (SPAN - STRIDE)), STRIDE)


def pieces(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbours that together have about `most`, or of one that has more."""
    at = np.cumsum(sizes, dtype=np.int64) // most
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
    return (slice(a, b) for a, b in zip(cuts, cuts[1:]))


class Features:
    """Hashed inputs of distinct words: one word row each, and their character n-gram rows as runs.

    Rows are held in the smallest type that has them, and hashed from about `PIECE` bytes of words at a time.
    """

    PIECE = 1 << 18

    def __init__(self, words: list[str], word_rows: int, gram_rows: int):
        self.sizes = (word_rows, gram_rows)
        self.word, self.grams = (np.empty(0, np.min_scalar_type(n - 1)) for n in self.sizes)
        self.count = np.empty(0, np.int32)
        self.add(words)

    def add(self, words: list[str]) -> None:
        """`words` get the next numbers."""
        parts = [self.hashed(words[some]) for some in pieces(np.fromiter(map(len, words), np.int64, len(words)), self.PIECE)]
        for name, new in zip(("word", "grams", "count"), zip(*parts)):
            own = getattr(self, name)
            setattr(self, name, np.concatenate([own, *new], dtype=own.dtype, casting="same_kind"))
        self.first = np.cumsum(self.count, dtype=np.int64) - self.count

    def hashed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word row, n-gram rows end to end, number of n-grams) of `words`."""
        word_rows, gram_rows = self.sizes
        marked = [bytes([EDGE[0]]) + w.encode() + bytes([EDGE[1]]) for w in words]
        size = np.array([len(m) for m in marked], dtype=np.int64)
        text = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        first = np.cumsum(size) - size
        of = np.repeat(np.arange(len(words)), size)
        at = np.arange(len(text)) - first[of]
        left = size[of] - at
        power = np.cumprod(np.full(int(size.max(initial=1)), 1099511628211, dtype=np.uint64))
        word = mixed(np.add.reduceat(text * power[at], first), word_rows)
        padded = np.append(text, np.zeros(4, np.uint64))
        rows, owner = [], []
        for n in (3, 4, 5):
            code = np.full(len(text), n, dtype=np.uint64)
            for k in range(n):
                code = code * np.uint64(257) + padded[k : k + len(text)]
            whole = left >= n
            rows.append(mixed(code[whole], gram_rows))
            owner.append(of[whole])
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        grams = np.concatenate(rows)[order]
        return word.astype(self.word.dtype), grams.astype(self.grams.dtype), np.bincount(owner, minlength=len(words)).astype(np.int32)

    def runs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram rows of the words `ids`, which of `ids` each belongs to)."""
        count = self.count[ids]
        owner = np.repeat(np.arange(len(ids)), count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        return self.grams[self.first[ids][owner] + within], owner


def mixed(code: np.ndarray, rows: int) -> np.ndarray:
    code = (code ^ (code >> np.uint64(29))) * PRIME
    return ((code >> np.uint64(33)) % np.uint64(rows)).astype(np.int64)


def summed(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of `values` rows by their (sorted) owner."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first]] = np.add.reduceat(values, first, axis=0)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Embeddings, a forward and a backward gated recurrent layer, attention, a logistic output.

    Embeddings take plain gradient steps, scaled by one running size a table: with a size of its own
    each rare word would learn as fast as a common one, which is to learn the sample by heart.
    """

    scale, embedding_rate = 0.1, 0.5

    def __init__(self, dim: int = 16, hidden: int = 12, attention: int = 8, word_rows: int = 1 << 16, gram_rows: int = 1 << 15, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden, self.shift = hidden, 0.0
        self.sizes = (word_rows, gram_rows)
        self.p = {"word": draw(word_rows, dim) * 0, "gram": (rng.standard_normal((gram_rows, dim)) * self.scale).astype(np.float32)}
        for d in "fb":
            self.p |= {f"{d}x": draw(dim, 3 * hidden), f"{d}u": draw(hidden, 3 * hidden), f"{d}c": np.zeros(3 * hidden, np.float32)}
        self.p |= {"a": draw(2 * hidden, attention), "av": draw(attention, 1), "o": draw(2 * hidden, 1), "oc": np.zeros(1, np.float32)}
        self.g2 = {k: np.full(v.shape, 1e-6, np.float32) for k, v in self.p.items() if k not in ("word", "gram")} | {"word": 0.0, "gram": 0.0}

    def inputs(self, features: Features, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        """A vector for each word of `ids`."""
        grams, owner = features.runs(ids)
        count = np.maximum(features.count[ids], 1).astype(np.float32)[:, None]
        return self.p["word"][features.word[ids]] + summed(self.p["gram"][grams], owner, len(ids)) / count, (grams, owner, count)

    def layer(self, d: str, x: np.ndarray, keep: list | None) -> np.ndarray:
        """States (steps, windows, hidden) of inputs x (steps, windows, 3 hidden); `keep` gets what the way back needs."""
        k, u = self.hidden, self.p[f"{d}u"]
        h = np.zeros((x.shape[1], k), x.dtype)
        out = np.empty((*x.shape[:2], k), x.dtype)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            m = h @ u
            zr = sigmoid(x[t, :, : 2 * k] + m[:, : 2 * k])
            z, r, v = zr[:, :k], zr[:, k:], m[:, 2 * k :]
            n = np.tanh(x[t, :, 2 * k :] + r * v)
            if keep is not None:
                keep.append((t, h, z, r, v, n))
            h = n + z * (h - n)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, real: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logits of windows; x (steps, windows, dim) of words, `real` (steps, windows) False where padded."""
        gates = {d: x @ self.p[f"{d}x"] + self.p[f"{d}c"] for d in "fb"}
        return self.from_gates(gates["f"], gates["b"], real, tape)

    def from_gates(self, f: np.ndarray, b: np.ndarray, real: np.ndarray, tape: dict | None = None) -> np.ndarray:
        keep = {d: [] if tape is not None else None for d in "fb"}
        states = np.concatenate([self.layer("f", f, keep["f"]), self.layer("b", b, keep["b"])], axis=2)
        looked = np.tanh(states @ self.p["a"])
        e = np.where(real, (looked @ self.p["av"])[:, :, 0], -1e9)
        weight = np.exp(e - e.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        if tape is not None:
            tape |= {"keep": keep, "states": states, "looked": looked, "weight": weight, "pooled": pooled}
        return (pooled @ self.p["o"])[:, 0] + self.p["oc"][0]

    def step(self, features: Features, ids: np.ndarray, real: np.ndarray, label: np.ndarray, importance: np.ndarray, rate: float) -> None:
        """One Adagrad step on windows of words `ids` (windows, steps)."""
        distinct, where = np.unique(ids, return_inverse=True)
        where = where.reshape(ids.shape).T
        vectors, (grams, owner, count) = self.inputs(features, distinct)
        x, mask, k, tape = vectors[where] * real.T[:, :, None], real.T, self.hidden, {}
        logit = self.forward(x, mask, tape)
        dl = ((sigmoid(logit) - label) * importance / importance.sum()).astype(np.float32)
        states, weight = tape["states"], tape["weight"]
        g = {"o": tape["pooled"].T @ dl[:, None], "oc": dl.sum(keepdims=True)}
        dpool = dl[:, None] * self.p["o"][:, 0]
        dstates = weight[:, :, None] * dpool
        dw = (states * dpool).sum(axis=2)
        de = weight * (dw - (weight * dw).sum(axis=0))
        dlook = de[:, :, None] * self.p["av"][:, 0] * (1 - tape["looked"] ** 2)
        g["av"] = np.einsum("tba,tb->a", tape["looked"], de)[:, None]
        g["a"] = np.einsum("tbs,tba->sa", states, dlook)
        dstates = dstates + dlook @ self.p["a"].T
        dx = np.zeros_like(x)
        for i, d in enumerate("fb"):
            dgates, du = np.empty((*x.shape[:2], 3 * k), np.float32), np.zeros_like(self.p[f"{d}u"])
            carry = np.zeros((x.shape[1], k), np.float32)
            for t, before, z, r, v, n in reversed(tape["keep"][d]):
                dh = dstates[t, :, i * k : (i + 1) * k] + carry
                dz, dn = dh * (before - n) * z * (1 - z), dh * (1 - z) * (1 - n**2)
                dr, dv = dn * v * r * (1 - r), dn * r
                dm = np.concatenate([dz, dr, dv], axis=1)
                du += before.T @ dm
                carry = dh * z + dm @ self.p[f"{d}u"].T
                dgates[t] = np.concatenate([dz, dr, dn], axis=1)
            flat = dgates.reshape(-1, 3 * k)
            g |= {f"{d}u": du, f"{d}c": flat.sum(axis=0), f"{d}x": x.reshape(-1, x.shape[2]).T @ flat}
            dx += dgates @ self.p[f"{d}x"].T
        dx *= mask[:, :, None]
        order = np.argsort(where.ravel(), kind="stable")
        dvec = summed(dx.reshape(-1, x.shape[2])[order], where.ravel()[order], len(distinct))
        for name, grad in g.items():
            self.g2[name] += grad**2
            self.p[name] -= rate * grad / np.sqrt(self.g2[name])
        for name, rows, grad in (("word", features.word[distinct], dvec), ("gram", grams, (dvec / count)[owner])):
            order = np.argsort(rows, kind="stable")
            touched, place = np.unique(rows[order], return_inverse=True)
            grad = summed(grad[order], place, len(touched))
            size = float((grad**2).mean())
            self.g2[name] = 0.99 * self.g2[name] + 0.01 * size if self.g2[name] else size
            self.p[name][touched] -= self.embedding_rate * rate * grad / np.sqrt(self.g2[name] + 1e-20)


def windows_of(word_ids: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of documents that lie end to end: (ids (windows, SPAN), real, document of each window)."""
    first, n = limits[:-1], np.diff(limits)
    many = np.array([len(starts_of(int(x))) for x in n], dtype=np.int64)
    doc = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    at = (nth * STRIDE)[:, None] + np.arange(SPAN)
    real = at < n[doc][:, None]
    padded = np.append(word_ids, 0)
    return padded[np.where(real, first[doc][:, None] + at, len(word_ids))], real, doc


def window_logits(net: Network, features: Features, ids: np.ndarray, real: np.ndarray, step: int = 2048, group: int = 16_384) -> np.ndarray:
    """Logits of windows. What the gates get from a word is computed once for each distinct word of a group of windows."""
    out = []
    for i in range(0, len(ids), group):
        spans, full = ids[i : i + group], real[i : i + group]
        used = np.zeros(len(features.word), bool)
        used[spans[full]] = True
        place, own = np.cumsum(used, dtype=np.int32) - 1, np.flatnonzero(used)
        vectors = np.zeros((len(own) + 1, net.p["word"].shape[1]), np.float32)  # the last one is of no word
        for some in pieces(features.count[own], 1 << 17):
            vectors[some] = net.inputs(features, own[some])[0]
        table = {d: vectors @ net.p[f"{d}x"] + net.p[f"{d}c"] for d in "fb"}
        for k in range(0, len(spans), step):
            mask = full[k : k + step]
            some = np.full(mask.shape, len(own), np.int32)
            some[mask] = place[spans[k : k + step][mask]]
            mask = mask.T | ~mask.any(axis=1)
            out.append(net.from_gates(table["f"][some.T], table["b"][some.T], mask))
    return np.concatenate(out) if out else np.empty(0, np.float32)


def factorised(texts: Iterable[list[str]], net: Network, most: int = 1 << 18) -> tuple[Features, np.ndarray, np.ndarray]:
    """(features of the words, word ids end to end, limits of the texts).

    Of the words only the distinct ones are held, as text at most about `most`: then they are forgotten, and one
    that comes again gets a second id with the same features.
    """
    known: dict[str, int] = {}
    features, ids, limits, before = Features([], *net.sizes), array("i"), [0], 0
    for words in texts:
        ids.extend([known.setdefault(w, before + len(known)) for w in words])
        limits.append(len(ids))
        if len(known) >= most:
            features.add(list(known))
            before += len(known)
            known.clear()
    features.add(list(known))
    return features, np.array(ids, dtype=np.int32), np.array(limits)


def document_logits(net: Network, texts: list[str | None], most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """(the worst window of each text, which texts have no word), batched by number of words."""
    out, none, held, size = [], [], [], 0

    def flush() -> None:
        features, ids, limits = factorised(held, net)
        spans, real, doc = windows_of(ids, limits)
        worst = np.full(len(held), -np.inf)
        np.maximum.at(worst, doc, window_logits(net, features, spans, real))
        out.append(worst)
        none.append(np.diff(limits) == 0)
        held.clear()

    for text in texts:
        held.append(words_of(text))
        size += len(held[-1])
        if size >= most:
            flush()
            size = 0
    if held:
        flush()
    return (np.concatenate(out), np.concatenate(none)) if out else (np.empty(0), np.empty(0, bool))


def train(sample: pd.DataFrame, odds: float = 1.0, seed: int = 11, batch: int = 256, rounds: int = 2, worst_rounds: int = 3,
          rate: float = 0.08) -> Network | None:
    """Fit on (doc_id, toxic, window: words with blanks between) rows; None unless both classes occur.

    `odds`: how many clean documents there are for a toxic one in what the sample is drawn from.
    """
    if sample["toxic"].nunique() < 2:
        return None
    rng = np.random.default_rng(seed)
    net = Network()
    features, words, limits = factorised((w.split() for w in sample["window"]), net)
    label = sample["toxic"].to_numpy(np.float32)
    doc, _ = pd.factorize(sample["doc_id"])
    del sample  # its texts are the larger part of what the driver holds
    real = np.arange(SPAN) < np.diff(limits)[:, None]
    ids = np.zeros(real.shape, words.dtype)
    ids[real] = words
    real[:, 0] |= ~real.any(axis=1)
    of_doc = pd.Series(label).groupby(doc).first().to_numpy()
    held = rng.permutation(len(of_doc)) % 6 == 0
    for c in (0, 1):
        if not held[of_doc == c].any():
            held[np.flatnonzero(of_doc == c)[0]] = True
    held = held[doc]

    def epoch(rows: np.ndarray, speed: float) -> None:
        rows = rng.permutation(rows)
        share = max(1.0, (label[rows] == 0).sum() / max(1, (label[rows] == 1).sum()))
        for i in range(0, len(rows), batch):
            r = rows[i : i + batch]
            net.step(features, ids[r], real[r], label[r], np.where(label[r] == 1, share**0.5, 1.0).astype(np.float32), speed)

    fit = np.flatnonzero(~held)
    repeats = max(1, min(8, 25_000 // max(1, len(fit))))
    for _ in range(rounds * repeats):
        epoch(fit, rate)
    for _ in range(worst_rounds * repeats):
        logit = window_logits(net, features, ids, real)
        worst = pd.Series(logit).groupby(doc).transform("max").to_numpy()
        epoch(fit[(label[fit] == 0) | (logit[fit] == worst[fit]) | (logit[fit] > 1)], rate / 2)
    apart = pd.DataFrame({"doc": doc, "logit": window_logits(net, features, ids, real), "toxic": label})[held].groupby("doc").max()
    net.shift = cutoff(apart, odds)
    return net


def cutoff(docs: pd.DataFrame, odds: float) -> float:
    """The middle of the cuts that give the fewest errors where there are `odds` clean documents for a toxic one."""
    cuts = np.sort(docs["logit"].to_numpy())
    cuts = np.r_[cuts[0] - 1, (cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 1]
    toxic, clean = (np.sort(docs["logit"][docs["toxic"] == c]) for c in (1, 0))
    wrong = np.searchsorted(toxic, cuts) / len(toxic) + odds * (1 - np.searchsorted(clean, cuts) / len(clean))
    return float(np.median(cuts[wrong <= wrong.min() + 1e-9]))


def fitting(sizes: pd.DataFrame, most: int) -> list[int]:
    """Documents (doc_id, toxic, windows, in order of hash) of each class that together have at most `most` windows."""
    out = []
    for _, docs in sizes.groupby("toxic"):
        left = most
        for ident, windows in zip(docs["doc_id"], docs["windows"]):
            if windows <= left:
                out.append(int(ident))
                left -= windows
    return out


def sample_windows(docs: DataFrame, labels: DataFrame, rows: int, most: int, id_col: str, text_col: str) -> tuple[pd.DataFrame, float]:
    """(sample, odds). Whole documents: at most `rows` of each class, with at most `most` windows together."""
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    number = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    picked = [marks.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    wanted = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).join(wanted, "doc_id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ident, text, toxic in batch.itertuples(index=False, name=None):
                words = words_of(text)
                spans = [" ".join(words[s : s + SPAN]) for s in starts_of(len(words))]
                for i in range(0, len(spans), 10_000):
                    yield pd.DataFrame({"doc_id": ident, "toxic": toxic, "window": spans[i : i + 10_000]})

    with passing(docs.sparkSession):
        found = materialise(texts.mapInPandas(cut, "doc_id bigint, toxic int, window string"), "toxicity-windows")
        sizes = found.groupBy("doc_id", "toxic").agg(F.count("*").alias("windows")).orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
        chosen = fitting(sizes, most)
        if len(chosen) < len(sizes):
            found = found.where(F.col("doc_id").isin(chosen))
        with configured(docs.sparkSession, "spark.sql.execution.arrow.pyspark.enabled", "true"):
            found = found.toPandas()
    return found.sort_values(["doc_id", "window"], kind="stable", ignore_index=True), number.get(0, 0) / max(1, number.get(1, 0))


def score(docs: DataFrame, labels: DataFrame, rows: int = 1200, most: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row of `docs`; `labels` (doc_id, toxic) are what may be learned from."""
    spark = docs.sparkSession
    ship(spark)
    net = train(*sample_windows(docs, labels, rows, most, id_col, text_col))
    if net is not None:
        net.g2 = {}  # what only training needs stays here
    sent = spark.sparkContext.broadcast(net)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            if model is None:
                batch["score"] = 0.0
            else:
                logit, wordless = document_logits(model, batch["text"].tolist())
                chance = sigmoid(logit - model.shift)
                batch["score"] = np.where(wordless, np.minimum(chance, 0.49), chance).astype(np.float64)
            yield batch[["doc_id", "score"]]

    source = docs.select(F.col(id_col).cast("decimal(20,0)").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(judge, "doc_id decimal(20,0), score double").withColumn("doc_id", F.col("doc_id").cast("bigint"))
