"""Tokens equal to the tokenizer's, whole documents, gapless sequences, as few as best fit gives."""

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest

from boxloom.llm import packing

TEXTS = ["Hello world", "", None, "Ça va? 你好 😀 " * 30, "x" * 9000, "a b\n\tc  d" * 400, "12345 " * 2000, "Hello world", "it's 'quoted' <|endoftext|> text\r\n", "<|endoftext|><|endoftext|>", "a<|endoftext|>b <|endoftext| > <|ENDOFTEXT|>", " lead", "trail "]


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*own.encode(text or "", add_special_tokens=False).ids, 0]


def test_pack(spark):
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "repeat")], "doc_id long, text string, length string")
    rows = packing.pack(docs, size=256).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(TEXTS):
        ids = reference_ids(text)
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in pieces[i]})
        assert [p for p, *_ in own] == list(range(len(own))) and sum(n for _, _, n, _ in own) == len(ids)
        assert all(n == 256 for _, _, n, _ in own[1:])
        for _, start, n, crc in own:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
    assert len(pieces[0]) == 2
    gapless(rows, 256)


def gapless(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size


def test_empty_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema)).count() == 0
    rows = packing.pack(spark.createDataFrame([(None, "a"), (2**60 + 1, None)], schema)).collect()
    assert {r.doc_id for r in rows} == {None, 2**60 + 1} and len({r.sequence_id for r in rows}) == 1


def best_fit_decreasing(lengths, size):
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect_left(gaps, n)
        if i == len(gaps):
            bins, left = bins + 1, size - n
        else:
            left = gaps.pop(i) - n
        insort(gaps, left)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_as_few_as_best_fit(seed):
    rng = random.Random(seed)
    lengths = [min(2048, max(1, int(rng.lognormvariate(5.5, 1.2)))) for _ in range(4000)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    places = packing.plan(counts)
    used, ranks = {}, {}
    for length, rank, n, first, offset in places.tolist():
        for i in range(n):
            used.setdefault(first + i, []).append((offset, length))
            ranks.setdefault(length, set()).add(rank + i)
    assert {k: len(v) for k, v in ranks.items()} == counts
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) <= 1.005 * best_fit_decreasing(lengths, 2048) + 1


def test_plan_does_not_grow_with_documents():
    small = packing.plan({n: 30_000 for n in range(1, 600)})
    large = packing.plan({n: 3_000_000 for n in range(1, 600)})
    assert len(large) < 1.5 * len(small)
