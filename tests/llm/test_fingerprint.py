"""Weighted SimHash, edited texts and block tables against plain restatements."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from cases import ordered, table, texts
from pyspark.sql import functions as F

from textweir.llm import fingerprint, queries


def plain_print(text):
    words = text.lower().encode().split()
    votes, total = [0] * 64, 0
    pairs = [(a, b) for a, b in zip(words, words[1:], strict=False)]
    ends = [(words[-1], None)] if words else []
    for a, b in pairs + ends:
        h = xxhash.xxh64_intdigest(a, 42)
        letters = len(a.decode())
        if b is not None:
            h, letters = xxhash.xxh64_intdigest(b, h), letters + len(b.decode())
        w = min(letters, 15)
        total += w
        for i in range(64):
            votes[i] += w * (h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * votes[i] > total)


def signed(x):
    return int(np.uint64(x).view(np.int64))


def unique_rows():
    return list({i: (i, t) for i, t in texts() if i is not None}.values())


@pytest.mark.parametrize("slice_rows", [2_000, 3])
def test_edits_and_prints(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(fingerprint, "SLICE", slice_rows)
    rows = unique_rows()
    got = {r.doc_id: r for r in fingerprint.compare_next(table(spark, rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(order):
        text, after = t or "", order[(n + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fp == signed(plain_print(text))
        assert got[i].edited_fp == signed(plain_print(edited))
        assert got[i].next_fp == signed(plain_print(after))


def test_nulls_ties_and_repeats(spark, monkeypatch):
    """Every row has a result; rows of equal text have equal fingerprints."""
    monkeypatch.setattr(fingerprint, "SLICE", 3)
    rows = fingerprint.compare_next(table(spark)).collect()
    assert ordered((r.doc_id,) for r in rows) == ordered((i,) for i, _ in texts())
    assert sorted(r.fp for r in rows) == sorted(signed(plain_print(t or "")) for _, t in texts())


def test_likeness(spark):
    df = spark.createDataFrame([(0, 0), (0, -1), (0, 1 << 40)], "a long, b long")
    got = [r[0] for r in df.select(fingerprint.likeness(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1.0, 0.0, math.cos(math.pi / 64)])


@pytest.mark.parametrize(("radius", "blocks"), [(3, 4), (3, 6), (1, 2)])
def test_search_finds_all(spark, radius, blocks):
    rng = random.Random(radius * blocks)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(6))) for b in base for _ in range(20)]
    df = spark.createDataFrame([(signed(p),) for p in prints] + [(None,)], "fp long")
    asked = spark.createDataFrame([(signed(p),) for p in prints[::7]] + [(None,)], "fp long")
    got = {(r.query, r.fp) for r in fingerprint.search(df, asked, radius, blocks).collect()}
    want = {
        (signed(q), signed(p)) for q in prints[::7] for p in prints if (q ^ p).bit_count() <= radius
    }
    assert got == want


def test_empty_table_and_query(spark):
    assert fingerprint.compare_next(table(spark, [])).count() == 0
    rows = queries.QUERIES["op4_fingerprints"](spark, "/root/testdata/sf0.001").toPandas()
    assert len(rows) == 200
    assert rows.near_edited.mean() > 0.5 > 0.3 > rows.near_next.mean()
    assert rows.n_near.notna().sum() == 2
