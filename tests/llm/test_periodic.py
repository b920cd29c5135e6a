"""Periodic runs against a search of all periods and starts."""

import hashlib
import itertools
import random
import zlib

import pytest
from cases import SF, ordered, table, texts
from pyspark.sql import functions as F

from textweir.llm import periodic, queries


def brute(words):
    """All runs by their definition: maximal stretches of a period that has no smaller one."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(6, 4 * q):
                some = words[at : at + length]
                if not any(some[d:] == some[:-d] for d in range(1, q)):
                    found.add((at, length, q))
            at = end + 1
    gone = {i for s, n_, q in found for i in range(s + q, s + n_)}
    return sorted(found, key=lambda r: (r[0], r[2])), [w for i, w in enumerate(words) if i not in gone]


def rhythmic(rng):
    """Words with nested, adjacent and overlapping repeats of few different words."""
    words = []
    for _ in range(rng.randint(1, 6)):
        unit = rng.choices("abc", k=rng.randint(1, 9))
        if rng.random() < 0.4:
            unit = unit * rng.randint(1, 5) + rng.choices("ab", k=rng.randint(0, 2))
        words += unit * rng.randint(1, 8) + unit[: rng.randint(0, len(unit))]
        words += rng.choices("abcd", k=rng.randint(0, 4))
    return words


def check(spark, bodies):
    rows = table(spark, list(enumerate(bodies)))
    got = {r.doc_id: r for r in periodic.collapse(rows).collect()}
    assert len(got) == len(bodies)
    for n, body in enumerate(bodies):
        words = (body or "").encode().split()
        runs, kept = brute(words)
        assert got[n].n_words == len(words)
        assert [tuple(r) for r in got[n].runs] == runs, body
        assert got[n].collapsed == b" ".join(kept).decode()


def test_random_rhythms(spark):
    rng = random.Random(4)
    bodies = [" ".join(rhythmic(rng)) for _ in range(600)]
    check(spark, bodies)
    assert sum(len(brute(b.split())[0]) > 1 for b in bodies) > 100


def test_all_short_texts(spark):
    check(spark, [" ".join(w) for n in range(5, 12) for w in itertools.product("ab", repeat=n)])


def test_periods_at_the_borders_of_ranges(spark):
    bodies = []
    for q in (1, 2, 3, 4, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64):
        unit = [f"w{i}" for i in range(q)]
        for length in (max(6, 4 * q) - 1, max(6, 4 * q), 5 * q + 1):
            body = (unit * 7)[:length]
            bodies += [" ".join(body), " ".join(["x", *body, "y"]), " ".join([*body, *body[::-1], *body])]
    check(spark, bodies)


def test_texts_in_one_step_do_not_touch(spark):
    check(spark, ["a a a", "a a a a", "", "a a", None, "a a a a a a"] * 20)


def test_edge_cases(spark):
    rows = [t for _, t in texts()]
    check(spark, [*rows, "word " * 20_000, " ".join(f"{i % 700}" for i in range(9_000)), "é x " * 9])
    assert periodic.collapse(table(spark, [])).count() == 0
    base = table(spark).withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("x"))
    out = periodic.collapse(base)
    assert out.columns == [*table(spark).columns, "n_words", "runs", "collapsed"]
    assert out.count() == len(texts())


def bent(doc_id, text):
    """The words of the query's texts, from its contract."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text).hexdigest()


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        runs, kept = fast(bent(r.doc_id, r.text))
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        milli = top[1] and 1000 * top[1] // top[2]
        want.append((r.doc_id, len(runs), *top, milli, sha(lines.encode()), sha(b" ".join(kept))))
    got = queries.QUERIES["op12_periodic_runs"](spark, sf).collect()
    assert ordered(tuple(r) for r in got) == ordered(want)
    assert sum(w[1] > 0 for w in want) > len(want) // 20


def fast(words):
    """``brute``, with stretches found by numbers and smaller periods seen in the found runs."""
    import numpy as np

    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a = np.array([number[w] for w in words])
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s + q >= max(6, 4 * q):
                some = a[s : e + q]
                if not any((some[d:] == some[:-d]).all() for d in range(1, q)):
                    found.append((s, e - s + q, q))
    gone = {i for s, n_, q in found for i in range(s + q, s + n_)}
    return sorted(found, key=lambda r: (r[0], r[2])), [w for i, w in enumerate(words) if i not in gone]
