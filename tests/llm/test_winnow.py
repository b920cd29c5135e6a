"""Benchmark windows against a plain scan."""

import re

import pytest
from cases import SF, ordered, table, texts
from pyspark.sql import functions as F

from textweir import session
from textweir.llm import queries, winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(n, {}).setdefault(tuple(w[a : a + n]), set()).add(name)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n, known in windows.items():
            for a in range(len(w) - n + 1):
                if names := known.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= names
        found.discard(None)
        out.append((i, len(w), len(hit), ",".join(sorted(map(str, found))), bool(hit)))
    return ordered(out)


def result(docs, items):
    found = winnow.report(docs, items)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    found = found.select("doc_id", "n_words", "n_hit", names, "contaminated")
    return ordered(tuple(r) for r in found.collect())


def items_of(rows):
    some = dict(rows)
    long = words(some[11])
    return [
        (1, " ".join(long[50:75])), (2, "X-Y " * 8), (3, None), (4, ""), (5, "ONE two"), (6, "one"),
        (7, " ".join(long[2000:2010])), (7, " ".join(long[2600:2609])), (None, "a a a a a a a a a a a"),
        (8, "never seen words " * 5),
    ]


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 0, "") for i, t in rows], "item_id long, text string, h int, words string")


@pytest.mark.parametrize("bytes_limit", [None, 0])
def test_edge_cases(spark, monkeypatch, bytes_limit):
    """Also without the broadcast."""
    if bytes_limit is not None:
        monkeypatch.setattr(session, "BROADCAST_BYTES", bytes_limit)
    rows = texts()
    items = items_of(rows)
    assert result(table(spark), bench(spark, items)) == plain(rows, items)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert result(docs, items) == want
    got = queries.QUERIES["op7_decontamination"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in got) == sorted(w[:3] for w in want)


def test_clean_keeps_rows_and_columns(spark):
    rows = texts()
    items = items_of(rows)
    kept = winnow.clean(table(spark), bench(spark, items))
    want = [(i, t) for i, t in rows if not plain([(i, t)], items)[0][4]]
    assert kept.columns == table(spark).columns
    assert ordered((r.doc_id, r.text) for r in kept.collect()) == ordered(want)


def test_empty_tables(spark):
    rows = texts()
    none = bench(spark, [])
    assert result(table(spark), none) == plain(rows, [])
    assert result(table(spark, []), bench(spark, items_of(rows))) == []
    assert winnow.clean(table(spark), none).count() == len(rows)
