"""Filter audit against a walk through all orders, and against SQL."""

import itertools
import re

import pytest
from cases import texts
from compare import connect, difference
from pyspark.sql import functions as F

from textweir.llm import audit, queries

LABELS = "doc_id long, quality int, toxic int, part string"


def failed(rows):
    """``(part, failed letters)`` of ``(doc_id, text, source)`` rows."""
    out = []
    for i, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        if len(words) < 50:
            bad.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            bad.add("E")
        out.append((s or "", bad))
    return out


def brute(rows, good, toxic):
    marks = [(p, bad, r[0] in good, r[0] in toxic) for (p, bad), r in zip(failed(rows), rows, strict=True)]
    out = {}
    for part in {m[0] for m in marks}:
        mine = [m for m in marks if m[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order):
                here = [m for m in left if c in m[1]]
                gone = [m for m in mine if c in m[1] and m not in left]
                redundant = sum(c in m[1] for m in mine) - len(here)
                assert not gone or redundant
                left = [m for m in left if c not in m[1]]
                shapley[c] += len(here)
                out[part, "".join(order), step + 1] = [
                    len(left), len(here), redundant, sum(m[1] == {c} for m in mine),
                    sum(m[2] for m in here), sum(m[3] for m in here),
                ]
        for order in itertools.permutations("ABCDE"):
            for step, c in enumerate(order):
                out[part, "".join(order), step + 1].append(shapley[c])
    return out


def result(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in rows}
    assert len(out) == len(rows)
    return out


def source(spark, rows):
    """Documents with clashing columns; a source for each row."""
    plain = [(i, t, s, 1, 2, "x", True, "y") for i, t, s in rows]
    return spark.createDataFrame(
        plain, "doc_id long, text string, source string, h long, block long, part string, maybe boolean, bits string"
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_edge_cases(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(audit, "broadcast_if_bounded", lambda df, *_: df)
    rows = [(i, t, ["s1", "s2", None, ""][n % 4]) for n, (i, t) in enumerate(texts())]
    rows += [(100 + n, "Copied TEXT & more " * 20, ["s1", "s3"][n % 2]) for n in range(40)]
    rows += [(100, "Copied TEXT & more " * 20, "s2"), (None, "Copied TEXT & more " * 20, "s2"), (7, None, "s9")]
    good, toxic = {1, 3, 7, 100, 101, 120}, {2, 3, 120, 139}
    marks = [(i, int(i in good), int(i in toxic), "p") for i in [*range(1, 17), *range(100, 140), 500]]
    marks += [(101, 1, 0, "p"), (101, None, None, "p"), (None, 1, 1, "p")]
    labels = spark.createDataFrame(marks, LABELS)
    got = result(audit.interactions(audit.failures(source(spark, rows), labels)))
    assert got == brute(rows, good, toxic)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit.interactions(audit.failures(source(spark, []), none)).count() == 0
    one = result(audit.interactions(audit.failures(source(spark, [(1, None, None)]), none)))
    assert one == brute([(1, None, None)], set(), set())


def test_sketch_clears_unique_texts_only(spark):
    """No text that repeats is cleared, and few others are kept."""
    n, blocks = 20_000, 79
    docs = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 500).otherwise(F.col("id") + n).cast("string").alias("t")
    )
    docs = docs.select("t", F.pmod(F.xxhash64("t"), F.lit(blocks)).alias("block"), F.xxhash64(F.lit(1), "t").alias("g"))
    sketch = audit.repeat_sketch(docs.repartition(7))
    rows = docs.join(sketch, "block", "left").select("t", audit._maybe_repeated(F.col("bits"), F.col("g")).alias("m"))
    kept = rows.where("m").groupBy("t").count().collect()
    repeated = {r.t for r in kept if r["count"] > 1}
    assert repeated == {str(i) for i in range(0, 500, 10)}
    assert len(kept) - len(repeated) < 0.02 * n


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    df = queries.QUERIES["op11_filter_audit"](spark, sf)
    assert difference(df, connect(sf), queries.ORACLES["op11_filter_audit"]) is None
    assert df.count() % 600 == 0
