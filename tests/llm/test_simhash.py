"""SimHash groups against library hashes and all pairs."""

import itertools
import random

import numpy as np
import xxhash
from cases import SF, ordered, table, texts
from pyspark.sql import functions as F

from textweir.llm import queries, simhash
from textweir.llm.common import hex_print
from textweir.llm.graph import components
from textweir.llm.hashing import xxh64


def plain_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def roots(rows, radius=3):
    prints = [plain_print(t) for _, t in rows]
    near = (
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if (prints[a] ^ prints[b]).bit_count() <= radius
    )
    return prints, smallest(near, range(len(rows)))


def groups(rows, radius=3):
    prints, root = roots(rows, radius)
    ids = {}
    for n, (i, _) in enumerate(rows):
        ids.setdefault(root[n], []).append(i)
    name = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return ordered((i, f"{prints[n]:016x}", name[root[n]]) for n, (i, _) in enumerate(rows))


def result(df, **options):
    found = simhash.near_groups(df, **options)
    found = found.select("doc_id", hex_print(F.col("fingerprint")), "component_id")
    return ordered(tuple(r) for r in found.collect())


def test_hashes_equal_the_library():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(4000))
    starts = np.array([rng.randrange(3900) for _ in range(500)])
    sizes = np.array([rng.randrange(0, 90) for _ in range(500)])
    want = [xxhash.xxh64_intdigest(data[a : a + n], 42) for a, n in zip(starts, sizes, strict=True)]
    assert xxh64(data, starts, sizes, 42).tolist() == want
    assert xxh64(data, starts[:3], sizes[:3], 42).tolist() == want[:3]


def test_edge_cases(spark):
    assert result(table(spark)) == groups(texts())


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == groups(rows)
    got = queries.QUERIES["op5_simhash_dedup"](spark, SF).collect()
    assert ordered(tuple(r) for r in got) == groups(rows)


def test_links_in_small_tiles(spark):
    """Dense fingerprints, cells split into many tiles: the components of all pairs."""
    rng = random.Random(4)
    centre = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1)
              for c in centre for _ in range(60)}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.links(df, 3, tile=5)).collect()}
    near = (
        (a, b) for a, b in itertools.combinations(signed, 2)
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    )
    want = smallest(near, signed)
    assert {n: got.get(n, n) for n in signed} == want


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "u long, v long")
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = smallest(real, {n for e in real for n in e})
    assert {r.node: r.root for r in components(df).collect()} == want
    assert components(df.where("false")).count() == 0


def test_keep_one(spark):
    rows = texts()
    kept = simhash.keep_one(table(spark))
    assert kept.columns == table(spark).columns
    _, root = roots(rows)
    first = {}
    for n, (i, _) in enumerate(rows):
        first[root[n]] = min(first.get(root[n], (True, None)), (i is None, i), key=lambda x: (x[0], x[1] or 0))
    assert ordered((r.doc_id,) for r in kept.collect()) == ordered((i,) for _, i in first.values())


def test_empty_table(spark):
    none = table(spark, [])
    assert result(none) == [] and simhash.keep_one(none).count() == 0
