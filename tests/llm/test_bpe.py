"""Tokens and texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import SF, table, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textweir.llm import bpe, queries

PATH = queries.VOCABULARY
ALPHABET = "ab \n\t'strelld<|endoftext|>éß漢字🙂‍\x1c\x85\xa0　 1２٣_-\r\0"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def samples():
    rng = random.Random(9)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(90))) for _ in range(800)]
    return made + ["", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "a" * 3000, "ab" * 700,
                   " " * 500, "🙂" * 90, "we'll they're I'd", *(t or "" for _, t in texts())]


def split(values, counts):
    ends = np.cumsum(counts)
    return [values[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]


@pytest.mark.parametrize("cache", [None, 40])
def test_encode_and_decode(vocabulary, library, monkeypatch, cache):
    if cache:
        monkeypatch.setattr(bpe, "CACHE", cache)
        monkeypatch.setattr(bpe, "CHUNK", 300)
    some = samples()
    ids, counts = vocabulary.encode(some)
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert split(ids, counts) == want
    assert vocabulary.decode(ids, counts) == [library.decode(w, skip_special_tokens=False) for w in want]


def test_both_trees_agree(vocabulary):
    rng = random.Random(1)
    pieces = [bytes(rng.choice(b"aeinorst th") for _ in range(rng.randrange(1, 33))) for _ in range(400)]
    ids, counts = vocabulary.merge_many(pieces, 32)
    assert split(ids, counts) == [vocabulary.merge_one(p) for p in pieces]


def test_broken_and_unknown_tokens(vocabulary, library):
    rng = np.random.default_rng(2)
    lists = [rng.integers(0, 50_257, 12).tolist() for _ in range(200)]
    flat = np.array([i for row in lists for i in row])
    got = vocabulary.decode(flat, np.full(200, 12))
    assert got == [library.decode(row, skip_special_tokens=False) for row in lists]
    assert vocabulary.decode(np.array([-1, 60_000, 64]), np.array([2, 0, 1])) == ["", "", "a"]


def test_columns(spark, vocabulary, library):
    df = table(spark).withColumn("ids", bpe.encode(F.col("text"), vocabulary))
    rows = df.withColumn("back", bpe.decode(F.col("ids"), vocabulary)).collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.back == (r.text or "")
    lone = spark.createDataFrame([(None,), ([None, 64],), ([],)], "ids array<int>")
    assert [r[0] for r in lone.select(bpe.decode(F.col("ids"), vocabulary)).collect()] == ["", "a", ""]
    assert table(spark, []).select(bpe.encode(F.col("text"), vocabulary)).count() == 0


def test_token_rows_come_in_stretches(spark, vocabulary, library, monkeypatch):
    """Ids leave a task some rows at a time, not a whole batch; rows of a stretch stay in order."""
    some = samples()
    rows = spark.createDataFrame(list(enumerate([None, *some])), "n int, text string")
    got = {r.n: r for r in bpe.tokens(rows, vocabulary, "n").collect()}
    assert len(got) == len(some) + 1 and got[0].ids == []
    for n, text in enumerate(some, 1):
        assert got[n].ids == library.encode(text, add_special_tokens=False).ids
        assert got[n].n_tokens == len(got[n].ids)
        assert got[n].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    monkeypatch.setattr(bpe, "CHUNK", 2000)
    sizes = [len(c[0]) for c in bpe._coded_parts(vocabulary, True)(pa.array(some))]
    assert sum(sizes) == len(some) and len(sizes) > 10


def test_query(spark, library):
    texts_of = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op10_bpe"](spark, SF).collect():
        ids = library.encode(texts_of[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts_of[r.doc_id].encode()).hexdigest()
