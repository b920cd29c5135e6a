"""Long repeats of words and bytes against a plain scan of all windows."""

import numpy as np
import pytest
from cases import SF, ordered, table, texts

from textweir.llm import queries, repeats, substring, suffix

BIG = 1 << 62


def words_without_repeats(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        rank = BIG if i is None else i
        for a in range(len(w) - window + 1):
            seen = tuple(w[a : a + window])
            first[seen] = min(first.get(seen, BIG + 1), rank)
    out = []
    for i, w in split:
        rank, gone = BIG if i is None else i, [False] * len(w)
        for a in range(len(w) - window + 1):
            if first[tuple(w[a : a + window])] < rank:
                gone[a : a + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
        out.append((i, len(w), sum(gone), kept))
    return ordered(out)


def bytes_without_repeats(rows, window):
    """Distinct ids only: a string is kept where it starts first."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: BIG if r[0] is None else r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for a in range(len(data) - window + 1):
            if (piece := data[a : a + window]) in seen:
                gone[a : a + window] = b"\1" * window
            seen.add(piece)
        spans = sum(1 for a, g in enumerate(gone) if g and (a == 0 or not gone[a - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), spans, kept))
    return ordered(out)


def word_result(df, **options):
    return ordered(tuple(r) for r in substring.deduplicate(df, **options).collect())


def byte_result(df):
    return ordered((*r[:4], bytes(r[4])) for r in suffix.deduplicate(df).collect())


def unique(rows):
    """One row per id: byte repeats between texts of one id have an order of their own."""
    return list({i: (i, t) for i, t in rows}.values())


def test_words(spark):
    assert word_result(table(spark)) == words_without_repeats(texts(), 50)


def test_words_short_window(spark):
    assert word_result(table(spark), window=6) == words_without_repeats(texts(), 6)


def test_words_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert word_result(spark.createDataFrame(rows, "doc_id long, text string")) == words_without_repeats(rows, 50)


def test_bytes(spark):
    rows = unique(texts())
    assert byte_result(table(spark, rows)) == bytes_without_repeats(rows, 100)


def test_split_shards(spark, monkeypatch):
    """Frequent anchors dealt over many shards and merged."""
    rows = unique(texts())
    monkeypatch.setattr(repeats, "SHARD", 2_000)
    for module in (suffix, substring):
        default = module.repeated_spans.__defaults__
        monkeypatch.setattr(module.repeated_spans, "__defaults__", (*default[:-1], 1))
    assert byte_result(table(spark, rows)) == bytes_without_repeats(rows, 100)
    assert word_result(table(spark)) == words_without_repeats(texts(), 50)


def test_equal_rows_and_ids(spark):
    """Equal rows give equal rows; of different texts with one id, one is the earlier."""
    rows = [(1, "ab" * 100), (1, "ab" * 100), (2, "x" + "ab" * 100)]
    got = byte_result(table(spark, rows))
    assert got[0] == got[1] and got[0][:3] == (1, 200, 198) and got[2][1:3] == (201, 200)


@pytest.mark.parametrize("size", [1, 9, 700])
def test_suffix_array_and_prefixes(size):
    data = np.random.default_rng(size).integers(97, 99, size).astype(np.uint8)
    text = data.tobytes()
    order, _ = suffix.suffix_array(data, 1 << 20)
    assert order.tolist() == sorted(range(size), key=lambda i: text[i:])

    def common(a, b):
        n = 0
        while n < 30 and max(a, b) + n < size and text[a + n] == text[b + n]:
            n += 1
        return n

    got = suffix.common_prefixes(data, order, 30).tolist()
    assert got == [0, *(common(a, b) for a, b in zip(order[1:], order[:-1], strict=True))]


def test_long_text_in_pieces(monkeypatch):
    """A text longer than a piece has the anchors of the whole text."""
    text = np.random.default_rng(1).integers(97, 101, 5_000).astype(np.uint8).tobytes()

    def windows():
        _, h, _, at, n = suffix.find([text])
        return {a + j: x for x, a, c in zip(h, at, n, strict=True) for j in range(c)}

    whole = windows()
    monkeypatch.setattr(repeats, "CHUNK", 300)
    assert windows() == whole and len(whole) == len(text) - 99


def test_symbols_of_equal_spans_agree():
    """Recompression: symbols inside a repeated span are the same at every round."""
    rng = np.random.default_rng(5)
    a = rng.integers(1, 6, 400).astype(np.uint64)
    b = np.concatenate([rng.integers(1, 6, 37).astype(np.uint64), a[100:300]])

    def inside(words, low, high):
        n = len(words)
        return [
            {(x, s - low, e - low) for x, s, e in zip(*level, strict=True) if s >= low and e <= high}
            for level in substring.levels(words, np.zeros(n, int), np.full(n, n))
        ]

    assert inside(a, 100, 300) == inside(b, 37, 237)


def test_empty_tables(spark):
    none = table(spark, [])
    assert word_result(none) == [] and byte_result(none) == []


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op9_suffix_dedup"])
def test_queries_keep_every_document(spark, name):
    assert queries.QUERIES[name](spark, SF).count() == 200


@pytest.mark.parametrize("seed", range(12))
def test_windows_of_long_shared_passages(seed):
    """Passages of 128 to 168 bytes in several snippets: classes are exactly the equal windows."""
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(97, 100, n, dtype=np.uint8).tobytes()
    passage = draw(168)
    parts = []
    for _ in range(30):
        size = int(rng.integers(128, 169))
        at = int(rng.integers(0, 169 - size))
        parts.append(draw(int(rng.integers(0, 20))) + passage[at : at + size] + draw(int(rng.integers(0, 20))))
    counts = np.array([len(p) - 99 for p in parts])
    group, owner, inside = suffix.equal_windows(parts, counts, 100)
    assert len(group) == counts.sum()
    found, names = {}, {}
    for g, o, i in zip(group.tolist(), owner.tolist(), inside.tolist(), strict=True):
        window = parts[o][i : i + 100]
        assert found.setdefault(g, window) == window and names.setdefault(window, g) == g
    data = np.frombuffer(b"".join(parts), np.uint8)
    order, _ = suffix.suffix_array(data, len(data))
    line = data.tobytes()
    assert order.tolist() == sorted(range(len(line)), key=lambda i: line[i:])
