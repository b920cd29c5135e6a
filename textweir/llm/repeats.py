"""What the two long-repeat operators share: from anchors to removed spans.

A window is a run of fixed length. Both operators cover the windows of a text by *anchors*:
each window is given to one anchor, chosen by the content of the window alone, so equal windows
have equal anchors, at the same distance. An anchor and the consecutive windows given to it form
a *snippet*. Windows repeat only if their anchors do, so anchors that occur once are dropped
before anything longer than a hash crosses the network.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import grouped
from textweir.session import stage



# Characters of text that are worked on at once, to bound the memory of a task.
CHUNK = 1 << 20
LAST = (1 << 63) - 1
# Snippets of one anchor that one shard takes; an anchor with more is dealt over several.
HOT = 10_000
# Bytes of a shard, about; more bytes make more shards.
SHARD = 1 << 20

ANCHORS = "k long, d long, h long, snip long, at int, n int"


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, k, d, text)``: ``k`` names a pair of id and text, ``d`` orders by id, null last."""
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    k = F.xxhash64(F.col("doc_id"), F.col("text"), F.col("text").isNull())
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select(*columns).select("doc_id", k.alias("k"), d.alias("d"), "text")


def chunks(column: pa.Array):
    """Row numbers and UTF-8 texts of a column, about ``CHUNK`` bytes at a time; null is empty."""
    rows: list[int] = []
    texts: list[bytes] = []
    size = 0
    for i, value in enumerate(column.cast(pa.binary())):
        rows.append(i)
        texts.append(value.as_py() or b"")
        size += len(texts[-1])
        if size >= CHUNK:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def anchors(docs: DataFrame, find: Callable) -> DataFrame:
    """``(k, d, h, snip, at, n)``: anchor, snippet hash, first window and number of windows.

    ``find(texts)`` gives ``(text number, h, snip, at, n)`` as arrays.
    """

    def run(batches):
        for batch in batches:
            keys, order = batch.column("k").to_numpy(), batch.column("d").to_numpy()
            for rows, texts in chunks(batch.column("text")):
                owner, h, snip, at, n = find(texts)
                of = np.array(rows)[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[of]), pa.array(order[of]),
                        pa.array(h.view(np.int64)), pa.array(snip.view(np.int64)),
                        pa.array(at, pa.int32()), pa.array(n, pa.int32()),
                    ],
                    names=["k", "d", "h", "snip", "at", "n"],
                )

    return docs.select("k", "d", "text").mapInArrow(run, ANCHORS)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``(*columns, z)``: texts compressed for the shuffles that carry them whole."""
    schema = docs.select(*columns).schema

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [pack.compress(v.as_py() or b"") for v in batch.column("text").cast(pa.binary())]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(z, pa.binary())], names=[*columns, "z"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", z binary"
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(run, ddl)


def unpack(column: pa.Array):
    """The texts of a compressed column, one by one."""
    open_ = zstandard.ZstdDecompressor()
    for z in column:
        yield open_.decompress(z.as_py(), max_output_size=1 << 31)


def snippets(docs: DataFrame, asked: DataFrame, cut: Callable, schema: str) -> DataFrame:
    """Snippets of texts: ``asked (h, k, d, at, n, salts)`` with what ``cut`` takes of the text.

    ``cut(text, at, n)`` gives the bytes of one text's snippets; each text crosses the network
    once, compressed, whatever is asked of it.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    wanted = asked.groupBy("k").agg(
        F.collect_list(F.struct("h", "d", "at", "n", "salts")).alias("asked")
    )
    # Equal rows have one ``k`` and are asked once; the join has already dealt them by ``k``.
    texts = packed(docs, "k").join(wanted, "k").dropDuplicates(["k"])

    def run(batches):
        for batch in batches:
            parts = []
            for k, text, want in zip(
                batch.column("k").to_pylist(), unpack(batch.column("z")), batch.column("asked"), strict=True
            ):
                h, d, at, n, salts = (c.to_numpy(zero_copy_only=False) for c in want.values.flatten())
                wide = (c.astype(np.int64) for c in (np.full(len(h), k), d, at, n))
                parts.append((h, *wide, salts, cut(text, at, n)))
                if sum(len(p[0]) for p in parts) >= CHUNK >> 6:
                    yield _batch(parts, names)
                    parts = []
            if parts:
                yield _batch(parts, names)

    return texts.select("k", "z", "asked").mapInArrow(run, schema)


def _batch(parts, names) -> pa.RecordBatch:
    columns = []
    for values in zip(*parts, strict=True):
        if isinstance(values[0], np.ndarray):
            columns.append(pa.array(np.concatenate(values)))
        else:
            columns.append(pa.array([b for v in values for b in v], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=names)


def occurrences(docs: DataFrame, find: Callable) -> DataFrame:
    """``(h, snip, k, d, at, n)``: every place of every anchor that occurs in more than one place.

    Counting is a partial aggregate over hashes, so copies and frequent passages add one row
    for each task. Both sides of the join back are stored or plain, so adaptive execution can
    split it where an anchor is frequent.
    """
    often = anchors(docs, find).groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    often = stage(often.select("h"), "often")
    return anchors(docs, find).join(often, "h").select("h", "snip", "k", "d", "at", "n")


def shards(batches, equal: Callable, by_document: bool):
    """Repeats within one shard, and what an anchor dealt over several shards leaves to merge.

    ``equal(parts, counts)`` gives ``(class, snippet, window of the snippet)`` and a function
    that names windows by 16 bytes. A window repeats if its class holds one of a smaller ``d``
    (``by_document``), or an earlier ``(d, k, at)``.
    """
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    k, d, at, n = (table[c].to_numpy() for c in ("k", "d", "at", "n"))
    dealt = table["salts"].to_numpy() > 1
    (group, owner, inside), name = equal(table["part"].to_pylist(), n)
    place = at[owner] + inside
    order = np.lexsort((place, k[owner], d[owner], group))
    group, owner, inside, place = group[order], owner[order], inside[order], place[order]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    late = ~first
    if by_document:
        lowest = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        late = d[owner] > d[owner[lowest]]
    left = np.flatnonzero(~late & dealt[owner])
    names = np.frombuffer(name(owner[left], inside[left]), np.int64).reshape(-1, 2)
    late = np.flatnonzero(late)
    picked = np.concatenate([late, left])
    zeros = np.zeros(len(late), np.int64)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(d[owner[picked]]), pa.array(k[owner[picked]]), pa.array(place[picked]),
            pa.array(np.concatenate([zeros, names[:, 0]])),
            pa.array(np.concatenate([zeros, names[:, 1]])),
            pa.array(np.concatenate([zeros, np.ones(len(left), np.int64)])),
        ],
        names=["d", "k", "at", "w1", "w2", "open"],
    )


def merge(batches, by_document: bool):
    """Repeats among the leftovers of several shards, sorted by window and place.

    The shards' ordered windows are one ordered run here; binary search finds where each
    window's run begins, and what comes after its first place (or smallest ``d``) is a repeat.
    """
    for table in grouped(batches, "w1"):
        w1, w2, d = (table[c].to_numpy() for c in ("w1", "w2", "d"))
        begin = np.searchsorted(w1, w1, "left")
        other = np.flatnonzero(np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])]))
        begin = np.maximum(begin, other[np.searchsorted(other, np.arange(len(w1)), "right") - 1])
        late = d > d[begin] if by_document else begin < np.arange(len(w1))
        late = np.flatnonzero(late)
        yield pa.RecordBatch.from_arrays(
            [table["k"].combine_chunks().take(late), table["at"].combine_chunks().take(late)],
            names=["k", "at"],
        )


def repeated(
    docs: DataFrame,
    find: Callable,
    cut: Callable,
    equal: Callable,
    by_document: bool,
    hot: int,
    window_bytes: int,
) -> DataFrame:
    """``(k, at, n)``: the runs of windows that repeat. ``docs`` as from ``keyed``.

    ``window_bytes`` is about the size of a window; the number of shards follows from it.

    All copies of a snippet but the first are settled as a whole. The first copies meet in
    shards by anchor: equal windows have equal anchors, so a shard settles all its windows.
    Only an anchor with more than ``hot`` different snippets is dealt over several shards,
    whose leftovers are merged. Windows of one snippet differ, as they lie differently around
    its one anchor; so an anchor with a single snippet has nothing left to compare.
    """
    places = stage(occurrences(docs, find), "anchors")
    place = F.struct("d", "k", "at")
    first = places.groupBy("h", "snip").agg(F.min(place).alias("first"), F.first("n").alias("n"))
    first = stage(first, "first")
    compared = places.join(first.drop("n"), ["h", "snip"])
    counts = first.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    counts = counts.select("h", F.ceil(F.col("c") / hot).cast("int").alias("salts"))
    if by_document:
        later = compared.where(F.col("d") > F.col("first.d"))
        asked = compared.where(F.col("d") == F.col("first.d")).select("h", "k", "d", "at", "n").distinct()
    else:
        later = compared.where(place > F.col("first"))
        asked = first.select("h", "first.k", "first.d", "first.at", "n")
    asked = stage(asked.join(counts, "h"), "asked")
    size = asked.agg(F.coalesce(F.sum(F.col("n") + window_bytes), F.lit(0))).first()[0]
    parts = snippets(
        docs, asked, cut, "h long, k long, d long, at long, n long, salts int, part binary"
    )
    salt = F.pmod(F.xxhash64("part"), F.col("salts"))
    dealt = parts.repartition(max(1, -(-size // SHARD)), "h", salt)
    found = dealt.mapInArrow(
        lambda batches: shards(batches, equal, by_document),
        "d long, k long, at long, w1 long, w2 long, open long",
    )
    found = stage(found, "repeats")
    left = found.where("open = 1").repartition("w1").sortWithinPartitions("w1", "w2", "d", "k", "at")
    merged = left.mapInArrow(lambda batches: merge(batches, by_document), "k long, at long")
    single = found.where("open = 0").select("k", "at").union(merged)
    single = single.select("k", F.col("at").cast("int"), F.lit(1).alias("n"))
    return later.select("k", "at", "n").union(single)


def removals(docs: DataFrame, spans: DataFrame, remove: Callable, schema: str) -> DataFrame:
    """``(doc_id, ...)`` for each row of ``docs``: what ``remove`` makes of a text and its spans.

    ``spans (k, at, n)``: runs of ``n`` windows from window ``at`` on. ``remove(text, at, n)``
    gives one value for each column of ``schema``.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    per_text = spans.groupBy("k").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    texts = packed(docs, "doc_id", "k").join(per_text, "k", "left").select("doc_id", "z", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    none = np.zeros(0, np.int64)

    def run(batches):
        for batch in batches:
            whole = zip(unpack(batch.column("z")), batch.column("spans"), strict=True)
            found, size, first = [], 0, 0
            for row, (text, want) in enumerate(whole):
                values = [none, none]
                if want.is_valid:
                    values = [c.to_numpy(zero_copy_only=False) for c in want.values.flatten()]
                found.append(remove(text, *values))
                size += len(text)
                if size >= 16 * CHUNK or row == batch.num_rows - 1:
                    ids = batch.column("doc_id").slice(first, len(found))
                    rest = [pa.array(v) for v in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids, *rest], names=["doc_id", *names])
                    found, size, first = [], 0, row + 1

    return texts.mapInArrow(run, f"doc_id {kind}, {schema}")


def marked(length: int, at: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Which of ``length`` items lie in one of the windows ``at, ..., at + n - 1``."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal neighbours."""
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return start, np.diff(np.append(start, len(values)))


