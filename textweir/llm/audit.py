"""How the filters of a corpus interact: what each removes, alone, after others, on average."""

from __future__ import annotations

import itertools
import json
import math
import re
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import grouped
from textweir.session import broadcast_if_bounded, stage

FILTERS = "ABCDE"
WORDS, DISTINCT, CAPITALS = 50, 65, 5
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = string.ascii_uppercase.encode()
# The sketch: counters of a block, hashes of a text, rows of the table for each block.
SLOTS, HASHES, ROWS = 1 << 12, 3, 256
_BITS = SLOTS.bit_length() - 1
# Rows that a task counts before it writes its counters.
FLUSH = 1 << 20
_BLOCK_BYTES = SLOTS // 8 + 64


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a whole text fails; a null text is an empty one.

    A: fewer than ``WORDS`` words; B: of a hundred words fewer than ``DISTINCT`` distinct ones;
    C: of a hundred code points more than ``CAPITALS`` are A-Z; D: one of ``#$%&*|``.
    """

    @F.arrow_udf("int")
    def of(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.int32)
        points = pc.utf8_length(texts).fill_null(0).to_pylist()
        for n, value in enumerate(texts):
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            words = raw.split()
            out[n] = (
                (len(words) < WORDS)
                + 2 * (100 * len(set(words)) < DISTINCT * len(words))
                + 4 * (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > CAPITALS * points[n])
                + 8 * (_MARKS.search(raw) is not None)
            )
        return pa.array(out)

    return of(text)


def _slots(g: Column) -> list[Column]:
    """Counters of a text in its block."""
    return [F.shiftrightunsigned(g, _BITS * i).bitwiseAND(SLOTS - 1) for i in range(HASHES)]


def _count(batches):
    """Partial sketches: for each block that a stretch of rows touches, counters at 1 and above."""
    held, rows = [], 0

    def flush():
        block = np.concatenate([b.column("block").to_numpy() for b in held])
        g = np.concatenate([b.column("g").to_numpy() for b in held]).view(np.uint64)
        spots = [((g >> np.uint64(_BITS * i)) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]
        spot, n = np.unique(np.concatenate([block * SLOTS + s for s in spots]), return_counts=True)
        cuts = [0, *(np.flatnonzero(np.diff(spot // SLOTS)) + 1).tolist(), len(spot)]
        slot = (spot % SLOTS).astype("<u2")
        out = [[], [], []]
        for a, b in itertools.pairwise(cuts):
            more = n[a:b] > 1
            out[0].append(int(spot[a] // SLOTS))
            out[1].append(slot[a:b][~more].tobytes())
            out[2].append(slot[a:b][more].tobytes())
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["block", "once", "more"]
        )

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= FLUSH:
            yield flush()
            held, rows = [], 0
    if rows:
        yield flush()


def _merge(batches):
    """The counters of each block added up; a bit for each that is 2 or more."""
    for table in grouped(batches, "block"):
        block = table["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        found, bits = [], []
        for a, b in itertools.pairwise(cuts):
            once, more = (
                np.frombuffer(b"".join(table[c].slice(a, b - a).to_pylist()), "<u2") for c in ("once", "more")
            )
            counter = np.bincount(once, minlength=SLOTS) + 2 * np.bincount(more, minlength=SLOTS)
            if (counter > 1).any():
                found.append(block[a])
                bits.append(np.packbits(counter > 1, bitorder="little").view("<i8"))
        flat = np.concatenate([np.zeros(0, np.int64), *bits])
        borders = np.arange(len(found) + 1, dtype=np.int32) * (SLOTS // 64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.ListArray.from_arrays(pa.array(borders), pa.array(flat))],
            names=["block", "bits"],
        )


def repeat_sketch(hashes: DataFrame) -> DataFrame:
    """``(block, bits)`` of a counting Bloom filter over ``hashes (block, g)``.

    Each text counts ``HASHES`` counters of its block; ``bits`` tells which were counted twice or
    more. A text with a counter below two occurs once. Tasks write counters, not rows, so a text
    that fills a third of the table costs one row for each ``FLUSH`` rows; all blocks are merged
    independently.
    """
    partial = hashes.select("block", "g").mapInArrow(_count, "block long, once binary, more binary")
    partial = partial.repartition("block").sortWithinPartitions("block")
    return partial.mapInArrow(_merge, "block long, bits array<long>")


def _maybe_repeated(bits: Column, g: Column) -> Column:
    found = [F.getbit(F.get(bits, F.shiftright(s, 6).cast("int")), s.bitwiseAND(63).cast("int")) for s in _slots(g)]
    return F.coalesce(sum(found[1:], found[0]) == HASHES, F.lit(False))


def failures(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``(doc_id, part, mask, good, toxic)``, one row for each row of ``docs``.

    ``mask`` holds the bits of the failed filters, A lowest. E fails a text that is identical to
    that of a smaller ``doc_id``, anywhere in the table; null texts are empty ones, a null id is
    neither smaller nor larger than any, and rows that repeat id and text do not fail by each
    other. ``part`` is null as an empty string. ``good`` and ``toxic`` say that ``labels
    (doc_id, quality, toxic)`` has 1; rows that repeat an id there count once. Other columns are
    ignored. Empty tables give no rows, or no labels.

    One pass makes a short row for each document. A counting Bloom filter of the texts' hashes,
    one block for each ``ROWS`` documents, clears texts that occur once for certain; a second
    scan keeps the texts that may repeat, and only these are shuffled, as partial aggregates by
    full text, to find their smallest ids. Failed rows are those that may repeat and are not
    found among the first ones by hash and id, so no group of copies meets in a join. The sketch
    is broadcast if its measured size allows, else joined by block.
    """
    text = F.coalesce("text", F.lit(""))
    h, g = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    thin = docs.select(
        "doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), text_failures(F.col("text")).alias("mask"),
        h.alias("h"), g.alias("g"),
    )
    thin = stage(thin, "audit-rows")
    blocks = max(1, math.ceil(thin.count() / ROWS))
    block = F.pmod(F.col("h"), F.lit(blocks)).cast("long")
    sketch = stage(repeat_sketch(thin.select(block.alias("block"), "g")), "audit-sketch")
    sketch = broadcast_if_bounded(sketch, sketch.count(), _BLOCK_BYTES)
    maybe = _maybe_repeated(F.col("bits"), F.col("g"))
    texts = docs.select("doc_id", text.alias("text"), h.alias("h"), g.alias("g")).withColumn("block", block)
    texts = texts.join(sketch, "block").where(maybe)
    first = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    first = stage(first.where(F.col("doc_id").isNotNull()).select("doc_id", h.alias("h"), g.alias("g")), "audit-firsts")
    marked = thin.withColumn("block", block).join(sketch, "block", "left").select(
        "doc_id", "part", "mask", "h", "g", maybe.alias("maybe")
    )
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    named = marked.where(F.col("doc_id").isNotNull())
    again = named.join(first.withColumn("first", F.lit(True)), ["doc_id", "h", "g"], "left")
    whole = again.withColumn("fails", F.col("maybe") & F.col("first").isNull()).join(known, "doc_id", "left")
    nameless = marked.where(F.col("doc_id").isNull()).select(
        "doc_id", "part", "mask", F.lit(False).alias("fails"), F.lit(False).alias("good"), F.lit(False).alias("toxic")
    )
    every = whole.select("doc_id", "part", "mask", "fails", "good", "toxic").union(nameless)
    return every.select(
        "doc_id", "part", (F.col("mask") + F.col("fails").cast("int") * 16).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def _orders(filters: str) -> Column:
    """All orders and steps, ``array<struct<filter_order, step, bit, before>>``, as one literal."""
    bit = {c: 1 << n for n, c in enumerate(filters)}
    rows = [
        {"filter_order": "".join(o), "step": n + 1, "bit": bit[c], "before": sum(bit[x] for x in o[:n])}
        for o in itertools.permutations(filters)
        for n, c in enumerate(o)
    ]
    return F.from_json(
        F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    )


def interactions(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every filter does at every step of every order, by part; zeros included.

    ``failed (part, mask, good, toxic)`` as ``failures`` gives it, for any few filters whose bits
    ascend in ``mask`` (all orders are listed, so their number is a factorial). Returns ``part,
    filter_order, step`` and, of the step's filter: ``kept`` after it, ``removed`` by it,
    ``redundant`` (fails it, gone before), ``unique_fails`` (fails it only), ``good_lost`` and
    ``toxic_lost`` (removed, labelled so) and ``shapley`` (removed, summed over all orders). No
    rows give no rows.

    Rows are summed to at most ``2 ** len(filters)`` cells for each part before anything else; all
    columns are sums of cells, so nothing is counted twice and only cells are shuffled.
    """
    total = math.factorial(len(filters))
    cells = failed.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"),
        F.sum(F.col("toxic").cast("long")).alias("toxic"),
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = parts.select("part", "cells", F.inline(_orders(filters)))

    def summed(value, holds) -> Column:
        def add(a, c):
            return a + F.when(holds(c["mask"]), value(c)).otherwise(0)

        return F.aggregate("cells", F.lit(0).cast("long"), add)

    bit, before = F.col("bit"), F.col("before")
    fails = lambda m: m.bitwiseAND(bit) != 0
    here = lambda m: fails(m) & (m.bitwiseAND(before) == 0)
    n = lambda c: c["n"]
    return steps.select(
        "part", "filter_order", "step",
        summed(n, lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        summed(n, here).alias("removed"),
        summed(n, lambda m: fails(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        summed(n, lambda m: m == bit).alias("unique_fails"),
        summed(lambda c: c["good"], here).alias("good_lost"),
        summed(lambda c: c["toxic"], here).alias("toxic_lost"),
        # A row that fails k filters is removed by each of them in one k-th of all orders.
        summed(lambda c: (c["n"] * total / F.bit_count(c["mask"])).cast("long"), fails).alias("shapley"),
    )
