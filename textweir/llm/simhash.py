"""SimHash near-duplicate groups by tiled exact comparison."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import fresh, grouped
from textweir.llm.graph import components
from textweir.llm.hashing import xxh64
from textweir.session import stage

SEED = 42
SHINGLE = 3
RADIUS = 3
# Rows of a tile; a cell with more rows is split into several tiles.
TILE = 4096
# Comparisons made at once, to bound the memory of one numpy step.
BLOCK = 1 << 21
_SEGMENTS = 4
_SEGMENT_BITS = 64 // _SEGMENTS
_CELLS = _SEGMENT_BITS + 1
# Words hashed at once, and hashes whose bits are counted at once (below 2**16).
CHUNK = 20_000
_STEP = 2_048
# For each byte value its eight bits as sixteen-bit counters, four in a word.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.uint16)
_LANES = np.ascontiguousarray(_BITS).view(np.uint64)


def _votes(hashes: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Set bits per owner, most significant bit first; ``owner`` ascends."""
    votes = np.zeros((owners, 64), np.int64)
    big = hashes.byteswap().view(np.uint8)
    for at in range(0, len(hashes), _STEP):
        whose = owner[at : at + _STEP]
        cuts = np.flatnonzero(np.diff(whose, prepend=-1))
        lanes = np.take(_LANES, big[8 * at : 8 * (at + _STEP)], axis=0).reshape(-1, 16)
        votes[whose[cuts]] += np.add.reduceat(lanes, cuts).view(np.uint16)
    return votes


def shingle_hashes(texts: list[bytes], shingle: int):
    """``(hashes, owner, texts)`` for stretches of texts: a hash for each shingle, owners ascend.

    Words are runs of non-blanks, A-Z lower-cased; fewer words than a shingle form one
    shingle; no word gives none.
    """
    at = 0
    while at < len(texts):
        words: list[bytes] = []
        borders = [0]
        while at < len(texts) and len(words) < CHUNK:
            words += texts[at].lower().split()
            borders.append(len(words))
            at += 1
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        count = np.diff(borders)
        owner = np.repeat(np.arange(len(count)), count)
        final = np.repeat(borders[1:], count) - 1
        first = np.repeat(borders[:-1], count)
        place = np.arange(len(words))
        begin = np.flatnonzero((place + shingle - 1 <= final) | (place == first))
        stop = np.minimum(begin + shingle - 1, final[begin])
        starts = (ends - size)[begin]
        yield xxh64(b" ".join(words), starts, ends[stop] - starts, SEED), owner[begin], len(count)


def simhash(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned fingerprints: each bit by majority over the hashes of a text's shingles.

    Shingles as from ``shingle_hashes``; no word gives 0.
    """
    prints = [np.zeros(0, np.uint64)]
    for hashes, owner, count in shingle_hashes(texts, shingle):
        total = np.bincount(owner, minlength=count)
        bits = 2 * _votes(hashes, owner, count) > total[:, None]
        prints.append(np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64))
    return np.concatenate(prints)


def fingerprints(texts, shingle: int = SHINGLE):
    """Column: signed 64-bit SimHash of each text; a null text counts as empty (0)."""

    @F.pandas_udf("long")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series(simhash([(t or "").encode() for t in column], shingle).view(np.int64))

    return of(texts)


def _offsets(radius: int) -> list[list[int]]:
    """Differences of segment population counts within the radius, one of each +/- pair."""
    span = range(-radius, radius + 1)
    found = (d for d in itertools.product(span, repeat=_SEGMENTS) if sum(map(abs, d)) <= radius)
    return [list(d) for d in found if d >= (0,) * _SEGMENTS]


def _links(own: np.ndarray, guests: np.ndarray, radius: int):
    """Links that join what lies within the radius: at most one per guest and merge.

    Every own row is compared with every guest; hits that join nothing new are left out, so a
    dense group gives a spanning set of links, not all its pairs.
    """
    of_guest = np.full(len(guests), -1)
    of_own = np.arange(len(own))
    step = max(1, BLOCK // max(1, len(guests)))
    for at in range(0, len(own), step):
        near = np.bitwise_count(own[at : at + step, None] ^ guests[None, :]) <= radius
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            hit = np.flatnonzero(near[i])
            mine = of_own[at + i]
            groups = of_guest[hit]
            new = hit[groups < 0]
            known, first = np.unique(groups, return_index=True)
            keep = (known >= 0) & (known != mine)
            for j in itertools.chain(new, hit[first[keep]]):
                yield own[at + i], guests[j]
            if keep.any():
                of_guest[np.isin(of_guest, known[keep])] = mine
                of_own[np.isin(of_own, known[keep])] = mine
            of_guest[new] = mine


def _compare(radius: int):
    def run(batches):
        for table in grouped(batches, "tile"):
            tile = table["tile"].to_numpy()
            fp = table["fp"].to_numpy().view(np.uint64)
            own = table["own"].to_numpy(zero_copy_only=False).astype(bool)
            cuts = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist(), len(tile)]
            found: list[tuple] = []
            for a, b in itertools.pairwise(cuts):
                mine = fp[a:b][own[a:b]]
                found += _links(mine, fp[a:b][~own[a:b]], radius)
                found += ((x, y) for x, y in _links(mine, mine, radius) if x != y)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"]
            )

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(u, v)``: links that connect what is connected among distinct ``prints (fp)``.

    The exact tiled comparison: a cell holds the fingerprints whose four 16-bit segments have
    the same population counts; two cells are compared unless these counts differ by more than
    the radius in sum, which no pair within the radius does. Cells with many rows are split
    into tiles by a hash. A row visits one half of the cells around its own, so each pair of
    cells meets once. There are at most 17**4 cells, so their table is broadcast.
    """
    bits = [
        F.bit_count(F.shiftrightunsigned("fp", i * _SEGMENT_BITS).bitwiseAND((1 << _SEGMENT_BITS) - 1))
        for i in range(_SEGMENTS)
    ]
    cell = sum((c * _CELLS**i for i, c in enumerate(bits)), F.lit(0))
    placed = prints.select("fp", F.array(*bits).alias("counts"), cell.cast("int").alias("cell"))
    cells = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    cells = F.broadcast(stage(cells, "cells"))
    steps = F.array(*[F.array(*map(F.lit, d)) for d in _offsets(radius)])
    # The own tile of each row; a row also visits the later tiles of its own cell.
    home = placed.join(cells, "cell").select(
        "fp", "counts", "cell", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("home")
    )
    toward = home.select("fp", "counts", "cell", "home", F.explode(steps).alias("step"))
    there = [F.get("counts", F.lit(i)) + F.get("step", F.lit(i)) for i in range(_SEGMENTS)]
    inside = F.lit(True)
    for x in there:
        inside &= x.between(0, _SEGMENT_BITS)
    target = sum((x * _CELLS**i for i, x in enumerate(there)), F.lit(0)).cast("int")
    toward = toward.where(inside).select("fp", "home", F.col("cell").alias("source"), target.alias("cell"))
    visits = toward.join(cells, "cell").select(
        "fp", "cell", "home", (F.col("source") == F.col("cell")).alias("same"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("part"),
    )
    own = F.col("same") & (F.col("part") == F.col("home"))
    visits = visits.where(~F.col("same") | (F.col("part") >= F.col("home"))).select(
        "fp", (F.col("cell").cast("long") * (1 << 31) + F.col("part")).alias("tile"), own.alias("own")
    )
    dealt = visits.repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(_compare(radius), "u long, v long")


def _groups(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, root, component_id)`` of ``prints (doc_id, fp)``; the root names the group."""
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stage(placed.join(names, "root").select("fp", "root", "component_id"), "groups")


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """``(doc_id, fingerprint long, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links of at most
    ``radius`` differing bits, itself included. Null and empty texts have fingerprint 0 and are
    linked like any other; a null id joins its group but never names it, so a group of null ids
    only has a null ``component_id``; rows that repeat an id are linked by their own texts.
    Other columns are ignored. An empty table gives no rows.

    Copies collapse to one fingerprint before the comparison. Links, components and
    fingerprints stay distributed.
    """
    prints = docs.select(
        F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")
    )
    prints = stage(prints, "simhash")
    named = _groups(prints, radius).drop("root")
    return prints.join(named, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` less near duplicates: one row of each group stays, as it is.

    It is the row with the smallest ``doc_id`` (null last), of equal ids the one with the
    smallest hash of id and text, and one of rows that are equal in both. Null and empty texts
    are one group. The columns are those of ``docs``.
    """
    key = fresh("key", docs)
    hashed = docs.withColumn(key, F.xxhash64(F.col("doc_id"), F.col("text"), F.col("text").isNull()))
    prints = hashed.select("doc_id", F.col(key).alias("key"), fingerprints(F.col("text"), shingle).alias("fp"))
    prints = stage(prints, "simhash")
    grouped_rows = prints.join(_groups(prints, radius).select("fp", "root"), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    winners = grouped_rows.groupBy("root").agg(F.min(order).alias("w")).select(F.col("w.key").alias(key))
    return hashed.join(winners, key, "left_semi").dropDuplicates([key]).drop(key)
