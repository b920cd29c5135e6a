"""Document fingerprints: weighted SimHash and block tables, in DataFrame functions only."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.llm.common import digest
from textweir.session import stage

BITS = 64
RADIUS = 3
BLOCKS = 4
# A term votes with its letters, up to this weight. Two 32-bit counters share one sum, so the
# weights of a text may add up to 2**32, beyond the longest string there can be.
WEIGHT = 15
_HALVES = 0x0000_0001_0000_0001
# Documents of one slice of the id order, and the most slices.
SLICE = 2_000
SLICES = 10_000


def terms(text: Column) -> Column:
    """Weighted terms ``array<struct<h, w>>``: hashed neighbouring words, and single ends.

    Words are runs of other characters than blanks and line ends, lower-cased.
    """
    plain = F.translate(F.lower(text), "\t\n\x0b\x0c\r", "     ")
    words = F.array_remove(F.split(plain, " "), "")
    return F.zip_with(
        words,
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))),
        lambda a, b: F.struct(
            F.xxhash64(a, b).alias("h"),
            F.least(F.length(a) + F.coalesce(F.length(b), F.lit(0)), F.lit(WEIGHT)).alias("w"),
        ),
    )


def votes() -> list[Column]:
    """Sums over rows ``(h, w)``: counter ``i`` holds the weights of bits ``i`` and ``i + 32``."""
    w = F.col("w").cast("long")
    sums = [
        F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_HALVES)) * w).alias(f"v{i}")
        for i in range(BITS // 2)
    ]
    return [*sums, F.sum(w).alias("total")]


def decide() -> Column:
    """The fingerprint of summed votes: a bit is set if over half of the weight votes for it."""
    half = F.coalesce(F.col("total"), F.lit(0).cast("long"))
    bits = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFF_FFFF))
        high = F.shiftrightunsigned(f"v{i}", 32)
        one = F.lit(1).cast("long")
        bits = bits.bitwiseOR(F.when(low * 2 > half, F.shiftleft(one, i)).otherwise(0))
        bits = bits.bitwiseOR(F.when(high * 2 > half, F.shiftleft(one, i + 32)).otherwise(0))
    return F.coalesce(bits, F.lit(0).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of the weighted terms, from 0 (unrelated) to 1 (equal fingerprints)."""
    angle = F.bit_count(a.bitwiseXOR(b)) * (math.pi / BITS)
    return F.greatest(F.cos(angle), F.lit(0.0))


def fingerprints(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``(*keys, fp)``: the fingerprint of each text; a null text counts as empty (0).

    ``keys`` identify a row. Rows already partitioned by some of the keys are not shuffled:
    the votes of a text are summed where the text is.
    """
    empty = F.lit("")
    exploded = df.select(*keys, F.inline_outer(terms(F.coalesce(F.col(text), empty))))
    return exploded.groupBy(*keys).agg(*votes()).select(*keys, decide().alias("fp"))


def _slice_of(value: Column, borders: list) -> Column:
    """Number of borders below the value, found in two steps of about the square root."""
    if not borders:
        return F.lit(0)
    width = math.isqrt(len(borders)) + 1
    rows = [borders[i : i + width] for i in range(0, len(borders), width)]
    heads = F.array(*[F.lit(r[0]) for r in rows])
    table = F.array(*[F.array(*map(F.lit, r)) for r in rows])
    coarse = F.greatest(F.size(F.filter(heads, lambda x: x < value)) - 1, F.lit(0))
    fine = F.size(F.filter(F.get(table, coarse), lambda x: x < value))
    return F.coalesce(coarse * width + fine, F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` with ``part, row, next_text, next_part, next_row``.

    The next document goes by descending ``doc_id`` (null last, equal ids by descending text);
    after the last comes the first. ``(part, row)`` numbers the rows. Slices of the id order
    are found from quantiles of the ids, one number for each slice; each slice is ordered on
    its own and gets the first row of the following slice as a guest, so no task sees the
    whole order. Every text crosses the network once.
    """
    ids = docs.select("doc_id")
    count = ids.count()
    parts = min(SLICES, count // SLICE)
    borders: list = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        found = ids.agg(F.percentile_approx("doc_id", shares, 20 * parts)).first()[0]
        borders = sorted(set(found or []))
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("part", _slice_of(F.col("doc_id"), borders))
    # At most ``SLICES`` short rows: the first id of each slice, and the slice before it in order.
    first = placed.groupBy("part").agg(F.max("doc_id").alias("doc_id"))
    heads = [(r["part"], r["doc_id"]) for r in first.orderBy(F.desc("part")).collect()]
    order = [(heads[i - 1][0], p) for i, (p, _) in enumerate(heads)]
    schema = "part int, next_part int"
    follow = F.broadcast(docs.sparkSession.createDataFrame(order, schema))
    heads_of = F.broadcast(stage(first, "slice-heads").withColumnRenamed("doc_id", "head"))
    # The first text of each slice: among equal ids the largest.
    guests = placed.join(heads_of, "part").where(F.col("doc_id").eqNullSafe(F.col("head")))
    guests = guests.groupBy("part").agg(F.max("text").alias("text"))
    guests = guests.withColumnRenamed("part", "next_part").join(follow, "next_part").select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", "part",
        F.lit(True).alias("guest"),
    )
    every = placed.withColumn("guest", F.lit(False)).unionByName(guests)
    window = Window.partitionBy("part").orderBy(
        "guest", F.desc_nulls_last("doc_id"), F.desc("text")
    )
    numbered = every.select(
        "*",
        F.row_number().over(window).alias("row"),
        F.lead("text").over(window).alias("next_text"),
        F.lead("guest").over(window).alias("at_end"),
    ).where(~F.col("guest"))
    return numbered.join(follow, "part").select(
        "doc_id", "text", "part", "row", "next_text",
        F.when(F.col("at_end"), F.col("next_part")).otherwise(F.col("part")).alias("next_part"),
        F.when(F.col("at_end"), 1).otherwise(F.col("row") + 1).alias("next_row"),
    )


def edited(text: Column, other: Column) -> Column:
    """The last third (rounded down) of the code points replaced by the first as many of ``other``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - third), F.substr(other, F.lit(1), third))


def search(
    prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """``(query, fp)``: every distinct fingerprint within ``radius`` bits of each query.

    ``prints (fp)`` and ``queries (fp)`` are signed 64-bit numbers; nulls find nothing, and
    repeated ones count once. Permuted block tables: the bits are cut into ``blocks`` blocks,
    and each choice of ``blocks - radius`` blocks is a table keyed by those blocks. Two
    fingerprints within the radius agree in all blocks of some table, so the join on table and
    key finds every pair; the distance is then compared. More blocks make longer keys.
    """
    width = -(-BITS // blocks)
    block = lambda i: F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1))
    tables = list(itertools.combinations(range(blocks), blocks - radius))
    keys = F.array(
        *[F.xxhash64(F.lit(n), *[block(i) for i in chosen]) for n, chosen in enumerate(tables)]
    )

    def keyed(df: DataFrame, name: str) -> DataFrame:
        one = df.select("fp").where(F.col("fp").isNotNull()).distinct()
        return one.select(F.col("fp").alias(name), F.explode(keys).alias("key"))

    pairs = keyed(queries, "query").join(keyed(prints, "fp"), "key")
    near = F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))) <= radius
    return pairs.where(near).select("query", "fp").distinct()


def compare_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    ``(doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp)`` for each row of ``docs``; the
    edited text and the next document are those of ``edited`` and ``with_next``. Null texts are
    empty; a single document is its own next; no rows give no rows; other columns are ignored.
    """
    rows = with_next(docs.select("doc_id", "text"))
    changed = edited(F.col("text"), F.col("next_text"))
    both = rows.select(
        "part", "row", "next_part", "next_row", "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.col("text"), changed.alias("changed"),
    )
    texts = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("changed").alias("text")),
    )
    keys = ["part", "row", "next_part", "next_row", "doc_id", "n_chars", "edited_sha256"]
    each = both.withColumn("edited_sha256", digest(F.col("changed"))).select(*keys, F.inline(texts))
    found = fingerprints(each, [*keys, "kind"])
    wide = found.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"),
    )
    wide = stage(wide, "fingerprints")
    following = wide.select(
        F.col("part").alias("next_part"), F.col("row").alias("next_row"), F.col("fp").alias("next_fp")
    )
    return wide.join(following, ["next_part", "next_row"], "left").select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"
    )
