"""Benchmark decontamination by winnowed word k-grams, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import digest, fresh, row_key
from textweir.session import broadcast_if_measured, stage

# A window of this many words must be found wherever it occurs; a shorter item is one window.
SPAN = 10
# Most slots of the bits that tell which hashes an item may have.
SIEVE = 1 << 18
_LOW = -(1 << 63)
# A word is a run of a-z, 0-9 and everything beyond ASCII; A-Z become a-z first.
_KEPT = set(string.ascii_letters + string.digits)
_BLANKS = "".join(c for c in map(chr, range(128)) if c not in _KEPT)


def words(text: Column) -> Column:
    plain = F.translate(
        F.coalesce(text, F.lit("")),
        string.ascii_uppercase + _BLANKS,
        string.ascii_lowercase + " " * len(_BLANKS),
    )
    return F.array_remove(F.split(plain, " "), "")


def _tail(values: Column, skip: int, size: Column) -> Column:
    return F.slice(values, F.lit(skip + 1), F.greatest(size, F.lit(0)))


def _sliding(df: DataFrame, column: str, width: int, join) -> DataFrame:
    """Replace an array by what ``join`` makes of each ``width`` neighbours.

    Widths double from step to step, so an element is touched about ``2 log2(width)`` times.
    """
    parts = {1: column}
    reach = 1
    while reach * 2 <= width:
        name = f"{column}_{reach * 2}"
        df = _join_at(df, name, parts[reach], reach, parts[reach], 2 * reach, join)
        reach *= 2
        parts[reach] = name
    done, whole = reach, parts[reach]
    while done < width:
        step = max(r for r in parts if r <= width - done)
        name = f"{column}_{done + step}_of"
        df = _join_at(df, name, whole, done, parts[step], done + step, join)
        done, whole = done + step, name
    gone = [c for c in df.columns if c.startswith(f"{column}_") and c != whole]
    df = df.drop(*gone)
    return df if whole == column else df.withColumn(column, F.col(whole)).drop(whole)


def _join_at(df, name: str, left: str, skip: int, right: str, width: int, join) -> DataFrame:
    """``name[i]`` = ``join(left[i], right[i + skip])``, as long as ``width`` neighbours exist."""
    # ``left`` holds one value for each ``skip`` neighbours.
    size = F.size(left) + (skip - width)
    return df.withColumn(name, F.zip_with(_tail(F.col(left), 0, size), _tail(F.col(right), skip, size), join))


def _sieve(known: DataFrame) -> tuple[Column, int]:
    """One bit for each slot of a hash that an item has, as a constant array, and their number.

    About one slot in 16 is set, up to ``SIEVE`` slots; a larger benchmark fills more of them,
    and lets more hashes pass to the join, which decides. The driver holds the bits only.
    """
    rows, slots = known.count(), 1 << 12
    while slots < min(16 * rows, SIEVE):
        slots *= 2
    slot = F.col("h").bitwiseAND(slots - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int"))
    words = [0] * (slots // 32)
    for row in known.groupBy(F.shiftright(slot, 5).alias("at")).agg(F.bit_or(bit).alias("bits")).collect():
        words[row["at"]] = row["bits"]
    return F.expr(f"array({','.join(f'{w}L' for w in words)})"), slots


def _passes(sieve: tuple[Column, int] | None, h: Column) -> Column:
    if sieve is None:
        return F.lit(True)
    bits, slots = sieve
    slot = h.bitwiseAND(slots - 1)
    return F.getbit(F.get(bits, F.shiftright(slot, 5).cast("int")), slot.bitwiseAND(31).cast("int")) == 1


def _prints(df: DataFrame, name: str, span: int, sieve: tuple[Column, int] | None = None) -> DataFrame:
    """Add ``name``: an array of ``(at, h, near)`` that guarantees every run of ``span`` words.

    k-grams of half the span are hashed; each window of as many k-grams as fit into a span
    keeps its smallest hash (every place of it), so any two equal runs of ``span`` words share
    a kept hash at the same place. ``near`` holds the words of all spans around the k-gram, null
    beyond the text.
    A span below ``SPAN`` is the whole of a short item: then every k-gram of that length is kept.
    Of the kept hashes only those that pass the ``sieve`` get their words.
    """
    k = span // 2 if span == SPAN else span
    window = span - k + 1
    df = df.withColumn("g", F.transform("words", lambda w: F.xxhash64(w)))
    df = _sliding(df, "g", k, lambda x, y: F.xxhash64(x, y))
    df = df.withColumn("m", F.col("g"))
    if window > 1:
        df = _sliding(df, "m", window, lambda x, y: F.least(x, y))
        pad = F.array_repeat(F.lit(_LOW), window - 1)
        df = df.withColumn("m", F.when(F.size("m") > 0, F.concat(pad, "m", pad)).otherwise(F.col("m")))
        df = _sliding(df, "m", window, lambda x, y: F.greatest(x, y))
    # Element by element, as a slice inside a lambda would copy the whole text for each k-gram.
    near = lambda i: F.array(*[F.get("words", i + d) for d in range(1 - window, span)])
    kept = F.zip_with("g", "m", lambda x, y: F.when(x == y, F.xxhash64(x, F.lit(span))))
    found = F.transform(
        kept,
        lambda h, i: F.when(
            h.isNotNull() & _passes(sieve, h),
            F.struct(i.alias("at"), h.alias("h"), F.lit(span).alias("span"), near(i).alias("near")),
        ),
    )
    return df.withColumn(name, F.filter(found, lambda x: x.isNotNull())).drop("g", "m")


def item_prints(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """``(h, item_id, item_span, item_near)``: kept hashes of the items; their short lengths."""
    base = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    base = stage(base.withColumn("size", F.size("words")), "items")
    # At most nine short lengths exist, whatever the size of the benchmark.
    short = [r[0] for r in base.where(F.col("size") < SPAN).select("size").distinct().collect()]
    found = None
    for span in sorted([SPAN, *short]):
        fits = F.col("size") == span if span < SPAN else F.col("size") >= SPAN
        part = _prints(base.where(fits), "prints", span)
        part = part.select("item_id", F.inline_outer("prints"))
        part = part.select(
            "h", "item_id", F.col("span").alias("item_span"), F.col("near").alias("item_near")
        )
        found = part if found is None else found.union(part)
    found = found.withColumn("near_text", F.array_join("item_near", " "))
    return stage(found.drop("at"), "item-prints"), short


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(key, doc_id, n_words, n_hit, items, copies)`` per distinct ``(doc_id, text)``.

    ``docs (doc_id, text)``, ``items (item_id, text)``; other columns are ignored. A document
    word is hit inside any occurrence of a window: ``SPAN`` consecutive words of an item, or a
    whole shorter item. ``items`` holds the ids of the items with an occurring window, each
    once; an item without an id hits words but is not listed. ``copies`` counts equal rows.
    Null and empty texts have no words and no hits; empty tables give no rows or no hits.

    One pass over the texts: each document is exploded to those kept hashes that pass a sieve of
    the items' hashes, with the few words around each, plus one row that stands for the document.
    The hashes of the items are broadcast after their size is measured, otherwise joined by a
    shuffle; word by word comparison then settles each candidate. Only hits and one short row per document are
    shuffled to be counted.
    """
    known, short = item_prints(items)
    sieve = _sieve(known)
    base = docs.select("doc_id", row_key(docs).alias("key"), words(F.col("text")).alias("words"))
    names = []
    for span in sorted([SPAN, *short]):
        names.append(f"prints_{span}")
        base = _prints(base, names[-1], span, sieve)
    itself = F.array(
        F.struct(
            F.lit(-1).alias("at"),
            F.xxhash64("key").alias("h"),
            F.lit(0).alias("span"),
            F.lit(None).cast("array<string>").alias("near"),
        )
    )
    rows = base.select(
        "key", "doc_id", F.size("words").alias("n_words"), F.inline_outer(F.concat(itself, *names))
    )
    joined = rows.join(broadcast_if_measured(known, ["near_text"]), "h", "left")
    joined = joined.where((F.col("at") < 0) | (F.col("span") == F.col("item_span")))
    window = F.when(F.col("span") == SPAN, SPAN - SPAN // 2 + 1).otherwise(1)

    def occurs(o: Column) -> Column:
        ends = F.get("near", o).isNotNull() & F.get("near", o + F.col("span") - 1).isNotNull()
        here, there = (F.slice(c, o + 1, F.col("span")) for c in ("near", "item_near"))
        return ends & (here == there)

    found = F.when(F.col("at") >= 0, F.filter(F.sequence(F.lit(0), window - 1), occurs))
    start = F.col("at") - window + 1
    hits = joined.select(
        "key", "doc_id", "n_words", "at", "item_id",
        F.transform(
            found,
            lambda o: F.struct((start + o).alias("s"), (start + o + F.col("span")).alias("e")),
        ).alias("hits"),
    ).withColumn("item_id", F.when(F.size("hits") > 0, F.col("item_id")))
    counted = hits.where((F.col("at") < 0) | (F.size("hits") > 0)).groupBy("key").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(F.col("at") < 0, 1)).alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits"),
        F.collect_set("item_id").alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["e"]).alias("end"),
            (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("n"),
        ),
        lambda a: a["n"],
    )
    return counted.select("key", "doc_id", "n_words", covered.alias("n_hit"), "items", "copies")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, items, contaminated``."""
    found = contamination(docs, items)
    every = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return every.select("doc_id", "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns kept."""
    name = fresh("bad", docs)
    bad = contamination(docs, items).where("n_hit > 0").select(F.col("key").alias(name))
    return docs.join(bad, row_key(docs).eqNullSafe(F.col(name)), "left_anti")


def items_digest(items: Column) -> Column:
    ids = F.array_sort(F.transform(items, lambda x: x.cast("string")))
    return digest(F.array_join(ids, ","))
