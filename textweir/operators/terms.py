"""Vocabulary tokens, n-grams, term counts and the vocabulary.

A document is a row: ``row_id`` tells rows apart, and ``doc_id``, which may repeat, is carried
along. Documents are spread by row once, as compact clean text (:func:`by_document`).
Everything keyed by row afterwards (counts, lengths, norms, windows) reuses that partitioning,
so long-form rows cross the network only as partial sums per term.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textweir.operators.skew import spread_join
from textweir.session import broadcast_fits, broadcast_if_bounded, broadcast_if_measured, free_shuffles, stage

ROW = "row_id"
# Clean text that one task counts, as every occurrence of a term costs some hundred bytes there;
# and the least that is worth a task of its own.
TASK_BYTES = 4 * 1024 * 1024
_LEAST_BYTES = 256 * 1024
_PART = "__part"
_NOT_WORD = r"[^\p{L}\p{N}_]+"


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, ``row_id``, unless it has one.

    Store the result (``stage``) where it is read more than once, so the numbers stay.
    """
    return docs if ROW in docs.columns else docs.withColumn(ROW, F.monotonically_increasing_id())


def task_count(docs: DataFrame) -> int:
    """Tasks that count the ``clean`` text of stored ``docs``, each about ``TASK_BYTES`` of it."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("clean")), F.lit(0))).first()[0]
    tasks = min(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(size / _LEAST_BYTES))
    return max(1, tasks, math.ceil(size / TASK_BYTES))


def by_document(docs: DataFrame, *columns: str, tasks: int | None = None) -> DataFrame:
    """``row_id``, ``doc_id``, ``clean`` and the named columns of stored ``docs``, spread by row.

    The text is measured first, unless ``tasks`` is known: a task gets about ``TASK_BYTES`` of it,
    however much there is, so its counts, sorts and windows stay in memory.
    """
    tasks = tasks or task_count(docs)
    return identified(docs).select(ROW, "doc_id", "clean", *columns).repartition(tasks, ROW)


def by_part(docs: DataFrame, tasks: int) -> DataFrame:
    """Clean text of ``docs``, dealt by row to ``tasks`` numbered parts that later sums may name."""
    part = F.pmod(F.xxhash64(ROW), F.lit(tasks)).cast("int").alias(_PART)
    return identified(docs).select(part, "clean").repartitionById(tasks, _PART)


def vocabulary_tokens(clean: Column) -> Column:
    """Second tokenization of clean text: lower-case words of two or more characters."""
    words = F.split(F.regexp_replace(F.lower(clean), _NOT_WORD, " "), " ")
    return F.filter(words, lambda word: F.length(word) >= 2)


def ngrams(tokens: str, lowest: int, highest: int) -> Column:
    """All n-grams of a token array *column*, joined by spaces."""
    words = F.col(tokens)
    grams, parts = words, []
    for n in range(1, highest + 1):
        if n > 1:
            room = F.greatest(F.size(words) - F.lit(n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, F.lit(1), room),
                F.slice(words, F.lit(n), room),
                lambda left, right: F.concat(left, F.lit(" "), right),
            )
        if n >= lowest:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def document_terms(
    docs: DataFrame, ngram_range: tuple[int, int] = (1, 1), carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(row_id, doc_id, term)`` and the carried columns, one row per n-gram occurrence."""
    keys = (ROW, "doc_id", *carry)
    words = identified(docs).select(*keys, vocabulary_tokens(F.col("clean")).alias("words"))
    return words.select(*keys, F.explode(ngrams("words", *ngram_range)).alias("term"))


def term_counts(
    docs: DataFrame, ngram_range: tuple[int, int] = (1, 1), carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(row_id, doc_id, term, tf)`` and carried document columns.

    Without a shuffle when ``docs`` comes from :func:`by_document`.
    """
    terms = document_terms(docs, ngram_range, carry)
    return terms.groupBy(ROW, "doc_id", *carry, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_statistics(
    docs: DataFrame, ngram_range: tuple[int, int] = (1, 1), tasks: int | None = None
) -> DataFrame:
    """``(term, df, cf)``: documents holding the term, and its occurrences.

    Each document sorts its own n-grams, so the first of a run counts the document. Terms
    then need one aggregation with partial sums, and no table of (document, term) pairs. A task
    keeps its terms in memory. With a number of ``tasks`` the documents are dealt to these by
    :func:`by_part`, unless they are already, and the sums by term have as many; without, ``docs`` of
    :func:`by_document` bound what a task keeps, and the sums by term have the session's number of
    tasks, and grow with the text.
    """
    if tasks and _PART not in docs.columns:
        docs = by_part(docs, tasks)
    part = F.col(_PART) if tasks else F.lit(0)
    words = docs.select(part.alias("part"), vocabulary_tokens(F.col("clean")).alias("words"))
    grams = words.select("part", F.sort_array(ngrams("words", *ngram_range)).alias("grams"))
    before = F.slice(
        F.concat(F.array(F.lit(None).cast("string")), "grams"), F.lit(1), F.size("grams")
    )
    marked = F.zip_with(
        "grams",
        before,
        lambda term, last: F.struct(
            term.alias("term"), F.when(term.eqNullSafe(last), 0).otherwise(1).alias("first")
        ),
    )
    sums = (F.sum("first").alias("df"), F.count(F.lit(1)).alias("cf"))
    if not tasks:
        return grams.select(F.inline(marked)).groupBy("term").agg(*sums)
    # The first sums stay in the task of their part, so that the second shuffle can be dealt.
    partial = grams.select("part", F.inline(marked))
    partial = partial.groupBy("part", "term").agg(*sums).repartition(tasks, "term")
    return partial.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def count_documents(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery."""
    return docs.agg(F.count(F.lit(1))).scalar()


def prune(
    stats: DataFrame, n_docs: Column | int | None, min_df: int | float, max_features: int | None
) -> DataFrame:
    """Keep terms in ``min_df`` documents (a float is a share of ``n_docs``), then the
    ``max_features`` most frequent ones, ties by term.

    The cut is found from the histogram of frequencies first, so the final ranking sees
    little more than ``max_features`` rows, not the whole vocabulary.
    """
    if isinstance(min_df, float):
        if n_docs is None:
            raise ValueError("a fractional min_df needs n_docs")
        kept = stats.where(F.col("df") >= F.lit(min_df) * n_docs)
    else:
        kept = stats.where(F.col("df") >= min_df)
    if max_features is None:
        return kept
    upto = F.sum("terms").over(Window.orderBy(F.desc("cf")))
    lowest = (
        kept.groupBy("cf")
        .agg(F.count(F.lit(1)).alias("terms"))
        .withColumn("upto", upto)
        .where(F.col("upto") >= max_features)
        .agg(F.coalesce(F.max("cf"), F.lit(0)))
        .scalar()
    )
    return kept.where(F.col("cf") >= lowest).orderBy(F.desc("cf"), "term").limit(max_features)


def term_index(vocabulary: DataFrame, bounded: bool) -> DataFrame:
    """Add ``term_id``, the dense rank of the term in alphabetical order, from 0.

    A vocabulary cut to ``max_features`` is numbered in one window. An uncut one is stored
    in term ranges of even size, each numbered on its own after the rows of the ranges
    before it.
    """
    if bounded:
        rank = F.row_number().over(Window.orderBy("term"))
        return vocabulary.withColumn("term_id", (rank - 1).cast("int"))
    ranges = vocabulary.repartitionByRange("term").withColumn("part", F.spark_partition_id())
    ranges = stage(ranges, "term-ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("term"))
    # One row per partition of the stored ranges, so the broadcast is small.
    return (
        ranges.withColumn("rank", rank)
        .join(F.broadcast(starts), "part")
        .withColumn("term_id", (F.col("start") + F.col("rank") - 1).cast("int"))
        .drop("part", "start", "rank")
    )


def fit_vocabulary(
    stats: DataFrame,
    n_docs: Column | int | None = None,
    min_df: int | float = 2,
    max_features: int | None = 100_000,
) -> DataFrame:
    """``(term, term_id, df, cf)`` from term statistics."""
    kept = prune(stats, n_docs, min_df, max_features)
    indexed = term_index(kept, max_features is not None)
    return indexed.select("term", "term_id", "df", "cf")


def known_counts(
    docs: DataFrame,
    vocabulary: DataFrame,
    ngram_range: tuple[int, int],
    max_rows: int | None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(row_id, doc_id, term_id, tf)``, carried columns and the vocabulary columns but ``term``
    and ``cf``.

    Unknown n-grams, most of the distinct ones, drop out before anything is counted, and
    the counting keys are numbers. ``max_rows`` bounds the vocabulary: within the broadcast
    limit the documents stay where they are. Beyond it n-grams meet the vocabulary by term, and
    the frequent terms, by their ``cf``, are dealt over several tasks. Without ``max_rows`` the
    vocabulary's own hint decides.
    """
    keys = [c for c in vocabulary.columns if c not in ("term", "cf")]
    grams = document_terms(docs, ngram_range, carry)
    if "cf" in vocabulary.columns and max_rows is not None and not broadcast_fits(max_rows):
        known = spread_join(grams, vocabulary, "term", "cf", F.col(ROW))
    else:
        known = grams.join(broadcast_if_bounded(vocabulary, max_rows), "term")
    return known.groupBy(ROW, "doc_id", *carry, *keys).agg(F.count(F.lit(1)).alias("tf"))


def named(rows: DataFrame, vocabulary: DataFrame, max_rows: int | None) -> DataFrame:
    """Add ``term`` to rows with a ``term_id``."""
    names = vocabulary.select("term_id", "term")
    return rows.join(broadcast_if_bounded(names, max_rows), "term_id")


@dataclass(frozen=True)
class FittedTerms:
    """A stored vocabulary ``(term, term_id, df, cf)`` and the corpus totals behind it.

    ``vocab`` carries a broadcast hint if its measured size allows one.
    """

    vocab: DataFrame
    size: int
    total: int
    n_docs: int

    @property
    def avgdl(self) -> float:
        """Mean document length in known n-grams; documents without any count as well.

        The total over all documents is the total frequency of the vocabulary.
        """
        return self.total / self.n_docs if self.n_docs else 0.0


def fit_terms(
    docs: DataFrame,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int | float = 2,
    max_features: int | None = 100_000,
) -> FittedTerms:
    """Fit and store the vocabulary of stored clean text ``(doc_id, clean)``."""
    n_docs = docs.count()
    tasks = task_count(docs)
    stats = term_statistics(by_part(docs, tasks), ngram_range, tasks)
    vocab = stage(fit_vocabulary(stats, n_docs, min_df, max_features), "vocab")
    del stats
    free_shuffles(docs.sparkSession)
    size, total = vocab.agg(F.count(F.lit(1)), F.coalesce(F.sum("cf"), F.lit(0))).first()
    return FittedTerms(broadcast_if_measured(vocab, ["term"]), size, total, n_docs)
