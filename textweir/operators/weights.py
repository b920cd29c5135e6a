"""Bag of words, TF-IDF and BM25 weights in long form.

All take documents spread by :func:`terms.by_document` and a vocabulary
``(term, term_id, df, cf)`` of at most ``max_rows`` rows, and return
``(row_id, doc_id, term_id, weight)``. :func:`terms.named` adds the term itself where it is shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from textweir.operators.terms import ROW, known_counts


def _per_document() -> WindowSpec:
    return Window.partitionBy(ROW)


def _frequency(vocabulary: DataFrame) -> list[str]:
    """By which frequent terms are known, where the vocabulary tells."""
    return [c for c in ("cf",) if c in vocabulary.columns]


def bag_of_words(
    docs: DataFrame, vocabulary: DataFrame, ngram_range: tuple[int, int], max_rows: int | None
) -> DataFrame:
    """Raw counts."""
    counts = known_counts(docs, vocabulary.select("term", "term_id", *_frequency(vocabulary)), ngram_range, max_rows)
    return counts.select(ROW, "doc_id", "term_id", F.col("tf").cast("double").alias("weight"))


def tfidf_idf(df: Column, n_docs: Column | int) -> Column:
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def tfidf(
    docs: DataFrame,
    vocabulary: DataFrame,
    ngram_range: tuple[int, int],
    n_docs: Column | int,
    max_rows: int | None,
) -> DataFrame:
    """Count times smoothed idf, rows scaled to length one."""
    idf = tfidf_idf(F.col("df"), n_docs).alias("idf")
    known = vocabulary.select("term", "term_id", idf, *_frequency(vocabulary))
    counts = known_counts(docs, known, ngram_range, max_rows)
    raw = counts.select(ROW, "doc_id", "term_id", (F.col("tf") * F.col("idf")).alias("x"))
    length = F.sqrt(F.sum(F.col("x") * F.col("x")).over(_per_document()))
    return raw.select(ROW, "doc_id", "term_id", (F.col("x") / length).alias("weight"))


def bm25_idf(df: Column, n_docs: Column | int) -> Column:
    return F.log((n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)) + F.lit(1.0))


def document_lengths(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(row_id, doc_id, doc_len)``; 0 for documents without a known term."""
    lengths = counts.groupBy(ROW).agg(F.sum("tf").alias("doc_len"))
    return (
        docs.select(ROW, "doc_id")
        .join(lengths, ROW, "left")
        .select(ROW, "doc_id", F.coalesce("doc_len", F.lit(0)).alias("doc_len"))
    )


def bm25(
    docs: DataFrame,
    vocabulary: DataFrame,
    ngram_range: tuple[int, int],
    n_docs: Column | int,
    avgdl: float,
    max_rows: int | None,
    k1: float = 1.5,
    b: float = 0.75,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(row_id, doc_id, term_id, tf, weight)`` and carried columns, by the fitted statistics."""
    idf = bm25_idf(F.col("df"), n_docs).alias("idf")
    known = vocabulary.select("term", "term_id", idf, *_frequency(vocabulary))
    counts = known_counts(docs, known, ngram_range, max_rows, carry)
    lengths = counts.withColumn("doc_len", F.sum("tf").over(_per_document()))
    share = F.lit(1.0 - b) + F.lit(b) * F.col("doc_len") / F.lit(max(float(avgdl), 1e-12))
    saturated = F.col("tf") * F.lit(k1 + 1.0) / (F.col("tf") + F.lit(k1) * share)
    weight = (F.col("idf") * saturated).alias("weight")
    return lengths.select(ROW, "doc_id", *carry, "term_id", "tf", weight)
