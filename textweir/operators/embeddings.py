"""Word embeddings from PPMI co-occurrence or from the TF-IDF matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.functions.vectors import unit
from textweir.operators import cooccurrence, terms, weights
from textweir.operators.svd import truncated_svd
from textweir.session import stage


@dataclass(frozen=True)
class WordVectors:
    """``vectors`` (term, term_id, embedding), with their number and dimension."""

    vectors: DataFrame
    rows: int
    dims: int


def _attach(vocab: DataFrame, rows: DataFrame) -> DataFrame:
    # Both sides are one row per vocabulary term and stored, so Spark sees their sizes.
    return vocab.select("term", F.col("term_id").alias("row_id")).join(rows, "row_id").select(
        "term", F.col("row_id").alias("term_id"), "embedding"
    )


def fit_word_vectors(
    docs: DataFrame,
    dims: int = 100,
    window: int = 4,
    max_features: int | None = 20_000,
    min_df: int | float = 2,
    seed: int = 42,
    stats: DataFrame | None = None,
) -> WordVectors:
    """Unit word vectors from documents spread by :func:`terms.by_document`.

    Vocabulary, windowed co-occurrence, PPMI, truncated SVD, rows scaled to length one. ``stats``
    are the documents' :func:`terms.term_statistics`, where they are stored already.
    """
    n_docs = terms.count_documents(docs) if isinstance(min_df, float) else None
    stats = terms.term_statistics(docs) if stats is None else stats
    vocab = stage(terms.fit_vocabulary(stats, n_docs, min_df, max_features), "vocab")
    size = vocab.count()
    sequence = cooccurrence.known_sequence(docs, vocab, size)
    cells = stage(cooccurrence.cooccurrence(sequence, window), "cooccurrence")
    matrix = stage(cooccurrence.ppmi(cells, size), "ppmi")
    rank = min(dims, max(1, size - 1))
    rows, _ = truncated_svd(matrix, size, rank, seed=seed, symmetric=True)
    rows = rows.select("row_id", unit("embedding").alias("embedding"))
    return WordVectors(stage(_attach(vocab, rows), "word-vectors"), size, rank)


def fit_term_document_vectors(
    docs: DataFrame,
    n_docs: int,
    dims: int = 100,
    max_features: int | None = 20_000,
    min_df: int | float = 2,
    seed: int = 42,
) -> WordVectors:
    """Term vectors from the transposed unigram TF-IDF matrix; rows are not rescaled."""
    stats = terms.term_statistics(docs)
    vocab = stage(terms.fit_vocabulary(stats, n_docs, min_df, max_features), "vocab")
    size = vocab.count()
    cells = weights.tfidf(docs, vocab, (1, 1), n_docs, size).select(
        F.col("term_id").alias("row_id"), F.col("row_id").alias("col_id"),
        F.col("weight").alias("x"),
    )
    rank = min(dims, max(2, n_docs - 1), size)
    rows, _ = truncated_svd(stage(cells, "tfidf-cells"), size, rank, seed=seed)
    return WordVectors(stage(_attach(vocab, rows), "term-vectors"), size, rank)
