"""Nearest-word report and term embeddings of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.operators import embeddings, nearest, terms
from textweir.plans.training import normalizer_for
from textweir.session import stage


def clean_documents(corpus: DataFrame, dataset: str, reduction: str = "lemma") -> DataFrame:
    """Normalized text, spread by document and stored: the fits read it several times."""
    clean = normalizer_for(dataset, reduction).apply(corpus.select("doc_id", "text"))
    return terms.by_document(stage(terms.identified(clean).select(terms.ROW, "doc_id", "clean"), "clean"))


def nearest_words(
    corpus: DataFrame,
    dataset: str,
    words: DataFrame,
    top_k: int = 10,
    reduction: str = "lemma",
    **fit,
) -> DataFrame:
    """``(dataset, term, neighbor, cosine_similarity)`` for the terms of ``words``."""
    return nearest_of(clean_documents(corpus, dataset, reduction), dataset, words, top_k, **fit)


def nearest_of(
    clean: DataFrame, dataset: str, words: DataFrame, top_k: int = 10, **fit
) -> DataFrame:
    """The same from documents of :func:`clean_documents`."""
    fitted = embeddings.fit_word_vectors(clean, **fit)
    found = nearest.nearest(fitted.vectors, words, top_k)
    return found.select(
        F.lit(dataset).alias("dataset"), "term", "neighbor",
        F.col("score").alias("cosine_similarity"),
    )


def term_embeddings(
    corpus: DataFrame, dataset: str, reduction: str = "lemma", **fit
) -> embeddings.WordVectors:
    """Term vectors of the transposed TF-IDF matrix, ready for the wide parquet sink."""
    docs = clean_documents(corpus, dataset, reduction)
    return embeddings.fit_term_document_vectors(docs, docs.count(), **fit)
