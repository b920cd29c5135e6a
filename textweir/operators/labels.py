"""Label derivation, corpus projection and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_neutral(reviews: DataFrame, score: str = "Score") -> DataFrame:
    """Drop score 3. Rows without a score stay."""
    return reviews.where(~F.col(score).eqNullSafe(F.lit(3)))


def threshold_label(score: Column) -> Column:
    """1 for a score of 4 or more, else 0; no score counts as 0."""
    return F.coalesce(score >= 4, F.lit(False)).cast("int")


def equality_label(target: Column) -> Column:
    return F.coalesce(target == 4, F.lit(False)).cast("int")


def joined_text(*parts: Column) -> Column:
    """Parts joined by a space, nulls as empty, trimmed of all Unicode white space."""
    text = F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def label_reviews(reviews: DataFrame, dataset: str = "amazon") -> DataFrame:
    """``(Id, Score, Summary, Text)`` to the common corpus form."""
    return drop_neutral(reviews).select(
        F.lit(dataset).alias("dataset"),
        F.col("Id").alias("doc_id"),
        joined_text(F.col("Summary"), F.col("Text")).alias("text"),
        threshold_label(F.col("Score")).alias("label"),
        F.col("Score").alias("raw_score"),
    )


def label_messages(messages: DataFrame, dataset: str = "sentiment140") -> DataFrame:
    """Messages with target 0 or 4 to the common corpus form."""
    return messages.where(F.col("target").isin(0, 4)).select(
        F.lit(dataset).alias("dataset"),
        F.col("tweet_id").alias("doc_id"),
        "text",
        equality_label(F.col("target")).alias("label"),
        F.col("target").alias("raw_score"),
    )


def with_sentiment(df: DataFrame, sentiment: str | None) -> DataFrame:
    """Keep one class for ``positive``/``negative``; any other value keeps all rows."""
    if sentiment not in ("positive", "negative"):
        return df
    return df.where(F.col("label") == (1 if sentiment == "positive" else 0))
