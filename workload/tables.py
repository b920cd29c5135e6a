"""The test tables seen as the corpora the library works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators import labels
from textweir.sources.tables import read_table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", "doc_id", "text")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, text)``: the address and the markup of each page."""
    table = read_table(spark, f"{sf}/pages.parquet", "page_id", "url", "html")
    return table.select(
        F.col("page_id").alias("doc_id"), F.concat_ws(" ", "url", "html").alias("text")
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """``(Id, Score, Summary, Text)``: a 1-5 score where labels exist, null elsewhere; a
    null summary for one language."""
    docs = read_table(spark, f"{sf}/documents.parquet", "doc_id", "lang", "text")
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    score = F.lit(1) + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))
    return docs.join(marks, "doc_id", "left").select(
        F.col("doc_id").alias("Id"),
        score.alias("Score"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("Summary"),
        F.col("text").alias("Text"),
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_reviews(reviews(spark, sf))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, text, label)`` of the documents that have a quality label."""
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    return documents(spark, sf).join(marks, "doc_id").select(
        "doc_id", "text", F.col("quality").alias("label")
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as messages: users positive, assistants negative, others neither."""
    turns = read_table(spark, f"{sf}/conversations.parquet", "conv_id", "turn", "role", "text")
    return turns.select(
        F.when(F.col("role") == "user", 4).when(F.col("role") == "assistant", 0).otherwise(2)
        .alias("target"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("tweet_id"),
        F.col("turn").cast("string").alias("date"),
        F.lit("NO_QUERY").alias("flag"),
        F.col("role").alias("user"),
        "text",
    )


def short_texts(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, text, label)`` of the messages."""
    return labels.label_messages(messages(spark, sf)).select("doc_id", "text", "label")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Search requests from all benchmark texts; a rule makes some of them invalid."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    kind = F.col("item_id") % 5
    return items.select(
        F.col("item_id").alias("query_id"),
        F.when(F.col("item_id") % 11 == 10, "").otherwise(F.col("text")).alias("query"),
        F.when(kind == 1, "positive").when(kind == 2, "negative").when(kind == 3, "neutral")
        .alias("sentiment"),
        (F.col("item_id") % 53).cast("int").alias("top_k"),
    )


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction table by rule: quality is the label, freedom of toxicity the prediction."""
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    return marks.select(
        "doc_id", F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
    )


def term_vectors(spark: SparkSession, sf: str, vocabulary: DataFrame) -> DataFrame:
    """``(term, embedding)``: every vocabulary term gets a vector of the table, in turn."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    count = table.count()
    vectors = table.select(
        F.col("vec_id").alias("turn"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    turned = vocabulary.withColumn("turn", (F.col("term_id") % count).cast("bigint"))
    return turned.join(vectors, "turn").select("term", "embedding")
