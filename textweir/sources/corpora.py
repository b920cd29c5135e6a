"""Review and short-message corpora in one common form.

Both readers return ``(dataset, doc_id, text, label, raw_score)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweir.operators import labels, sampling

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("target", T.IntegerType()),
        T.StructField("tweet_id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("flag", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

REVIEW_FILE = "Reviews.csv"
MESSAGE_FILE = "training.1600000.processed.noemoticon.csv"

# Cell contents that count as missing in both CSV files.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _cell(name: str) -> Column:
    return F.when(~F.col(name).isin(MISSING_CELLS), F.col(name)).alias(name)


def read_reviews(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``(Id, Score, Summary, Text)`` of a CSV with a header; other columns are not parsed.

    Quoted line breaks need ``multiline``, which gives one task per *file*. Store large
    corpora as parquet once and use :func:`review_corpus` on that table.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .csv(path)
    )
    return raw.select(
        F.expr("try_cast(Id AS BIGINT)").alias("Id"),
        F.expr("try_cast(Score AS INT)").alias("Score"),
        _cell("Summary"),
        _cell("Text"),
    )


def read_messages(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The six columns of a Latin-1 CSV without header; ``date`` stays a string."""
    raw = (
        spark.read.schema(MESSAGE_SCHEMA)
        .option("header", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("encoding", "ISO-8859-1")
        .csv(path)
    )
    return raw.withColumn("text", _cell("text"))


def review_corpus(reviews: DataFrame, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Label reviews, dropping neutral scores.

    With ``sample``, only the first ``3 * sample`` rows by ``Id`` are looked at, before the
    neutral ones are dropped; ``sample`` of the rest are drawn. 0 or ``None`` means all.
    """
    if sample:
        reviews = sampling.head(reviews, 3 * sample, "Id")
    corpus = labels.label_reviews(reviews)
    return sampling.draw(corpus, sample, seed) if sample else corpus


def message_corpus(messages: DataFrame, sample: int | None = None) -> DataFrame:
    """Label messages by target; ``sample`` takes its halves from the two classes."""
    corpus = labels.label_messages(messages)
    if not sample:
        return corpus
    half = max(sample // 2, 1)
    return sampling.head_per_class(corpus, {0: half, 1: sample - half}, "doc_id")


def _load_reviews(spark, folder, sample, seed):
    return review_corpus(read_reviews(spark, f"{folder}/{REVIEW_FILE}"), sample, seed)


def _load_messages(spark, folder, sample, seed):
    return message_corpus(read_messages(spark, f"{folder}/{MESSAGE_FILE}"), sample)


DATASETS = {"amazon": _load_reviews, "sentiment140": _load_messages}


def load_dataset(
    spark: SparkSession, name: str, folder: str, sample: int | None = None, seed: int = 42
) -> DataFrame:
    """Read one of the known corpora from ``folder`` by name."""
    if name not in DATASETS:
        raise ValueError(f"Unknown dataset: {name}")
    return DATASETS[name](spark, folder.rstrip("/"), sample, seed)


def mode_for(dataset: str) -> str:
    """Normalization mode of a corpus: messages are tweets, everything else is standard."""
    return "tweet" if dataset == "sentiment140" else "standard"


def missing_text_for(dataset: str) -> str:
    """What a null text reads as: missing messages become the word ``nan``."""
    return "nan" if dataset == "sentiment140" else ""
