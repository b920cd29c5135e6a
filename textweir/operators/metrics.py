"""Class weights, binary metrics, per-class report and summaries of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, weight)`` with balanced weights: rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    rows = totals.select("rows").scalar()
    classes = totals.select("classes").scalar()
    return sizes.withColumn("weight", rows / (classes * F.col("n")))


def _share(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where undefined."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _confusion(label: str, prediction: str, positive: int) -> list[Column]:
    actual, said = F.col(label) == positive, F.col(prediction) == positive
    return [
        F.count_if(actual & said).alias("hit"),
        F.count_if(said).alias("said"),
        F.count_if(actual).alias("actual"),
    ]


def _scores(hit: str, said: str, actual: str) -> tuple[Column, Column, Column]:
    hits, told, real = F.col(hit), F.col(said), F.col(actual)
    return _share(hits, told), _share(hits, real), _share(2 * hits, told + real)


def binary_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``(accuracy, precision, recall, f1, rows)`` for class 1, per group of ``by``."""
    right = F.count_if(F.col(label) == F.col(prediction)).alias("right")
    counts = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), right, *_confusion(label, prediction, 1)
    )
    precision, recall, f1 = _scores("hit", "said", "actual")
    return counts.select(
        *by,
        _share(F.col("right"), F.col("rows")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        "rows",
    )


def class_report(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction",
    names: tuple[str, str] = ("negative", "positive"),
) -> DataFrame:
    """``(class, precision, recall, f1, support)`` for both classes, then the summary rows
    ``accuracy``, ``macro avg`` and ``weighted avg``. One pass over the predictions.
    """
    right = F.count_if(F.col(label) == F.col(prediction)).alias("right")
    parts = [c.alias(f"{n}{i}") for i in (0, 1) for c, n in zip(
        _confusion(label, prediction, i), ("hit", "said", "actual"), strict=True
    )]
    counts = predictions.agg(F.count(F.lit(1)).alias("rows"), right, *parts)
    per_class = [_scores(f"hit{i}", f"said{i}", f"actual{i}") for i in (0, 1)]
    support = [F.col("actual0"), F.col("actual1")]
    rows = F.col("rows")

    def line(name: str, precision: Column, recall: Column, f1: Column, size: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            size.alias("support"),
        )

    accuracy = _share(F.col("right"), rows)
    macro = [(a + b) / F.lit(2.0) for a, b in zip(*per_class, strict=True)]
    weighted = [
        _share(a * support[0] + b * support[1], support[0] + support[1])
        for a, b in zip(*per_class, strict=True)
    ]
    lines = [line(names[i], *per_class[i], support[i]) for i in (0, 1)]
    lines.append(line("accuracy", accuracy, accuracy, accuracy, rows))
    lines.append(line("macro avg", *macro, rows))
    lines.append(line("weighted avg", *weighted, rows))
    return counts.select(F.inline(F.array(*lines)))


def run_summary(runs: DataFrame, vocabulary: bool = True) -> DataFrame:
    """``(rows, best_f1, best_accuracy[, best_vocabulary_size])``, each maximum on its own."""
    best = [
        F.count(F.lit(1)).alias("rows"),
        F.max("f1").alias("best_f1"),
        F.max("accuracy").alias("best_accuracy"),
    ]
    if vocabulary:
        best.append(F.max("vocabulary_size").alias("best_vocabulary_size"))
    return runs.agg(*best)
