"""Compression classifier: held-out accuracy and edge cases."""

import zlib

import numpy as np
import pytest
from cases import table, texts
from pyspark.sql import functions as F

from textweir.llm import quality, queries

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op8_quality"](spark, SF).toPandas().set_index("doc_id")
    marks = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    assert len(rows) == 10_000 and rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in rows.held_out.items())
    both = rows[rows.held_out].join(marks, how="inner")
    assert (both.predicted == both.quality).mean() > 0.95
    assert both.predicted[both.quality == 1].mean() > 0.985
    place = both.score.rank()
    good = both.quality.sum()
    area = (place[both.quality == 1].sum() - good * (good + 1) / 2) / (good * (len(both) - good))
    assert area > 0.97


def test_held_out_labels_are_not_learned(spark):
    """Turning round all labels of the held-out fifth changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality.fit(docs, labels) == quality.fit(docs, turned)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, score string")


def test_edge_cases(spark):
    rows = texts()
    df = table(spark, rows)
    marks = labels_of(spark, [(1, 1, ""), (2, 0, ""), (None, 1, ""), (3, None, ""), (7, 0, ""), (7, 0, ""),
                              (11, 1, ""), (9, 0, ""), (3, 1, ""), (6, 1, ""), (10, 0, "")])
    out = quality.classify(df, quality.fit(df, marks)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert set(out[0].asDict()) == {*df.columns, "predicted"}
    empty = {r.score for r in out if not r.text}
    assert len(empty) == 1


@pytest.mark.parametrize(("marks", "value"), [([], 0.5), ([(1, 1, "")], 1.0), ([(2, 0, "")], 0.0)])
def test_without_both_classes(spark, marks, value):
    df = table(spark)
    assert {r.score for r in quality.classify(df, quality.fit(df, labels_of(spark, marks))).collect()} == {value}


def test_empty_tables(spark):
    none = table(spark, [])
    assert quality.classify(none, quality.fit(none, labels_of(spark, [(1, 1, "")]))).count() == 0


def test_calibration_ascends():
    rng = np.random.default_rng(1)
    y = (rng.random(2000) < 0.8).astype(float)
    x = rng.normal(0, 1, 2000) + 2 * y
    knots, levels = quality.calibrate(x, y, np.ones(2000))
    assert knots == sorted(knots) and levels == sorted(levels)
    p = np.interp(x, knots, levels)
    assert abs(p.mean() - y.mean()) < 0.02
