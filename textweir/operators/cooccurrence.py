"""Windowed co-occurrence of terms and positive pointwise mutual information."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textweir.operators.terms import ROW
from textweir.session import broadcast_if_bounded


def known_sequence(
    docs: DataFrame, vocabulary: DataFrame, max_rows: int | None, clean: str = "clean"
) -> DataFrame:
    """``(row_id, pos, term, term_id)`` of the known words, split at blanks only."""
    words = docs.select(ROW, F.posexplode(F.split(clean, " ")).alias("pos", "term"))
    ids = broadcast_if_bounded(vocabulary.select("term", "term_id"), max_rows)
    return words.join(ids, "term").select(ROW, "pos", "term", "term_id")


def cooccurrence(sequence: DataFrame, window: int = 4) -> DataFrame:
    """``(row_id, col_id, x)``: sum of 1/distance over both directions.

    Distance counts known words only. Each unordered pair is summed once, in whole
    multiples of 1/lcm, so half the pairs are shuffled and the result does not depend on
    the order of addition; the mirror image is added afterwards.
    """
    unit = math.lcm(*range(1, window + 1))
    order = Window.partitionBy(ROW).orderBy("pos")
    ahead = F.array(
        *[
            F.struct(
                F.lead("term_id", k).over(order).alias("other"),
                F.lit(unit // k).cast("bigint").alias("parts"),
            )
            for k in range(1, window + 1)
        ]
    )
    near = sequence.select("term_id", ahead.alias("ahead"))
    pairs = near.select("term_id", F.inline("ahead")).where("other IS NOT NULL")
    halves = (
        pairs.groupBy(
            F.least("term_id", "other").alias("low"), F.greatest("term_id", "other").alias("high")
        )
        .agg(F.sum("parts").alias("parts"))
        .select("low", "high", (F.col("parts") / F.lit(float(unit))).alias("x"))
    )
    # A pair of equal terms is seen from both ends, so it counts twice in its one cell.
    def cell(row: str, col: str, x: Column) -> Column:
        return F.struct(F.col(row).alias("row_id"), F.col(col).alias("col_id"), x.alias("x"))

    both = F.when(
        F.col("low") == F.col("high"), F.array(cell("low", "high", F.col("x") * 2))
    ).otherwise(F.array(cell("low", "high", F.col("x")), cell("high", "low", F.col("x"))))
    return halves.select(F.inline(both))


def ppmi(cells: DataFrame, max_rows: int | None) -> DataFrame:
    """``(row_id, col_id, x)`` with ``max(0, ln(x * total / (row * col)))``, zeros dropped.

    ``max_rows`` bounds the number of rows and of columns of the matrix.
    """
    rows = cells.groupBy("row_id").agg(F.sum("x").alias("row_sum"))
    cols = cells.groupBy("col_id").agg(F.sum("x").alias("col_sum"))
    total = rows.agg(F.sum("row_sum")).scalar()
    expected = F.greatest(F.col("row_sum") * F.col("col_sum"), F.lit(1e-12))
    return (
        cells.join(broadcast_if_bounded(rows, max_rows), "row_id")
        .join(broadcast_if_bounded(cols, max_rows), "col_id")
        .select("row_id", "col_id", F.log(F.col("x") * total / expected).alias("x"))
        .where("x > 0")
    )


def named_cells(cells: DataFrame, vocabulary: DataFrame, max_rows: int | None) -> DataFrame:
    """``(row_term, col_term, x)`` for cells by id."""

    def side(name: str) -> DataFrame:
        table = vocabulary.select(F.col("term_id").alias(f"{name}_id"), F.col("term").alias(name))
        return broadcast_if_bounded(table, max_rows)

    named = cells.join(
        side("row").withColumnRenamed("row", "row_term"), "row_id"
    ).join(side("col").withColumnRenamed("col", "col_term"), "col_id")
    return named.select("row_term", "col_term", "x")
