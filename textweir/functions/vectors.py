"""Dense vectors as ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def unit(vector: str) -> Column:
    """Row scaled to length one; a zero row stays zero.

    Takes a column *name*: inside the lambda an expression would be evaluated per element.
    """
    length = norm(F.col(vector))
    scaled = F.zip_with(
        F.col(vector),
        F.array_repeat(length, F.size(vector)),
        lambda x, n: F.when(n > 0, x / n).otherwise(x),
    )
    return scaled


def summed(vector: Column, dims: int) -> Column:
    """Aggregate: element-wise sum of ``dims`` numbers, one plain sum per element."""
    return F.array(*[F.sum(F.get(vector, F.lit(i))) for i in range(dims)])
