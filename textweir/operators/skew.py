"""Joins whose frequent keys are dealt over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.session import broadcast_if_measured, stage

# Rows of one key that a task may join.
ROWS_PER_TASK = 1_000_000


def spread_join(
    many: DataFrame, few: DataFrame, key: str, rows: str, spread: Column, limit: int | None = None
) -> DataFrame:
    """``many`` joined by ``key`` to ``few``, which has each key once and tells by ``rows`` how
    many rows of ``many`` have it.

    A key with more than ``limit`` rows is cut into as many parts as needed: its row in ``few`` is
    repeated, its rows in ``many`` are dealt by a hash of ``spread``. All other keys keep one part,
    so neither side grows by more than its frequent keys. There are at most ``rows of many /
    limit`` frequent keys; their list is stored and measured before it is broadcast. Rows with a
    null or unknown key drop out, as in any inner join.
    """
    limit = limit or ROWS_PER_TASK
    parts = F.ceil(F.col(rows) / limit).cast("int")
    heavy = stage(few.where(F.col(rows) > limit).select(key, parts.alias("__parts")), "frequent-keys")
    heavy = broadcast_if_measured(heavy, [c for c, kind in heavy.dtypes if kind == "string"])
    part = F.pmod(F.xxhash64(spread), F.coalesce("__parts", F.lit(1)).cast("bigint")).cast("int")
    dealt = many.join(heavy, key, "left").withColumn("__part", part).drop("__parts")
    every = F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))
    return dealt.join(few.withColumn("__part", every), [key, "__part"]).drop("__part")
