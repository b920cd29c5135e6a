"""Stored tables as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Chosen columns of a parquet table, split finely enough to keep all cores busy.

    A large table arrives in many splits and is left alone; one written as a single row
    group would otherwise be normalized by one task.
    """
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df
