"""Nearest rows by cosine, mean vectors per document and the longest vectors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweir.functions.vectors import norm, summed
from textweir.operators.terms import ROW
from textweir.session import broadcast_if_bounded

# A task multiplies one block of vectors with one chunk of queries, of at most these bytes.
_BLOCK_BYTES = 64 * 1024 * 1024
_CHUNK_BYTES = 16 * 1024 * 1024
# Products that a task holds at once.
_PRODUCTS = 4_000_000


def _best_of_block(top_k: int):
    """Task function: for every query of a chunk the best ``top_k`` rows of a block."""

    def best(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            none = np.array([], dtype=object)
            return pd.DataFrame({"term": none, "neighbor": none, "score": np.array([])})
        rows = rows.sort_values("key")
        names, asked = rows["key"].to_numpy(), queries["asked"].to_numpy()
        left, right = np.stack(rows["vector"].to_numpy()), np.stack(queries["wish"].to_numpy())
        found = []
        step = max(1, _PRODUCTS // len(left))
        for start in range(0, len(right), step):
            # Rounded, so that equal vectors tie wherever they are multiplied.
            scores = np.round(right[start : start + step] @ left.T, 12)
            mine = names[None, :] == asked[start : start + step, None]
            scores[mine] = -np.inf
            keep = min(top_k, scores.shape[1])
            least = np.partition(scores, -keep, axis=1)[:, -keep]
            query, row = np.nonzero((scores >= least[:, None]) & ~mine)
            # Rows lie in key order, so ties go by key.
            order = np.lexsort((row, -scores[query, row], query))
            query, row = query[order], row[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            query, row = query[place < top_k], row[place < top_k]
            found.append(
                pd.DataFrame(
                    {
                        "term": asked[start + query],
                        "neighbor": names[row],
                        "score": scores[query, row],
                    }
                )
            )
        return pd.concat(found)

    return best


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    top_k: int = 10,
    key: str = "term",
    vector: str = "embedding",
) -> DataFrame:
    """``(term, neighbor, score, rank)``: the ``top_k`` rows of largest dot product.

    ``vectors`` holds unit rows with unique keys, so the product is the cosine. ``queries``
    lists keys; unknown ones give no rows, and a row is not its own neighbor. Ties go by
    key. Blocks of vectors meet chunks of queries, and only the best rows of each block go
    on per query, so no table of pairs is formed.
    """
    spark = vectors.sparkSession
    table = vectors.select(
        F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")
    )
    wanted = table.join(queries.select(F.col(key).alias("key")).distinct(), "key", "left_semi")
    entries = table.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()[0]
    asked = wanted.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()[0]
    blocks = max(spark.sparkContext.defaultParallelism, math.ceil(8 * entries / _BLOCK_BYTES))
    chunks = max(1, math.ceil(8 * asked / _CHUNK_BYTES))

    def slot(count: int) -> Column:
        return F.pmod(F.hash("key"), F.lit(count))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = table.withColumn("block", slot(blocks)).withColumn("chunk", every(chunks))
    right = wanted.select(
        F.col("key").alias("asked"), F.col("vector").alias("wish"), slot(chunks).alias("chunk")
    ).withColumn("block", every(blocks))
    key_type = table.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("term", key_type),
            T.StructField("neighbor", key_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    found = (
        left.groupBy("block", "chunk")
        .cogroup(right.groupBy("block", "chunk"))
        .applyInPandas(_best_of_block(top_k), schema)
    )
    order = Window.partitionBy("term").orderBy(F.desc("score"), "neighbor")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top_k)


def _weighted_sums(dims: int):
    """Task function: for each stretch of one row's words the sum of their vectors, each times its count.

    A missing vector or element adds nothing; a sum of nothing is null. Words count in any case.
    """

    def add(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            row, lists = batch.column(ROW), batch.column("embedding")
            n = batch.column("n").to_numpy(zero_copy_only=False)
            keys = row.to_numpy(zero_copy_only=False)
            starts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1]
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            valid = None
            if flat.null_count or (sizes != dims).any():
                # Elements of any length in their places, the others null.
                place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                used = (place < dims) & flat.is_valid().to_numpy(zero_copy_only=False)
                at = (np.repeat(np.arange(len(sizes)), sizes)[used], place[used])
                x, valid = np.zeros((len(sizes), dims)), np.zeros((len(sizes), dims), bool)
                x[at], valid[at] = flat.to_numpy(zero_copy_only=False)[used], True
            else:
                x = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)
            total = np.add.reduceat(x * n[:, None], starts, axis=0).ravel()
            none = None if valid is None else ~np.logical_or.reduceat(valid, starts, axis=0).ravel()
            ends = np.arange(0, len(total) + 1, dims, dtype="int32")
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(total, mask=none))
            columns = [row.take(pa.array(starts)), found, pa.array(np.add.reduceat(n, starts))]
            yield pa.RecordBatch.from_arrays(columns, names=[ROW, "total", "words"])

    return add


def mean_embedding(
    docs: DataFrame, vectors: DataFrame, dims: int, max_rows: int | None, clean: str = "clean"
) -> DataFrame:
    """``(row_id, doc_id, embedding)``: mean over the known words, repeated words counting again.

    Words are split at blanks and counted before their vectors are joined; a document without
    known words gets the zero vector.
    """
    words = docs.select(ROW, F.explode(F.split(clean, " ")).alias("term"))
    counts = words.groupBy(ROW, "term").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions(ROW)
    table = broadcast_if_bounded(vectors.select("term", "embedding"), max_rows, 8 * dims + 64)
    known = counts.join(table, "term").select(ROW, "n", "embedding")
    kind = known.schema[ROW].dataType.simpleString()
    partial = known.mapInArrow(_weighted_sums(dims), f"{ROW} {kind}, total array<double>, words bigint")
    totals = partial.groupBy(ROW).agg(summed(F.col("total"), dims).alias("total"), F.sum("words").alias("words"))
    mean = F.zip_with(
        "total", F.array_repeat(F.col("words").cast("double"), dims), lambda total, n: total / n
    )
    means = totals.select(ROW, mean.alias("mean"))
    zeros = F.array_repeat(F.lit(0.0), dims)
    return (
        docs.select(ROW, "doc_id")
        .join(means, ROW, "left")
        .select(ROW, "doc_id", F.coalesce("mean", zeros).alias("embedding"))
    )


def longest(vectors: DataFrame, n: int, key: str = "term", vector: str = "embedding") -> DataFrame:
    """The ``n`` rows of largest norm, ties by key."""
    measured = vectors.select(key, norm(F.col(vector)).alias("norm"))
    return measured.orderBy(F.desc("norm"), key).limit(n)
