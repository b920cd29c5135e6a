"""Small helpers shared by the operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def fresh(base: str, *frames: DataFrame) -> str:
    """A column name that starts with ``base`` and that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """``(doc_id, hash of doc_id and text)``: equal for equal pairs, nulls included."""
    return F.struct(
        F.col(doc_id).cast("string").alias("id"),
        F.xxhash64(F.col(doc_id), F.col(text), F.col(text).isNull()).alias("h"),
        F.length(text).alias("n"),
    )


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def lists(values, offsets, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the list borders."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def grouped(batches, key: str):
    """Tables of whole groups from record batches that come sorted by ``key``.

    Only the last, possibly unfinished group of a batch is held back, so memory holds one
    batch and one group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(keys.searchsorted(keys[-1]))
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        elif held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def shape(text: str) -> StructType:
    return StructType.fromDDL(text)


def hex_print(fingerprint: Column) -> Column:
    """Sixteen lowercase hex digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def below(h: Column, count: int, rows: int) -> Column:
    """True for about one and a half times ``rows`` of ``count`` signed 64-bit hashes.

    A first cut of a sample by smallest hash, so that sorting it moves a bounded number of
    rows, however many tasks there are.
    """
    if count <= 2 * rows:
        return F.lit(True)
    return h < -(1 << 63) + (3 * rows << 63) // count
