"""Session settings, shared scratch tables and size-checked broadcasts."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A side is broadcast only when its row count is known to stay below this limit ...
BROADCAST_ROWS = 1_000_000
# ... and, where its bytes are measured, below this one.
BROADCAST_BYTES = 256 * 1024 * 1024


def build_session(app: str = "textweir", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master without that setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="textweir-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Paths to delete by thread; a plain dict, as functions of the package travel by value.
_scopes: dict[int, list[str]] = {}


@contextmanager
def staging(spark: SparkSession):
    """Delete what ``stage`` writes inside the block when it ends.

    For work that is finished within the block: a micro-batch, a written result.
    """
    thread = threading.get_ident()
    outer, _scopes[thread] = _scopes.get(thread), []
    try:
        yield
    finally:
        for path in _scopes.pop(thread):
            discard(spark, path)
        if outer is not None:
            _scopes[thread] = outer


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stored table, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def unstage(table: DataFrame) -> None:
    """Remove a table of ``stage`` that nothing reads any more."""
    for folder in {os.path.dirname(f) for f in table.inputFiles()}:
        discard(table.sparkSession, folder)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished work now.

    It does so when the driver collects the tables that made them, which may take half an hour: until
    then the files of all steps so far lie on the disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, as ``schema`` if given.

    Cuts the lineage, survives lost executors and lets several jobs read one result. Inside a
    ``staging`` block the table goes when the block ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if threading.get_ident() in _scopes:
        _scopes[threading.get_ident()].append(path)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def broadcast_fits(max_rows: int | None, row_bytes: int = 64) -> bool:
    """Whether ``max_rows`` rows of about ``row_bytes`` may be broadcast; unknown numbers may not."""
    return max_rows is not None and max_rows <= BROADCAST_ROWS and max_rows * row_bytes <= BROADCAST_BYTES


def broadcast_if_bounded(df: DataFrame, max_rows: int | None, row_bytes: int = 64) -> DataFrame:
    """Broadcast hint when ``max_rows`` rows of about ``row_bytes`` are small, else Spark's choice."""
    return F.broadcast(df) if broadcast_fits(max_rows, row_bytes) else df


def broadcast_if_measured(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """Broadcast hint for a stored table whose rows and string bytes are counted first."""
    size = sum((F.octet_length(c) for c in text_columns), F.lit(0))
    rows, text_bytes = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    width = 16 * len(df.columns)
    if rows <= BROADCAST_ROWS and text_bytes + rows * width <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df
