"""Truncated SVD of a sparse matrix in long form, by a block Krylov basis.

Method: Musco and Musco, "Randomized block Krylov methods" (2015). With ``M = A A'`` (``M = A``
where ``A`` is symmetric) the basis holds ``Y, M Y, M M Y, ...``, each made orthonormal to all
before it, and the decomposition is that of ``M`` on this basis. The matrix is packed once into
blocks of compact rows; a pass multiplies each block with the last part of the basis. The basis
lies in chunks of rows, one binary value each; only products of its columns, a few hundred
squared, reach the driver. Where the matrix has few columns, ``A' Y`` is so small that it does as
well, and each chunk needs its own rows of the matrix only.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.session import stage

_CELLS_PER_BLOCK = 4_000_000
# Cells that are sorted at once to pack them, and the least that are worth a task of a pass.
_CELLS_PER_PIECE = 250_000
# Bytes of the last columns of the basis up to which every task gets all of them with its code, and
# cells of one such task, whose sums are as long.
_SMALL_BYTES = 32 * 1024 * 1024
_CELLS_PER_TASK = 16_000_000
# Bytes of one chunk of a new block of columns, and of one task that writes a whole basis: the
# writer holds a hundred values before it looks at their size.
_CHUNK_BYTES = 256 * 1024
_TASK_BYTES = 32 * 1024 * 1024
# A task holds a panel about four times: as it was, multiplied, and both as they travel.
_PANEL_BYTES = 64 * 1024 * 1024
# Share of a panel's bytes up to which ``A' Y`` goes through the driver.
_NARROW = 64
_CHUNKS = 256
_FAN_IN = 64
_GRAMS = 64
# Values multiplied at once, to stay in the processor's cache.
_PRODUCTS = 1 << 18
# Parts of a new block below this share of its squared length are rounding, not directions.
_NOTHING = 1e-16
_PARTIAL = "block int, panel int, chunk int, ids binary, z binary"


def _random_chunks(n_rows: int, rows: int, width: int, seed: int):
    """Task function: reproducible Gaussian rows per chunk, whatever the partitioning."""

    def fill(batches):
        for batch in batches:
            for chunk in batch["id"]:
                size = min(rows, n_rows - chunk * rows)
                z = np.random.default_rng([seed, int(chunk)]).standard_normal((size, width))
                yield pd.DataFrame({"chunk": [chunk], "x": [z.tobytes()]})

    return fill


def _packed(symmetric: bool):
    """Task function: the cells of one piece of a block as compact rows, and compact columns if needed.

    ``ids`` are the piece's rows, ``starts`` their first cells; ``index`` tells which column a
    cell has: its number if symmetric, else its place among the block's columns, whose first
    cells, row numbers and values follow as ``down_*``.
    """

    def pack(cells: pd.DataFrame) -> pd.DataFrame:
        row, col, x = (cells[c].to_numpy() for c in ("row_id", "col_id", "x"))
        out = {"block": cells["block"].iloc[0]}
        if not symmetric:
            _, col = np.unique(col, return_inverse=True)
            order = np.lexsort((row, col))
            first = np.flatnonzero(np.diff(col[order], prepend=-1))
            out |= {"down_starts": first.tobytes(), "down_index": row[order].astype("<i4").tobytes(),
                    "down_value": x[order].tobytes()}
        else:
            out |= {"down_starts": b"", "down_index": b"", "down_value": b""}
        order = np.lexsort((col, row))
        row = row[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        out |= {"ids": row[first].astype("<i4").tobytes(), "starts": first.tobytes(),
                "index": col[order].astype("<i4").tobytes(), "value": x[order].tobytes()}
        return pd.DataFrame({c: [v] for c, v in out.items()})

    return pack


_PACKED = (
    "block int, down_starts binary, down_index binary, down_value binary, "
    "ids binary, starts binary, index binary, value binary"
)


def _gathered(starts: np.ndarray, index: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """For each stretch of cells the sum of the rows of ``dense`` they name, times their values."""
    out = np.empty((len(starts), dense.shape[1]))
    ends = np.append(starts[1:], len(index))
    step = max(1, _PRODUCTS // max(1, dense.shape[1]))
    cuts = [0, *(np.flatnonzero(np.diff(ends // step)) + 1).tolist(), len(starts)]
    for a, b in itertools.pairwise(cuts):
        if a < b:
            lo, hi = int(starts[a]), int(ends[b - 1])
            out[a:b] = np.add.reduceat(value[lo:hi, None] * dense[index[lo:hi]], starts[a:b] - lo, axis=0)
    return out


def _add_product(cell, y: np.ndarray, symmetric: bool, total: np.ndarray, touched: np.ndarray) -> None:
    """Add what one piece of the matrix gives to the rows of ``M Y``, and mark these rows."""
    dense = y
    if not symmetric:
        starts, index, value = (cell[f"down_{c}"] for c in ("starts", "index", "value"))
        dense = _gathered(np.frombuffer(starts, "<i8"), np.frombuffer(index, "<i4"), np.frombuffer(value), y)
    ids, found = _gathered_cells(cell, "", dense)
    total[ids] += found
    touched[ids] = True


def _by_chunk(rows: int, block: int, panel: int, total: np.ndarray, touched: np.ndarray) -> list[tuple]:
    """The marked rows as ``_PARTIAL`` rows, one for each chunk."""
    ids = np.flatnonzero(touched).astype("<i4")
    cuts = [0, *(np.flatnonzero(np.diff(ids // rows)) + 1).tolist(), len(ids)]
    return [
        (block, panel, int(ids[a]) // rows, (ids[a:b] % rows).tobytes(), total[ids[a:b]].tobytes())
        for a, b in itertools.pairwise(cuts) if a < b
    ]


_PARTIAL_NAMES = ["block", "panel", "chunk", "ids", "z"]


def _multiply_block(n_rows: int, rows: int, widths: list[int], symmetric: bool):
    """Task function: what one block of the matrix adds to one panel of ``M Y``."""

    def multiply(cells: pd.DataFrame, chunks: pd.DataFrame) -> pd.DataFrame:
        if cells.empty:
            return pd.DataFrame({c: np.array([], dtype=object) for c in _PARTIAL_NAMES})
        block, panel = int(cells["block"].iloc[0]), int(chunks["panel"].iloc[0])
        y, total = np.empty((n_rows, widths[panel])), np.zeros((n_rows, widths[panel]))
        touched = np.zeros(n_rows, bool)
        for chunk, data in zip(chunks["chunk"], chunks["y"], strict=True):
            part = np.frombuffer(data).reshape(-1, widths[panel])
            y[chunk * rows : chunk * rows + len(part)] = part
        for cell in cells.to_dict("records"):
            _add_product(cell, y, symmetric, total, touched)
        return pd.DataFrame(_by_chunk(rows, block, panel, total, touched), columns=_PARTIAL_NAMES)

    return multiply


def _multiply_pieces(rows: int, y: np.ndarray, symmetric: bool):
    """Task function: what the pieces of one partition add to ``M Y``, one piece at a time."""

    def multiply(batches):
        total, touched = np.zeros(y.shape), np.zeros(len(y), bool)
        for batch in batches:
            names = [c for c in batch.schema.names if c != "block"]
            for i in range(batch.num_rows):
                cell = {c: batch.column(c)[i].as_buffer() for c in names}
                _add_product(cell, y, symmetric, total, touched)
        for row in _by_chunk(rows, 0, 0, total, touched):
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            arrays = [pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=_PARTIAL_NAMES)

    return multiply


def _packed_rows(rows: int):
    """Task function: the cells of one chunk of rows, by row (``index`` are columns) and by column
    (``down_index`` are rows of the chunk, ``ids`` the columns)."""

    def pack(cells: pd.DataFrame) -> pd.DataFrame:
        chunk = int(cells["chunk"].iloc[0])
        row, col, x = (cells[c].to_numpy() for c in ("row_id", "col_id", "x"))
        row = row - chunk * rows
        out = {"chunk": chunk}
        for name, key, other in (("", row, col), ("down_", col, row)):
            order = np.lexsort((other, key))
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            out |= {f"{name}ids": key[order][first].astype("<i4").tobytes(), f"{name}starts": first.tobytes(),
                    f"{name}index": other[order].astype("<i4").tobytes(), f"{name}value": x[order].tobytes()}
        return pd.DataFrame({c: [v] for c, v in out.items()})

    return pack


_PACKED_COLUMNS = [f"{name}{c}" for name in ("", "down_") for c in ("ids", "starts", "index", "value")]
_PACKED_ROWS = "chunk int, " + ", ".join(f"{c} binary" for c in _PACKED_COLUMNS)


def _gathered_cells(cell, name: str, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, starts, index, value = (cell[f"{name}{c}"] for c in ("ids", "starts", "index", "value"))
    found = _gathered(np.frombuffer(starts, "<i8"), np.frombuffer(index, "<i4"), np.frombuffer(value), dense)
    return np.frombuffer(ids, "<i4"), found


def _each_chunk(batches, name: str, turns: tuple):
    """Chunks of the basis with the cells of their rows, ``None`` where there are none."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_buffer() for c in (f"{name}{p}" for p in ("ids", "starts", "index", "value"))}
            x = _applied(batch.column("x")[i].as_buffer(), batch.column("columns")[i].as_py(), turns)
            yield batch.slice(i, 1), x, None if row[f"{name}ids"] is None else row


def _down(columns: int, width: int, turns: tuple):
    """Task function: what the chunks of one partition add to ``A' Y``."""

    def multiply(batches):
        total = np.zeros((columns, width))
        for _, x, cells in _each_chunk(batches, "down_", turns):
            if cells:
                ids, found = _gathered_cells(cells, "down_", x[:, -width:])
                total[ids] += found
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

    return multiply


def _widened(down: np.ndarray, turns: tuple):
    """Task function: chunks of the basis with their rows of ``A`` times ``down`` to their right."""

    def extend(batches):
        for row, x, cells in _each_chunk(batches, "", turns):
            new = np.zeros((len(x), down.shape[1]))
            if cells:
                ids, found = _gathered_cells(cells, "", down)
                new[ids] = found
            whole = np.hstack([x, new])
            changed = {"columns": pa.array([whole.shape[1]], pa.int32()), "x": pa.array([whole.tobytes()], pa.binary())}
            arrays = [changed.get(c, row.column(c)) for c in row.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=row.schema.names)

    return extend


def _applied(data: bytes, columns: int, turns: tuple) -> np.ndarray:
    """A chunk of ``columns``; each turn keeps the first ``ready`` ones and has others instead of the rest."""
    x = np.frombuffer(data).reshape(-1, columns)
    for ready, matrix in turns:
        x = np.hstack([x[:, :ready], x @ matrix])
    return x


def _turned(width: int, panels: list[int], turns: tuple):
    """Task function: the last ``width`` columns of every chunk, cut into panels."""
    ends = np.cumsum(panels)

    def turn(batches):
        for batch in batches:
            for chunk, columns, data in zip(batch["chunk"], batch["columns"], batch["x"], strict=True):
                y = _applied(data, columns, turns)[:, -width:]
                parts = [y[:, e - n : e].tobytes() for e, n in zip(ends, panels, strict=True)]
                yield pd.DataFrame({"chunk": chunk, "panel": range(len(parts)), "y": parts})

    return turn


def _placed(group: pd.DataFrame, size: int, width: int) -> np.ndarray:
    total = np.zeros((size, width))
    for ids, data in zip(group["ids"], group["z"], strict=True):
        ids = np.frombuffer(ids, "<i4")
        total[ids] += np.frombuffer(data).reshape(len(ids), width)
    return total


def _added(n_rows: int, rows: int, widths: list[int]):
    """Task function: sum of the partial results of one chunk and panel."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[:1]
        size = min(rows, n_rows - int(first["chunk"].iloc[0]) * rows)
        total = _placed(group, size, widths[int(first["panel"].iloc[0])])
        ids = np.arange(size, dtype="<i4").tobytes()
        return first[["block", "panel", "chunk"]].assign(ids=[ids], z=[total.tobytes()])

    return add


def _extended(widths: list[int], turns: tuple):
    """Task function: a chunk of the basis with the new columns to its right."""

    def extend(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        x = _applied(old["x"].iloc[0], int(old["columns"].iloc[0]), turns)
        parts = [_placed(new[new["panel"] == p], len(x), w) for p, w in enumerate(widths)]
        whole = np.hstack([x, *parts])
        return pd.DataFrame({"chunk": old["chunk"], "columns": [whole.shape[1]], "x": [whole.tobytes()]})

    return extend


def _gram(ready: int, turns: tuple):
    """Task function: products of all columns with those beyond the first ``ready``, over the
    chunks of one partition."""

    def add(batches):
        total = 0.0
        for batch in batches:
            for columns, data in zip(batch["columns"], batch["x"], strict=True):
                x = _applied(data, columns, turns)
                total = total + x.T @ x[:, ready:]
        if not np.isscalar(total):
            yield pd.DataFrame({"g": [total.tobytes()]})

    return add


def _rows(rows: int, matrix: np.ndarray, turns: tuple):
    """Task function: chunks times ``matrix``, one output row per matrix row."""

    def turn(batches):
        for batch in batches:
            for chunk, columns, data in zip(batch["chunk"], batch["columns"], batch["x"], strict=True):
                z = _applied(data, columns, turns) @ matrix
                ids = np.arange(chunk * rows, chunk * rows + len(z))
                yield pd.DataFrame({"row_id": ids, "embedding": list(z)})

    return turn


_CHUNK = "chunk int, columns int, x binary"


class _Basis:
    """Chunks of orthonormal columns, of which the last block may still be raw.

    ``turns`` are what stored chunks still have to go through; every task that reads them does it.
    """

    def __init__(self, chunks: DataFrame, columns: int, turns: tuple = ()):
        self.chunks, self.columns, self.turns = chunks, columns, turns

    def gram(self, ready: int) -> np.ndarray:
        """Products of all columns with those beyond the first ``ready``."""
        parts = self.chunks.select("columns", "x").coalesce(_GRAMS).mapInPandas(_gram(ready, self.turns), "g binary").collect()
        total = sum(np.frombuffer(p["g"]) for p in parts).reshape(self.columns, self.columns - ready)
        total[ready:] = (total[ready:] + total[ready:].T) / 2
        return total

    def orthonormal(self, ready: int) -> tuple[_Basis, np.ndarray]:
        """Make all columns beyond the first ``ready`` orthonormal to these and each other.

        Also returns the products of the first columns with the raw ones. Done twice, as one
        round leaves what rounding hides; what is only rounding drops out, so fewer columns, or
        none, may be added. Nothing is written: the chunks are turned where they are read.
        """
        basis, first, length = self, None, None
        for _ in range(2):
            gram = basis.gram(ready)
            over, own = gram[:ready], gram[ready:]
            first = over if first is None else first
            squares, directions = np.linalg.eigh(own - over.T @ over)
            length = max(np.trace(own), 1e-300) if length is None else 1.0
            kept = squares > _NOTHING * length
            turn = directions[:, kept] / np.sqrt(squares[kept])
            matrix = np.vstack([-over @ turn, turn])
            basis = _Basis(basis.chunks, ready + turn.shape[1], (*basis.turns, (ready, matrix)))
        return basis, first


def truncated_svd(
    cells: DataFrame,
    n_rows: int,
    rank: int,
    passes: int = 3,
    oversampling: int = 10,
    seed: int = 42,
    symmetric: bool = False,
) -> tuple[DataFrame, np.ndarray]:
    """Rows of ``U * Sigma`` as ``(row_id, embedding)``, and the singular values.

    ``cells`` is ``(row_id, col_id, x)`` with row ids ``0 .. n_rows - 1``. Rows without a cell
    get a zero vector. Coordinates are defined up to rotation: compare cosines. Each pass
    multiplies with ``A A'``; for a ``symmetric`` matrix (column ids are row ids) with ``A``
    twice as often, each half the work.

    The last columns of the basis go to every task where they are small; else they travel in panels.
    Column ids that are small numbers, so few that ``A' Y`` is a few thousand rows, let each chunk
    of rows work on its own: no task holds all rows then.
    """
    spark = cells.sparkSession
    rank = min(rank, n_rows)
    ids = spark.range(n_rows).select(F.col("id").cast("int").alias("row_id"))
    zero = F.array_repeat(F.lit(0.0), rank).alias("embedding")
    known = (F.count(F.lit(1)), F.count("col_id"), F.min("col_id"), F.max("col_id"))
    n_cells, numbered, low, high = cells.agg(*known).first()
    if n_cells == 0:
        return ids.select("row_id", zero), np.zeros(rank)

    width = min(rank + oversampling, n_rows)
    narrow = (
        not symmetric and numbered == n_cells and low >= 0 and 8 * (high + 1) * width * _NARROW <= _PANEL_BYTES
    )
    rows = max(64, math.ceil(n_rows / _CHUNKS))
    cores = spark.sparkContext.defaultParallelism
    value = F.col("x").cast("double").alias("x")

    def narrow_product():
        """How chunks get the cells of their rows, and the function that widens a basis by ``M`` times
        its last columns."""
        nonlocal rows
        rows = max(1, min(rows, _CELLS_PER_PIECE * n_rows // n_cells, _CHUNK_BYTES // (8 * width)))
        chunks = math.ceil(n_rows / rows)
        whole = 8 * n_rows * width * (passes + 1)
        tasks = max(min(cores, math.ceil(n_cells / _CELLS_PER_PIECE)), math.ceil(whole / _TASK_BYTES))
        tasks = min(chunks, max(tasks, math.ceil(n_cells / _CELLS_PER_BLOCK)))
        chunk = F.floor(F.col("row_id") / rows).cast("int").alias("chunk")
        packed = cells.select(chunk, "row_id", "col_id", value).repartition(tasks, "chunk").groupBy("chunk")
        packed = stage(packed.applyInPandas(_packed_rows(rows), _PACKED_ROWS), "svd-cells")

        def multiplied(basis: _Basis, last: int) -> _Basis:
            cells = basis.chunks.select("columns", "x", *_PACKED_COLUMNS[4:]).coalesce(_GRAMS)
            parts = cells.mapInArrow(_down(high + 1, last, basis.turns), "g binary").collect()
            down = sum(np.frombuffer(p["g"]) for p in parts).reshape(high + 1, last)
            wider = basis.chunks.mapInArrow(_widened(down, basis.turns), basis.chunks.schema)
            return _Basis(stage(wider, "svd-raw"), basis.columns + last)

        def started(chunks: DataFrame) -> DataFrame:
            return chunks.repartition(tasks, "chunk").join(packed.repartition(tasks, "chunk"), "chunk", "left")

        return started, multiplied

    def pieces(blocks: int) -> DataFrame:
        """The packed matrix in pieces of columns, or of rows if symmetric, dealt to blocks; a task packs few."""
        count = blocks * math.ceil(n_cells / blocks / _CELLS_PER_PIECE)
        piece = F.pmod(F.hash("row_id" if symmetric else "col_id"), F.lit(count))
        block = F.pmod(piece, F.lit(blocks)).alias("block")
        packed = cells.select(block, piece.alias("piece"), "row_id", "col_id", value)
        packed = packed.repartition(max(min(cores, count), math.ceil(count / 8)), "block", "piece")
        return stage(packed.groupBy("block", "piece").applyInPandas(_packed(symmetric), _PACKED), "svd-cells")

    def added(basis: _Basis, partial: DataFrame, pending: int, widths: list[int]) -> _Basis:
        """The basis with the sums of ``partial``, of ``pending`` rows for a chunk at most, to its right."""
        while pending > _FAN_IN:
            pending = math.ceil(pending / _FAN_IN)
            partial = (
                partial.withColumn("block", F.pmod("block", F.lit(pending)))
                .groupBy("chunk", "panel", "block")
                .applyInPandas(_added(n_rows, rows, widths), _PARTIAL)
            )
        wider = basis.chunks.groupBy("chunk").cogroup(partial.groupBy("chunk"))
        wider = wider.applyInPandas(_extended(widths, basis.turns), _CHUNK)
        return _Basis(stage(wider, "svd-raw"), basis.columns + sum(widths))

    def small_product():
        """The same where the dense columns are few enough to be sent to every task."""
        tasks = max(min(cores, math.ceil(n_cells / _CELLS_PER_PIECE)), math.ceil(n_cells / _CELLS_PER_TASK))
        packed = pieces(tasks)
        parts = packed.rdd.getNumPartitions()

        def multiplied(basis: _Basis, last: int) -> _Basis:
            columns = basis.chunks.mapInPandas(_turned(last, [last], basis.turns), "chunk int, panel int, y binary")
            found, y = columns.toArrow(), np.zeros((n_rows, last))
            for chunk, data in zip(found.column("chunk").to_pylist(), found.column("y"), strict=True):
                part = np.frombuffer(data.as_buffer()).reshape(-1, last)
                y[chunk * rows : chunk * rows + len(part)] = part
            partial = packed.mapInArrow(_multiply_pieces(rows, y, symmetric), _PARTIAL)
            return added(basis, partial.withColumn("block", F.spark_partition_id()), parts, [last])

        return None, multiplied

    def wide_product():
        """The same from blocks of columns, or of rows if symmetric: a task holds one panel of the
        dense matrix, all its rows, but only some columns."""
        blocks = max(cores, math.ceil(n_cells / _CELLS_PER_BLOCK))
        most = min(width, math.ceil(8 * n_rows * width / _PANEL_BYTES))
        packed = pieces(blocks)
        slots = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
        packed = packed.withColumn("panel", slots).repartition(blocks * most, "block", "panel")
        packed = packed.persist(StorageLevel.DISK_ONLY)
        every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

        def multiplied(basis: _Basis, last: int) -> _Basis:
            widths = [len(p) for p in np.array_split(np.arange(last), min(most, last))]
            spread = basis.chunks.mapInPandas(_turned(last, widths, basis.turns), "chunk int, panel int, y binary")
            partial = (
                packed.where(F.col("panel") < len(widths)).groupBy("block", "panel")
                .cogroup(spread.withColumn("block", every_block).groupBy("block", "panel"))
                .applyInPandas(_multiply_block(n_rows, rows, widths, symmetric), _PARTIAL)
            )
            return added(basis, partial, 1 if symmetric else blocks, widths)

        kept.append(packed)
        return None, multiplied

    small = 8 * n_rows * width <= _SMALL_BYTES
    kept: list[DataFrame] = []
    started, multiplied = narrow_product() if narrow else small_product() if small else wide_product()
    try:
        start = spark.range(math.ceil(n_rows / rows)).mapInPandas(
            _random_chunks(n_rows, rows, width, seed), "chunk int, x binary"
        )
        start = start.select("chunk", F.lit(width).cast("int").alias("columns"), "x")
        start = started(start) if started else start
        basis, _ = _Basis(stage(start, "svd-start"), width).orthonormal(0)
        ready, last, products = basis.columns, basis.columns, []
        for left in range((2 if symmetric else 1) * passes - 1, -1, -1):
            raw = multiplied(basis, last)
            if left:
                basis, over = raw.orthonormal(ready)
            else:
                over = raw.gram(ready)[:ready]
            products.append((ready - last, over))
            if not left or basis.columns == ready:
                break
            ready, last = basis.columns, basis.columns - ready
    finally:
        for table in kept:
            table.unpersist()

    # M on the basis: each product covers the columns up to its own block, symmetry the rest.
    whole = np.zeros((ready, ready))
    for at, over in products:
        whole[: len(over), at : at + over.shape[1]] = over
        whole[at : at + over.shape[1], : len(over)] = over.T
    values, vectors = np.linalg.eigh(whole)
    values[np.abs(values) < 1e-13 * np.abs(values).max()] = 0.0
    order = np.argsort(-np.abs(values), kind="stable")[:rank]
    found = np.abs(values[order]) if symmetric else np.sqrt(np.maximum(values[order], 0))
    turn, sigma = np.zeros((basis.columns, rank)), np.zeros(rank)
    turn[:ready, : len(order)] = vectors[:, order] * found
    sigma[: len(order)] = found
    return basis.chunks.select("chunk", "columns", "x").mapInPandas(_rows(rows, turn, basis.turns), "row_id int, embedding array<double>"), sigma
