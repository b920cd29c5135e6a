"""Feature blocks, class-weighted logistic regression and scoring in long form."""

from __future__ import annotations

import math
from collections import deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.functions.text import label_name
from textweir.operators import metrics
from textweir.operators.terms import ROW
from textweir.session import broadcast_if_bounded, stage

# Entries of one task of a pass, and the least that are worth a task of their own.
_ENTRIES_PER_PARTITION = 8_000_000
_LEAST_ENTRIES = 250_000
# Entries of one stored block; columns of one slice of a gradient; gradients added up directly.
_BLOCK_ENTRIES = 500_000
_SLICE = 1 << 17
_FAN_IN = 64
# Columns up to which a fit of few entries runs in one task, whose memory of steps has 16 bytes for each
# column and step.
_ALONE_COLUMNS = 1 << 17
# Steps that the optimizer remembers: vectors on the driver, which spare passes over the rows.
_MEMORY = 100
# Power of the curvature of a column by which its first guess is scaled; 0 is none, 1 favours rare
# columns so much that the frequent ones, which the end of a fit depends on, come late.
_SCALING = 0.25
# Largest component of the gradient of the mean loss at which a fit ends, as is usual for this fit.
TOLERANCE = 1e-4
_BLOCK = "rows int, label binary, size binary, index binary, value binary"


@dataclass(frozen=True)
class Features:
    """Labelled rows as blocks of a sparse or dense matrix with ``columns`` columns.

    ``blocks`` is stored: ``(rows, label, size, index, value)``, little-endian arrays of the
    labels, entries per row, column numbers (empty for dense rows) and values of some rows; small
    counts take one byte each.
    ``classes`` is ``(label, n, weight)``, with the balanced weight of each class.
    """

    blocks: DataFrame
    columns: int
    classes: DataFrame


@dataclass(frozen=True)
class Classifier:
    """Coefficients by column, the intercept, the data passes of the fit and the largest
    absolute component of the gradient where it ended."""

    coefficients: np.ndarray
    intercept: float
    passes: int = 0
    gradient: float = 0.0


def _packed(dense: bool):
    """Task function: rows of arrays to blocks."""

    def pack(batches):
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False).astype("<f8")
            lists = batch.column("value")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype("<i8")
            value = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            index = np.zeros(0, "<i4") if dense else batch.column("index").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            cuts = [0, *(np.flatnonzero(np.diff(ends // _BLOCK_ENTRIES)) + 1).tolist(), len(size)]
            small = not dense and (value >= 0).all() and (value < 256).all() and (value == np.floor(value)).all()
            value = value.astype("u1") if small else value
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                lo, hi = int(ends[a] - size[a]), int(ends[b - 1])
                parts = (label[a:b], size[a:b], index if dense else index[lo:hi].astype("<i4"), value[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b - a], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                    names=["rows", "label", "size", "index", "value"],
                )

    return pack


def _features(docs: DataFrame, rows: DataFrame, columns: int, dense: bool) -> Features:
    """Store the ``rows (label, index, value)`` of the labelled ones among ``docs``."""
    blocks = stage(rows.select("label", "index", "value").mapInArrow(_packed(dense), _BLOCK), "features")
    return Features(blocks, columns, metrics.class_weights(docs.select("label")))


def sparse_features(docs: DataFrame, weights: DataFrame, size: int) -> Features:
    """``docs (row_id, label)`` with their long-form weights as sparse rows.

    Documents without a known term get an empty row.
    """
    entries = weights.groupBy(ROW).agg(F.collect_list(F.struct("term_id", "weight")).alias("entries"))
    docs = docs.where(F.col("label").isNotNull())
    joined = docs.join(entries, ROW, "left")
    index = F.coalesce(F.col("entries.term_id"), F.array().cast("array<int>")).alias("index")
    value = F.coalesce(F.col("entries.weight"), F.array().cast("array<double>")).alias("value")
    return _features(docs, joined.select("label", index, value), size, False)


def dense_features(docs: DataFrame, embeddings: DataFrame, size: int) -> Features:
    """``docs (row_id, label)`` with ``(row_id, embedding)`` of ``size`` values as dense rows."""
    docs = docs.where(F.col("label").isNotNull())
    joined = docs.join(embeddings.select(ROW, F.col("embedding").alias("value")), ROW)
    index = F.lit(None).cast("array<int>").alias("index")
    return _features(docs, joined.select("label", index, "value"), size, True)


def _block(rows: int, label: bytes, size: bytes, index: bytes, value: bytes):
    y, n, index = np.frombuffer(label, "<f8"), np.frombuffer(size, "<i8"), np.frombuffer(index, "<i4")
    small = len(index) and len(value) == len(index)
    return y, n, index, np.frombuffer(value, "u1").astype("<f8") if small else np.frombuffer(value, "<f8")


def _each(batches):
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
            yield _block(*row)


def _slices(total: np.ndarray, loss: float):
    """A gradient cut into slices, so that no value and no sum of many holds all columns."""
    for n, at in enumerate(range(0, len(total), _SLICE)):
        data = total[at : at + _SLICE].tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int32()), pa.array([loss if n == 0 else 0.0]), pa.array([data], pa.binary())],
            names=["slice", "loss", "gradient"],
        )


def _margins(n, index, value, columns: int, point: np.ndarray) -> np.ndarray:
    if not len(index):
        return (value.reshape(len(n), -1) @ point[:columns] if len(value) else np.zeros(len(n))) + point[columns]
    out = np.zeros(len(n))
    some = n > 0
    out[some] = np.add.reduceat(value * point[index], (np.cumsum(n) - n)[some])
    return out + point[columns]


def _spread(n, index, value, columns: int, share: np.ndarray) -> np.ndarray:
    """Sum of the rows, each times its share, and of the shares themselves."""
    out = np.empty(columns + 1)
    if len(index):
        out[:columns] = np.bincount(index, value * np.repeat(share, n), columns)
    else:
        out[:columns] = share @ value.reshape(len(n), -1) if len(value) else 0.0
    out[columns] = share.sum()
    return out


def _loss(blocks, point: np.ndarray, columns: int, weight: dict[float, float]) -> tuple[float, np.ndarray]:
    """Weighted logistic loss of all rows of the blocks and its gradient."""
    total, loss = np.zeros(columns + 1), 0.0
    for y, n, index, value in blocks:
        w = np.where(y == 1, weight.get(1, 0.0), weight.get(0, 0.0))
        margin = _margins(n, index, value, columns, point)
        loss += float(w @ (np.logaddexp(0, margin) - y * margin))
        positive = 0.5 * (1 + np.tanh(margin / 2))
        total += _spread(n, index, value, columns, w * (positive - y))
    return loss, total


def _losses(point: np.ndarray, columns: int, weight: dict[float, float]):
    """Task function: the loss of one partition and its gradient."""

    def add(batches):
        loss, total = _loss(_each(batches), point, columns, weight)
        yield from _slices(total, loss)

    return add


def _curvatures(columns: int, weight: dict[float, float]):
    """Task function: sum of the weighted squares of each column, a quarter of which bounds its
    second derivative."""

    def add(batches):
        total = np.zeros(columns + 1)
        for y, n, index, value in _each(batches):
            w = np.where(y == 1, weight.get(1, 0.0), weight.get(0, 0.0))
            total += _spread(n, index, value * value, columns, w)
        yield from _slices(total, 0.0)

    return add


def _added(batches):
    """Task function: sums of the slices of one partition, one value at a time."""
    total: dict[int, np.ndarray] = {}
    loss = 0.0
    for batch in batches:
        for n, part, data in zip(*(batch.column(c).to_pylist() for c in ("slice", "loss", "gradient")), strict=True):
            values = np.frombuffer(data)
            total[n] = total[n] + values if n in total else values
            loss += part
    for n, values in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int32()), pa.array([loss]), pa.array([values.tobytes()], pa.binary())],
            names=["slice", "loss", "gradient"],
        )
        loss = 0.0


def _summed(blocks: DataFrame, task, tasks: int, columns: int) -> tuple[float, np.ndarray]:
    """Loss and gradient over all blocks; many partial ones are added up in a tree first."""
    schema = "slice int, loss double, gradient binary"
    slices = math.ceil((columns + 1) / _SLICE)
    partial = blocks.mapInArrow(task, schema)
    while tasks > _FAN_IN:
        tasks = math.ceil(tasks / _FAN_IN)
        group = F.pmod(F.spark_partition_id(), F.lit(tasks))
        partial = partial.withColumn("group", group).repartition(tasks * slices, "group", "slice").drop("group")
        partial = partial.mapInArrow(_added, schema)
    total: dict[int, np.ndarray] = {}
    loss = 0.0
    # As Arrow: rows of long binary values are slow to collect.
    found = partial.toArrow()
    for n, part, data in zip(*(found.column(c) for c in ("slice", "loss", "gradient")), strict=True):
        values = np.frombuffer(data.as_buffer())
        total[n.as_py()] = total[n.as_py()] + values if n.as_py() in total else values
        loss += part.as_py()
    return loss, np.concatenate([total[n] for n in sorted(total)])


def _direction(gradient: np.ndarray, steps: deque, scale: np.ndarray) -> np.ndarray:
    """Two-loop recursion of limited-memory BFGS, from ``scale`` as the diagonal of the first guess."""
    q, shares = gradient.copy(), []
    for s, y, sy in reversed(steps):
        a = (s @ q) / sy
        q -= a * y
        shares.append(a)
    q *= scale
    if steps:
        _, y, sy = steps[-1]
        q *= sy / (y @ (scale * y))
    else:
        q /= max(1.0, np.abs(q).sum())
    for (s, y, sy), a in zip(steps, reversed(shares), strict=True):
        q += s * (a - (y @ q) / sy)
    return -q


def _minimum(at, point: np.ndarray, loss: float, gradient: np.ndarray, scale: np.ndarray, enough: float, max_iter: int):
    """The steps of :func:`fit_classifier` from ``point``: where they end, their passes and the largest
    component of the gradient there. ``at`` gives loss and gradient of a point."""
    passes, steps = 0, deque(maxlen=_MEMORY)
    for _ in range(max_iter):
        if np.abs(gradient).max() <= enough:
            break
        move = _direction(gradient, steps, scale)
        slope, length = float(gradient @ move), 1.0
        while True:
            new_loss, new_gradient = at(point + length * move)
            passes += 1
            if new_loss <= loss + 1e-4 * length * slope or length < 1e-10:
                break
            # The minimum of the parabola through both losses and the slope, within bounds.
            bend = new_loss - loss - length * slope
            length = min(max(-slope * length * length / (2 * bend), length / 10), length / 2)
        if new_loss >= loss:
            break
        step, change = length * move, new_gradient - gradient
        bend = float(step @ change)
        if bend > 1e-12 * np.sqrt((step @ step) * (change @ change)):
            steps.append((step, change, bend))
        point, loss, gradient = point + step, new_loss, new_gradient
    return point, passes, float(np.abs(gradient).max())


def _fitted(
    columns: int, weight: dict[float, float], penalty: np.ndarray, rows: int, scale: np.ndarray, enough: float,
    max_iter: int,
):
    """Task function: the whole fit over the blocks of one partition, which stay in the task's memory."""

    def fit(batches):
        kept = [
            _block(0, *(batch.column(c)[i].as_buffer() for c in ("label", "size", "index", "value")))
            for batch in batches for i in range(batch.num_rows)
        ]

        def at(point: np.ndarray) -> tuple[float, np.ndarray]:
            loss, gradient = _loss(kept, point, columns, weight)
            return (loss + point @ (penalty * point) / 2) / rows, (gradient + penalty * point) / rows

        zero = np.zeros(columns + 1)
        point, passes, largest = _minimum(at, zero, *at(zero), scale, enough, max_iter)
        yield pa.RecordBatch.from_arrays(
            [pa.array([passes], pa.int32()), pa.array([largest]), pa.array([point.tobytes()], pa.binary())],
            names=["passes", "gradient", "point"],
        )

    return fit


def fit_classifier(
    features: Features, entries: int, max_iter: int = 1000, strength: float = 1.0, tol: float = TOLERANCE
) -> Classifier:
    """Logistic regression with an L2 penalty of ``1/strength`` and balanced classes.

    Minimizes the mean of the weighted losses plus half the squared coefficients over
    ``strength`` times the rows, on the features as they are, by limited-memory BFGS whose first
    guess knows the curvature of each column. Ends where no component of the gradient exceeds
    ``tol`` times the largest one at zero (or ``tol`` itself, if larger), after ``max_iter``
    steps, or where the loss cannot fall any more. Labels are 0 and 1. No rows give zeros.

    ``entries``, the number of values, decides how the steps run. What one task may hold is fitted in
    one task after a first pass: it keeps the blocks, and passes cost no jobs, so that several fits
    have a core each. Beyond that every pass is one job over the blocks, which are kept on the
    executors for the fit only and read again from storage where an executor is lost, in one task
    for each core as long as these stay within memory, since a pass waits for its last task. The
    memory of steps, on the driver or in the one task, has ``_MEMORY`` pairs of vectors of the
    length of the coefficients.
    """
    columns = features.columns
    classes = features.classes.select("label", "n", "weight").collect()
    rows = sum(r["n"] for r in classes)
    if not rows:
        return Classifier(np.zeros(columns), 0.0)
    weight = {int(r["label"]): float(r["weight"]) for r in classes}
    penalty = np.full(columns + 1, 1.0 / strength)
    penalty[columns] = 0.0
    cores = features.blocks.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, math.ceil(entries / _LEAST_ENTRIES)), math.ceil(entries / _ENTRIES_PER_PARTITION))
    alone = entries <= _ENTRIES_PER_PARTITION and columns <= _ALONE_COLUMNS
    blocks = features.blocks if alone else features.blocks.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)

    def at(point: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = _summed(blocks, _losses(point, columns, weight), tasks, columns)
        return (loss + point @ (penalty * point) / 2) / rows, (gradient + penalty * point) / rows

    try:
        point = np.zeros(columns + 1)
        loss, gradient = at(point)
        enough = tol * max(1.0, np.abs(gradient).max())
        curvature = (_summed(blocks, _curvatures(columns, weight), tasks, columns)[1] / 4 + penalty) / rows
        scale = np.maximum(curvature, 1e-300) ** -_SCALING
        if alone:
            task = _fitted(columns, weight, penalty, rows, scale, enough, max_iter)
            found = blocks.coalesce(1).mapInArrow(task, "passes int, gradient double, point binary").toArrow()
            passes, largest = found.column("passes")[0].as_py(), found.column("gradient")[0].as_py()
            point = np.frombuffer(found.column("point")[0].as_buffer())
        else:
            point, passes, largest = _minimum(at, point, loss, gradient, scale, enough, max_iter)
    finally:
        if not alone:
            blocks.unpersist()
    return Classifier(point[:columns], float(point[columns]), passes + 1, largest)


def coefficients(spark: SparkSession, model: Classifier) -> DataFrame:
    """``(term_id, coef)`` of the non-zero coefficients."""
    used = model.coefficients.nonzero()[0]
    table = pd.DataFrame({"term_id": used.astype("int32"), "coef": model.coefficients[used]})
    return spark.createDataFrame(table, "term_id int, coef double")


def score_weights(
    docs: DataFrame, weights: DataFrame, coefs: DataFrame, intercept: float, max_rows: int | None
) -> DataFrame:
    """``docs`` with ``margin``: intercept plus the sum of weight times coefficient.

    Long form throughout: no vector per document is built to score it.
    """
    margins = (
        weights.join(broadcast_if_bounded(coefs, max_rows), "term_id")
        .groupBy(ROW)
        .agg(F.sum(F.col("weight") * F.col("coef")).alias("m"))
    )
    margin = F.lit(intercept) + F.coalesce("m", F.lit(0.0))
    return docs.join(margins, ROW, "left").withColumn("margin", margin).drop("m")


def gradient(
    docs: DataFrame, weights: DataFrame, coefs: DataFrame, intercept: float, strength: float = 1.0
) -> DataFrame:
    """``(term_id, gradient)`` of the loss that ``fit_classifier`` minimizes, in long form.

    A check of a fit that shares no code with it: the errors of ``docs (row_id, label)`` meet
    their ``weights`` again, and the penalty of each coefficient is added. The intercept has
    ``term_id`` -1. Terms without any weight are not listed.
    """
    classes = metrics.class_weights(docs.select("label"))
    scored = predictions(score_weights(docs, weights, coefs, intercept, None), keep_margin=True)
    positive = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
    rows = classes.agg(F.sum("n")).scalar()
    balanced = scored.join(F.broadcast(classes.select("label", F.col("weight").alias("share"))), "label")
    errors = balanced.select(ROW, (F.col("share") * (positive - F.col("label")) / rows).alias("error"))
    terms = weights.join(errors, ROW).groupBy("term_id").agg(F.sum(F.col("weight") * F.col("error")).alias("g"))
    penalty = F.coalesce("coef", F.lit(0.0)) / (F.lit(strength) * rows)
    whole = terms.join(coefs, "term_id", "left").select("term_id", (F.col("g") + penalty).alias("gradient"))
    return whole.union(errors.select(F.lit(-1).alias("term_id"), "error").groupBy("term_id").agg(F.sum("error")))


def predictions(scored: DataFrame, keep_margin: bool = False) -> DataFrame:
    """Replace (or, if kept, follow) ``margin`` by ``prediction``, ``sentiment`` and the probability of that class."""
    positive = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
    label = F.when(F.col("margin") > 0, 1).otherwise(0)
    found = (
        scored.withColumn("prediction", label)
        .withColumn("sentiment", label_name(F.col("prediction")))
        .withColumn(
            "probability", F.when(F.col("prediction") == 1, positive).otherwise(1 - positive)
        )
    )
    return found if keep_margin else found.drop("margin")
