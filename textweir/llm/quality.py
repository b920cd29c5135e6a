"""Text quality from compressed sizes under a good and a bad zstandard dictionary."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import below
from textweir.session import stage

# Bounds of the fit: labelled rows of each class, and UTF-8 bytes of one such text.
FIT_ROWS = 3_000
FIT_BYTES = 1 << 16
# Texts are compressed in blocks, so that the dictionary counts in long texts as in short ones.
BLOCK = 1_024
DICTIONARY_BYTES = 112_640
LEVEL = 3
THRESHOLD = 0.3
FOLDS = 5
# Weight of the penalty that keeps the calibration finite when the classes separate.
RIDGE = 1e-3
_KNOTS = 16


def _blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; of too few texts, the texts themselves."""
    blocks = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b"\0" * 8


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False
    )


def difference(text: bytes, good: bytes, bad: bytes) -> float:
    """``(bytes under the bad dictionary - bytes under the good one) / bytes``; 0 if empty."""
    first, second = _compressor(good), _compressor(bad)
    gain = sum(len(second.compress(b)) - len(first.compress(b)) for b in _blocks(text))
    return gain / len(text) if text else 0.0


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and a monotone map from the size difference to a probability."""

    good: bytes = b""
    bad: bytes = b""
    knots: list[float] = field(default_factory=lambda: [0.0])
    levels: list[float] = field(default_factory=lambda: [0.5])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.knots, self.levels)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted, slightly penalized logistic regression on one feature, by Newton steps."""
    a = np.zeros(2)
    data = np.column_stack([x, np.ones(len(x))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(data @ a, -30, 30)))
        grad = data.T @ (w * (p - y)) + RIDGE * w.sum() * a * [1, 0]
        curve = data.T @ (data * (w * p * (1 - p) + 1e-12)[:, None])
        curve += RIDGE * w.sum() * np.diag([1.0, 1e-6])
        move = np.linalg.solve(curve, grad)
        a -= move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-9:
            break
    return float(a[0]), float(a[1])


def calibrate(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots and levels of the map: smoothed shares of class 1, made to ascend.

    The differences are cut into slices of equal number; a logistic fit is the prior of each
    slice, worth a few rows, so sparse slices stay between 0 and 1. Neighbours that descend
    are pooled.
    """
    scale = float(x.std()) or 1.0
    slope, base = _logistic(x / scale, y, w)
    order = np.argsort(x, kind="stable")
    groups = [g for g in np.array_split(order, min(_KNOTS, len(x))) if len(g)]
    pools: list[list[float]] = []
    prior = 4 * w.mean()
    for g in groups:
        middle = float(np.average(x[g], weights=w[g]))
        guess = 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * middle / scale + base))))
        weight = float(w[g].sum()) + prior
        pools.append([middle, (float((w[g] * y[g]).sum()) + prior * guess) / weight, weight])
        while len(pools) > 1 and pools[-1][1] < pools[-2][1]:
            b, a = pools.pop(), pools.pop()
            both = a[2] + b[2]
            pools.append([(a[0] * a[2] + b[0] * b[2]) / both, (a[1] * a[2] + b[1] * b[2]) / both, both])
    # Beyond the outer slices the map goes on to 0 and 1, so that no two differences tie there.
    span = 4 * scale
    knots = [pools[0][0] - span, *(p[0] for p in pools), pools[-1][0] + span]
    levels = [pools[0][1] / 2, *(p[1] for p in pools), (1 + pools[-1][1]) / 2]
    return knots, levels


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids whose labels are never learned; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, label: str = "quality"
) -> QualityModel:
    """Learn from at most ``rows`` labelled texts of each class.

    ``docs (doc_id, text)``, ``labels (doc_id, quality 0/1)``; null ids, null labels and
    held-out ids are left out. The sample is the distinct texts of each class with the smallest
    hash of their id, texts up to ``FIT_BYTES``. Half of it makes the dictionaries, the other half the
    calibration, weighted to the shares of the classes among all labels. Without both classes
    every score is the share of class 1, and 0.5 without labels.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    counts = {int(r["label"]): r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return QualityModel(levels=[float(next(iter(counts), 0.5))])
    few = F.lit(False)
    for c, count in counts.items():
        few |= (F.col("label") == c) & below(F.col("h"), count, rows)
    # About three times ``rows`` short rows at most.
    few = F.broadcast(known.where(few).distinct())
    texts = docs.select("doc_id", "text").where(
        F.col("doc_id").isNotNull() & (F.octet_length(F.coalesce("text", F.lit(""))) <= FIT_BYTES)
    )
    sample = texts.join(few, "doc_id").groupBy("label", "h", F.xxhash64("text").alias("t"))
    sample = stage(sample.agg(F.first("text").alias("text")), "quality-texts")
    found = [
        sample.where(F.col("label") == c).orderBy("h", "t").limit(rows).toPandas() for c in (0, 1)
    ]
    found = pd.concat(found)
    halves: dict[tuple[int, int], list[bytes]] = {}
    for c, group in found.groupby("label"):
        whole = [(t or "").encode() for t in group["text"]]
        halves[c, 0], halves[c, 1] = whole[::2], whole[1::2] or whole
    if len(halves) < 4:
        return QualityModel(levels=[counts[1] / (counts[0] + counts[1])])
    good, bad = _dictionary(halves[1, 0]), _dictionary(halves[0, 0])
    x = np.array([difference(t, good, bad) for c in (0, 1) for t in halves[c, 1]])
    sizes = [len(halves[c, 1]) for c in (0, 1)]
    y = np.repeat([0.0, 1.0], sizes)
    w = np.repeat([counts[c] / sizes[c] for c in (0, 1)], sizes)
    knots, levels = calibrate(x, y, w / w.mean())
    return QualityModel(good, bad, knots, levels)


def score(text: Column, model: QualityModel) -> Column:
    """Calibrated probability of class 1 for whole texts; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        if not model.good:
            return pd.Series(np.full(len(texts), model.levels[0]))
        x = [difference((t or "").encode(), model.good, model.bad) for t in texts]
        return pd.Series(model.probability(np.array(x, float)))

    return of(text)


def classify(
    docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``score double`` and ``predicted int`` (1 from ``threshold`` on).

    Columns of these names are replaced. Only ``text`` enters the score.
    """
    scored = docs.withColumn("score", score(F.col("text"), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
