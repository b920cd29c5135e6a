"""Secrets in texts: fixed patterns, and a small character network over every other candidate."""

from __future__ import annotations

import itertools
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import digest
from textweir.operators.sampling import key_bounds
from textweir.session import stage

# The patterns of the base findings. Letters of the key words match in either case.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
MINIMUM = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "cnn")
# A candidate of the network: a long run of the characters that values are made of.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")

# Labelled findings that one task learns from in a round; rounds of the fit, each over all
# findings: fewer where there are many, as a round then has more steps.
SHARD = 8_000
EPOCHS, LEAST_EPOCHS = 12, 4
_EXAMPLES_SEEN = 60_000
# A candidate is reported from this calibrated probability on, or from a lower one where a kind
# would otherwise miss more than 1 - RECALL of its findings.
PROBABILITY = 0.9
RECALL = 0.95
LEAST = 8
BEFORE, AFTER = 24, 8
# Longer candidates are scored in parts of this many characters; the best part counts.
PART = 96
_WIDTH = BEFORE + PART + AFTER
_CODES = 130
_DIMS, _KERNEL, _FILTERS = 8, 5, 24
_BATCH = 512
# Bytes of text that a redaction unpacks at once.
CHUNK = 1 << 20

Span = tuple[int, int]


def base_findings(text: str) -> list[tuple[str, int, int, Span]]:
    """``(kind, start, end, (start and end of the value))``, per kind from left to right."""
    found = []
    lower = text.encode("utf-8", "replace").lower()
    if any(w in lower for w in KEY_WORDS):
        found += [("assign", m.start(), m.end(), m.span(2)) for m in ASSIGN.finditer(text)]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m.span()) for m in HEX.finditer(text)]
    return [f for f in found if f[3][1] - f[3][0] >= MINIMUM[f[0]]]


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """Runs of value characters that no base finding overlaps."""
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    return [r for r in runs if not any(a < r[1] and r[0] < b for a, b in taken)] if taken else runs


def _row(before: str, value: str, after: str) -> np.ndarray:
    """Codes of a candidate and its surroundings; 0 is padding, other values say which part."""
    row = np.zeros(_WIDTH, np.int16)
    for at, part, base in (
        (BEFORE - len(before), before, 0), (BEFORE, value, _CODES), (BEFORE + len(value), after, 0)
    ):
        codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        row[at : at + len(codes)] = np.minimum(codes, 127) + 1 + base
    return row


def rows_of(text: str, span: Span) -> list[np.ndarray]:
    """Network input of one candidate, whole: one row for each part."""
    return [
        _row(text[max(0, a - BEFORE) : a], text[a : min(a + PART, span[1])],
             text[min(a + PART, span[1]) :][:AFTER])
        for a in range(span[0], span[1], PART)
    ]


@dataclass
class SecretModel:
    """Weights of the network, the scaling of its scores, and the threshold of a finding."""

    weights: list[np.ndarray] = field(default_factory=list)
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    @property
    def threshold(self) -> float:
        return min(self.thresholds.values(), default=2.0)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        found = [np.zeros(0)]
        for at in range(0, len(rows), _BATCH):
            found.append(_forward(self.weights, rows[at : at + _BATCH])[0])
        z = self.scale[0] * np.concatenate(found) + self.scale[1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: str, spans: list[Span]) -> list[float]:
        if not spans:
            return []
        if not self.weights:
            return [0.0] * len(spans)
        parts = [rows_of(text, s) for s in spans]
        flat = self.probability(np.stack([r for p in parts for r in p]))
        cuts = np.cumsum([0, *map(len, parts)])
        return np.maximum.reduceat(flat, cuts[:-1]).tolist()


def _forward(weights, rows: np.ndarray):
    """Embedding, convolution, rectifier, maximum and mean over places, one linear unit."""
    table, kernel, bias, top, shift = weights
    e = table[rows]
    places = rows.shape[1] - _KERNEL + 1
    cols = np.concatenate([e[:, k : k + places] for k in range(_KERNEL)], axis=2)
    h = np.maximum(cols @ kernel + bias, 0)
    real = (rows[:, _KERNEL // 2 : _KERNEL // 2 + places] > 0)[:, :, None]
    h = h * real
    count = np.maximum(real.sum(axis=1), 1)
    best = h.argmax(axis=1)
    pooled = np.concatenate([h.max(axis=1), h.sum(axis=1) / count], axis=1)
    return pooled @ top + shift[0], (cols, h, real, count, best, pooled)


def _start(seed: int) -> list[np.ndarray]:
    """Random weights, and zeros for Adam's means and squares."""
    rng = np.random.default_rng(seed)
    weights = [
        rng.normal(0, 0.3, (2 * _CODES, _DIMS)),
        rng.normal(0, (_KERNEL * _DIMS) ** -0.5, (_KERNEL * _DIMS, _FILTERS)),
        np.zeros(_FILTERS),
        rng.normal(0, 0.2, 2 * _FILTERS),
        np.zeros(1),
    ]
    weights[0][0] = 0
    return weights + [np.zeros_like(w) for w in weights * 2]


def _epoch(state: list[np.ndarray], step: int, rows: np.ndarray, y: np.ndarray, good: float, order: np.ndarray) -> int:
    """One pass of Adam over the rows in ``order``, after ``step`` steps; changes ``state``.

    ``good`` is the share of label 1 among all rows; the classes are weighted to equal shares.
    """
    weights, mean, square = state[:5], state[5:10], state[10:]
    share = np.where(y == 1, 0.5 / max(good, 1e-9), 0.5 / max(1 - good, 1e-9))
    for at in range(0, len(rows), 64):
        i = order[at : at + 64]
        z, (cols, h, real, count, best, pooled) = _forward(weights, rows[i])
        d = share[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / len(i)
        dpool = d[:, None] * weights[3]
        dh = np.broadcast_to((dpool[:, _FILTERS:] / count)[:, None, :], h.shape).copy()
        n, f = np.ogrid[: len(i), :_FILTERS]
        dh[n, best, f] += dpool[:, :_FILTERS]
        dh *= (h > 0) & real
        dcols = dh @ weights[1].T
        dtable = np.zeros_like(weights[0])
        places = dcols.shape[1]
        for k in range(_KERNEL):
            np.add.at(dtable, rows[i][:, k : k + places],
                      dcols[:, :, k * _DIMS : (k + 1) * _DIMS])
        dtable[0] = 0
        grads = [dtable, np.tensordot(cols, dh, ([0, 1], [0, 1])), dh.sum(axis=(0, 1)),
                 pooled.T @ d, np.array([d.sum()])]
        step += 1
        for w, g, m, s in zip(weights, grads, mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return step


def train(rows: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> list[np.ndarray]:
    """Fit the network by Adam on the logistic loss, classes weighted to equal shares."""
    state, step, rng = _start(seed), 0, np.random.default_rng([seed, 1])
    for _ in range(epochs):
        step = _epoch(state, step, rows, y, y.mean(), rng.permutation(len(rows)))
    return state[:5]


def labelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled findings ``(rows, y, kind)``: base values 1, other candidates 0.

    Each value also enters with the surroundings of another candidate, so that the network
    learns the value and not only the key word before it.
    """
    good, kinds, bad, around = [], [], [], []
    for text in texts:
        base = base_findings(text)
        for kind, _, _, (a, b) in base:
            good.append((text[max(0, a - BEFORE) : a], text[a:b][:PART], text[b : b + AFTER]))
            kinds.append(KINDS.index(kind))
        for a, b in candidates(text, [f[1:3] for f in base]):
            bad += rows_of(text, (a, b))
            around.append((text[max(0, a - BEFORE) : a], text[b : b + AFTER]))
    rows = [_row(*g) for g in good]
    if around:
        rows += [
            _row(around[i % len(around)][0], g[1], around[i % len(around)][1])
            for i, g in enumerate(good)
        ]
        kinds += kinds
    y = np.concatenate([np.ones(len(rows)), np.zeros(len(bad))])
    every = rows + bad
    return (
        np.stack(every) if every else np.zeros((0, _WIDTH), np.int16), y,
        np.concatenate([np.array(kinds, int), np.full(len(bad), -1)]),
    )


def fit_texts(texts: list[str]) -> SecretModel:
    """Train on two thirds of the labelled findings; scale and set thresholds on the rest.

    The threshold of a kind is ``PROBABILITY``, or the highest that still finds ``RECALL`` of
    its findings where that is lower; a candidate is reported from the lowest threshold on, so
    every kind keeps its recall. With fewer than ``LEAST`` findings of either label the network reports nothing.
    """
    learn = labelled([t for i, t in enumerate(texts) if i % 3])
    rest = labelled([t for i, t in enumerate(texts) if i % 3 == 0])
    if min(min((p[1] == v).sum() for v in (0, 1)) for p in (learn, rest)) < LEAST:
        return SecretModel()
    model = SecretModel(train(learn[0], learn[1]))
    z = np.concatenate(
        [_forward(model.weights, rest[0][i : i + _BATCH])[0] for i in range(0, len(rest[0]), _BATCH)]
    )
    model.scale = _platt(z, rest[1])
    p = model.probability(rest[0])
    for code, kind in enumerate(KINDS[:3]):
        if (mine := np.sort(p[rest[2] == code])).size:
            model.thresholds[kind] = min(PROBABILITY, float(mine[int((1 - RECALL) * len(mine))]))
    return model


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn network outputs into probabilities (smoothed targets)."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * z).sum(), (p - target).sum()])
        curve = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]])
        move = np.linalg.solve(curve + 1e-6 * np.eye(2), g)
        move /= max(1.0, np.abs(move).max())
        a, b = a - move[0], b - move[1]
    return float(a), float(b)


_EXAMPLE = "part int, kind int, h bigint, row binary"


def _examples(batches):
    """Task function: texts and the third they belong to, to their labelled findings."""
    for batch in batches:
        part = batch.column("part").to_numpy(zero_copy_only=False)
        texts = np.array(batch.column("text").to_pylist(), object)
        for third in np.unique(part):
            rows, _, kind = labelled(texts[part == third].tolist())
            if len(rows):
                data = [r.astype("<i2").tobytes() for r in rows]
                h = [zlib.crc32(d) for d in data]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), third, "i4")), pa.array(kind.astype("i4")),
                     pa.array(h, pa.int64()), pa.array(data, pa.binary())],
                    names=["part", "kind", "h", "row"],
                )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i2").reshape(-1, _WIDTH).astype(np.int64)


def _round(state: list[np.ndarray], step: int, epoch: int, good: float):
    """Task function: one epoch over the examples of a shard; its state, steps and examples."""

    def learn(batches):
        table = pa.Table.from_batches([b for b in batches if b.num_rows] or [], SHARD_SCHEMA)
        if not table.num_rows:
            return
        table = table.sort_by([("h", "ascending"), ("row", "ascending"), ("kind", "ascending")])
        rows, y = _matrix(table.column("row")), (table.column("kind").to_numpy() >= 0).astype(float)
        mine = [w.copy() for w in state]
        order = np.random.default_rng([7, epoch + 1]).permutation(len(rows))
        steps = _epoch(mine, step, rows, y, good, order)
        flat = np.concatenate([w.ravel() for w in mine])
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(rows)], pa.int64()), pa.array([steps], pa.int64()), pa.array([flat.tolist()])],
            names=["n", "steps", "state"],
        )

    return learn


SHARD_SCHEMA = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("row", pa.binary())])


def _scored(weights: list[np.ndarray]):
    """Task function: the network's output for every example."""

    def score(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                some = batch.slice(at, _BATCH)
                z = _forward(weights, _matrix(some.column("row")))[0]
                yield pa.RecordBatch.from_arrays([some.column("kind"), pa.array(z)], names=["kind", "z"])

    return score


def _train_all(examples: DataFrame, n: int, good: float) -> list[np.ndarray]:
    """The network learned from all examples: in each round every shard takes one epoch from the
    common state, and the mean of the shards' states, by their examples, is the next one."""
    shards = max(1, -(-n // SHARD))
    dealt = examples.select("kind", "h", "row").repartition(shards, "h").persist(StorageLevel.MEMORY_AND_DISK)
    state, step = _start(7), 0
    for epoch in range(max(LEAST_EPOCHS, min(EPOCHS, -(-_EXAMPLES_SEEN // n)))):
        found = dealt.mapInArrow(_round(state, step, epoch, good), "n long, steps long, state array<double>")
        # Sums by place in the state, so the driver gets one state, however many shards there are.
        total = found.select("n", "steps", F.posexplode("state").alias("at", "x")).groupBy("at").agg(
            F.sum(F.col("x") * F.col("n")).alias("x"), F.sum("n").alias("n"), F.max("steps").alias("steps")
        ).toArrow().sort_by("at")
        mean = total.column("x").to_numpy() / total.column("n").to_numpy()
        step, cuts = total.column("steps")[0].as_py(), np.cumsum([w.size for w in state])[:-1]
        state = [x.reshape(w.shape) for x, w in zip(np.split(mean, cuts), state, strict=True)]
    dealt.unpersist()
    return state[:5]


def _platt_all(scored: DataFrame) -> tuple[float, float]:
    """:func:`_platt` over a table ``(kind, z)``: each Newton step is one aggregation."""
    y = F.when(F.col("kind") >= 0, 1.0).otherwise(0.0)
    n1, n0 = scored.agg(F.sum(y), F.sum(1 - y)).first()
    target = F.when(F.col("kind") >= 0, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        at = F.greatest(F.least(F.lit(a) * F.col("z") + F.lit(b), F.lit(30.0)), F.lit(-30.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-at))
        terms = scored.select("z", (p * (1 - p) + 1e-9).alias("w"), (p - target).alias("e"))
        wz = F.col("w") * F.col("z")
        g0, g1, h00, h01, h11 = terms.agg(
            F.sum(F.col("e") * F.col("z")), F.sum("e"), F.sum(wz * F.col("z")), F.sum(wz), F.sum("w")
        ).first()
        move = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + 1e-6 * np.eye(2), [g0, g1])
        move /= max(1.0, np.abs(move).max())
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame) -> SecretModel:
    """Learn from the findings of all documents: what :func:`fit_texts` does, as Spark jobs.

    A text belongs to one of three parts by its hash, so copies stay together; two parts train,
    the third sets scaling and thresholds. One scan turns all texts into labelled findings, which
    are stored; the network, its scaling and the exact quantiles of its scores are fitted on this
    table.
    """
    part = F.pmod(F.xxhash64("text"), F.lit(3)).cast("int").alias("part")
    texts = docs.where(F.col("text").isNotNull()).select(part, "text")
    examples = stage(texts.mapInArrow(_examples, _EXAMPLE), "secret-findings")
    good, rest = F.col("kind") >= 0, F.col("part") == 0
    n = {(r["r"], r["g"]): r["count"] for r in examples.groupBy(rest.alias("r"), good.alias("g")).count().collect()}
    if min(n.get((r, g), 0) for r in (False, True) for g in (False, True)) < LEAST:
        return SecretModel()
    learning = n[False, True] + n[False, False]
    model = SecretModel(_train_all(examples.where(~rest), learning, n[False, True] / learning))
    scored = stage(
        examples.where(rest).select("kind", "row").mapInArrow(_scored(model.weights), "kind int, z double"),
        "secret-scores",
    )
    model.scale = a, b = _platt_all(scored)
    z = F.greatest(F.least(F.lit(a) * F.col("z") + F.lit(b), F.lit(30.0)), F.lit(-30.0))
    found = scored.where(good).select("kind", F.floor((1 / (1 + F.exp(-z))) * (1 << 52)).cast("long").alias("o"))
    bounds = key_bounds(found, F.col("o"), lambda kind, n: int((1 - RECALL) * n) + 1, F.col("kind"))
    for r in found.groupBy("kind").agg(F.min("o").alias("least")).collect():
        at = bounds[r["kind"]].at if r["kind"] in bounds else r["least"]
        model.thresholds[KINDS[r["kind"]]] = min(PROBABILITY, at / (1 << 52))
    return model


FINDINGS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def _scan(text: str, model: SecretModel) -> list[dict]:
    base = base_findings(text)
    spans = candidates(text, [f[1:3] for f in base])
    scores = model.score(text, [f[3] for f in base] + spans)
    found = [(f[1], KINDS.index(f[0]), f[2], p) for f, p in zip(base, scores, strict=False)]
    found += [
        (a, 3, b, p)
        for (a, b), p in zip(spans, scores[len(base) :], strict=True)
        if p >= model.threshold
    ]
    return [
        {"kind": KINDS[k], "start": a, "end": b, "score": p} for a, k, b, p in sorted(found)
    ]


def scan(text: Column, model: SecretModel) -> Column:
    """Findings of each text, ``array<struct<kind, start, end, score>>`` by start and kind.

    Places are code points, the end is exclusive. Base findings (``assign``, ``access``,
    ``hex``) are always kept, with the score the network gives their value; a candidate beyond
    them becomes a ``cnn`` finding from the threshold on. Null and empty texts give none.
    """

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_scan(t, model) if t else [] for t in texts.to_pylist()], FINDINGS)

    return of(text)


def _cut(text: str, found: list[dict], mark: str) -> str:
    done, parts = 0, []
    for f in sorted(found, key=lambda f: f["start"]):
        if f["start"] >= done:
            parts += [text[done : f["start"]], mark]
        done = max(done, f["end"])
    return "".join(parts) + text[done:]


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every finding replaced by ``mark``; overlapping findings by one mark."""

    @F.arrow_udf("string")
    def of(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = texts.to_pylist()
        for i in np.flatnonzero(found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)):
            out[i] = _cut(out[i], found[int(i)].as_py(), mark)
        return pa.array(out, pa.string())

    return of(text, findings)


def redacted(text: Column, model: SecretModel, mark: str = "[secret]") -> Column:
    """:func:`redact` by the findings of :func:`scan`, in one step.

    As two functions they keep two worker processes a task, and each of them the texts of a
    whole batch. Here one worker unpacks about ``CHUNK`` bytes of text at a time.
    """

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        step = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // CHUNK
        parts = [pa.array([], pa.string())]
        for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(texts)]):
            some = texts.slice(a, b - a).to_pylist()
            parts.append(pa.array([_cut(t, _scan(t, model), mark) if t else t for t in some], pa.string()))
        return pa.concat_arrays(parts)

    return of(text)


def spans_text(findings: Column) -> Column:
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
    )


def digests(findings: Column) -> list[Column]:
    """Counts of the base kinds, the digest of the base spans, and all spans."""
    kind = lambda k: F.filter(findings, lambda f: f["kind"] == k)
    base = F.filter(findings, lambda f: f["kind"] != "cnn")
    return [
        *(F.size(kind(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        digest(spans_text(base)).alias("base_sha256"),
        spans_text(findings).alias("spans"),
    ]
