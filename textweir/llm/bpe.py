"""Byte-pair encoding by segment trees over the ranks of adjacent pairs, and decoding."""

from __future__ import annotations

import hashlib
import itertools
import json
import sys
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textweir.llm.common import lists, shape

# Fixed value: how byte-level vocabularies of this family split a text into pieces.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Pieces of up to this many bytes are merged side by side in numpy, longer ones one by one.
SIDE_BY_SIDE = 64
# Pieces of each of the two generations a worker remembers, and characters split at once: bounds
# of its memory.
CACHE = 200_000
CHUNK = 1 << 19
# Bytes of the pieces that are merged in step: their trees stay in the processor's cache.
_STEP = 1 << 16
# More than any rank; times the largest side-by-side size it still fits 32 bits.
_NONE = 1 << 24


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable Latin-1 itself, the rest from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Memory:
    """Tokens of the pieces met lately, kept by a worker from task to task.

    A full generation becomes the older one; pieces met again are taken over from there, so only
    pieces not met for a whole generation are forgotten.
    """

    name = ""

    def __init__(self, name: str = "", older: _Memory | None = None):
        self.name = name
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.order: dict[int, int] = older.order if older else {}
        self.older = older
        if older:
            older.older = None

    def add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.ids = np.concatenate([self.ids, ids]).astype(np.int32)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def recall(self, pieces: set[str]) -> None:
        """Take over what the older generation knows of these."""
        if self.older:
            again = [p for p in pieces if p in self.older.known]
            at = np.fromiter(map(self.older.known.__getitem__, again), np.int64, len(again))
            self.add(again, *_pick(self.older.ids, self.older.ends, at))
            pieces.difference_update(again)


def _process() -> dict:
    """What outlives a task. Functions travel by value, so module globals do not: each task
    would keep, and leave behind, a memory of its own."""
    return sys.modules.setdefault("_textweir_process", ModuleType("_textweir_process")).__dict__


@dataclass
class ByteBpe:
    """A byte-level vocabulary as arrays.

    ``pairs`` are the mergeable pairs as ``left * 2**32 + right``, ascending, with the ``rank``
    of each; ``merged`` gives the token that a rank makes; ``base`` the token of each byte;
    ``data`` and ``border`` hold the bytes of all tokens; ``added`` the tokens that are cut out
    of a text before it is split.
    """

    pairs: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    base: np.ndarray
    data: np.ndarray
    border: np.ndarray
    added: dict[str, int]
    name: str

    def memory(self, renew: bool = False) -> _Memory:
        """What this process remembers of this vocabulary; of one vocabulary at a time."""
        kept = _process().get("bpe")
        if kept is None or kept.name != self.name:
            kept = _process()["bpe"] = _Memory(self.name)
        elif renew:
            kept = _process()["bpe"] = _Memory(self.name, kept)
        return kept

    # -- encoding ---------------------------------------------------------------------------

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge."""
        key = (left.astype(np.int64) << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], np.int32(_NONE))

    def merge_one(self, piece: bytes) -> list[int]:
        """Tokens of one piece, by one segment tree over its adjacent pairs.

        A leaf is the rank of the pair that starts there; a node keeps the leftmost leaf of the
        lowest rank below it. The root is the next merge, which changes three leaves.
        """
        ids = self.base[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        order, merged = self.memory().order, self.merged
        if not order:
            order.update(zip(self.pairs.tolist(), self.rank.tolist(), strict=True))
        size = 1 << max(1, (n - 1).bit_length())
        tree = [(_NONE, 0)] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = (order.get((ids[i] << 32) + ids[i + 1], _NONE), i)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, other: int) -> None:
            rank = order.get((ids[leaf] << 32) + ids[other], _NONE) if other < n else _NONE
            at = size + leaf
            tree[at] = (rank, leaf)
            while at > 1:
                at >>= 1
                tree[at] = min(tree[2 * at], tree[2 * at + 1])

        while tree[1][0] < _NONE:
            rank, i = tree[1]
            j = after[i]
            ids[i] = int(merged[rank])
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            put(j, n)
            put(i, after[i])
            if before[i] >= 0:
                put(before[i], i)
        found, i = [], 0
        while i < n:
            found.append(ids[i])
            i = after[i]
        return found

    def merge_many(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and token counts of pieces of at most ``size`` bytes, a power of two.

        The trees of all pieces are the rows of one matrix and take their merges in step: each
        round applies every row's root and updates three leaves of each, level by level.
        """
        rows = len(pieces)
        length = np.fromiter(map(len, pieces), np.int32, rows)
        place = np.arange(size + 1, dtype=np.int32)
        ids = np.zeros((rows, size + 1), np.int32)
        alive = place < length[:, None]
        ids[alive] = self.base[np.frombuffer(b"".join(pieces), np.uint8)]
        none = np.int32(_NONE * size)
        tree = np.full((rows, 2 * size), none, np.int32)
        inner = place[:-1] < length[:, None] - 1
        first = self.ranks(ids[:, :-1][inner], ids[:, 1:][inner]) * size
        tree[:, size:][inner] = first + np.broadcast_to(place[:-1], inner.shape)[inner]
        for i in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])
        after = np.tile(place + 1, (rows, 1))
        before = np.tile(place - 1, (rows, 1))
        row = np.flatnonzero(tree[:, 1] < none)
        while len(row):
            root = tree[row, 1]
            i = root & (size - 1)
            j = after[row, i]
            k = after[row, j]
            p = before[row, i]
            back = np.maximum(p, 0)
            here = self.merged[root // size]
            ids[row, i] = here
            alive[row, j] = False
            after[row, i] = k
            ahead = np.minimum(k, size)
            before[row, ahead] = i
            pairs = self.ranks(
                np.concatenate([here, ids[row, back]]), np.concatenate([ids[row, ahead], here])
            )
            new = np.where(k < length[row], pairs[: len(row)], _NONE) * size + i
            old = pairs[len(row) :] * size + back
            tree[row, size + j] = none
            tree[row, size + i] = new
            tree[row, size + back] = np.where(p >= 0, old, tree[row, size])
            spots = [size + j, size + i, size + back]
            for _ in range(size.bit_length() - 1):
                spots = [x >> 1 for x in spots]
                for x in spots:
                    tree[row, x] = np.minimum(tree[row, 2 * x], tree[row, 2 * x + 1])
            row = row[tree[row, 1] < none]
        return ids[:, :-1][alive[:, :-1]], alive.sum(axis=1)

    def _learn(self, pieces: list[str]) -> None:
        """Remember the tokens of new pieces."""
        memory = self.memory()
        data = [p.encode() for p in pieces]
        length = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(length, kind="stable")
        found, counts = [], []
        whole = [data[i] for i in order]
        at, size = 0, 4
        while size <= SIDE_BY_SIDE:
            stop = int(np.searchsorted(length[order], size, "right"))
            for a in range(at, stop, _STEP // size):
                ids, n = self.merge_many(whole[a : min(a + _STEP // size, stop)], size)
                found.append(ids)
                counts.append(n)
            at, size = stop, 2 * size
        for piece in whole[at:]:
            found.append(np.array(self.merge_one(piece)))
            counts.append(np.array([len(found[-1])]))
        memory.add([pieces[i] for i in order], np.concatenate(found), np.concatenate(counts))

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[str] = []
        borders = [0]
        cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        for text in texts:
            at = 0
            for m in cut.finditer(text) if self.added else ():
                pieces += PATTERN.findall(text, at, m.start())
                pieces.append(m.group())
                at = m.end()
            pieces += PATTERN.findall(text, at)
            borders.append(len(pieces))
        memory = self.memory()
        at = np.fromiter(map(memory.known.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0)
        new = {pieces[i] for i in unknown.tolist()}
        if len(memory.known) + len(new) > CACHE:
            memory = self.memory(renew=True)
            new, unknown = set(pieces), np.arange(len(pieces))
        memory.recall(new)
        special = [t for t in self.added if t in new]
        memory.add(special, np.array([self.added[t] for t in special], np.int32), np.ones(len(special), np.int64))
        new.difference_update(special)
        if new:
            self._learn(list(new))
        at[unknown] = [memory.known[pieces[i]] for i in unknown.tolist()]
        ids, n = _pick(memory.ids, memory.ends, at)
        total = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(total[borders])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens in order, and the number of tokens of each text."""
        ids, counts, at = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHUNK):
                size += len(texts[stop])
                stop += 1
            some, n = self._chunk(texts[at:stop])
            ids.append(some)
            counts.append(n)
            at = stop
        return np.concatenate(ids), np.concatenate(counts)

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of token lists; unknown tokens give nothing, broken bytes U+FFFD."""
        ids = np.where((ids >= 0) & (ids < len(self.border) - 1), ids, len(self.border) - 2)
        found, at = [], 0
        ends = np.cumsum(counts)
        while at < len(counts):
            begin = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
            data, n = _pick(self.data, self.border, ids[begin : ends[stop - 1]])
            total = np.concatenate([[0], np.cumsum(n)])
            cuts = total[np.concatenate([[0], ends[at:stop] - begin])].tolist()
            whole = data.tobytes()
            found += (
                whole[a:b].decode("utf-8", "replace")
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            )
            at = stop
        return found


def _pick(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``values[ends[i] : ends[i + 1]]`` for ``i`` in ``at``, and the lengths."""
    start, size = ends[at], ends[at + 1] - ends[at]
    shift = start - np.cumsum(size) + size
    return values[np.repeat(shift, size) + np.arange(int(size.sum()))], size


def load(path: str) -> ByteBpe:
    """Read a byte-level BPE vocabulary (a tokenizers JSON file) on the driver.

    The arrays, about 2 MB, travel with the function; executors need no file.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocab = dict(content["model"]["vocab"])
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    chars = byte_chars()
    back = {c: b for b, c in enumerate(chars)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
    keys = np.array([(vocab[a] << 32) + vocab[b] for a, b in merges], np.int64)
    order = np.argsort(keys)
    top = max([*vocab.values(), *added.values()])
    content_of = [b""] * (top + 2)  # the last, empty one stands for unknown tokens
    for token, i in vocab.items():
        content_of[i] = bytes(back[c] for c in token)
    for token, i in added.items():
        content_of[i] = token.encode()
    return ByteBpe(
        keys[order],
        order.astype(np.int32),
        np.array([vocab[a + b] for a, b in merges], np.int32),
        np.array([vocab[c] for c in chars], np.int32),
        np.frombuffer(b"".join(content_of), np.uint8),
        np.concatenate([[0], np.cumsum([len(c) for c in content_of])]),
        added,
        hashlib.sha256(keys.tobytes() + repr(sorted(added.items())).encode()).hexdigest(),
    )


def _slices(column: pa.Array, size: np.ndarray):
    """Stretches of a column of about ``CHUNK`` bytes, so that little is unpacked at once."""
    step = np.cumsum(size) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(column)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield column.slice(a, b - a)


def encode(text: Column, bpe: ByteBpe) -> Column:
    """Token ids ``array<int>`` of whole texts, added tokens included; null gives no tokens."""

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        parts = []
        size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        for part in _slices(texts, size):
            ids, counts = bpe.encode([t or "" for t in part.to_pylist()])
            parts.append(lists(ids, np.concatenate([[0], np.cumsum(counts)]), pa.int32()))
        return pa.concat_arrays(parts)

    return of(text)


def decode(ids: Column, bpe: ByteBpe) -> Column:
    """Text of token ids, special tokens included; null and empty lists give an empty text.

    Null and unknown ids give nothing; bytes that are no UTF-8 give U+FFFD.
    """

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        parts = []
        size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        for part in _slices(column, 4 * size.astype(np.int64)):
            counts = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            parts.append(pa.array(bpe.decode(flat, counts.astype(np.int64)), pa.string()))
        return pa.concat_arrays(parts)

    return of(ids)


def _coded_parts(bpe: ByteBpe, keep_ids: bool):
    """Task function: the fields of ``coded`` for texts, a stretch of them at a time."""

    def parts(texts: pa.Array):
        digits = [f"{i},".encode() for i in range(len(bpe.border) - 1)]
        border = np.concatenate([[0], np.cumsum([len(d) for d in digits])])
        digits = np.frombuffer(b"".join(digits), np.uint8)
        size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        for part in _slices(texts, size):
            ids, counts = bpe.encode([t or "" for t in part.to_pylist()])
            ends = np.concatenate([[0], np.cumsum(counts)])
            spelled, n = _pick(digits, border, ids)
            cuts = np.concatenate([[0], np.cumsum(n)])[ends].tolist()
            spelled = spelled.tobytes()
            sha = [hashlib.sha256(spelled[a : max(a, b - 1)]).hexdigest() for a, b in itertools.pairwise(cuts)]
            read = [hashlib.sha256(t.encode()).hexdigest() for t in bpe.decode(ids, counts)]
            columns = [pa.array(counts.astype(np.int64)), pa.array(sha, pa.string()), pa.array(read, pa.string())]
            if keep_ids:
                columns.append(lists(ids, ends, pa.int32()))
            yield columns

    return parts


def _coded_fields(keep_ids: bool) -> list[str]:
    return ["n_tokens long", "ids_sha256 string", "decoded_sha256 string", *["ids array<int>"] * keep_ids]


def coded(text: Column, bpe: ByteBpe, keep_ids: bool = True) -> Column:
    """``struct<n_tokens, ids_sha256, decoded_sha256, ids>`` of whole texts in one step.

    ``ids`` as ``encode`` gives them, left out if not kept; ``ids_sha256`` is that of the decimal
    ids joined by commas, ``decoded_sha256`` that of the text that ``decode`` makes of them. One
    function, as Spark would encode anew for each column made of the ids, and send all decoded
    texts back. Where the ids of large tables are kept, :func:`tokens` needs less memory.
    """
    fields = [f.replace(" ", ":", 1) for f in _coded_fields(keep_ids)]
    names = [f.split(":")[0] for f in fields]
    of_parts = _coded_parts(bpe, keep_ids)

    @F.arrow_udf(f"struct<{','.join(fields)}>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.StructArray.from_arrays(c, names=names) for c in of_parts(texts)])

    return of(text)


def tokens(docs: DataFrame, bpe: ByteBpe, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the fields of ``coded``, ids included, for every row of ``docs``.

    A task hands on the ids of about ``CHUNK`` bytes of text at a time, so neither a worker nor
    its executor holds those of a whole batch of rows.
    """
    fields, of_parts = _coded_fields(True), _coded_parts(bpe, True)
    names = [key, *(f.split(" ")[0] for f in fields)]
    schema = StructType([docs.schema[key], *shape(", ".join(fields))])

    def run(batches):
        for batch in batches:
            at = 0
            for columns in of_parts(batch.column(1)):
                rows = len(columns[0])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, rows), *columns], names=names)
                at += rows

    return docs.select(key, text).mapInArrow(run, schema)
