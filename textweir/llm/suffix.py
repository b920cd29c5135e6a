"""Removal of long byte strings that occur earlier, by suffix arrays."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from textweir.llm import repeats

WINDOW = 100
# Bytes of an anchor. Every window holds ``WINDOW - GRAM + 1`` of them.
GRAM = 32
_LANES = 64
_RANDOM = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_ODD = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64((1 << 22) - 1)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash for each ``size`` neighbouring bytes, a power of two, by doubling."""
    h = _RANDOM[data]
    reach, step = 1, 0
    while reach < size:
        h = h[:-reach] * _ODD[step] + h[reach:]
        h ^= h >> np.uint64(29)
        reach, step = 2 * reach, step + 1
    h = h * _ODD[step]
    return h ^ (h >> np.uint64(31))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    reach, whole = 1, x
    while 2 * reach <= width:
        whole = np.minimum(whole[:-reach], whole[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(whole[:-rest], whole[rest:]) if rest else whole


def find(texts: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """Anchors of the windows of some texts, for ``repeats.anchors``: the smallest gram hash.

    The place stands in the low bits of what is compared, so of equal hashes the first counts.
    """
    kept = [(i, t) for i, t in enumerate(texts) if len(t) >= window]
    empty = np.zeros(0, np.int64)
    found = [(empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty)]
    part: list[tuple[int, bytes]] = []
    size = 0
    for i, text in kept:
        # A very long text goes in pieces that overlap by a window, less one byte.
        for a in range(0, max(1, len(text) - window + 1), 2 * repeats.CHUNK):
            piece = text[a : a + 2 * repeats.CHUNK + window - 1]
            if size + len(piece) > 3 * repeats.CHUNK and part:
                found.append(_find(part, window, gram))
                part, size = [], 0
            part.append((i, a, piece))
            size += len(piece)
    if part:
        found.append(_find(part, window, gram))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _find(part: list[tuple[int, int, bytes]], window: int, gram: int):
    line = b"".join(p for _, _, p in part)
    size = np.array([len(p) for _, _, p in part])
    border = np.cumsum(size)
    hashes = _gram_hashes(np.frombuffer(line, np.uint8), gram)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (_sliding_min(keys, window - gram + 1) & _PLACE).astype(np.int64)
    number = np.repeat(np.arange(len(part)), size)[: len(place)]
    inside = np.arange(len(place)) + window <= border[number]
    whole = np.flatnonzero(inside)
    group, of = place[whole], number[whole]
    at = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (of[1:] != of[:-1])]))
    n = np.diff(np.append(at, len(whole)))
    first = whole[at]
    h = hashes[group[at]]
    digest = xxhash.xxh3_64_intdigest
    ends = (first + n - 1 + window).tolist()
    snip = [digest(line[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
    mine = of[at]
    owner = np.array([i for i, _, _ in part])[mine]
    shift = np.array([a for _, a, _ in part])[mine]
    return owner, h, np.array(snip, np.uint64), first - (border - size)[mine] + shift, n


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` (bytes) in order of their first ``depth`` bytes or more, and ranks.

    Larsson and Sadakane's refinement: suffixes are ordered by eight bytes at first; then the
    groups that are still tied are ordered by the rank of the suffix that starts ``reach`` bytes
    further on, which doubles the reach, while settled suffixes are left alone.
    """
    n = len(data)
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    head = np.ndarray(n, ">u8", room.tobytes(), strides=(1,)).astype(np.uint64)
    order = np.argsort(head, kind="stable")
    sorted_head = head[order]
    new = np.concatenate([[True], sorted_head[1:] != sorted_head[:-1]])[:n]
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = group
    reach = 8
    while reach < depth:
        tied = ~new | ~np.append(new[1:], True)
        at = np.flatnonzero(tied)
        if not len(at):
            break
        suffix = order[at]
        ahead = suffix + reach
        key = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = group[at]
        # Groups keep their places, so one sort by group and key orders all of them.
        inner = np.lexsort((key, own)) if n >= 1 << 31 else np.argsort((own << 32) | key, kind="stable")
        order[at] = suffix[inner]
        key, own = key[inner], own[inner]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        new[at] = fresh
        group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[at]] = group[at]
        reach *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to ``limit`` bytes.

    Kasai's rule, in lanes: the value at a place is at least that of the place before, less
    one. That holds only for the whole order, so no suffixes may be left tied in ``order``.
    Each lane walks its own stretch of the text, all lanes side by side.
    """
    n = len(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    room = np.concatenate([data, np.zeros(1, np.uint8)])
    common = np.zeros(n, np.int64)
    carry = np.zeros(-(-n // _LANES), np.int64)
    for step in range(_LANES):
        here = np.arange(step, n, _LANES)
        carry = np.maximum(carry[: len(here)] - 1, 0)
        there = before[here]
        carry[there < 0] = 0
        open_ = np.flatnonzero((there >= 0) & (carry < limit))
        while len(open_):
            a, b = here[open_] + carry[open_], there[open_] + carry[open_]
            end = np.maximum(a, b) < n
            same = end & (room[np.minimum(a, n)] == room[np.minimum(b, n)])
            open_ = open_[same]
            carry[open_] += 1
            open_ = open_[carry[open_] < limit]
        common[here] = carry
    return common[order]


def equal_windows(parts: list[bytes], counts: np.ndarray, window: int):
    """Classes of the windows of some snippets: ``(class, snippet, window of the snippet)``.

    ``counts`` windows start at the first bytes of each snippet. Windows are of one class if
    they are equal; their suffixes are then neighbours with a common prefix of a whole window.
    """
    data = np.frombuffer(b"".join(parts), np.uint8)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    first = np.cumsum(size) - size
    order, _ = suffix_array(data, len(data))
    common = common_prefixes(data, order, window)
    group = np.cumsum(common < window)
    owner = np.repeat(np.arange(len(parts)), size)
    inside = np.arange(len(data)) - first[owner]
    starts = (inside < counts[owner])[order]
    place = order[starts]
    return group[starts], owner[place], inside[place]


def _equal(window: int):
    def equal(parts: list[bytes], counts: np.ndarray):
        def name(owner, inside):
            of = xxhash.xxh3_128_digest
            pairs = zip(owner.tolist(), inside.tolist(), strict=True)
            return b"".join(of(parts[o][i : i + window]) for o, i in pairs)

        return equal_windows(parts, counts, window), name

    return equal


def _cut(window: int):
    def cut(text: bytes, at: np.ndarray, n: np.ndarray) -> list[bytes]:
        return [text[a : a + c - 1 + window] for a, c in zip(at.tolist(), n.tolist(), strict=True)]

    return cut


def repeated_spans(docs: DataFrame, window: int = WINDOW, hot: int = repeats.HOT) -> DataFrame:
    """``(k, at, n)``: runs of windows whose bytes also start earlier.

    ``docs`` as from ``repeats.keyed``; earlier is a smaller id, then a smaller ``k`` (texts
    that share an id), then an earlier place. A shard settles its windows by a suffix array.
    """
    find_ = lambda texts: find(texts, window)
    return repeats.repeated(docs, find_, _cut(window), _equal(window), False, hot, window)


def _remove(window: int):
    def remove(text: bytes, at: np.ndarray, n: np.ndarray):
        if not len(at):
            return len(text), 0, 0, text
        gone = repeats.marked(len(text), at, n, window)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        return len(text), int(gone.sum()), spans, kept

    return remove


def deduplicate(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept binary)``, one row for each row of ``docs``.

    Removed is each byte covered by a ``window``-byte string of the same text that also starts
    earlier: in a document with a smaller id, or earlier in the same one; overlaps count, and
    strings are judged on the input. ``n_spans`` counts the maximal removed runs; ``kept``
    holds the other bytes.

    Null and empty texts have no bytes. A null id counts as larger than all others; texts that
    share an id go by a hash of id and text; equal rows are one document and give equal rows.
    Other columns are ignored. An empty table gives no rows.
    """
    rows = repeats.keyed(docs, doc_id, text)
    spans = repeated_spans(rows, window)
    schema = "n_bytes long, n_removed long, n_spans long, kept binary"
    return repeats.removals(rows, spans, _remove(window), schema)
