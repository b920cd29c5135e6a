"""Removal of long word runs that occur in an earlier document, by recompression."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from textweir.llm import repeats
from textweir.llm.hashing import xxh64

WINDOW = 50
# Rounds of pair naming; a symbol grows by about a third in each.
ROUNDS = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray, y: np.ndarray | int = 0) -> np.ndarray:
    """A 64-bit name for a pair; it depends on the order of the two."""
    z = (x * _ODD) ^ (np.atleast_1d(np.asarray(y, np.uint64)) * _TWO + _ODD)
    z = (z ^ (z >> np.uint64(32))) * _TWO
    z = (z ^ (z >> np.uint64(29))) * _ODD
    return z ^ (z >> np.uint64(32))


def levels(words: np.ndarray, first: np.ndarray, last: np.ndarray, rounds: int = ROUNDS):
    """Recompression: ``(name, low, high)`` of the symbols after each round, words first.

    ``words`` are hashed words of texts end to end, ``first`` and ``last`` the borders of the
    text of each word. Names are hashes of what they stand for, so a name means the same in
    every text and task, and a round over all texts needs no dictionary.

    The first round names runs of one word. Each further round splits the names in two classes
    by one bit of a hash and names every pair of a left and a right one. Whether a symbol joins
    depends on its neighbour alone; ``low`` and ``high`` bound the words on which a symbol
    depends (beyond the text at its ends), so a symbol whose bounds lie inside a span of words
    is found again in every other occurrence of that span.
    """
    place = np.arange(len(words))
    yield words, place, place + 1
    fresh = np.concatenate([[True], (words[1:] != words[:-1]) | (first[1:] != first[:-1])])
    at = np.flatnonzero(fresh)
    size = np.diff(np.append(at, len(words)))
    name = np.where(size > 1, _mix(words[at], size), words[at])
    low, high = at - 1, at + size + 1
    text, end = first[at], last[at]
    yield name, low, high
    for r in range(rounds):
        side = (_mix(name, r + 1) >> np.uint64(63)).astype(bool)
        same = np.append(text[1:] == text[:-1], False)
        right_ok = np.append(side[1:], False) & same
        pair = ~side & right_ok  # a left one before a right one
        second = np.concatenate([[False], pair[:-1]])
        # What stays single has looked at one neighbour, or at the border of its text.
        next_high = np.where(same, np.append(high[1:], 0), end + 1)
        back = np.concatenate([[False], same[:-1]])
        before_low = np.where(back, np.concatenate([[0], low[:-1]]), text - 1)
        high = np.where(side, high, np.maximum(high, next_high))
        low = np.where(side & ~second, np.minimum(low, before_low), low)
        joined = np.flatnonzero(pair)
        name = name.copy()
        name[joined] = _mix(name[joined], name[joined + 1])
        keep = ~second
        name, low, high, text, end = name[keep], low[keep], high[keep], text[keep], end[keep]
        yield name, low, high


def _least(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of the smallest key in each range ``[a, b)``, the first of equal ones."""
    table = [np.arange(len(key))]
    reach = 1
    widest = int((b - a).max())
    while 2 * reach <= widest:
        x, y = table[-1][:-reach], table[-1][reach:]
        table.append(np.where(key[y] < key[x], y, x))
        reach *= 2
    step = np.frexp((b - a).astype(float))[1] - 1
    out = np.empty(len(a), np.int64)
    for n, t in enumerate(table):
        i = np.flatnonzero(step == n)
        x, y = t[a[i]], t[b[i] - (1 << n)]
        out[i] = np.where(key[y] < key[x], y, x)
    return out


def find(texts: list[bytes], window: int = WINDOW, rounds: int = ROUNDS):
    """Anchors of the windows of some texts, for ``repeats.anchors``.

    A window's anchor is the symbol of the highest round that depends on nothing outside the
    window, and of several the one with the smallest hash.
    """
    words: list[bytes] = []
    owners, counts = [], []
    for i, text in enumerate(texts):
        mine = text.split()
        if len(mine) >= window:
            words += mine
            owners.append(i)
            counts.append(len(mine))
    if not words:
        empty = np.zeros(0, np.int64)
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty
    size = np.fromiter(map(len, words), np.int64, len(words))
    line = b" ".join(words)
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    count = np.array(counts)
    border = np.cumsum(count)
    first = np.repeat(border - count, count)
    last = np.repeat(border, count)
    place = np.arange(len(words))
    todo = place[place + window <= last]
    chosen = np.full(len(words), -1)  # level and symbol of the window that starts here
    name = np.zeros(len(words), np.uint64)
    every = list(levels(xxh64(line, starts, size), first, last, rounds))
    for level in range(len(every) - 1, -1, -1):
        names, low, high = every[level]
        a = np.searchsorted(low, todo, "left")
        b = np.searchsorted(high, todo + window, "right")
        inside = np.flatnonzero(a < b)
        if len(inside):
            best = _least(_mix(names, level), a[inside], b[inside])
            chosen[todo[inside]] = best * len(every) + level
            name[todo[inside]] = _mix(names[best], level)
            todo = todo[a >= b]
        if not len(todo):
            break
    whole = place[place + window <= last]
    group = chosen[whole]
    cut = np.concatenate([[True], (group[1:] != group[:-1]) | (first[whole][1:] != first[whole][:-1])])
    at = np.flatnonzero(cut)
    n = np.diff(np.append(at, len(whole)))
    at = whole[at]
    stop = ends[at + n - 1 + window - 1].tolist()
    of = xxhash.xxh3_64_intdigest
    snip = [of(line[x:y]) for x, y in zip(starts[at].tolist(), stop, strict=True)]
    owner = np.repeat(np.array(owners), count)[at]
    return owner, name[at], np.array(snip, np.uint64), at - first[at], n


def _lines(parts: list[bytes]) -> tuple[list[int], list[int], np.ndarray]:
    """Where the words of the snippets begin and end, end to end, and the words of each."""
    split = [p.split(b" ") for p in parts]
    count = np.fromiter(map(len, split), np.int64, len(split))
    words = [w for mine in split for w in mine]
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    return (ends - size).tolist(), ends.tolist(), count


def _equal(window: int):
    """Classes of equal windows by 128-bit hashes of their words."""

    def equal(parts: list[bytes], counts: np.ndarray):
        starts, ends, words = _lines(parts)
        line = b" ".join(parts)
        owner = np.repeat(np.arange(len(parts)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = np.repeat(np.cumsum(words) - words, counts) + inside
        of = xxhash.xxh3_128_digest
        names = b"".join(of(line[starts[a] : ends[a + window - 1]]) for a in first.tolist())
        both = np.frombuffer(names, np.int64).reshape(-1, 2)
        order = np.lexsort((both[:, 1], both[:, 0]))
        near = both[order]
        group = np.cumsum(np.concatenate([[0], (near[1:] != near[:-1]).any(axis=1)]))
        begin = np.cumsum(counts) - counts

        def name(some_owner, some_inside):
            return both[begin[some_owner] + some_inside].tobytes()

        return (group, owner[order], inside[order]), name

    return equal


def _cut(text: bytes, at: np.ndarray, n: np.ndarray, window: int) -> list[bytes]:
    words = text.split()
    return [
        b" ".join(words[a : a + c - 1 + window]) for a, c in zip(at.tolist(), n.tolist(), strict=True)
    ]


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, hot: int = repeats.HOT
) -> DataFrame:
    """``(k, at, n)``: runs of windows that also start in a document with a smaller id.

    ``docs`` as from ``repeats.keyed``. Shared symbols reveal the repeats; the words of the
    snippets around them verify each window.
    """
    find_ = lambda texts: find(texts, window, rounds)
    cut = lambda text, at, n: _cut(text, at, n, window)
    return repeats.repeated(docs, find_, cut, _equal(window), True, hot, 8 * window)


def _remove(window: int):
    def remove(text: bytes, at: np.ndarray, n: np.ndarray):
        words = text.split()
        if not len(at):
            return len(words), 0, b" ".join(words).decode()
        gone = repeats.marked(len(words), at, n, window)
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        return len(words), int(gone.sum()), b" ".join(kept).decode()

    return remove


def deduplicate(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``, one row for each row of ``docs``.

    A word is a run of other characters than blank and U+0009 to U+000D. Removed is each word
    covered by ``window`` consecutive words that also start in a document with a smaller
    ``doc_id``; windows are judged on the input. ``kept`` are the other words joined by blanks.

    Null and empty texts have no words. A null id counts as larger than all others, so such a
    text loses what others hold and causes no removal elsewhere; rows with equal ids do not
    remove each other's words. Equal rows give equal rows. Other columns are ignored.
    """
    rows = repeats.keyed(docs, doc_id, text)
    spans = repeated_spans(rows, window)
    return repeats.removals(rows, spans, _remove(window), "n_words long, n_removed long, kept string")
