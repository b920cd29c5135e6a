"""Periodic word runs by seeds that are extended along diagonals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import digest

# A run has at least this many words, and this many periods.
LEAST, PERIODS = 6, 4
# UTF-8 bytes of the texts that are searched together, to bound the memory of one step.
CHUNK = 1 << 21
# Words compared at once where a match is extended; doubled as long as it goes on.
_REACH = 64


def _longer(place: np.ndarray, name: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams that ``shift`` more words make, where they recur.

    ``name[i]`` names the gram at word ``place[i]``; a longer gram is the pair of the names at its
    start and ``shift`` words on. If it recurs, so do both parts: grams that occur once are
    left out at every length.
    """
    at = np.minimum(np.searchsorted(place, place + shift), max(len(place) - 1, 0))
    both = np.flatnonzero(place[at] == place + shift)
    return _again(place[both], name[both] * (int(name.max(initial=0)) + 1) + name[at[both]])


def _again(place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, name, count = np.unique(key, return_inverse=True, return_counts=True)
    alive = count[name] > 1
    return place[alive], name[alive]


def _seeds(word: np.ndarray, longest: int):
    """``(gram, starts, lags)`` for each range of periods ``[2**j, 2**(j + 1))``.

    On the diagonal of its period ``q`` a run matches ``max(6, 4 * q) - q`` words or more; the
    least of this in the range is the length of its grams. It is no less than any ``q`` of the
    range, so within a run two occurrences of a gram that follow each other are just ``q`` apart
    (else the run had a smaller period), and only next occurrences need to be looked at.
    """
    place, name = _again(np.arange(len(word)), word)
    place, name = _longer(*_longer(place, name, 1), 2)
    low = 1
    while PERIODS * low <= longest and len(place):
        if low == 1:
            grams, here, called = LEAST - 1, *_longer(place, name, 1)
        else:
            grams = 3 * low
            place, name = _longer(place, name, 2 if low == 2 else grams // 2)
            here, called = place, name
        order = np.argsort(called, kind="stable")
        lag = np.diff(here[order])
        fits = (np.diff(called[order]) == 0) & (lag >= low) & (lag < 2 * low)
        starts, lags = here[order[:-1]][fits] if len(order) else here, lag[fits]
        by_lag = np.lexsort((starts, lags))
        yield grams, starts[by_lag], lags[by_lag]
        low *= 2


def _extend(word: np.ndarray, at: int, lag: int, step: int) -> int:
    """How far words ``lag`` apart go on matching from ``at``, forwards or backwards."""
    done, block = 0, _REACH
    while True:
        if step > 0:
            size = min(block, len(word) - lag - at - done)
            a = word[at + done : at + done + size]
            b = word[at + done + lag : at + done + lag + size]
        else:
            size = min(block, at + 1 - done)
            a = word[at - done - size + 1 : at - done + 1][::-1]
            b = word[at - done - size + 1 + lag : at - done + 1 + lag][::-1]
        unlike = np.flatnonzero(a != b)
        if len(unlike):
            return done + int(unlike[0])
        done += max(size, 0)
        if size < block:
            return done
        block *= 2


def runs(word: np.ndarray, longest: int) -> np.ndarray:
    """``(start, length, period)`` of all runs among numbered words, ascending.

    Words of different texts must have different numbers: then no match crosses their border.
    """
    found = []
    for grams, starts, lags in _seeds(word, longest):
        # A seed next to one of the same lag is the same match; what is left meets the table of
        # the furthest word that a match of this lag has covered.
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1] + 1) | (lags[1:] != lags[:-1])
        covered: dict[int, int] = {}
        for at, lag in zip(starts[new].tolist(), lags[new].tolist(), strict=True):
            if at < covered.get(lag, 0):
                continue
            end = at + grams + _extend(word, at + grams, lag, 1)
            begin = at - _extend(word, at - 1, lag, -1)
            covered[lag] = end
            if end - begin + lag >= max(LEAST, PERIODS * lag):
                found.append((begin, end - begin + lag, lag))
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _search(texts: list[bytes]):
    """``(words, runs, borders of runs, kept texts)`` of some texts."""
    split = [t.split() for t in texts]
    flat = [w for words in split for w in words]
    number = {w: n for n, w in enumerate(dict.fromkeys(flat))}
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ends = np.cumsum(sizes)
    word = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    word += np.repeat(np.arange(len(split)) * len(number), sizes)
    found = runs(word, int(sizes.max(initial=0)))
    owner = np.searchsorted(ends, found[:, 0], "right")
    gone = np.zeros(len(word) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    gone = np.cumsum(gone)[:-1] > 0
    touched = set(owner.tolist())
    kept = []
    for n, words in enumerate(split):
        if n in touched:
            drop = gone[ends[n] - sizes[n] : ends[n]].tolist()
            words = [w for w, d in zip(words, drop, strict=True) if not d]
        kept.append(b" ".join(words))
    found[:, 0] -= (ends - sizes)[owner]
    return sizes, found, np.searchsorted(owner, np.arange(len(split) + 1)), kept


def _chunks(texts: pa.Array):
    """Stretches of texts of about ``CHUNK`` bytes."""
    size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    step = np.cumsum(size, dtype=np.int64) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield [t or b"" for t in texts.slice(a, b - a).cast(pa.binary()).to_pylist()]


def find(text: Column) -> Column:
    """``struct<n_words, runs: array<struct<start, length, period>>, collapsed>`` of whole texts.

    Words are runs of anything but ASCII white space. A run is a stretch of at least ``LEAST``
    words and ``PERIODS`` periods that repeats with its smallest period and that no neighbouring
    word extends; runs come by start, then period. ``collapsed`` are the words less those that
    any run holds after its first period, joined by one space. Null, empty and blank texts have
    no words, no runs and an empty ``collapsed``.

    Texts are searched where they lie; nothing is shuffled, and memory holds ``CHUNK`` bytes of
    texts, or one longer text, at a time. The work grows with words times ranges of periods, also
    for a text of one repeated word: no pairs of occurrences other than neighbours are formed.
    """

    @F.arrow_udf(
        "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"
    )
    def of(texts: pa.Array) -> pa.Array:
        parts = []
        for some in _chunks(texts):
            sizes, found, borders, kept = _search(some)
            fields = [pa.array(np.ascontiguousarray(found[:, c])) for c in range(3)]
            places = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
            parts.append(pa.StructArray.from_arrays(
                [pa.array(sizes), pa.ListArray.from_arrays(pa.array(borders, pa.int32()), places),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["n_words", "runs", "collapsed"],
            ))
        return pa.concat_arrays(parts)

    return of(text)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, runs, collapsed``; columns of these names are replaced.

    Rows are neither dropped nor joined: repeated rows, null ids and all other columns stay, and
    an empty table stays empty.
    """
    added = ("n_words", "runs", "collapsed")
    base = docs.select(*[c for c in docs.columns if c.lower() not in added], find(F.col(text)).alias(added[0]))
    return base.select(*base.columns[:-1], *[F.col(f"n_words.{c}").alias(c) for c in added])


def greatest(found: Column) -> Column:
    """The longest run; of equal lengths the first, then that of the smallest period."""
    ranked = F.transform(
        found, lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    )
    top = F.array_max(ranked)
    return F.struct((-top["s"]).alias("start"), top["l"].alias("length"), (-top["p"]).alias("period"))


def runs_digest(found: Column) -> Column:
    """SHA-256 of the lines ``start,length,period`` of all runs."""
    line = F.transform(found, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return digest(F.array_join(line, ""))


def repeat_tail(text: Column, period_of: Column) -> Column:
    """Texts whose words from a place on repeat a stretch, to have runs of every size.

    With ``g = period_of`` and ``n`` words, word ``i >= a = g % n`` becomes word
    ``a + (i - a) % p`` with ``p = 1 + (n - a) // (3 + g % 8)``; words are joined by one space.
    Null texts, null ``g`` and texts without words give null.
    """

    @F.arrow_udf("string")
    def of(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        out = []
        for t, g in zip(texts, seeds, strict=True):
            words = t.as_py().encode().split() if t.is_valid and g.is_valid else []
            if not words:
                out.append(None)
                continue
            n, g = len(words), g.as_py()
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            again = words[a : a + p] * ((n - a) // p + 1)
            out.append(b" ".join(words[:a] + again[: n - a]).decode())
        return pa.array(out, pa.string())

    return of(text, period_of)
