"""Language of texts and of the spans of mixed texts."""

from __future__ import annotations

import itertools
import unicodedata
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a text without letters gets.
UNKNOWN = "und"
FOLDS = 5
# Buckets of hashed grams for up to ``WIDE`` languages; fewer for more, so the model is bounded.
BUCKETS, WIDE = 1 << 15, 256
# Kinds of grams: two letters, three letters, whole words.
KINDS = 3
# Added to each count, so that grams a language was not seen with stay possible.
SMOOTH = 0.5
# A language is a candidate for words of a script from this share of its letters on.
SCRIPT_SHARE = 0.01
# Log odds that one word can cost a language at most, and that a change of language costs.
FLOOR, SWITCH = 8.0, 12.0
# Characters that are scored together, to bound the memory of one step.
CHUNK = 1 << 20

# First and last code points of scripts; other letters are one more script.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F), ("Greek", 0x0370, 0x03FF), ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Gurmukhi", 0x0A00, 0x0A7F),
    ("Gujarati", 0x0A80, 0x0AFF), ("Tamil", 0x0B80, 0x0BFF), ("Telugu", 0x0C00, 0x0C7F),
    ("Kannada", 0x0C80, 0x0CFF), ("Malayalam", 0x0D00, 0x0D7F), ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF), ("Ethiopic", 0x1200, 0x137F), ("Latin", 0x1E00, 0x1EFF),
    ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF), ("Hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = [*dict.fromkeys(name for name, _, _ in SCRIPTS), "other"]


@dataclass(frozen=True)
class Letters:
    """What every code point is: letter or mark, its lower case, its script; packed to travel."""

    kinds: bytes
    upper: np.ndarray
    lower: np.ndarray

    @staticmethod
    def of_unicode() -> Letters:
        kind = {"L": 1, "M": 2}
        every = [chr(c) for c in range(0x110000)]
        kinds = bytes(kind.get(unicodedata.category(c)[0], 0) for c in every)
        pairs = [(ord(c), ord(c.lower())) for c in every if len(c.lower()) == 1 and c.lower() != c]
        upper, lower = np.array(pairs, np.uint32).T
        return Letters(zlib.compress(kinds), upper, lower)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kinds = np.frombuffer(zlib.decompress(self.kinds), np.uint8)
        lower = np.arange(len(kinds), dtype=np.uint32)
        lower[self.upper] = self.lower
        script = np.full(len(kinds), len(SCRIPT_NAMES) - 1, np.uint8)
        for name, first, last in SCRIPTS:
            script[first : last + 1] = SCRIPT_NAMES.index(name)
        return kinds, lower, script


@dataclass
class Words:
    """The words of some texts: places among all characters, and their hashed grams.

    ``owner``, ``start``, ``stop``, ``letters``, ``script``, ``whole`` have one value for each
    word, ``two`` and ``three`` one for each character of a word, word after word; ``border``
    are the words' first places among these. A word is letters and the marks between and after
    them.
    """

    owner: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    whole: np.ndarray
    two: np.ndarray
    three: np.ndarray
    border: np.ndarray


def _mix(parts: list[np.ndarray], buckets: int) -> np.ndarray:
    """Bucket of each tuple of code points."""
    h = np.zeros(len(parts[0]), np.uint32)
    for part in parts:
        h = (h ^ part) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h % np.uint32(buckets)).astype(np.int32)


def words_of(texts: list[str], tables, buckets: int) -> Words:
    """Cut texts into words and hash their grams; a word's ends count as a letter of their own."""
    kinds, lower, script = tables
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(sizes) - sizes
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le"), np.uint32)
    kind = kinds[points]
    inside = kind > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    start, stop = edge[::2], edge[1::2]
    letters = np.add.reduceat(kind == 1, start, dtype=np.int64) if len(start) else start
    # reduceat runs on to the next start; nothing between words is a letter. Marks alone are no word.
    start, stop, letters = (x[letters > 0] for x in (start, stop, letters))
    size = stop - start
    border = np.cumsum(size) - size
    at = np.repeat(start - border, size) + np.arange(int(size.sum()))
    small = np.where(inside, lower[points], 0).astype(np.uint32)
    here, before, after = small[at], small[np.maximum(at - 1, 0)], small[at + 1]
    before[at == 0] = 0
    turn = np.uint32(0x85EBCA6B) ** (np.arange(len(at)) - np.repeat(border, size)).astype(np.uint32)
    spelled = np.add.reduceat((here + np.uint32(1)) * turn, border, dtype=np.uint32) if len(border) else small[:0]
    owner = np.searchsorted(first, start, "right") - 1
    return Words(
        owner, start - first[owner], stop - first[owner], letters, script[points[start]],
        _mix([spelled], buckets), _mix([before, here], buckets), _mix([before, here, after], buckets), border,
    )


@dataclass
class LanguageModel:
    """Log probabilities of hashed grams by language, and the candidates of each script."""

    languages: list[str]
    buckets: int
    table: np.ndarray  # (KINDS * buckets, languages)
    candidates: np.ndarray  # (scripts, languages)
    letters: Letters

    def scores(self, words: Words) -> np.ndarray:
        """Log odds of each language for each word, the best one 0, none below ``-FLOOR``.

        Only candidates of the word's script are scored; a script that no language was seen in
        says nothing.
        """
        out = np.full((len(words.start), len(self.languages)), -FLOOR, np.float32)
        size = np.diff(np.append(words.border, len(words.two)))
        for s in np.unique(words.script):
            able = np.flatnonzero(self.candidates[s])
            rows = np.flatnonzero(words.script == s)
            if not len(able):
                out[rows] = 0
                continue
            if len(able) == len(self.languages) and len(rows) == len(out):
                table, at, border = self.table, slice(None), words.border
            else:
                table = np.ascontiguousarray(self.table[:, able])
                at = np.flatnonzero(np.repeat(words.script == s, size))
                border = np.cumsum(size[rows]) - size[rows]
            chars = table[words.two[at]] + table[self.buckets + words.three[at]]
            found = np.add.reduceat(chars, border, axis=0) / 2
            found += table[2 * self.buckets + words.whole[rows]]
            found -= found.max(axis=1, keepdims=True)
            out[np.ix_(rows, able)] = np.maximum(found, -FLOOR)
        return out


def viterbi(scores: np.ndarray, owner: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path of its text.

    A path is worth the scores of its words less ``switch`` for each change of language. Texts
    go side by side, the longest first: step ``t`` takes word ``t`` of all texts that have one.
    Of equal paths the one that stays, then the earlier language, counts.
    """
    label = np.zeros(len(owner), np.int64)
    if not len(owner):
        return label
    _, first, count = np.unique(owner, return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    active = np.searchsorted(-count, -np.arange(int(count[0])), "left")
    best = scores[first].astype(np.float64)
    back, stays = [], []
    for t in range(1, len(active)):
        n = active[t]
        old = best[:n]
        jump = old.max(axis=1, keepdims=True) - switch
        back.append(old.argmax(axis=1))
        stays.append(old >= jump)
        best[:n] = np.maximum(old, jump) + scores[first[:n] + t]
    state = best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        label[first[:n] + t] = state[:n]
        if t:
            stay = stays[t - 1][np.arange(n), state[:n]]
            state[:n] = np.where(stay, state[:n], back[t - 1])
    return label


def _chunks(texts: pa.Array):
    """Stretches of texts of about ``CHUNK`` bytes, nulls as empty texts."""
    size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    step = np.cumsum(size, dtype=np.int64) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(texts)]
    for a, b in itertools.pairwise(cuts):
        yield a, [t or "" for t in texts.slice(a, b - a).to_pylist()]


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids whose languages are never learned; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _counting(languages: list[str], buckets: int, letters: Letters):
    """Count grams and scripts of all texts of a task by language, one row per non-zero count."""
    scripts = len(SCRIPT_NAMES)
    width = KINDS * buckets + scripts
    number = {name: n for n, name in enumerate(languages)}

    def run(batches):
        tables = letters.tables()
        total = np.zeros(len(languages) * width, np.int64)
        for batch in batches:
            known = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for a, texts in _chunks(batch.column("text")):
                words = words_of(texts, tables, buckets)
                base = known[a + words.owner] * width
                each = np.repeat(base, np.diff(np.append(words.border, len(words.two))))
                for spot in (each + words.two, each + buckets + words.three, base + 2 * buckets + words.whole):
                    total += np.bincount(spot, minlength=len(total))
                seen = base + KINDS * buckets + words.script
                total += np.bincount(seen, weights=words.letters, minlength=len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // width).astype(np.int32)), pa.array((at % width).astype(np.int32)), pa.array(total[at])],
            names=["language", "spot", "n"],
        )

    return run


def fit(docs: DataFrame) -> LanguageModel:
    """Learn from all texts with a language outside the held-out fifth.

    ``docs (doc_id, text, lang)``; rows with a null id, text or language are left out, other
    columns are ignored. Grams are counted over whole texts inside the tasks, each of which
    gives at most one row per language and bucket to a summing shuffle, however its rows are
    spread over languages. The driver receives the sums: at most ``KINDS * BUCKETS`` and the
    scripts for each of up to ``WIDE`` languages, and no more beyond, as buckets are halved.
    Without such rows the model has no languages.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    known = known.where(~held_out(F.col("doc_id")))
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())
    buckets = BUCKETS
    while buckets * len(languages) > BUCKETS * WIDE and buckets > 1:
        buckets //= 2
    letters = Letters.of_unicode()
    width = KINDS * buckets + len(SCRIPT_NAMES)
    counts = np.zeros((max(len(languages), 1), width))
    if languages:
        counted = known.select("lang", "text").mapInArrow(
            _counting(languages, buckets, letters), "language int, spot int, n long"
        )
        summed = counted.groupBy("language", "spot").agg(F.sum("n").alias("n")).toArrow()
        language, spot, n = (c.to_numpy() for c in summed.columns)
        counts[language, spot] = n
    table = np.empty((KINDS * buckets, len(languages)), np.float32)
    for k in range(KINDS):
        part = counts[: len(languages), k * buckets : (k + 1) * buckets] + SMOOTH
        table[k * buckets : (k + 1) * buckets] = np.log(part / part.sum(axis=1, keepdims=True)).T
    scripts = counts[: len(languages), KINDS * buckets :]
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return LanguageModel(languages, buckets, table, (share >= SCRIPT_SHARE).T, letters)


def spans(text: Column, model: LanguageModel) -> Column:
    """``struct<language, score, spans: array<struct<start, stop, language, letters>>>``.

    Spans are the stretches of words of one language on the best path, from the first to the
    last character of their words (code points, ``stop`` exclusive); ``letters`` are the letters
    in them. ``language`` holds most letters (of equal ones the first by name), ``score`` is its
    share. Null texts and texts without a letter have no spans, ``UNKNOWN`` and 0, and so has
    every text under a model without languages.
    """

    @F.arrow_udf(
        "struct<language:string,score:double,"
        "spans:array<struct<start:long,stop:long,language:string,letters:long>>>"
    )
    def of(column: pa.Array) -> pa.Array:
        tables = model.letters.tables()
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        wide = len(model.languages)
        parts = []
        for _, texts in _chunks(column):
            words = words_of(texts, tables, model.buckets)
            if not wide:
                words = words_of([""] * len(texts), tables, model.buckets)
            label = viterbi(model.scores(words), words.owner) if wide else words.owner
            spot = words.owner * max(wide, 1) + label
            held = np.bincount(spot, weights=words.letters, minlength=len(texts) * max(wide, 1))
            held = held.reshape(len(texts), -1)
            letters = held.sum(axis=1)
            main = np.where(letters > 0, held.argmax(axis=1), wide)
            share = held.max(axis=1) / np.maximum(letters, 1)
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (words.owner[1:] != words.owner[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(label)) - 1
            sums = np.add.reduceat(words.letters, begin) if len(begin) else begin
            found = pa.StructArray.from_arrays(
                [pa.array(words.start[begin]), pa.array(words.stop[last] if len(begin) else begin),
                 names.take(pa.array(label[begin])), pa.array(sums.astype(np.int64))],
                names=["start", "stop", "language", "letters"],
            )
            borders = np.searchsorted(words.owner[begin], np.arange(len(texts) + 1))
            parts.append(pa.StructArray.from_arrays(
                [names.take(pa.array(main)), pa.array(share),
                 pa.ListArray.from_arrays(pa.array(borders, pa.int32()), found)],
                names=["language", "score", "spans"],
            ))
        return pa.concat_arrays(parts)

    return of(text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, spans``; columns of these names are replaced.

    Only the text enters. Rows are neither dropped nor joined; an empty table stays empty.
    """
    added = ("lang_pred", "score", "spans")
    base = docs.select(*[c for c in docs.columns if c.lower() not in added], spans(F.col(text), model).alias(added[0]))
    found = F.col(added[0])
    return base.select(
        *base.columns[:-1],
        *[found[c].alias(a) for c, a in zip(("language", "score", "spans"), added, strict=True)],
    )
