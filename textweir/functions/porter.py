"""Suffix stripping after Porter (1980), with the usual later extensions.

The rules are data: ``(suffix, replacement, smallest measure of the stem)``. The extended
variant adds a pool of irregular words, keeps words of one or two letters, and relaxes
the rules for ``ies``, ``ied``, ``y``, ``bli``, ``fulli`` and ``logi``.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published rule tables and the irregular words.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """Vowel/consonant pattern; ``y`` is a vowel exactly after a consonant."""
    if "y" not in word:
        return "".join("v" if ch in "aeiou" else "c" for ch in word)
    out = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_syllable(stem: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is vowel-consonant itself."""
    shape = _shape(stem)
    if shape == "vc":
        return True
    return shape.endswith("cvc") and stem[-1] not in "wxy"


def _swap(word: str, rules, least: int) -> str:
    """Apply the first rule whose suffix fits, if its stem measures at least ``least``."""
    for suffix, replacement in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + replacement if _measure(stem) >= least else word
    return word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_syllable(stem) else stem


def _step_2(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP_2, 1)


def _step_4(word: str) -> str:
    suffix = next((s for s in STEP_4 if word.endswith(s)), None)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) < 2 or (suffix == "ion" and not stem.endswith(("s", "t"))):
        return word
    return stem


def _final_letters(word: str) -> str:
    if word.endswith("e"):
        measure = _measure(word[:-1])
        if measure > 1 or (measure == 1 and not _short_syllable(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem_word(token: str) -> str:
    """Stem of one token; the result is lower case."""
    if token in IRREGULAR:
        return IRREGULAR[token]
    word = token.lower()
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    return _final_letters(_step_4(_swap(_step_2(word), STEP_3, 1)))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_batch(tokens: pa.Array) -> pa.Array:
    """Stem every *distinct* token of an Arrow batch once, then map the batch by index."""
    words = tokens.flatten().dictionary_encode()
    stems = pa.array([stem_word(w) for w in words.dictionary.to_pylist()], pa.string())
    lengths = pd.Series(tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
    return pa.ListArray.from_arrays(offsets, stems.take(words.indices))


def stem_tokens(tokens: Column) -> Column:
    """Array of stems for an array of tokens. Row-local: no shuffle, no join back."""
    return _stem_batch(tokens)
