"""Text normalization as Spark column expressions.

The steps run in one fixed order: unescape, lower case, contractions, links and tags,
punctuation, numbers, tokens, stop words, reduction. Everything is row-local, so the same
expressions serve batch tables and streams.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.functions.html import unescape_entities
from textweir.functions.porter import stem_tokens
from textweir.session import broadcast_if_measured, stage

# Contractions as plain substrings, in the order they are applied.
CONTRACTIONS = (
    ("can't", "can not"),
    ("cannot", "can not"),
    ("won't", "will not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'t", " not"),
    ("'ve", " have"),
    ("'m", " am"),
)
# The default stop words, and the negations dropped on request.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
    "its", "of", "on", "that", "the", "to", "was", "were", "will", "with",
)
NEGATIONS = ("no", "nor", "not")
# The ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

MODES = ("minimal", "standard", "tweet")
REDUCTIONS = ("none", "stem", "lemma")

# Java's classes are ASCII by default; these name the Unicode sets instead.
_VISIBLE = r"[^\s\x1c-\x1f]"
_LINK = rf"(?U)https?://{_VISIBLE}+|www\.{_VISIBLE}+"
_WORD = r"[\p{L}\p{N}_]"


def expand_contractions(text: Column) -> Column:
    """Replace the contractions one after the other, wherever the characters occur."""
    for short, long in CONTRACTIONS:
        text = F.replace(text, F.lit(short), F.lit(long))
    return text


def remove_links(text: Column) -> Column:
    return F.regexp_replace(text, _LINK, " ")


def tag_links(text: Column) -> Column:
    return F.regexp_replace(text, _LINK, " <url> ")


def tag_mentions(text: Column) -> Column:
    return F.regexp_replace(text, f"@{_WORD}+", " <user> ")


def unwrap_hashtags(text: Column) -> Column:
    return F.regexp_replace(text, f"#({_WORD}+)", " $1 ")


def squeeze_elongations(text: Column) -> Column:
    """Cut runs of three or more equal characters (but newlines) to two."""
    return F.regexp_replace(text, r"([^\n])\1{2,}", "$1$1")


def blank_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, " " * len(PUNCTUATION))


def tag_numbers(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Nd}+", " <num> ")


def split_tokens(text: Column, least: int) -> Column:
    """Tokens of ``[a-zA-Z_<>']``, stripped of ``'`` and ``_``, at least ``least`` long.

    One pattern does all three: it starts and ends on a letter or bracket, and being
    greedy it reaches the last of them in each run.
    """
    edge, inner = "[a-zA-Z<>]", "[a-zA-Z_<>']"
    if least <= 1:
        pattern = f"{edge}(?:{inner}*{edge})?"
    else:
        pattern = f"{edge}{inner}{{{least - 2},}}{edge}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def snippet(text: Column, length: int = 500) -> Column:
    return F.substring(text, 1, length)


def label_name(label: Column) -> Column:
    return F.when(label == 1, F.lit("positive")).otherwise(F.lit("negative"))


@dataclass(frozen=True)
class Normalizer:
    """Settings of the normalizer; ``apply`` adds the clean text to a DataFrame.

    ``lemmas`` is an optional table ``(surface, lemma)`` for ``reduction="lemma"``; without
    one, lemmatization leaves tokens as they are. ``stopwords_table``, a table with a column
    ``word`` of any size, adds to the stop words. ``missing`` stands in for null texts.
    """

    mode: str = "standard"
    reduction: str = "lemma"
    lowercase: bool = True
    remove_stopwords: bool = True
    keep_negations: bool = True
    min_token_length: int = 2
    extra_stopwords: tuple[str, ...] = ()
    lemmas: DataFrame | None = None
    missing: str = ""
    stopwords_table: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"Unknown normalization mode: {self.mode}")
        if self.reduction not in REDUCTIONS:
            raise ValueError(f"Unknown reduction: {self.reduction}")

    def stopwords(self) -> list[str]:
        words = set(STOPWORDS) | set(self.extra_stopwords)
        return sorted(words if self.keep_negations else words | set(NEGATIONS))

    def prepared(self, text: Column) -> Column:
        """The text just before it is split into tokens."""
        text = unescape_entities(F.coalesce(text.cast("string"), F.lit(self.missing)))
        if self.lowercase:
            text = F.lower(text)
        text = expand_contractions(text)
        if self.mode == "tweet":
            text = squeeze_elongations(unwrap_hashtags(tag_mentions(tag_links(text))))
        else:
            text = remove_links(text)
        if self.mode != "minimal":
            text = tag_numbers(blank_punctuation(text))
        return text

    def surface_tokens(self, text: Column) -> Column:
        """Tokens before reduction."""
        tokens = split_tokens(self.prepared(text), self.min_token_length)
        if self.remove_stopwords:
            words = self.stopwords()
            tokens = F.filter(tokens, lambda token: ~token.isin(words))
        return tokens

    def tokens(self, text: Column) -> Column:
        """Tokens after ``none`` or ``stem`` reduction, as one row-local expression."""
        tokens = self.surface_tokens(text)
        return stem_tokens(tokens) if self.reduction == "stem" else tokens

    def apply(self, df: DataFrame, text: str = "text", into: str = "clean") -> DataFrame:
        """Add the space-joined clean text.

        Tables of stop words or lemmas are joined, before and as the reduction; everything else is
        one expression of the row, which also serves ``tokens``.
        """
        lemmas = self.lemmas if self.reduction == "lemma" else None
        if lemmas is None and self.stopwords_table is None:
            return df.withColumn(into, F.array_join(self.tokens(F.col(text)), " "))
        stopwords = self.stopwords_table if self.remove_stopwords else None
        found = _looked_up(df, self.surface_tokens(F.col(text)), into, stopwords, lemmas)
        if self.reduction == "stem":
            found = found.withColumn(into, F.array_join(stem_tokens(F.split(into, " ")), " "))
        return found


def _looked_up(
    df: DataFrame, tokens: Column, into: str, stopwords: DataFrame | None, lemmas: DataFrame | None
) -> DataFrame:
    """Drop tokens listed in ``stopwords (word)``, then look them up in ``(surface, lemma)``.

    Rows are numbered and stored first, so each is put together again by its number. The tables
    are stored as well, so each is computed once and broadcast by its measured size; a larger one
    is joined by word.
    """
    row = "__row"
    docs = df.withColumn(into, F.array_join(tokens, " "))
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "surface").repartition(row)
    words = docs.select(row, F.posexplode(F.split(into, " ")).alias("pos", "surface"))
    if stopwords is not None:
        listed = stage(stopwords.select(F.col("word").alias("surface")).distinct(), "stop-words")
        words = words.join(broadcast_if_measured(listed, ["surface"]), "surface", "left_anti")
    reduced = words.withColumn("token", F.col("surface"))
    if lemmas is not None:
        table = stage(lemmas.groupBy("surface").agg(F.min("lemma").alias("lemma")), "lemmas")
        table = broadcast_if_measured(table, ["surface", "lemma"])
        reduced = words.join(table, "surface", "left").withColumn("token", F.coalesce("lemma", "surface"))
    joined = reduced.groupBy(row).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]
            ),
            " ",
        ).alias(into)
    )
    whole = docs.drop(into).join(joined, row, "left").drop(row)
    return whole.withColumn(into, F.coalesce(into, F.lit("")))
