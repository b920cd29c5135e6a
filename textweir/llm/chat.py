"""Chat formatting by grammar round trip, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import digest

# The grammar: a conversation is a row of turns "### role: text\n</turn>\n". Within role and text
# a control string counts only without a backslash before it.
HEAD, COLON, END = "### ", ": ", "\n</turn>\n"
_CONTROL = r"(?:#{3,}|</turn>)"
# A run of backslashes is read from its first one on, so that long runs stay linear.
_CONFLICT = rf"(?<!\\)\\*+{_CONTROL}"
_ESCAPED = rf"(?<!\\)\\(\\*+{_CONTROL})"
_BARE = r"(?<![\\#])#{3,}"
_TURN = r"(?s)^### ((?:\\.|[^\\:])*+): (.*)\n$"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    """One more backslash before every control string, after those it has."""
    return F.regexp_replace(text, _CONFLICT, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def _role(role: Column) -> Column:
    return F.regexp_replace(role, r"[\\:#<]", r"\\$0")


def _header(role: Column) -> Column:
    return F.concat(F.lit(HEAD), _role(role), F.lit(COLON))


def _render(turns: Column, text) -> Column:
    parts = F.transform(turns, lambda t: F.concat(_header(t["role"]), text(t["text"]), F.lit(END)))
    return F.array_join(parts, "")


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``array<struct<role, text>>``.

    A turn ends at the first bare end mark; a part that is no turn by the grammar gives a null
    role and text.
    """
    parts = F.filter(F.split(formatted, r"(?<!\\)</turn>\n"), lambda p: p != "")
    good = lambda p: p.rlike(_TURN) & ~F.regexp_extract(p, _TURN, 2).rlike(_BARE)
    return F.transform(
        parts,
        lambda p: F.struct(
            F.when(good(p), F.regexp_replace(F.regexp_extract(p, _TURN, 1), r"\\(.)", "$1")).alias("role"),
            F.when(good(p), unescape(F.regexp_extract(p, _TURN, 2))).alias("text"),
        ),
    )


def format_chats(rows: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans, identical)`` from ``(conv_id, turn, role, text)`` rows.

    Turns go by ``turn`` (null first), then role and text, so repeated turn numbers have one
    order; repeated rows are turns of their own. Null roles and texts are empty; rows with a
    null ``conv_id`` form one conversation; other columns are ignored; an empty table gives no
    rows. ``loss_spans`` are the places of the assistant texts in ``formatted``,
    ``array<struct<start, end>>`` in code points, end exclusive.

    Round trip: the conversation is rendered as it is and parsed; where the recovered turns
    differ from the source, the conflicting content is escaped and the rest is left alone. An
    escaped text holds no bare control string and unescapes to itself, so a second round is
    always identical; ``identical`` reports the comparison.
    """
    empty = F.lit("")
    turns = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce("role", empty).alias("role"),
                    F.coalesce("text", empty).alias("text"),
                )
            )
        ).alias("turns")
    )
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = turns.withColumn("source", source).withColumn(
        "plain", _render(F.col("turns"), lambda t: t)
    )
    first = first.withColumn("same", parse(F.col("plain")).eqNullSafe(F.col("source")))
    second = first.withColumn(
        "formatted", F.when(F.col("same"), F.col("plain")).otherwise(_render(F.col("turns"), escape))
    )
    places = F.aggregate(
        "turns",
        F.struct(
            F.lit(0).alias("at"),
            F.expr("CAST(array() AS array<struct<start: int, end: int>>)").alias("spans"),
        ),
        _place,
        lambda a: a["spans"],
    )
    done = second.withColumn("loss_spans", places)
    return done.select(
        "conv_id", "formatted", "loss_spans",
        parse(F.col("formatted")).eqNullSafe(F.col("source")).alias("identical"),
    )


def _place(a: Column, t: Column) -> Column:
    """Go on by one turn; the place of an assistant text is noted."""
    text = F.when(F.col("same"), t["text"]).otherwise(escape(t["text"]))
    start = a["at"] + F.length(_header(t["role"]))
    end = start + F.length(text)
    span = F.array(F.struct(start.alias("start"), end.alias("end")))
    return F.struct(
        (end + len(END)).alias("at"),
        F.when(t["role"] == LEARNED, F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"),
    )


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    parts = F.transform(
        spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))
    )
    return F.array_join(parts, "")


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted conversations read back as."""
    read = chats.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "loss", learned_text(F.col("formatted"), F.col("loss_spans"))
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
