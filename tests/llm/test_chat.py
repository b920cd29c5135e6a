"""Chat formatting: exact round trips and the SQL of the query."""

import random

import pytest
from cases import SF
from compare import connect, difference
from pyspark.sql import functions as F

from textweir.llm import chat, queries

HARD = ["</turn>", "\n</turn>\n", "### ", "###", "\\", "\\\\", "#", "\n", ": ", "User", "a", "é", "🙂", "\r", "$1", "<"]


def conversations():
    rng = random.Random(8)
    text = lambda: "".join(rng.choice(HARD) for _ in range(rng.randrange(9)))
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "a: b", "x\\", "###", "<r>\n", ""])
            rows.append((conv, turn, role, text()))
    rows += [(500, None, "user", "first"), (500, 0, None, None), (500, 0, "assistant", ""),
             (500, 0, "assistant", ""), (None, 1, "assistant", "no id"), (None, 0, "user", "\\### x")]
    rows.append((501, 0, "assistant", "\\" * 20_000 + "###" + "</turn>" * 3_000))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "conv_id long, turn long, role string, text string, formatted string, turns int",
    )


def expected(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(v)] for c, v in found.items()}


def test_round_trip(spark):
    rows = conversations()
    out = chat.format_chats(frame(spark, rows)).cache()
    assert out.where(~F.col("identical")).count() == 0
    read = out.select("conv_id", chat.parse(F.col("formatted")).alias("turns")).collect()
    want = expected(rows)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in read} == want
    learned = out.select("conv_id", chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("t"))
    assert {r.conv_id: r.t for r in learned.collect()} == {
        c: "".join(t for role, t in v if role == "assistant") for c, v in want.items()
    }


def test_plain_text_stays_plain(spark):
    rows = [(1, 0, "user", "a # b ## \\n"), (1, 1, "assistant", "c")]
    done = chat.format_chats(frame(spark, rows)).first().formatted
    assert done == "### user: a # b ## \\n\n</turn>\n### assistant: c\n</turn>\n"


def test_empty_table(spark):
    assert chat.format_chats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_query_matches_sql(spark, sf):
    name = "op3_chat_format"
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) is None
