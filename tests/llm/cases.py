"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, h long, k long, fp long, words string, score string, key string, part int"


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared, other = line(70), line(55)
    rows = [
        (1, f"{line(30)} {shared} {line(20)}"),
        (2, f"{line(10)}\n{shared}\t{other}"),
        (3, shared),
        (3, f"{other} {line(5)}"),
        (4, None),
        (5, ""),
        (6, " \t\n"),
        (None, f"{shared} end"),
        (None, None),
        (7, "a " * 130),
        (8, "b " + "a " * 90),
        (9, "x y " * 60),
        (10, "z " + "y x " * 70),
        (11, line(3000)),
        (12, "one"),
        (13, "One two"),
        (14, "one TWO three"),
    ]
    long = rows[13][1]
    rows += [(15, long), (16, long[:9000] + " changed " + long[9000:]), (15, long), (1, rows[0][1])]
    return rows


def table(spark, rows=None):
    """A documents table whose other columns have names that operators use inside."""
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, 1, 2, 3, "w", "s", "k", 4) for i, t in rows], SCHEMA)


def key(value):
    """Sorts nulls first."""
    return (value is not None, value)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(key(v) for v in r))
