"""License scan: TF-IDF cosine to templates and inheritance by path, in DataFrame functions only."""

from __future__ import annotations

import functools
import math
import string
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import fresh
from textweir.session import broadcast_if_measured, stage

# Usual license statements.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "SPDX-License-Identifier: ISC",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "proprietary": ("All rights reserved.", "Proprietary and confidential."),
}
# A statement bears a license from this cosine on.
COSINE = 0.7
# A file whose license statements hold this share of its words is its directory's license file.
FILE_SHARE = 0.5

_KEPT = set(string.ascii_letters + string.digits)
_BLANKS = "".join(c for c in map(chr, range(128)) if c not in _KEPT and c != "\n")


def _plain(text: Column) -> Column:
    return F.translate(F.lower(text), _BLANKS, " " * len(_BLANKS))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def template_words(text: str) -> list[str]:
    table = str.maketrans(_BLANKS, " " * len(_BLANKS))
    return text.lower().translate(table).split()


def vocabulary() -> list[str]:
    return sorted({w for texts in TEMPLATES.values() for t in texts for w in template_words(t)})


def inverse_frequency(files: DataFrame, text: str = "text") -> tuple[dict[str, float], float]:
    """Weight of each template term over all files, and that of a term in no file.

    ``ln((files + 1) / (files with the term + 1)) + 1``.
    """
    known = F.array(*map(F.lit, vocabulary()))
    words = _stream(F.col(text))
    held = files.select(F.explode_outer(F.array_intersect(known, words)).alias("term"))
    counts = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count("*").alias("n")).collect()}
    total = files.count()
    weigh = lambda n: math.log((total + 1) / (n + 1)) + 1
    return {w: weigh(counts.get(w, 0)) for w in vocabulary()}, weigh(0)


def vectors(idf: dict[str, float]) -> list[tuple[str, dict[str, float]]]:
    """``(license, unit TF-IDF vector)`` of every template."""
    found = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            counts = Counter(template_words(text))
            raw = {w: n * idf[w] for w, n in counts.items()}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            found.append((name, {w: x / norm for w, x in raw.items()}))
    return found


def anchors(templates: list[tuple[str, dict[str, float]]], cosine: float) -> list[str]:
    """Terms of which a line needs one to reach ``cosine`` with any template.

    The lightest terms of a template are left out as long as they alone cannot reach it.
    """
    found = set()
    for _, vector in templates:
        share = 0.0
        for w, x in sorted(vector.items(), key=lambda p: (p[1], p[0])):
            share += x * x
            if math.sqrt(share) >= cosine - 1e-9:
                found.add(w)
    return sorted(found)


def _mapping(values: dict[str, float]) -> Column:
    keys = F.array(*map(F.lit, values))
    return F.map_from_arrays(keys, F.array(*map(F.lit, values.values())))


def _stream(text: Column) -> Column:
    return _words(F.translate(_plain(F.coalesce(text, F.lit(""))), "\n", " "))


def _share(words: Column, vector: dict[str, float]) -> Column:
    """The squared share of a template's vector that some words hold, repeats ignored.

    By the Cauchy-Schwarz inequality no text of these words has a larger squared cosine.
    """
    squares = _mapping({w: x * x for w, x in vector.items()})
    known = F.array_intersect(F.array(*map(F.lit, vector)), words)
    return F.aggregate(known, F.lit(0.0), lambda a, w: a + F.try_element_at(squares, w))


def _units(words: Column, lines: Column, templates, cosine: float) -> Column:
    """What is compared: ``array<struct<at, words>>`` with places in the words of the text.

    Lines that hold an anchor, and for each template all windows of as many words as it has
    that begin with one of its words, across lines, and share enough of it.
    """
    needed = F.array(*map(F.lit, anchors(templates, cosine)))
    starts = F.aggregate(
        lines, F.array(F.lit(1)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.size(x)))
    )
    placed = F.zip_with(starts, lines, lambda at, x: F.struct(at.alias("at"), x.alias("words")))
    found = [F.filter(placed, lambda u: u["words"].isNotNull() & F.arrays_overlap(u["words"], needed))]
    floor = cosine * cosine - 1e-9

    def windows(vector: dict[str, float], length: int) -> Column:
        own = F.array(*map(F.lit, vector))
        places = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)))
        begin = F.filter(places, lambda i: F.coalesce(F.array_contains(own, F.get(words, i - 1)), F.lit(False)))
        cut = F.transform(begin, lambda i: F.struct(i.alias("at"), F.slice(words, i, length).alias("words")))
        likely = F.filter(cut, lambda u: _share(u["words"], vector) >= floor)
        return F.when(_share(words, vector) >= floor, likely).otherwise(F.slice(placed, 1, 0))

    lengths = [len(template_words(t)) for texts in TEMPLATES.values() for t in texts]
    found += [windows(vector, n) for (_, vector), n in zip(templates, lengths, strict=True)]
    return F.array_distinct(F.concat(*found))


def _scores(units: Column, weight: Column, foreign: float, templates, cosine: float) -> Column:
    """The units from ``cosine`` on: ``array<struct<words, cosine, license, at>>``.

    Every unit is compared with every template; of equal cosines the later name counts. Among
    units the longest counts, so a general phrase does not outrank a whole statement.
    """
    table = F.array(
        *[F.struct(F.lit(n).alias("license"), _mapping(v).alias("vector")) for n, v in templates]
    )

    def weights(words: Column) -> Column:
        return F.transform(
            F.array_distinct(words),
            lambda w: F.struct(
                w.alias("w"),
                ((F.size(words) - F.size(F.array_remove(words, w)))
                 * F.coalesce(F.try_element_at(weight, w), F.lit(foreign))).alias("x"),
            ),
        )

    def best(line: Column) -> Column:
        norm = F.sqrt(F.aggregate(line["v"], F.lit(0.0), lambda a, p: a + p["x"] * p["x"]))
        dot = lambda t: F.aggregate(
            line["v"], F.lit(0.0),
            lambda a, p: a + p["x"] * F.coalesce(F.try_element_at(t["vector"], p["w"]), F.lit(0.0)),
        )
        found = F.transform(
            table,
            lambda t: F.struct(
                F.round(dot(t) / norm, 9).alias("cosine"), t["license"].alias("license"),
                line["at"].alias("at"), line["n"].alias("words"),
            ),
        )
        return F.array_max(found)

    weighed = F.transform(
        units, lambda u: F.struct(weights(u["words"]).alias("v"), F.size(u["words"]).alias("n"), u["at"].alias("at"))
    )
    found = F.filter(F.transform(weighed, best), lambda s: s["cosine"] >= cosine)
    return F.transform(found, lambda s: F.struct(*[s[c].alias(c) for c in ("words", "cosine", "license", "at")]))


def statements(
    files: DataFrame, text: str = "text", cosine: float = COSINE
) -> DataFrame:
    """``(h, best, whole)`` of each distinct text with license statements, by hash of the text.

    ``best`` is the longest statement, ``whole`` says that statements hold ``FILE_SHARE`` of the
    words. Every word is weighed by the files that hold it: the words of the compared units
    are counted over all files and joined back by text.
    """
    idf, foreign = inverse_frequency(files, text)
    templates = vectors(idf)
    total = files.count()
    stream = _stream(F.col(text))
    held = F.array_intersect(F.array(*map(F.lit, vocabulary())), stream)

    def maybe(own: Column) -> Column:
        return functools.reduce(
            lambda a, t: a | (_share(own, t[1]) >= cosine * cosine - 1e-9), templates, F.lit(False)
        )

    lines = F.transform(F.split(_plain(F.coalesce(F.col(text), F.lit(""))), "\n"), _words)
    # Bound by a lambda: as a column, the filter would cut the text into words for each template.
    likely = files.where(F.exists(F.array(held), maybe)).select(F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    likely = likely.groupBy("h").agg(F.first("t").alias(text))
    likely = stage(likely.select("h", stream.alias("words"), lines.alias("lines")), "license-texts")
    units = likely.select(
        "h", F.size("words").alias("n"), _units(F.col("words"), F.col("lines"), templates, cosine).alias("units")
    )
    units = stage(units.where(F.size("units") > 0), "license-units")
    asked = units.select("h", F.explode(F.array_distinct(F.flatten(F.col("units.words")))).alias("w"))
    asked = stage(asked, "license-words")
    wanted = broadcast_if_measured(stage(asked.select("w").distinct(), "license-wanted"), ["w"])
    every = files.select(F.explode(F.array_distinct(stream)).alias("w"))
    counts = every.join(wanted, "w", "left_semi").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    weight = F.log((F.lit(total) + 1) / (F.col("n") + 1)) + 1
    counts = stage(counts.select("w", weight.alias("x")), "license-weights")
    maps = asked.join(counts, "w").groupBy("h").agg(
        F.map_from_entries(F.collect_list(F.struct("w", "x"))).alias("weight")
    )
    scored = units.join(maps, "h").select(
        "h", "n", _scores(F.col("units"), F.col("weight"), foreign, templates, cosine).alias("own")
    )
    scored = stage(scored.where(F.size("own") > 0), "license-statements")
    covered = F.transform("own", lambda s: F.sequence(s["at"], s["at"] + s["words"] - 1))
    return scored.select(
        "h", F.array_max("own").alias("best"),
        (F.size(F.array_distinct(F.flatten(covered))) >= FILE_SHARE * F.col("n")).alias("whole"),
    )


def _ancestors(folder: Column) -> Column:
    """The folder and all folders above it, ``array<struct<folder, depth>>``, the root as ``''``."""
    steps = F.split(folder, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(steps)),
        lambda n: F.struct(F.array_join(F.slice(steps, 1, n), "/").alias("folder"), n.alias("depth")),
    )


def scan(files: DataFrame, path: str = "path", text: str = "text", cosine: float = COSINE) -> DataFrame:
    """``files`` with ``license, cosine, origin, license_folder``; columns so named are replaced.

    ``origin`` is ``own`` where a line of the whole text, or a window of as many words as a
    template has, also across lines, is like a template (the longest such statement counts, then
    the highest cosine), ``inherited`` where the nearest folder at or above the file holds a
    license file, else ``none`` with null license. A license file is one whose license statements hold
    ``FILE_SHARE`` of its words; several in a folder: the longest statement, then the highest
    cosine and the later name, counts. Paths are ``/``-separated; a null path inherits nothing and gives nothing on, an
    empty one lies in the root. Null and empty texts have no license of their own. Repeated
    rows stay.

    Statements are found by distinct text and joined back. Folders, not files, look for their ancestors: each
    distinct folder is joined with the license folders by path, and files by their folder.
    """
    taken = ("license", "cosine", "origin", "license_folder")
    base = files.drop(*[c for c in files.columns if c.lower() in taken])
    folder, mark, own, up, at = (fresh(n, base) for n in ("folder", "mark", "own", "up", "at"))
    held = stage(statements(files, text, cosine).select(F.col("h").alias(mark), F.struct("best", "whole").alias(own)), "license-own")
    held = broadcast_if_measured(held, [])
    scored = base.withColumn(mark, F.xxhash64(text)).join(held, mark, "left").drop(mark)
    scored = scored.withColumn(folder, F.regexp_extract(F.col(path), r"(?s)^(.*)/[^/]*$", 1))
    marks = scored.where(F.col(own).isNotNull() & F.col(path).isNotNull()).select(
        F.col(folder).alias("folder"), F.col(own)["best"].alias("best"), F.col(own)["whole"].alias("whole")
    )
    given = marks.where("whole").groupBy("folder").agg(F.max("best").alias("best"))
    given = stage(given, "license-folders")
    folders = scored.where(F.col(path).isNotNull()).select(F.col(folder).alias("at")).distinct()
    above = folders.select("at", F.inline(_ancestors(F.col("at"))))
    nearest = above.join(given, "folder").groupBy("at").agg(
        F.max_by(F.struct("folder", "best"), "depth").alias(up)
    )
    nearest = nearest.withColumnRenamed("at", at)
    nearest = broadcast_if_measured(stage(nearest, "folder-licenses"), [at])
    whole = scored.join(nearest, F.col(folder) == F.col(at), "left").drop(at)
    mine = F.col(own)["best"]
    is_own = F.col(own).isNotNull()
    return whole.select(
        *base.columns,
        F.when(is_own, mine["license"]).otherwise(F.col(up)["best"]["license"]).alias("license"),
        F.when(is_own, mine["cosine"]).alias("cosine"),
        F.when(is_own, "own").when(F.col(up).isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~is_own, F.col(up)["folder"]).alias("license_folder"),
    )
