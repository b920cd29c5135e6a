"""License scan against a plain restatement of the cosines and the inheritance."""

import math
from collections import Counter

import pytest
from cases import SF, ordered

from textweir.llm import licenses, queries

APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."
FILES = [
    ("LICENSE", MIT),
    ("a/LICENSE", APACHE),
    ("a/x.py", "some code\nmore code"),
    ("a/b/c/y.py", "# " + MIT.upper() + "\ncode code code code code code code code"),
    ("a/b/c/z.py", "code"),
    ("d/e/f.py", ""),
    ("d/e/f.py", ""),
    ("d/e/g.py", None),
    ("d2/COPYING", APACHE + "\n" + MIT + "\n"),
    ("d2/q.py", "version two of the apache story"),
    (None, "nothing"),
    (None, "All rights reserved."),
    ("", "x"),
    ("top.py", "x " * 3000 + "\nlicensed under CC BY-NC 4.0"),
    ("/abs/k.py", "y"),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [(p, t, "x", 1, 2) for p, t in rows],
        "path string, text string, license string, folder int, at int",
    )


def plain(rows):
    words = lambda t: licenses.template_words(t or "")
    lines = [[words(x) for x in (t or "").split("\n")] for _, t in rows]
    held = Counter(w for t in lines for w in {w for x in t for w in x})
    weigh = lambda w: math.log((len(rows) + 1) / (held[w] + 1)) + 1
    known = set(licenses.vocabulary())
    idf = lambda w: weigh(w) if w in known else math.log(len(rows) + 1) + 1

    def vector(x):
        raw = {w: n * idf(w) for w, n in Counter(x).items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        return {w: v / norm for w, v in raw.items()}

    templates = [(n, vector(words(t))) for n, ts in licenses.TEMPLATES.items() for t in ts]
    own, given = [], {}
    for (path, _), text in zip(rows, lines, strict=True):
        found = []
        for x in text:
            v = vector(x)
            score = max((round(sum(v[w] * t.get(w, 0) for w in v), 9), n) for n, t in templates)
            if score[0] >= licenses.COSINE:
                found.append((len(x), *score))
        own.append(max(found, default=None))
        if path is not None and found and 2 * sum(f[0] for f in found) >= sum(map(len, text)):
            folder = path.rpartition("/")[0]
            given[folder] = max(given.get(folder, (0, 0, "")), max(found))
    out = []
    for (path, _), mine in zip(rows, own, strict=True):
        row = (path, None, "none", None)
        if mine:
            row = (path, mine[2], "own", None)
        elif path is not None:
            steps = path.rpartition("/")[0].split("/")
            for n in range(len(steps), -1, -1):
                if (folder := "/".join(steps[:n])) in given:
                    row = (path, given[folder][2], "inherited", folder)
                    break
        out.append(row)
    return ordered(out)


def result(df):
    found = licenses.scan(df)
    assert set(found.columns) == {"path", "text", "folder", "at", "license", "cosine", "origin", "license_folder"}
    return ordered((r.path, r.license, r.origin, r.license_folder) for r in found.collect())


def test_files(spark):
    got = result(frame(spark, FILES))
    assert got == plain(FILES)
    assert ("a/b/c/z.py", "Apache-2.0", "inherited", "a") in got
    assert ("a/b/c/y.py", "MIT", "own", None) in got
    assert ("d/e/f.py", "MIT", "inherited", "") in got


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    rows = [(f"{r.source}/{r.lang}/{r.doc_id}.txt", r.text) for r in docs]
    assert result(frame(spark, rows)) == plain(rows)


def test_query_and_empty_table(spark):
    assert result(frame(spark, [])) == []
    rows = queries.QUERIES["op6_licenses"](spark, SF).collect()
    assert len(rows) == 200 and {r.origin for r in rows} <= {"own", "inherited", "none"}


@pytest.mark.parametrize("cosine", [0.5, 0.7, 0.95])
def test_anchors_lose_no_line(cosine):
    idf = {w: 1.0 + len(w) / 5 for w in licenses.vocabulary()}
    templates = licenses.vectors(idf)
    needed = set(licenses.anchors(templates, cosine))
    for _, vector in templates:
        light = math.sqrt(sum(x * x for w, x in vector.items() if w not in needed))
        assert light < cosine


@pytest.mark.parametrize("files", [40, 4000])
def test_embedded_and_wrapped_statements(spark, files):
    own = [
        "This project is released under the MIT License.",
        "Released under the MIT License, see LICENSE file",
        "Copyright 2024 Jane Doe. Released under the MIT License.",
        "# This project is released\n# under the MIT\n# License.\ncode",
    ]
    prose = "this project has a file to see and is copyright of the house"
    rows = [(f"p{n}/x.py", t) for n, t in enumerate(own)]
    rows += [(f"q{n}/y.py", f"{prose} {n}") for n in range(files)]
    found = {r.path: r.license for r in licenses.scan(frame(spark, rows)).collect()}
    assert [found[p] for p, _ in rows[: len(own)]] == ["MIT"] * len(own)
    assert {found[p] for p, _ in rows[len(own) :]} == {None}


# The usual texts of whole license files and headers.
MIT_FILE = """MIT License

Copyright (c) 2024 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_FILE = """Copyright (c) 2024, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE.
"""
ISC_FILE = """Copyright 2024 Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS.
"""
APACHE_HEADER = """# Copyright 2024 Example Company. All rights reserved.
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""


def test_whole_license_files_pass_their_license_on(spark):
    code = "value = compute(first, second)\n" * 60
    rows = []
    for name, text in {"mit": MIT_FILE, "bsd": BSD_FILE, "isc": ISC_FILE}.items():
        rows += [(f"{name}/LICENSE", text), (f"{name}/src/a.py", code), (f"{name}/src/deep/b.py", "x = 1")]
    rows += [("other/c.py", APACHE_HEADER + code), ("other/d.py", code), (None, code)]
    rows += [(f"prose/{n}.txt", f"the owner of the house and {n} more words in all kinds of use") for n in range(40)]
    found = {r.path: (r.license, r.origin, r.license_folder) for r in licenses.scan(frame(spark, rows)).collect()}
    for name, license in {"mit": "MIT", "bsd": "BSD-3-Clause", "isc": "ISC"}.items():
        assert found[f"{name}/LICENSE"] == (license, "own", None)
        assert found[f"{name}/src/a.py"] == found[f"{name}/src/deep/b.py"] == (license, "inherited", name)
    assert found["other/c.py"] == ("Apache-2.0", "own", None)
    assert found["other/d.py"] == found["prose/3.txt"] == (None, "none", None)
