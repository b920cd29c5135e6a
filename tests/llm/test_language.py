"""Language spans against a search of all paths; held-out accuracy."""

import itertools
import unicodedata
import zlib

import numpy as np
import pytest
from cases import table, texts
from pyspark.sql import functions as F

from textweir.llm import language, queries

SF = "/root/testdata/sf0.1"
SAID = {
    "en": "the small house by the river was sold to the old man who never came back there again",
    "de": "das kleine haus am fluss wurde dem alten mann verkauft der niemals wieder dorthin kam",
    "ru": "маленький дом у реки был продан старику который никогда больше не возвращался туда",
    "uk": "маленький будинок біля річки був проданий старому який більше ніколи не повертався",
    "el": "το μικρό σπίτι δίπλα στο ποτάμι πουλήθηκε στον γέρο που δεν γύρισε ποτέ ξανά",
}


def learned(spark, more=()):
    rows = [(i, said, lang) for i, (lang, said) in enumerate(list(SAID.items()) * 30)]
    return language.fit(spark.createDataFrame([*rows, *more], "doc_id long, text string, lang string"))


def found(spark, model, bodies):
    rows = language.identify(table(spark, list(enumerate(bodies))), model).orderBy("doc_id").collect()
    assert len(rows) == len(bodies)
    return rows


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op13_language_id"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert len(rows) == len(docs) and rows.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in rows.held_out.items())
    both = rows[rows.held_out].join(docs)
    both = both[both.text.map(lambda t: any(map(str.isalpha, t)))]
    assert (both.lang_pred == both.lang).mean() > 0.97
    assert set(rows.lang_pred) <= {*docs.lang, "und"}


def test_held_out_languages_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    turned = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    one, two = language.fit(docs), language.fit(turned)
    assert one.languages == two.languages and (one.table == two.table).all()


def test_mixed_texts(spark):
    model = learned(spark)
    body = f"{SAID['en']}. «{SAID['ru']}» 12 -- {SAID['de']}!"
    row = found(spark, model, [body])[0]
    cut = [(s.language, body[s.start : s.stop]) for s in row.spans]
    assert cut == [("en", SAID["en"]), ("ru", SAID["ru"]), ("de", SAID["de"])]
    letters = {k: sum(map(str.isalpha, SAID[k])) for k in ("en", "ru", "de")}
    assert [s.letters for s in row.spans] == [letters[s.language] for s in row.spans]
    assert row.lang_pred == max(letters, key=letters.get)
    assert row.score == pytest.approx(max(letters.values()) / sum(letters.values()))


def test_scripts_narrow_candidates(spark):
    model = learned(spark)
    names = model.languages
    able = {s: {names[i] for i in np.flatnonzero(model.candidates[n])} for n, s in enumerate(language.SCRIPT_NAMES)}
    assert able["Cyrillic"] == {"ru", "uk"} and able["Latin"] == {"de", "en"} and able["Greek"] == {"el"}
    rows = found(spark, model, [SAID["uk"], "γύρισε", "漢字", "漢字 house by the river"])
    assert [r.lang_pred for r in rows] == ["uk", "el", names[0], "en"]


def test_paths(spark):
    """Every path of short texts, and texts of different lengths side by side."""
    rng = np.random.default_rng(8)
    sizes = [5, 1, 6, 0, 3, 6]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(50):
        scores = rng.integers(-9, 1, (len(owner), 3)).astype(np.float32)
        label = language.viterbi(scores, owner, 4.5)
        worth = lambda p, s: sum(s[range(len(p)), p]) - 4.5 * sum(a != b for a, b in itertools.pairwise(p))
        for n, size in enumerate(sizes):
            if size:
                mine, path = scores[owner == n], label[owner == n].tolist()
                best = max(worth(list(p), mine) for p in itertools.product(range(3), repeat=size))
                assert worth(path, mine) == pytest.approx(best)


def test_words(spark):
    """Words, places and letters as one Python loop finds them."""
    bodies = [*(t or "" for _, t in texts()), "été ́ a1b\0c İSTANBUL हिन्दी भाषा 漢字x", "1 2 3"]
    letters = language.Letters.of_unicode()
    words = language.words_of(bodies, letters.tables(), 1 << 15)
    want = []
    for n, body in enumerate(bodies):
        kind = [unicodedata.category(c)[0] for c in body]
        for word, group in itertools.groupby(range(len(body)), lambda i: kind[i] in "LM"):
            place = list(group)
            count = sum(kind[i] == "L" for i in place)
            if word and count:
                want.append((n, place[0], place[-1] + 1, count))
    got = zip(words.owner, words.start, words.stop, words.letters, strict=True)
    assert [tuple(map(int, x)) for x in got] == want


def test_edge_cases(spark):
    model = learned(spark, [(None, "xx", "zz"), (901, None, "yy"), (902, "some words", None), (903, "", "qq")])
    assert model.languages in (["de", "el", "en", "qq", "ru", "uk"], ["de", "el", "en", "ru", "uk"])
    rows = texts()
    out = language.identify(table(spark), model)
    assert out.columns == [*[c for c in table(spark).columns if c != "score"], "lang_pred", "score", "spans"]
    out = out.collect()
    assert len(out) == len(rows)
    for r in out:
        has = any(map(str.isalpha, r.text or ""))
        assert has == (r.lang_pred != "und") == bool(r.spans) and 0 <= r.score <= 1
    twice = {(r.lang_pred, r.score) for r in out if r.doc_id == 15}
    assert len(twice) == 1
    assert language.identify(table(spark, []), model).count() == 0
    none = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {(r.lang_pred, r.score, len(r.spans)) for r in language.identify(table(spark), none).collect()} == {("und", 0.0, 0)}
