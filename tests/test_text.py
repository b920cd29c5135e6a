import pytest
from pyspark.sql import functions as F

from textweir.functions.porter import stem_word
from textweir.functions.text import Normalizer

TEXTS = [
    "Can't stop!!! sooooo 'some' 'dog' dog's",
    "visit https://a.b/c?d=1 www.x.y @bob_é #Été yessss ...... 123 ٣٤",
    "I &amp; you &lt;b&gt; 5&nbsp;x don’t __init__ İstanbul ΣΑΣ",
    "us was",
    None,
    "😀😀😀😀 ok",
]
EXPECTED = {
    "minimal": [
        "can not stop sooooo isome wouldog dog", "visit bob yessss",
        "you <b> don init stanbul", "us", "", "ok",
    ],
    "standard": [
        "can not stop sooooo isome wouldog dog", "visit bob yessss <num> <num>",
        "you <num> don init stanbul", "us", "", "ok",
    ],
    "tweet": [
        "can not stop soo isome wouldog dog", "visit url url user yess <num> <num>",
        "you <num> don init stanbul", "us", "", "ok",
    ],
}


def _clean(spark, normalizer, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return [r["clean"] for r in normalizer.apply(df).orderBy("doc_id").collect()]


@pytest.mark.parametrize("mode", sorted(EXPECTED))
def test_adversarial_strings(spark, mode):
    assert _clean(spark, Normalizer(mode, "none"), TEXTS) == EXPECTED[mode]


def test_options(spark):
    text = ["No, won't GO: nor cats_ a1b"]
    assert _clean(spark, Normalizer(reduction="none"), text) == ["no not go nor cats <num>"]
    dropped = Normalizer(reduction="none", keep_negations=False, extra_stopwords=("go",))
    assert _clean(spark, dropped, text) == ["cats <num>"]
    cased = Normalizer(reduction="none", lowercase=False, remove_stopwords=False)
    assert _clean(spark, cased, ["Can't the DOG"]) == ["Ca not the DOG"]
    short = Normalizer(reduction="none", min_token_length=1, mode="minimal")
    assert _clean(spark, short, ["x '_y_' ''"]) == ["x y"]
    assert _clean(spark, Normalizer(reduction="none", missing="nan"), [None]) == ["nan"]


def test_unknown_settings():
    with pytest.raises(ValueError):
        Normalizer(mode="loud")
    with pytest.raises(ValueError):
        Normalizer(reduction="cut")


def test_lemmas(spark):
    lemmas = spark.createDataFrame([("cats", "cat"), ("geese", "goose")], "surface string, lemma string")
    found = _clean(spark, Normalizer(lemmas=lemmas), ["two cats, cats and geese", "", "dogs"])
    assert found == ["two cat cat goose", "", "dogs"]
    assert _clean(spark, Normalizer(), ["two cats"]) == ["two cats"]


def test_stems(spark):
    assert _clean(spark, Normalizer(reduction="stem"), ["Running ponies, 12", None]) == [
        "run poni <num>", "",
    ]


@pytest.mark.parametrize(
    ("word", "stem"),
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"),
        ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"),
        ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
        ("conditional", "condit"), ("digitizer", "digit"), ("vietnamization", "vietnam"),
        ("sensibiliti", "sensibl"), ("triplicate", "triplic"), ("goodness", "good"),
        ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"),
        ("controll", "control"), ("roll", "roll"), ("dies", "die"), ("enjoy", "enjoy"),
        ("generally", "gener"), ("dying", "die"), ("is", "is"),
    ],
)
def test_published_stems(word, stem):
    assert stem_word(word) == stem


def test_unescape_of_named_and_numeric_entities(spark):
    from textweir.functions.html import unescape_entities

    df = spark.createDataFrame([("&lt;&#233;&#x41;&copy &amp;lt;",), ("plain",), (None,)], "t string")
    found = [r[0] for r in df.select(unescape_entities(F.col("t"))).collect()]
    assert found == ["<éA© &lt;", "plain", None]
