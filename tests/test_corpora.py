from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from textweir.operators import labels, sampling
from textweir.sources import corpora, sinks

REVIEWS = (
    'Id,ProductId,Score,Time,Summary,Text\n'
    '1,p,5,9,Good,"Two\nlines, ""quoted"""\n'
    "2,p,3,9,Neutral,skip\n"
    "3,p,1,9,,only text\n"
    "4,p,,9,No score,kept\n"
    "5,p,4,9,NA,null summary\n"
)
MESSAGES = (
    '"0","11","Mon Apr 06","NO_QUERY","ann","caf\xe9 ""x"", sad"\n'
    '"4","12","Mon Apr 06","NO_QUERY","bob","happy"\n'
    '"2","13","Mon Apr 06","NO_QUERY","eve","neither"\n'
    '"4","14","Mon Apr 06","NO_QUERY","ann","null"\n'
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / corpora.REVIEW_FILE).write_text(REVIEWS)
    (tmp_path / corpora.MESSAGE_FILE).write_bytes(MESSAGES.encode("latin-1"))
    return str(tmp_path)


def test_reviews(spark, folder):
    rows = corpora.load_dataset(spark, "amazon", folder).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.label, r.raw_score) for r in rows] == [
        (1, 'Good Two\nlines, "quoted"', 1, 5),
        (3, "only text", 0, 1),
        (4, "No score kept", 0, None),
        (5, "null summary", 1, 4),
    ]


def test_review_sample_looks_at_the_head_only(spark, folder):
    rows = corpora.load_dataset(spark, "amazon", folder, sample=1).collect()
    assert len(rows) == 1 and rows[0].doc_id in (1, 3)
    assert corpora.load_dataset(spark, "amazon", folder, sample=0).count() == 4


def test_messages(spark, folder):
    rows = corpora.load_dataset(spark, "sentiment140", folder).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.label) for r in rows] == [
        (11, 'café "x", sad', 0), (12, "happy", 1), (14, None, 1),
    ]
    halves = corpora.load_dataset(spark, "sentiment140", folder, sample=2).collect()
    assert sorted(r.doc_id for r in halves) == [11, 12]


def test_unknown_dataset(spark, folder):
    with pytest.raises(ValueError):
        corpora.load_dataset(spark, "other", folder)


def test_unknown_sentiment_filters_nothing(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, label int")
    assert labels.with_sentiment(df, "negative").count() == 1
    assert labels.with_sentiment(df, "other").count() == 2
    assert labels.with_sentiment(df, None).count() == 2


def test_samples_are_exact_on_skewed_keys(spark, monkeypatch):
    """Keys far apart, and brackets that are narrowed several times; the result stays exact."""
    monkeypatch.setattr(sampling, "_LISTED", 10)
    keys = list(range(5000)) + [2**60 + i for i in range(3000)] + [-7]
    df = spark.createDataFrame([(k, k % 3 == 0) for k in keys], "k bigint, c boolean")
    for n in (1, 2, 4999, 5002, 7000, 8001, 9000):
        found = sorted(r.k for r in sampling.head(df, n, "k").collect())
        assert found == sorted(keys)[:n]


def test_draw_and_split_are_exact(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 1, 0) AS label")
    assert sampling.draw(df, 123).count() == 123
    assert sampling.draw(df, 5000).count() == 1000
    train, test = sampling.stratified_split(df, 0.25)
    assert test.where("label = 1").count() == 25 and test.where("label = 0").count() == 225
    assert train.count() == 750 and train.join(test, "doc_id").count() == 0


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1.0, 2.0])], "term string, embedding array<double>")
    path = sinks.write_wide_embeddings(rows, str(tmp_path / "wide"), 2)
    assert spark.read.parquet(path).columns == ["term", "dim_0", "dim_1"]
    table = rows.select("term")
    sinks.write_csv(table, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().term == "a"
    sinks.append_runs(table, str(tmp_path / "ledger"))
    sinks.append_runs(table, str(tmp_path / "ledger"))
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2
    assert sinks.read_runs(spark, str(tmp_path / "ledger")).collect() == table.collect()
    sinks.write_summary(table, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1


def test_head_fills_up_with_rows_without_a_key(spark):
    rows = [(i if i < 100 else None, f"t{i}") for i in range(150)]
    df = spark.createDataFrame(rows, "Id bigint, text string")
    for n in (60, 100, 120, 150, 200):
        got = sampling.head(df, n, "Id").collect()
        assert len(got) == min(n, 150)
        assert sum(r.Id is not None for r in got) == min(n, 100)


def test_samples_of_repeated_ids_are_exact(spark):
    rows = [(i % 20, f"t{i}", i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    assert sampling.draw(df, 33).count() == 33
    flagged = sampling.stratified_flag(df, 0.2)
    assert flagged.where("is_test").groupBy("label").count().orderBy("label").collect() == [(0, 8), (1, 8)]


@pytest.mark.parametrize("listed", [200_000, 3])
def test_samples_where_one_key_fills_a_third(spark, monkeypatch, listed):
    """Ties of a hot key are settled by row; rows with equal keys are not listed one by one."""
    monkeypatch.setattr(sampling, "_LISTED", listed)
    rows = [(7 if i % 3 == 0 else i, f"t{i}", None if i % 11 == 0 else i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    kept = {n: {r.text for r in sampling.draw(df, n).collect()} for n in (1, 250, 400, 899, 900)}
    assert {n: len(texts) for n, texts in kept.items()} == {n: n for n in kept}
    assert kept[1] <= kept[250] <= kept[400] <= kept[899] <= kept[900]
    flagged = sampling.stratified_flag(df, 0.3)
    sizes = {r.label: r.n for r in flagged.where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = {r.label: r.n for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {label: int(0.3 * n + 0.5) for label, n in total.items()}


def test_ledger_gives_each_run_once(spark, tmp_path):
    """Retries, concurrent writers, null settings, and runs that differ in one setting only."""
    path = str(tmp_path / "ledger")
    rows = [("a", "bow", None, 0.5), ("a", "bow", "10", 0.6), ("a", "tfidf", None, 0.7), ("b", "bow", None, 0.8)]
    runs = spark.createDataFrame(rows, "dataset string, vectorizer string, sample string, f1 double").coalesce(1)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: sinks.append_runs(runs.where(f"f1 > 0.{n}"), path), (4, 5, 6, 7)))
    sinks.append_runs(runs.where("f1 = 0.5").withColumn("f1", F.lit(0.1)), path)
    found = sinks.read_runs(spark, path)
    assert found.columns == runs.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)
