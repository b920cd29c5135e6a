from pathlib import Path

import numpy as np
import pytest

from textweir.operators import learn, metrics, terms, weights
from textweir.plans import training, words
from textweir.streaming.serve import score_stream

GOOD, BAD = "great lovely tasty coffee", "awful stale nasty coffee"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        (i, f"{GOOD if i % 3 else BAD} item{'abcdefgh'[i % 8]} {'fresh' if i % 2 else 'box'}",
         int(i % 3 > 0))
        for i in range(60)
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label int")


@pytest.fixture(scope="module")
def prepared(corpus):
    return training.prepare(corpus, "amazon", "none")


@pytest.mark.parametrize("vectorizer", training.VECTORIZERS)
def test_fit_save_load_predict(spark, prepared, corpus, vectorizer, tmp_path):
    run, model = training.train_evaluate(prepared, vectorizer, str(tmp_path))
    record = run.first()
    assert record.accuracy == 1.0 and record.train_rows == 48 and record.test_rows == 12
    assert spark.read.parquet(record.report_path).count() == 5
    loaded = training.load_model(spark, record.model_path)
    asked = corpus.select("doc_id", "text").union(
        spark.createDataFrame([(900, ""), (901, "unseen")], "doc_id bigint, text string")
    )
    one, two = (
        {r.doc_id: r for r in training.predict(m, asked).collect()} for m in (model, loaded)
    )
    assert one == two and 900 not in one and 901 in one
    assert all(0.5 <= r.probability <= 1 for r in one.values())
    assert all(r.sentiment == ("positive" if r.label else "negative") for r in one.values())


def test_unknown_vectorizer(prepared):
    with pytest.raises(ValueError):
        training.fit_model(prepared, "other")


def test_a_pass_has_one_task_for_each_core(prepared, monkeypatch):
    """More tasks than cores make a pass wait, until tasks grow too large; few entries need one."""
    asked, summed = [], learn._summed
    monkeypatch.setattr(learn, "_summed", lambda blocks, task, tasks, *a: asked.append(tasks) or summed(blocks, task, 1, *a))
    fitted = training.fit_terms(prepared)
    docs = terms.by_document(prepared.train)
    weighed = weights.bag_of_words(docs, fitted.vocab, training.NGRAMS, fitted.size)
    features = learn.sparse_features(prepared.train.select(terms.ROW, "label"), weighed, fitted.size)
    cores = prepared.train.sparkSession.sparkContext.defaultParallelism
    for entries, tasks in ((1000, 1), (cores * 2_000_000, cores), (cores * 16_000_000, 2 * cores)):
        asked.clear()
        learn.fit_classifier(features, entries, max_iter=1)
        assert set(asked) == {tasks}


def test_classifier_is_at_the_optimum(spark):
    """The gradient of the balanced, penalized loss vanishes on the plain features."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random((80, 30)) < 0.15, rng.random((80, 30)) * 9, 0)
    y = (x[:, 0] + 0.3 * rng.random(80) > 0.4).astype(int)
    rows = [(int(i), int(y[i]), int(j), float(x[i, j])) for i, j in zip(*x.nonzero(), strict=True)]
    cells = spark.createDataFrame(rows, "row_id int, label int, term_id int, weight double")
    docs = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "row_id int, label int")
    weights = cells.select("row_id", "term_id", "weight")
    features = learn.sparse_features(docs, weights, 30)
    model = learn.fit_classifier(features, len(rows), tol=1e-8)
    w, b = model.coefficients, model.intercept
    share = np.where(y == 1, 80 / (2 * y.sum()), 80 / (2 * (80 - y.sum())))
    error = share * (1 / (1 + np.exp(-(x @ w + b))) - y)
    assert np.abs(x.T @ error / 80 + w / 80).max() < 1e-7 and abs(error.mean()) < 1e-7
    assert model.gradient < 1e-7
    # Scoring in long form equals the probabilities of the dense matrix.
    coefs = learn.coefficients(spark, model)
    scored = learn.predictions(learn.score_weights(docs, weights, coefs, b, 30))
    positive = 1 / (1 + np.exp(-(x @ w + b)))
    for row in scored.collect():
        p = positive[row.row_id]
        assert abs(row.probability - (p if row.prediction else 1 - p)) < 1e-9
    # So does the gradient in long form, which shares no code with the fit.
    found = {r.term_id: r.gradient for r in learn.gradient(docs, weights, coefs, b).collect()}
    assert found.keys() == {-1, *x.any(axis=0).nonzero()[0].tolist()}
    assert max(map(abs, found.values())) < 1e-7


def test_many_tasks_and_slices_give_the_same_fit(spark, monkeypatch):
    """Gradients cut into slices and added up in a tree."""
    rng = np.random.default_rng(5)
    x, y = rng.random((60, 11)), rng.integers(0, 2, 60)
    rows = [(i, int(y[i]), x[i].tolist()) for i in range(60)]
    docs = spark.createDataFrame(rows, "row_id int, label int, embedding array<double>")
    features = learn.dense_features(docs.select("row_id", "label"), docs, 11)
    plain = learn.fit_classifier(features, 660, tol=1e-6)
    for name, value in {"_ENTRIES_PER_PARTITION": 160, "_FAN_IN": 3, "_SLICE": 4, "_BLOCK_ENTRIES": 30}.items():
        monkeypatch.setattr(learn, name, value)
    cut = learn.fit_classifier(learn.dense_features(docs.select("row_id", "label"), docs, 11), 660, tol=1e-6)
    assert np.abs(cut.coefficients - plain.coefficients).max() < 1e-3


def test_a_small_fit_runs_in_one_task(spark, monkeypatch):
    """Only its first loss and curvature are jobs of their own; it ends where a fit by jobs ends."""
    rng = np.random.default_rng(6)
    x, y = rng.random((60, 5)), rng.integers(0, 2, 60)
    docs = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(60)], "row_id int, label int, embedding array<double>")
    features = learn.dense_features(docs.select("row_id", "label"), docs, 5)
    jobs, summed = [], learn._summed
    monkeypatch.setattr(learn, "_summed", lambda *a: jobs.append(1) or summed(*a))
    alone = learn.fit_classifier(features, 300, tol=1e-8)
    assert len(jobs) == 2 and alone.passes > 3 and alone.gradient <= 1e-8
    monkeypatch.setattr(learn, "_ENTRIES_PER_PARTITION", 100)
    spread = learn.fit_classifier(features, 300, tol=1e-8)
    assert len(jobs) > 5 and np.abs(alone.coefficients - spread.coefficients).max() < 1e-6


def test_small_counts_are_stored_in_a_byte(spark):
    """Counts below 256 come back as they were; other values keep eight bytes."""
    docs = spark.createDataFrame([(0, 1), (1, 0)], "row_id int, label int")
    for values, width in (([255.0, 1.0, 0.0], 1), ([256.0, 1.0, 2.0], 8), ([0.5, 1.0, 2.0], 8), ([-1.0, 1.0, 2.0], 8)):
        cells = spark.createDataFrame([(0, 0, values[0]), (0, 2, values[1]), (1, 1, values[2])], "row_id int, term_id int, weight double")
        rows = learn.sparse_features(docs, cells.coalesce(1), 3).blocks.collect()
        assert sum(len(r["value"]) for r in rows) >= 3 * width if width == 8 else sum(len(r["value"]) for r in rows) == 3
        found = [learn._block(*r) for r in rows]
        assert sorted(float(v) for b in found for v in b[3]) == sorted(values) and all(b[3].dtype == "f8" for b in found)


def test_fit_without_rows_or_entries(spark):
    none = spark.createDataFrame([], "row_id int, label int")
    weights = spark.createDataFrame([], "row_id int, term_id int, weight double")
    assert learn.fit_classifier(learn.sparse_features(none, weights, 3), 0).coefficients.tolist() == [0, 0, 0]
    docs = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None)], "row_id int, label int")
    model = learn.fit_classifier(learn.sparse_features(docs, weights, 3), 0)
    assert model.coefficients.tolist() == [0, 0, 0] and abs(model.intercept) < 1e-3


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    row = metrics.binary_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert report["negative"].f1 == 1.0 and report["positive"].support == 0


def test_stream_equals_batch(spark, prepared, corpus, tmp_path):
    model = training.fit_model(prepared, "tfidf")
    source = str(tmp_path / "in")
    corpus.select("doc_id", "text").repartition(3).write.parquet(source)
    stream = (
        spark.readStream.schema("doc_id bigint, text string")
        .option("maxFilesPerTrigger", 1)
        .parquet(source)
    )
    query = score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    columns = ("doc_id", "label", "sentiment", "probability")
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*columns).collect()
    assert sorted(streamed) == sorted(training.predict(model, corpus).select(*columns).collect())


def test_equal_ids_are_predicted_apart(spark, prepared):
    model = training.fit_model(prepared, "tfidf")
    asked = spark.createDataFrame([(1, GOOD), (1, BAD)], "doc_id bigint, text string")
    assert sorted(r.sentiment for r in training.predict(model, asked).collect()) == [
        "negative", "positive"
    ]


def test_stream_leaves_no_staged_table(spark, corpus, tmp_path):
    """What a micro-batch of searches stages is gone when the stream has ended."""
    from textweir.operators import retrieval
    from textweir.session import scratch_root
    from textweir.streaming.serve import search_stream

    index = retrieval.fit_index(corpus, training.normalizer_for("amazon", "none"))
    asked = spark.createDataFrame(
        [(1, "coffee", None, 3), (2, "great", "positive", 2)],
        "query_id bigint, query string, sentiment string, top_k int",
    )
    asked.write.parquet(str(tmp_path / "in"))
    before = set(Path(scratch_root(spark)).iterdir())
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    search_stream(stream, index, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert set(Path(scratch_root(spark)).iterdir()) == before


def test_compare_representations(spark, corpus, tmp_path):
    out = str(tmp_path / "runs")
    runs = training.compare_representations(
        lambda _: corpus, ["amazon"], out, vectorizers=["bow", "tfidf"], reductions=["none"]
    )
    assert runs.count() == 2 and spark.read.json(f"{out}.metrics").first().rows == 2


def test_grid_writes_runs_and_best_values(spark, corpus, tmp_path):
    out, ledger = str(tmp_path / "runs"), str(tmp_path / "ledger")
    runs = training.compare_reductions(
        lambda _: corpus, ["amazon"], out, vectorizers=["bow"], reductions=["none", "stem"],
        ledger=ledger,
    )
    assert runs.count() == 2 == spark.read.parquet(ledger).count()
    best = spark.read.json(f"{out}.metrics").first()
    assert best.rows == 2 and best.best_f1 == 1.0 and best.best_vocabulary_size > 0


def test_nearest_words(spark, corpus):
    asked = spark.createDataFrame([("great",), ("missing",)], "term string")
    rows = words.nearest_words(corpus, "amazon", asked, top_k=3, dims=4).collect()
    assert len(rows) == 3 and {r.term for r in rows} == {"great"}
    assert all(r.cosine_similarity <= 1 + 1e-9 for r in rows)
    fitted = words.term_embeddings(corpus, "amazon", dims=4)
    assert fitted.vectors.count() == fitted.rows and fitted.dims == 4
