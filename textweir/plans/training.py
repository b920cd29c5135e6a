"""Train, evaluate, record, save and apply sentiment classifiers over a grid of settings."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from textweir.functions.text import Normalizer
from textweir.operators import embeddings, learn, metrics, nearest, sampling, terms, weights
from textweir.operators.retrieval import load_normalizer, save_normalizer
from textweir.session import broadcast_if_measured, stage
from textweir.sources import sinks
from textweir.sources.corpora import missing_text_for, mode_for

VECTORIZERS = ("bow", "tfidf", "bm25", "embedding")
MAX_FEATURES = 100_000
NGRAMS = (1, 2)
# Runs of a grid that are in work together.
RUNS_AT_ONCE = 4

RUN_SCHEMA = (
    "dataset string, vectorizer string, reduction string, sample string, test_size double, "
    "accuracy double, precision double, recall double, f1 double, vocabulary_size bigint, "
    "train_rows bigint, test_rows bigint, duration_seconds double, model_path string, "
    "report_path string"
)


def normalizer_for(dataset: str, reduction: str, lemmas: DataFrame | None = None) -> Normalizer:
    """Normalizer of a corpus: tweet mode for messages, standard for all others."""
    return Normalizer(
        mode=mode_for(dataset), reduction=reduction, lemmas=lemmas,
        missing=missing_text_for(dataset),
    )


@dataclass(frozen=True)
class SentimentModel:
    """A fitted classifier as small tables.

    ``vocab`` is ``(term, term_id, df, cf)``; ``coefs`` ``(term_id, coef)``. For word vectors
    ``vocab`` is ``(term, score)``, the product of each vector with the coefficients, since
    the mean of the vectors times the coefficients is the mean of these scores; ``coefs`` then
    has one row for each dimension.
    """

    vectorizer: str
    normalizer: Normalizer
    vocab: DataFrame
    coefs: DataFrame
    intercept: float
    n_docs: int
    avgdl: float
    vocabulary_size: int


@dataclass(frozen=True)
class PreparedCorpus:
    """Clean text stored once per corpus and reduction, shared by all vectorizers."""

    dataset: str
    normalizer: Normalizer
    train: DataFrame
    test: DataFrame
    train_rows: int
    test_rows: int


def prepare(
    corpus: DataFrame,
    dataset: str,
    reduction: str,
    test_size: float = 0.2,
    seed: int = 42,
    lemmas: DataFrame | None = None,
) -> PreparedCorpus:
    """Split ``(doc_id, text, label)`` by class and normalize it."""
    normalizer = normalizer_for(dataset, reduction, lemmas)
    flagged = sampling.stratified_flag(corpus.select("doc_id", "text", "label"), test_size, seed)
    clean = stage(
        terms.identified(normalizer.apply(flagged)).select(
            terms.ROW, "doc_id", "label", "is_test", "clean"
        ),
        "clean",
    )
    train, test = clean.where(~F.col("is_test")), clean.where("is_test")
    rows = {r["is_test"]: r["count"] for r in clean.groupBy("is_test").count().collect()}
    return PreparedCorpus(
        dataset, normalizer, train, test, rows.get(False, 0), rows.get(True, 0)
    )


def fit_terms(prepared: PreparedCorpus) -> terms.FittedTerms:
    """Vocabulary of the training rows, shared by all term vectorizers."""
    return terms.fit_terms(prepared.train, NGRAMS, 2, MAX_FEATURES)


def _weigh(
    vectorizer: str, docs: DataFrame, vocab: DataFrame, n_docs: int, avgdl: float, size: int
) -> DataFrame:
    """Long-form weights by a vocabulary of ``size`` terms."""
    if vectorizer == "bow":
        return weights.bag_of_words(docs, vocab, NGRAMS, size)
    if vectorizer == "tfidf":
        return weights.tfidf(docs, vocab, NGRAMS, n_docs, size)
    return weights.bm25(docs, vocab, NGRAMS, n_docs, avgdl, size)


def fit_model(
    prepared: PreparedCorpus,
    vectorizer: str,
    fitted: terms.FittedTerms | None = None,
    tol: float = learn.TOLERANCE,
) -> SentimentModel:
    """Fit one vectorizer and the classifier, to a gradient of ``tol``, on the training rows only.

    ``fitted`` is the vocabulary of the same corpus, if it is known already.
    """
    if vectorizer not in VECTORIZERS:
        raise ValueError(f"Unsupported vectorizer: {vectorizer}")
    docs = terms.by_document(prepared.train)
    labels = prepared.train.select(terms.ROW, "doc_id", "label")
    n_docs = prepared.train_rows
    if vectorizer == "embedding":
        words = embeddings.fit_word_vectors(docs)
        means = nearest.mean_embedding(docs, words.vectors, words.dims, words.rows)
        features = learn.dense_features(labels, means, words.dims)
        classifier = learn.fit_classifier(features, n_docs * words.dims, tol=tol)
        coef = F.array(*[F.lit(float(x)) for x in classifier.coefficients])
        products = F.zip_with("embedding", coef, lambda x, y: x * y)
        score = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
        scored = stage(words.vectors.select("term", score.alias("score")), "term-scores")
        return SentimentModel(
            vectorizer, prepared.normalizer, broadcast_if_measured(scored, ["term"]),
            learn.coefficients(docs.sparkSession, classifier), classifier.intercept, n_docs, 0.0,
            words.rows,
        )
    fitted = fitted or fit_terms(prepared)
    weighed = _weigh(vectorizer, docs, fitted.vocab, n_docs, fitted.avgdl, fitted.size)
    features = learn.sparse_features(labels, weighed, fitted.size)
    classifier = learn.fit_classifier(features, fitted.total, tol=tol)
    return SentimentModel(
        vectorizer, prepared.normalizer, fitted.vocab,
        learn.coefficients(docs.sparkSession, classifier), classifier.intercept, n_docs,
        fitted.avgdl, fitted.size,
    )


def predict_clean(model: SentimentModel, docs: DataFrame) -> DataFrame:
    """Predictions for stored documents ``(row_id, doc_id, clean)``; other columns are kept."""
    spread = terms.by_document(docs)
    kept = docs.drop("clean")
    if model.vectorizer == "embedding":
        words = spread.select(terms.ROW, F.explode(F.split("clean", " ")).alias("term"))
        means = words.join(model.vocab, "term").groupBy(terms.ROW).agg(F.avg("score").alias("m"))
        margin = F.lit(model.intercept) + F.coalesce("m", F.lit(0.0))
        scored = kept.join(means, terms.ROW, "left").withColumn("margin", margin).drop("m")
        return learn.predictions(scored)
    weighed = _weigh(
        model.vectorizer, spread, model.vocab, model.n_docs, model.avgdl, model.vocabulary_size
    )
    return learn.predictions(
        learn.score_weights(kept, weighed, model.coefs, model.intercept, model.vocabulary_size)
    )


def predict(model: SentimentModel, requests: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, label, sentiment, probability)`` for texts of at least one character."""
    valid = requests.where(F.length("text") >= 1).select(F.col(key).alias("doc_id"), "text")
    clean = terms.identified(model.normalizer.apply(valid)).select(terms.ROW, "doc_id", "clean")
    clean = stage(clean, "requests")
    found = predict_clean(model, clean)
    return found.select(
        F.col("doc_id").alias(key), F.col("prediction").alias("label"), "sentiment", "probability"
    )


def save_model(model: SentimentModel, path: str) -> str:
    spark = model.vocab.sparkSession
    model.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    model.coefs.write.mode("overwrite").parquet(f"{path}/coefs")
    schema = (
        "vectorizer string, intercept double, n_docs bigint, avgdl double, vocabulary_size bigint"
    )
    row = (
        model.vectorizer, float(model.intercept), model.n_docs, float(model.avgdl),
        model.vocabulary_size,
    )
    spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{path}/settings")
    save_normalizer(spark, model.normalizer, f"{path}/normalizer")
    return path


def load_model(spark: SparkSession, path: str) -> SentimentModel:
    row = spark.read.parquet(f"{path}/settings").first()
    return SentimentModel(
        row["vectorizer"],
        load_normalizer(spark, f"{path}/normalizer"),
        broadcast_if_measured(spark.read.parquet(f"{path}/vocab"), ["term"]),
        spark.read.parquet(f"{path}/coefs"),
        row["intercept"],
        row["n_docs"],
        row["avgdl"],
        row["vocabulary_size"],
    )


def train_evaluate(
    prepared: PreparedCorpus,
    vectorizer: str,
    model_dir: str | None = None,
    sample: int | None = None,
    test_size: float = 0.2,
    fitted: terms.FittedTerms | None = None,
) -> tuple[DataFrame, SentimentModel]:
    """Fit, evaluate and record one setting: a one-row run table, and the model.

    Without ``model_dir`` nothing is saved and both paths are null.
    """
    spark = prepared.train.sparkSession
    started = time.time()
    model = fit_model(prepared, vectorizer, fitted)
    predicted = stage(
        predict_clean(model, prepared.test).select("doc_id", "label", "prediction"), "predicted"
    )
    found = metrics.binary_metrics(predicted).first()
    duration = time.time() - started
    reduction = prepared.normalizer.reduction
    model_path = report_path = None
    if model_dir:
        name = f"{model_dir}/{prepared.dataset}_{vectorizer}_{reduction}"
        model_path = save_model(model, name)
        report_path = sinks.write_report(metrics.class_report(predicted), f"{name}_report")
    row = (
        prepared.dataset, vectorizer, reduction, str(sample or "all"), test_size,
        found["accuracy"], found["precision"], found["recall"], found["f1"],
        model.vocabulary_size, prepared.train_rows, prepared.test_rows, duration,
        model_path, report_path,
    )
    return spark.createDataFrame([row], RUN_SCHEMA), model


def run_grid(
    load: Callable[[str], DataFrame],
    datasets: list[str],
    vectorizers: list[str] = list(VECTORIZERS),
    reductions: list[str] = ["lemma"],
    model_dir: str | None = None,
    ledger: str | None = None,
    sample: int | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    lemmas: DataFrame | None = None,
    at_once: int = RUNS_AT_ONCE,
) -> DataFrame:
    """One run per dataset, reduction and vectorizer; each run is a chain of Spark jobs.

    ``load`` gives the corpus of a dataset. Reading, splitting, normalizing and the vocabulary
    of the term vectorizers happen once per dataset and reduction, and are stored. Runs only read
    these tables, so up to ``at_once`` of them are in work together, while the next corpus is
    prepared; on a session with fair scheduling each has a pool of its own. Runs come back in
    the order of the settings. Finished ones go to ``ledger`` at once when it is given; where one
    fails, the others end first.
    """
    found = []
    with ThreadPoolExecutor(at_once) as workers:
        for dataset in datasets:
            corpus = load(dataset)
            for reduction in reductions:
                prepared = prepare(corpus, dataset, reduction, test_size, seed, lemmas)
                shared = fit_terms(prepared) if set(vectorizers) - {"embedding"} else None
                for vectorizer in vectorizers:
                    work = _cell(prepared, vectorizer, model_dir, ledger, sample, test_size, shared)
                    found.append(workers.submit(work))
        rows = [row for f in found for row in f.result()]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, RUN_SCHEMA)


def _cell(prepared: PreparedCorpus, vectorizer: str, model_dir, ledger, sample, test_size, shared):
    """The work of one run, for a thread of its own: its row, which is in the ledger by then."""
    spark = prepared.train.sparkSession
    name = f"{prepared.dataset}-{vectorizer}-{prepared.normalizer.reduction}"

    @inheritable_thread_target
    def work() -> list[Row]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        run, _ = train_evaluate(prepared, vectorizer, model_dir, sample, test_size, shared)
        if ledger:
            sinks.append_runs(run, ledger)
        return run.collect()

    return work


def compare_representations(load, datasets, output: str, **settings) -> DataFrame:
    """All vectorizers on each dataset; writes the run table and its best values."""
    runs = run_grid(load, datasets, **settings)
    sinks.write_csv(runs, output)
    sinks.write_summary(metrics.run_summary(runs, vocabulary=False), f"{output}.metrics")
    return runs


def compare_reductions(load, datasets, output: str, **settings) -> DataFrame:
    """All vectorizers and reductions; writes the run table and its best values."""
    settings.setdefault("reductions", ["none", "stem", "lemma"])
    runs = run_grid(load, datasets, **settings)
    sinks.write_csv(runs, output)
    sinks.write_summary(metrics.run_summary(runs), f"{output}.metrics")
    return runs
