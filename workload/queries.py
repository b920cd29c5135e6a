"""Queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.functions import text as tx
from textweir.functions.html import unescape_entities
from textweir.functions.text import Normalizer
from textweir.functions.vectors import unit
from textweir.operators import (
    cooccurrence,
    labels,
    learn,
    metrics,
    nearest,
    retrieval,
    sampling,
    terms,
    weights,
)
from textweir.operators.svd import truncated_svd
from textweir.plans import training, words
from textweir.session import free_shuffles, scratch_root, stage, staging
from textweir.sources import corpora, sinks
from textweir.streaming import serve
from workload import tables

Query = Callable[[SparkSession, str], DataFrame]

MAX_FEATURES = 100_000
PAIR_FEATURES = 20_000
STANDARD = Normalizer(reduction="none")


def rounded(column: str | Column, name: str) -> Column:
    return F.round(column, 6).alias(name)


# Labels, projections and samples


def label_threshold(spark, sf):
    return tables.corpus(spark, sf).select("dataset", "doc_id", "label", "raw_score")


def neutral_filter(spark, sf):
    return labels.drop_neutral(tables.reviews(spark, sf)).select("Id", "Score")


def label_equality(spark, sf):
    corpus = labels.label_messages(tables.messages(spark, sf))
    return corpus.select("dataset", "doc_id", "label", "raw_score")


def text_concat(spark, sf):
    return tables.corpus(spark, sf).select("doc_id", "text")


def snippet(spark, sf):
    found = labels.with_sentiment(tables.corpus(spark, sf), "positive")
    return found.select(
        "doc_id",
        tx.label_name(F.col("label")).alias("sentiment"),
        tx.snippet(F.col("text")).alias("snippet"),
    )


def head_sample(spark, sf):
    corpus = corpora.review_corpus(tables.reviews(spark, sf), sample=150)
    return corpus.select("doc_id", "label", "raw_score")


def sample_md5(spark, sf):
    return sampling.draw(tables.corpus(spark, sf), 300).select("doc_id", "label")


def class_half_sample(spark, sf):
    corpus = corpora.message_corpus(tables.messages(spark, sf), sample=101)
    return corpus.select("doc_id", "label")


def stratified_split(spark, sf):
    return sampling.stratified_flag(tables.corpus(spark, sf), 0.2).select(
        "doc_id", "label", F.col("is_test").cast("int").alias("is_test")
    )


# Normalization


def _normalized(normalizer: Normalizer, source) -> Query:
    def run(spark, sf):
        return normalizer.apply(source(spark, sf)).select("doc_id", "clean")

    return run


def _message_texts(spark, sf):
    return tables.messages(spark, sf).select(F.col("tweet_id").alias("doc_id"), "text")


def _marked(step: Callable[[Column], Column], source) -> Query:
    def run(spark, sf):
        return source(spark, sf).select("doc_id", step(F.col("text")).alias("marked"))

    return run


def _with_apostrophes(spark, sf):
    """Documents with some blanks turned into apostrophes, so contractions occur."""
    text = F.regexp_replace(F.lower("text"), " ([stdm]|re|ll|ve)", "'$1")
    return tables.documents(spark, sf).withColumn("text", F.replace(text, F.lit("nt"), F.lit("n't")))


def _with_mentions(spark, sf):
    """Pages with some blanks turned into mention and hashtag signs."""
    text = F.replace(F.replace("text", F.lit(" d"), F.lit(" @d")), F.lit(" a"), F.lit(" #a"))
    return tables.pages(spark, sf).withColumn("text", text)


def lemma_lookup(spark, sf):
    """The lookup table drops a final s from every vocabulary word that has one."""
    docs = STANDARD.apply(tables.documents(spark, sf))
    surfaces = terms.document_terms(docs).select(F.col("term").alias("surface")).distinct()
    table = surfaces.where(F.col("surface").endswith("s")).select(
        "surface", F.expr("substring(surface, 1, length(surface) - 1)").alias("lemma")
    )
    normalizer = Normalizer(reduction="lemma", lemmas=table)
    return normalizer.apply(tables.documents(spark, sf)).select("doc_id", "clean")


# Term statistics


def _clean(spark, sf) -> DataFrame:
    """Stored clean documents, spread by row."""
    return terms.by_document(_stored(STANDARD.apply(tables.documents(spark, sf))))


def _stored(clean: DataFrame) -> DataFrame:
    return stage(terms.identified(clean).select(terms.ROW, "doc_id", "clean"), "clean")


def _unigrams(spark, sf, max_features: int | None = PAIR_FEATURES):
    clean = _clean(spark, sf)
    return clean, terms.fit_vocabulary(terms.term_statistics(clean), None, 2, max_features)


def _bigram_fit(spark, sf):
    """Stored clean text, spread by document, and its fitted uni- and bigrams."""
    clean = _stored(STANDARD.apply(tables.documents(spark, sf)))
    return terms.by_document(clean), terms.fit_terms(clean, (1, 2), 2, MAX_FEATURES)


def ngrams(spark, sf):
    return terms.term_counts(_clean(spark, sf), (2, 2)).drop(terms.ROW)


def doc_freq(spark, sf):
    return terms.term_statistics(_clean(spark, sf), (1, 2))


def vocab_topk(spark, sf):
    stats = terms.term_statistics(_clean(spark, sf), (1, 2))
    return terms.fit_vocabulary(stats, None, 2, 5000)


def vocab_share(spark, sf):
    stats = terms.term_statistics(_clean(spark, sf), (1, 2))
    n_docs = terms.count_documents(tables.documents(spark, sf))
    return terms.fit_vocabulary(stats, n_docs, 0.01, None)


def bow(spark, sf):
    clean, fitted = _bigram_fit(spark, sf)
    found = weights.bag_of_words(clean, fitted.vocab, (1, 2), None)
    return terms.named(found, fitted.vocab, None).drop(terms.ROW)


def tfidf(spark, sf):
    clean, fitted = _bigram_fit(spark, sf)
    found = weights.tfidf(clean, fitted.vocab, (1, 2), fitted.n_docs, None)
    return terms.named(found, fitted.vocab, None).select(
        "doc_id", "term", "term_id", rounded("weight", "weight")
    )


def bm25_stats(spark, sf):
    fitted = _bigram_fit(spark, sf)[1]
    return fitted.vocab.agg(
        F.lit(fitted.n_docs).cast("bigint").alias("n_docs"),
        F.count(F.lit(1)).alias("vocabulary_size"),
        F.round(F.sum("cf") / F.lit(fitted.n_docs), 6).alias("avgdl"),
    )


def bm25_idf(spark, sf):
    fitted = _bigram_fit(spark, sf)[1]
    idf = weights.bm25_idf(F.col("df"), F.lit(fitted.n_docs))
    return fitted.vocab.select("term", "df", rounded(idf, "idf"))


def doc_lengths(spark, sf):
    clean, fitted = _bigram_fit(spark, sf)
    counts = terms.known_counts(clean, fitted.vocab.select("term", "term_id"), (1, 2), None)
    return weights.document_lengths(clean, counts).drop(terms.ROW)


def bm25_weights(spark, sf):
    clean, fitted = _bigram_fit(spark, sf)
    found = weights.bm25(clean, fitted.vocab, (1, 2), fitted.n_docs, fitted.avgdl, None)
    return terms.named(found, fitted.vocab, None).select(
        "doc_id", "term", "term_id", "tf", rounded("weight", "weight")
    )


def _cells(spark, sf):
    clean, vocab = _unigrams(spark, sf)
    sequence = cooccurrence.known_sequence(clean, vocab, PAIR_FEATURES)
    return vocab, cooccurrence.cooccurrence(sequence)


def cooccurrence_cells(spark, sf):
    vocab, cells = _cells(spark, sf)
    named = cooccurrence.named_cells(cells, vocab, PAIR_FEATURES)
    return named.select("row_term", "col_term", rounded("x", "x"))


def ppmi(spark, sf):
    vocab, cells = _cells(spark, sf)
    named = cooccurrence.named_cells(
        cooccurrence.ppmi(cells, PAIR_FEATURES), vocab, PAIR_FEATURES
    )
    return named.select("row_term", "col_term", rounded("x", "x"))


# Vectors


def _unit_rows(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    return table.select("vec_id", unit("embedding").alias("embedding"))


def unit_vectors(spark, sf):
    dims = _unit_rows(spark, sf).select("vec_id", F.posexplode("embedding").alias("dim", "x"))
    return dims.select("vec_id", "dim", rounded("x", "x"))


def nearest_vectors(spark, sf):
    """Neighbors of every vector."""
    asked = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id")
    found = nearest.nearest(_unit_rows(spark, sf), asked, 10, key="vec_id")
    return found.select(
        F.col("term").alias("vec_id"), "neighbor", "rank", rounded("score", "cosine_similarity")
    )


def top_norm(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    return nearest.longest(table, 150, key="vec_id").select("vec_id", rounded("norm", "norm"))


def mean_embedding(spark, sf):
    clean, vocab = _unigrams(spark, sf, 20_000)
    vectors = tables.term_vectors(spark, sf, vocab)
    found = nearest.mean_embedding(clean, vectors, 64, 20_000)
    dims = found.select("doc_id", F.posexplode("embedding").alias("dim", "x"))
    return dims.select("doc_id", "dim", rounded("x", "x"))


def nearest_words(spark, sf):
    """Neighbors of the 20 most frequent words, in vectors learned from all documents."""
    clean = words.clean_documents(tables.documents(spark, sf), "amazon")
    counts = stage(terms.term_statistics(clean), "term-counts")
    asked = stage(counts.orderBy(F.desc("cf"), "term").limit(20).select("term"), "asked-words")
    return words.nearest_of(clean, "amazon", asked, stats=counts)


def lsa_terms(spark, sf):
    found = words.term_embeddings(tables.documents(spark, sf), "amazon")
    return sinks.wide_embeddings(found.vectors, found.dims)


def svd_gram(spark, sf):
    """Products of the decomposed rows of the table of vectors, for the benchmark numbers."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    cells = table.select(
        F.col("vec_id").cast("int").alias("row_id"),
        F.posexplode(F.col("embedding").cast("array<double>")).alias("col_id", "x"),
    )
    rows, _ = truncated_svd(stage(cells, "cells"), table.count(), 64)
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("row_id"))
    asked = stage(rows.join(items, "row_id"), "svd-asked")
    long = asked.select("row_id", F.posexplode("embedding").alias("dim", "x"))
    other = long.select(F.col("row_id").alias("other"), "dim", F.col("x").alias("y"))
    products = long.join(other, "dim").groupBy("row_id", "other").agg(F.sum(F.col("x") * F.col("y")).alias("p"))
    return products.select(F.col("row_id").cast("bigint").alias("vec_id"),
                           F.col("other").cast("bigint").alias("other"), rounded("p", "product"))


def wide_sink(spark, sf):
    """The table of vectors written in wide form and read back."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").cast("string").alias("term"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    path = f"{scratch_root(spark)}/wide-{uuid.uuid4().hex}"
    return spark.read.parquet(sinks.write_wide_embeddings(table, path, 64))


# Readers of the raw files


def reviews_csv(spark, sf):
    """Reviews written as the raw CSV and read back."""
    path = f"{scratch_root(spark)}/reviews-{uuid.uuid4().hex}"
    _write_reviews(tables.reviews(spark, sf), path)
    corpus = corpora.review_corpus(corpora.read_reviews(spark, path))
    return corpus.select("doc_id", "text")


def _as_latin(text: Column) -> Column:
    """Every UTF-8 byte of a text as the Latin-1 character of that number."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _from_latin(text: Column) -> Column:
    return F.decode(F.encode(text, "ISO-8859-1"), "UTF-8")


def _write_messages(table: DataFrame, path: str) -> None:
    plain = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    table.write.options(escape='"', quoteAll="true", encoding="ISO-8859-1", **plain).csv(path)


def _write_reviews(table: DataFrame, path: str) -> None:
    table.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def messages_csv(spark, sf):
    """Whole messages written as the raw Latin-1 CSV, their UTF-8 bytes as characters, and read back."""
    path = f"{scratch_root(spark)}/messages-{uuid.uuid4().hex}"
    _write_messages(tables.messages(spark, sf).withColumn("text", _as_latin(F.col("text"))), path)
    corpus = corpora.message_corpus(corpora.read_messages(spark, path, multiline=True))
    return corpus.withColumn("text", _from_latin(F.col("text")))


def dispatch_modes(spark, sf):
    """Both raw files read by corpus name, each normalized in the mode of its corpus."""
    folder = f"{scratch_root(spark)}/raw-{uuid.uuid4().hex}"
    _write_reviews(tables.reviews(spark, sf), f"{folder}/{corpora.REVIEW_FILE}")
    flat = F.regexp_replace("text", r"[^\x00-\xFF]|[\r\n]", " ")
    _write_messages(tables.messages(spark, sf).withColumn("text", flat), f"{folder}/{corpora.MESSAGE_FILE}")
    found = None
    for name in corpora.DATASETS:
        corpus = corpora.load_dataset(spark, name, folder)
        clean = training.normalizer_for(name, "none").apply(corpus)
        clean = clean.select("dataset", "doc_id", "label", "clean")
        found = clean if found is None else found.unionByName(clean)
    return found


def sink_roundtrips(spark, sf):
    """The class report through the CSV, report and JSON sinks."""
    report = stage(class_report(spark, sf), "class-report")
    folder = f"{scratch_root(spark)}/sinks-{uuid.uuid4().hex}"
    csv = spark.read.option("header", True).csv(sinks.write_csv(report, f"{folder}/csv"))
    stored = spark.read.parquet(sinks.write_report(report, f"{folder}/report"))
    json = spark.read.json(sinks.write_summary(report.where(F.col("class") == "accuracy"), f"{folder}/json"))
    found = None
    for name, table in {"csv": csv, "report": stored, "json": json}.items():
        columns = [F.col(c).cast(kind).alias(c) for c, kind in report.dtypes]
        rows = table.select(F.lit(name).alias("sink"), *columns)
        found = rows if found is None else found.unionByName(rows)
    return found


def ledger_rows(spark, sf):
    """Runs appended twice, by source; the ledger gives each once."""
    sources = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("source").alias("dataset"))
    runs = metrics.binary_metrics(tables.judged(spark, sf).join(sources, "doc_id"), by=("dataset",))
    path = f"{scratch_root(spark)}/ledger-{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.append_runs(runs, path)
    found = sinks.read_runs(spark, path)
    return found.select("dataset", *[rounded(c, c) for c in ("accuracy", "f1")], "rows")


# Rows that share an id


def _twice(spark, sf) -> DataFrame:
    docs = tables.documents(spark, sf)
    return docs.union(docs.withColumn("text", F.concat(F.lit("copied words "), "text")))


def repeated_ids(spark, sf):
    """Counts when every id belongs to two documents."""
    clean = _stored(STANDARD.apply(_twice(spark, sf)))
    fitted = terms.fit_terms(clean, (1, 2), 2, MAX_FEATURES)
    found = weights.bag_of_words(terms.by_document(clean), fitted.vocab, (1, 2), None)
    return terms.named(found, fitted.vocab, None).drop(terms.ROW)


def repeated_ids_split(spark, sf):
    """Sizes of a split when every id occurs with both labels."""
    docs = tables.labelled(spark, sf)
    twice = docs.union(docs.withColumn("label", 1 - F.col("label")))
    flagged = sampling.stratified_flag(twice, 0.2)
    return flagged.groupBy("label", F.col("is_test").cast("int").alias("is_test")).agg(
        F.count(F.lit(1)).alias("n")
    )


# Retrieval


def _index(spark, sf):
    return retrieval.fit_index(
        tables.corpus(spark, sf).select("doc_id", "text", "label"), STANDARD
    )


def _shown(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "rank", "doc_id", rounded("score", "score"), "sentiment", "text")


def _frequent_words(spark, sf, sentiment: str | None) -> DataFrame:
    """One request made of the five most frequent words of the corpus."""
    documents = tables.corpus(spark, sf).select("doc_id", "text", "label")
    with staging(spark):
        query = _most_frequent(STANDARD.apply(documents), 5)
    free_shuffles(spark)
    return spark.createDataFrame(
        [(0, query, sentiment, 10)], "query_id bigint, query string, sentiment string, top_k int"
    )


def _most_frequent(documents: DataFrame, n: int) -> str:
    """The ``n`` most frequent words, joined by spaces."""
    clean = _stored(documents)
    counts = terms.term_statistics(clean, (1, 1), terms.task_count(clean))
    top = counts.orderBy(F.desc("cf"), "term").limit(n)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("cf")).alias("c"), "term")))
    query = F.array_join(F.transform(ordered, lambda x: x["term"]), " ")
    return top.agg(query.alias("query")).first()["query"]


def bm25_search(spark, sf):
    request = _frequent_words(spark, sf, None)
    return _shown(retrieval.search_many(_index(spark, sf), request))


def bm25_search_positive(spark, sf):
    request = _frequent_words(spark, sf, "positive")
    return _shown(retrieval.search_many(_index(spark, sf), request))


def bm25_search_many(spark, sf):
    return _shown(retrieval.search_many(_index(spark, sf), tables.requests(spark, sf)))


def _stored_index(spark, sf):
    path = f"{scratch_root(spark)}/index-{uuid.uuid4().hex}"
    corpus = tables.corpus(spark, sf).select("doc_id", "text", "label")
    return retrieval.load_index(spark, retrieval.build_index(corpus, path, STANDARD))


def index_roundtrip(spark, sf):
    """An index stored, opened and searched."""
    return _shown(retrieval.search_many(_stored_index(spark, sf), tables.requests(spark, sf)))


def _one(spark, sf, sentiment: str | None, top_k: int) -> DataFrame:
    query = _frequent_words(spark, sf, sentiment).first()["query"]
    return _shown(
        retrieval.search(_stored_index(spark, sf), query, sentiment, top_k).withColumn(
            "query_id", F.lit(0)
        )
    ).drop("query_id")


def search_one(spark, sf):
    return _one(spark, sf, "positive", 10)


def search_top_200(spark, sf):
    return _one(spark, sf, None, 200)


def _finished(spark, requests: DataFrame, start) -> DataFrame:
    """Run a stream over stored requests to its end and read what it has written."""
    folder = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    requests.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(requests.schema).parquet(f"{folder}/in")
    start(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


def stream_hits(spark, sf):
    index = _index(spark, sf)
    found = _finished(
        spark, tables.requests(spark, sf),
        lambda asked, out, check: serve.search_stream(asked, index, out, check),
    )
    return _shown(found)


def search_responses(spark, sf):
    asked = tables.requests(spark, sf)
    hits = retrieval.search_many(_index(spark, sf), asked)
    found = retrieval.responses(asked, hits)
    first = F.try_element_at("results", F.lit(1))["doc_id"]
    return found.select("query_id", "query", "count", first.alias("first_doc"))


def rejected_requests(spark, sf):
    return retrieval.split_requests(tables.requests(spark, sf))[1]


# Learning and evaluation


def class_weights(spark, sf):
    found = metrics.class_weights(tables.judged(spark, sf))
    return found.select("label", "n", rounded("weight", "weight"))


def binary_metrics(spark, sf):
    found = metrics.binary_metrics(tables.judged(spark, sf))
    return found.select(
        *[rounded(c, c) for c in ("accuracy", "precision", "recall", "f1")], "rows"
    )


def class_report(spark, sf):
    found = metrics.class_report(tables.judged(spark, sf))
    return found.select(
        "class", *[rounded(c, c) for c in ("precision", "recall", "f1")], "support"
    )


def grid_summary(spark, sf):
    """Best values over runs; here a run is the rule-made predictions of one source."""
    sources = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source")
    judged = tables.judged(spark, sf).join(sources, "doc_id")
    runs = metrics.binary_metrics(judged, by=("source",))
    best = metrics.run_summary(runs.withColumn("vocabulary_size", F.col("rows")))
    return best.select(
        "rows", rounded("best_f1", "best_f1"), rounded("best_accuracy", "best_accuracy"),
        "best_vocabulary_size",
    )


def _trained(vectorizer: str, reduction: str = "none") -> Query:
    def run(spark, sf):
        prepared = training.prepare(tables.labelled(spark, sf), "amazon", reduction)
        record, _ = training.train_evaluate(prepared, vectorizer)
        return record.drop("duration_seconds", "model_path", "report_path")

    return run


def _given_model(spark, sf):
    """A classifier whose coefficients follow from the term numbers, and its documents."""
    clean = _stored(STANDARD.apply(tables.documents(spark, sf)))
    fitted = terms.fit_terms(clean, (1, 2), 2, MAX_FEATURES)
    coefs = fitted.vocab.select("term_id", ((F.col("term_id") % 7 - 3) / 2.0).alias("coef"))
    model = training.SentimentModel(
        "tfidf", STANDARD, fitted.vocab, coefs, 0.05, fitted.n_docs, fitted.avgdl, fitted.size
    )
    return model, clean


def score_given(spark, sf):
    model, clean = _given_model(spark, sf)
    found = training.predict_clean(model, clean)
    return found.select("doc_id", "prediction", "sentiment", rounded("probability", "probability"))


def model_roundtrip(spark, sf):
    """The given model saved, loaded and applied."""
    model, clean = _given_model(spark, sf)
    path = training.save_model(model, f"{scratch_root(spark)}/model-{uuid.uuid4().hex}")
    found = training.predict_clean(training.load_model(spark, path), clean)
    return found.select("doc_id", "prediction", "sentiment", rounded("probability", "probability"))


def fit_gradient(spark, sf):
    """The gradient at the fitted coefficients, by term, computed apart from the fit: zero."""
    prepared = training.prepare(tables.labelled(spark, sf), "amazon", "none")
    fitted = training.fit_terms(prepared)
    model = training.fit_model(prepared, "tfidf", fitted, tol=1e-6)
    docs = terms.by_document(prepared.train)
    weighed = stage(weights.tfidf(docs, fitted.vocab, training.NGRAMS, fitted.n_docs, fitted.size), "weights")
    found = learn.gradient(
        prepared.train.select(terms.ROW, "label"), weighed.select(terms.ROW, "term_id", "weight"),
        model.coefs, model.intercept,
    )
    named = found.join(fitted.vocab.select("term_id", "term"), "term_id", "left")
    return named.select(
        F.coalesce("term", F.lit("(intercept)")).alias("term"), F.round(F.abs("gradient"), 5).alias("gradient")
    )


def stopwords_table(spark, sf):
    """A table of stop words: half of all words of the documents, by their hash."""
    docs = tables.documents(spark, sf)
    words = STANDARD.apply(docs).select(F.explode(F.split("clean", " ")).alias("word"))
    listed = words.distinct().where(F.md5("word") < "8")
    normalizer = Normalizer(reduction="none", stopwords_table=listed)
    return normalizer.apply(docs).select("doc_id", "clean")


def stream_scores(spark, sf):
    model, _ = _given_model(spark, sf)
    found = _finished(
        spark, tables.documents(spark, sf),
        lambda asked, out, check: serve.score_stream(asked, model, out, check),
    )
    return found.select("doc_id", "label", "sentiment", rounded("probability", "probability"))


def run_sizes(spark, sf):
    prepared = training.prepare(tables.labelled(spark, sf), "amazon", "none")
    fitted = training.fit_terms(prepared)
    return fitted.vocab.agg(
        F.count(F.lit(1)).alias("vocabulary_size"),
        F.lit(prepared.train_rows).cast("bigint").alias("train_rows"),
        F.lit(prepared.test_rows).cast("bigint").alias("test_rows"),
    )


def predict(spark, sf):
    """A model fitted on the labelled documents, applied to every document."""
    prepared = training.prepare(tables.labelled(spark, sf), "amazon", "none")
    model = training.fit_model(prepared, "tfidf")
    return training.predict(model, tables.documents(spark, sf))


def grid_cells(spark, sf):
    """The settings and sizes of every run of the grid."""
    return grid_runs(spark, sf).select("dataset", "vectorizer", "reduction", "train_rows", "test_rows")


def grid_runs(spark, sf):
    """Both corpora, all vectorizers, all reductions."""
    corpora_of = {"amazon": tables.labelled, "sentiment140": tables.short_texts}
    runs = training.run_grid(
        lambda name: corpora_of[name](spark, sf), list(corpora_of),
        reductions=["none", "stem", "lemma"],
    )
    return runs.drop("duration_seconds", "model_path", "report_path")


QUERIES: dict[str, Query] = {
    "label_threshold": label_threshold,
    "neutral_filter": neutral_filter,
    "label_equality": label_equality,
    "text_concat": text_concat,
    "snippet": snippet,
    "head_sample": head_sample,
    "sample_md5": sample_md5,
    "class_half_sample": class_half_sample,
    "stratified_split": stratified_split,
    "norm_minimal": _normalized(Normalizer("minimal", "none"), tables.documents),
    "norm_standard": _normalized(STANDARD, tables.documents),
    "norm_tweet": _normalized(Normalizer("tweet", "none"), _message_texts),
    "norm_pages": _normalized(Normalizer("standard", "none"), tables.pages),
    "norm_pages_minimal": _normalized(Normalizer("minimal", "none"), tables.pages),
    "norm_pages_tweet": _normalized(Normalizer("tweet", "none"), _with_mentions),
    "norm_contractions": _normalized(STANDARD, _with_apostrophes),
    "norm_contractions_minimal": _normalized(Normalizer("minimal", "none"), _with_apostrophes),
    "stopwords_extra": _normalized(
        Normalizer(
            reduction="none", keep_negations=False, min_token_length=3,
            extra_stopwords=("que", "der", "los", "tion"),
        ),
        tables.documents,
    ),
    "norm_case_kept": _normalized(
        Normalizer(reduction="none", lowercase=False, remove_stopwords=False, min_token_length=1),
        tables.documents,
    ),
    "html_unescape_basic": _marked(unescape_entities, tables.pages),
    "contractions": _marked(tx.expand_contractions, _with_apostrophes),
    "link_removal": _marked(tx.remove_links, tables.pages),
    "link_tags": _marked(tx.tag_links, tables.pages),
    "mention_tags": _marked(tx.tag_mentions, _with_mentions),
    "hashtag_words": _marked(tx.unwrap_hashtags, _with_mentions),
    "elongation_squeeze": _marked(tx.squeeze_elongations, tables.pages),
    "punctuation_blanks": _marked(tx.blank_punctuation, tables.pages),
    "number_tags": _marked(tx.tag_numbers, tables.pages),
    "lemma_lookup": lemma_lookup,
    "stem": _normalized(Normalizer(reduction="stem"), tables.documents),
    "ngrams": ngrams,
    "doc_freq": doc_freq,
    "vocab_topk": vocab_topk,
    "vocab_share": vocab_share,
    "bow": bow,
    "tfidf": tfidf,
    "bm25_stats": bm25_stats,
    "bm25_idf": bm25_idf,
    "doc_lengths": doc_lengths,
    "bm25_weights": bm25_weights,
    "cooccurrence": cooccurrence_cells,
    "ppmi": ppmi,
    "unit_vectors": unit_vectors,
    "nearest_vectors": nearest_vectors,
    "top_norm": top_norm,
    "mean_embedding": mean_embedding,
    "nearest_words": nearest_words,
    "lsa_terms": lsa_terms,
    "bm25_search": bm25_search,
    "bm25_search_positive": bm25_search_positive,
    "bm25_search_many": bm25_search_many,
    "search_responses": search_responses,
    "rejected_requests": rejected_requests,
    "svd_gram": svd_gram,
    "wide_sink": wide_sink,
    "reviews_csv": reviews_csv,
    "messages_csv": messages_csv,
    "dispatch_modes": dispatch_modes,
    "sink_roundtrips": sink_roundtrips,
    "ledger_rows": ledger_rows,
    "model_roundtrip": model_roundtrip,
    "fit_gradient": fit_gradient,
    "stopwords_table": stopwords_table,
    "repeated_ids": repeated_ids,
    "repeated_ids_split": repeated_ids_split,
    "index_roundtrip": index_roundtrip,
    "search_one": search_one,
    "search_top_200": search_top_200,
    "stream_hits": stream_hits,
    "score_given": score_given,
    "stream_scores": stream_scores,
    "run_sizes": run_sizes,
    "class_weights": class_weights,
    "binary_metrics": binary_metrics,
    "class_report": class_report,
    "grid_summary": grid_summary,
    "train_bow": _trained("bow"),
    "train_tfidf": _trained("tfidf"),
    "train_bm25": _trained("bm25"),
    "train_embedding": _trained("embedding"),
    "train_tfidf_stem": _trained("tfidf", "stem"),
    "predict": predict,
    "grid_cells": grid_cells,
    "grid_runs": grid_runs,
}
