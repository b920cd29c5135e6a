"""BM25 retrieval over a stored or freshly built index.

Postings hold the document weight of every known n-gram. A query is weighted by the same
fitted statistics, so a shared term contributes the product of both weights.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textweir.functions.text import Normalizer, label_name, snippet
from textweir.operators import terms, weights
from textweir.session import broadcast_fits, broadcast_if_measured, free_shuffles, stage, staging, unstage

# The most hits a request form may ask for; the engine itself takes any number.
MAX_TOP_K = 50
NGRAMS = (1, 2)
# Folders of a stored index: ranges of terms, and ranges of documents.
BUCKETS = 64
# Hits up to this number are looked up by a list of their rows.
IN_LIST = 1_000
# Rows of a block of postings, as a power of two.
BLOCK_BITS = 7
# Postings that one task groups by term and block, as each may be a group of some hundred bytes there.
TASK_POSTINGS = 1_000_000
# Whole texts that one task sorts to store them, and the least share of a limit worth a task.
TASK_TEXTS = 10_000
_LEAST_SHARE = 16
# More than scores that count as equal, at nine decimals, can differ by.
_TIE = 2e-9
REQUEST_COLUMNS = ("query_id", "query", "sentiment", "top_k")


@dataclass(frozen=True)
class SearchIndex:
    """``vocab`` (term, term_id, df, cf), ``postings`` (term_id, block, row_id, doc_id, label,
    weight), ``blocks`` (term_id, block, top) and ``documents`` (row_id, doc_id, label, text) with
    whole texts. A block is a stretch of rows of one class; ``top`` is the largest weight of a
    term in it.

    ``vocab`` is stored, and carries a broadcast hint if its measured size allows. A stored
    index has a ``bucket`` column on postings and documents, by which reads are pruned:
    ``term_id`` and ``row_id`` divided by the widths."""

    normalizer: Normalizer
    vocab: DataFrame
    postings: DataFrame
    blocks: DataFrame
    documents: DataFrame
    n_docs: int
    avgdl: float
    k1: float = 1.5
    b: float = 0.75
    term_width: int | None = None
    row_width: int | None = None


def fit_index(
    documents: DataFrame,
    normalizer: Normalizer,
    max_features: int | None = 150_000,
    min_df: int | float = 2,
    k1: float = 1.5,
    b: float = 0.75,
) -> SearchIndex:
    """An index over ``(doc_id, text, label)``, all of it stored.

    Rows are numbered and stored with their whole text, then their clean text, the vocabulary, so its
    size is known before it is joined, the postings and the largest weights of their blocks. What a
    step leaves on the disks goes before the next one: the clean text, and the files of its shuffles.
    Documents may share a ``doc_id``.
    """
    spark = documents.sparkSession
    known = terms.identified(documents.select("doc_id", "text", "label"))
    rows = stage(known.select(terms.ROW, "doc_id", "label", "text"), "documents")
    clean = normalizer.apply(rows).select(terms.ROW, "doc_id", "clean", "label")
    clean = stage(clean, "clean")
    fitted = terms.fit_terms(clean, NGRAMS, min_df, max_features)
    postings = _weighted(
        terms.by_document(clean, "label"), fitted.vocab, fitted.n_docs, fitted.avgdl, k1, b,
        ("label",), fitted.size,
    )
    postings = stage(
        postings.select("term_id", block_of().alias("block"), terms.ROW, "doc_id", "label", "weight"), "postings"
    )
    unstage(clean)
    free_shuffles(spark)
    blocks = stage(block_tops(postings), "blocks")
    free_shuffles(spark)
    return SearchIndex(
        normalizer,
        fitted.vocab,
        postings,
        blocks,
        rows,
        fitted.n_docs,
        fitted.avgdl,
        k1,
        b,
    )


def _weighted(docs, vocab, n_docs, avgdl, k1, b, carry: tuple[str, ...], size: int | None = None):
    return weights.bm25(docs, vocab, NGRAMS, n_docs, avgdl, size, k1, b, carry)


def _tasks(spark: SparkSession, rows: int, limit: int) -> int:
    """Tasks for so many rows: about ``limit`` each at most, on all cores where that is worth it."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores, math.ceil(rows * _LEAST_SHARE / limit)), math.ceil(rows / limit))


def block_of(row: str = terms.ROW, label: str = "label") -> Column:
    """Number of a row's block: rows that follow each other, by class (0, 1, any other)."""
    kind = F.when(F.col(label) == 0, 0).when(F.col(label) == 1, 1).otherwise(2)
    return F.shiftright(F.col(row).cast("bigint"), BLOCK_BITS) * 3 + kind


def block_tops(postings: DataFrame) -> DataFrame:
    """``(term_id, block, top)``: the largest weight of each term in each block.

    Stored ``postings`` are counted and dealt by block first: a task gets about ``TASK_POSTINGS``
    of them, however many there are. Blocks have few rows each, so none is too large for a task.
    """
    tasks = max(1, math.ceil(postings.count() / TASK_POSTINGS))
    dealt = postings.select("term_id", "block", "weight").repartition(tasks, "block")
    return dealt.groupBy("term_id", "block").agg(F.max("weight").alias("top"))


def build_index(
    documents: DataFrame,
    path: str,
    normalizer: Normalizer,
    max_features: int | None = 150_000,
    min_df: int | float = 2,
    k1: float = 1.5,
    b: float = 0.75,
) -> str:
    """Fit and store an index.

    Postings lie in folders of term ranges, range-partitioned by (term, row) inside: a
    frequent term spreads over many files, and a search reads the folders of its terms only. So
    do the largest weights of the blocks.
    Documents lie in folders of row ranges. Row numbers are dense in ranges of even size, so
    the folders are even. The tables it is stored from go when all of it is stored.
    """
    with staging(documents.sparkSession):
        return _build(documents, path, normalizer, max_features, min_df, k1, b)


def _build(documents: DataFrame, path: str, normalizer: Normalizer, max_features, min_df, k1, b) -> str:
    spark = documents.sparkSession
    index = fit_index(documents, normalizer, max_features, min_df, k1, b)
    index.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    top_term = index.vocab.agg(F.coalesce(F.max("term_id"), F.lit(0))).first()[0]
    top_row = index.documents.agg(F.coalesce(F.max(terms.ROW), F.lit(0))).first()[0]
    term_width = max(1, math.ceil((top_term + 1) / BUCKETS))
    row_width = max(1, math.ceil((top_row + 1) / BUCKETS))
    _store(index.postings, "term_id", term_width, f"{path}/postings")
    _store(index.blocks, "term_id", term_width, f"{path}/blocks", "block")
    _store(index.documents, terms.ROW, row_width, f"{path}/documents")
    stats = (
        "n_docs bigint, avgdl double, k1 double, b double, term_width bigint, row_width bigint"
    )
    row = (index.n_docs, index.avgdl, index.k1, index.b, term_width, row_width)
    spark.createDataFrame([row], stats).write.mode("overwrite").parquet(f"{path}/corpus_stats")
    save_normalizer(spark, normalizer, f"{path}/config")
    return path


def _store(table: DataFrame, key: str, width: int, path: str, second: str = terms.ROW) -> None:
    """Stored ``table``, sorted, in folders; the number of tasks follows its rows."""
    keys = list(dict.fromkeys([key, second]))
    limit = TASK_TEXTS if key == terms.ROW else TASK_POSTINGS
    tasks = _tasks(table.sparkSession, table.count(), limit)
    ordered = table.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    bucket = F.floor(F.col(key) / width).cast("int")
    ordered.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(path)
    del ordered
    free_shuffles(table.sparkSession)


def _pruned(table: DataFrame, wanted: DataFrame, key: str, width: int | None) -> DataFrame:
    """Only the folders that hold a wanted key; there are at most ``BUCKETS`` of them."""
    if width is None:
        return table
    buckets = wanted.select(F.floor(F.col(key) / width).cast("int").alias("b")).distinct()
    return table.where(F.col("bucket").isin([r["b"] for r in buckets.collect()]))


def save_normalizer(spark: SparkSession, normalizer: Normalizer, path: str) -> None:
    """Settings as one row, the tables of lemmas and stop words next to it."""
    settings = (
        "mode string, reduction string, lowercase boolean, remove_stopwords boolean, "
        "keep_negations boolean, min_token_length int, extra_stopwords array<string>, "
        "missing string, has_lemmas boolean, has_stopwords boolean"
    )
    row = (
        normalizer.mode, normalizer.reduction, normalizer.lowercase, normalizer.remove_stopwords,
        normalizer.keep_negations, normalizer.min_token_length, list(normalizer.extra_stopwords),
        normalizer.missing, normalizer.lemmas is not None, normalizer.stopwords_table is not None,
    )
    spark.createDataFrame([row], settings).write.mode("overwrite").parquet(f"{path}/settings")
    if normalizer.lemmas is not None:
        normalizer.lemmas.write.mode("overwrite").parquet(f"{path}/lemmas")
    if normalizer.stopwords_table is not None:
        normalizer.stopwords_table.write.mode("overwrite").parquet(f"{path}/stopwords")


def load_normalizer(spark: SparkSession, path: str) -> Normalizer:
    row = spark.read.parquet(f"{path}/settings").first().asDict()
    lemmas = spark.read.parquet(f"{path}/lemmas") if row.pop("has_lemmas") else None
    stopwords = spark.read.parquet(f"{path}/stopwords") if row.pop("has_stopwords") else None
    row["extra_stopwords"] = tuple(row["extra_stopwords"])
    return Normalizer(lemmas=lemmas, stopwords_table=stopwords, **row)


def load_index(source: SparkSession | SearchIndex, path: str | None = None) -> SearchIndex:
    """Open a stored index; an open index is returned as it is."""
    if isinstance(source, SearchIndex):
        return source
    stats = source.read.parquet(f"{path}/corpus_stats").first()
    vocab = broadcast_if_measured(source.read.parquet(f"{path}/vocab"), ["term"])
    return SearchIndex(
        load_normalizer(source, f"{path}/config"),
        vocab,
        source.read.parquet(f"{path}/postings"),
        source.read.parquet(f"{path}/blocks"),
        source.read.parquet(f"{path}/documents"),
        stats["n_docs"],
        stats["avgdl"],
        stats["k1"],
        stats["b"],
        stats["term_width"],
        stats["row_width"],
    )


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` requests; rejected ones carry the broken rule."""
    reason = (
        F.when(F.col("query").isNull() | (F.length("query") < 1), F.lit("empty query"))
        .when(
            F.col("sentiment").isNotNull() & ~F.col("sentiment").isin("positive", "negative"),
            F.lit("unknown sentiment"),
        )
        .when(F.col("top_k").isNull() | ~F.col("top_k").between(1, MAX_TOP_K), F.lit("bad top_k"))
    )
    checked = requests.select(*REQUEST_COLUMNS, reason.alias("reason"))
    return (
        checked.where("reason IS NULL").drop("reason"),
        checked.where("reason IS NOT NULL"),
    )


def query_weights(index: SearchIndex, requests: DataFrame) -> DataFrame:
    """``(request, query_id, sentiment, top_k, term_id, query_weight)`` by the index statistics.

    ``request`` tells requests of one ``query_id`` apart; equal requests are answered once.
    """
    asked = requests.select(F.col("query_id").alias("doc_id"), "query", "sentiment", "top_k")
    asked = asked.distinct().withColumn(terms.ROW, F.xxhash64("doc_id", "query", "sentiment", "top_k"))
    clean = index.normalizer.apply(asked, "query")
    found = _weighted(
        clean, index.vocab, index.n_docs, index.avgdl, index.k1, index.b, ("sentiment", "top_k")
    )
    return found.select(
        F.col(terms.ROW).alias("request"), F.col("doc_id").alias("query_id"), "sentiment", "top_k",
        "term_id", F.col("weight").alias("query_weight"),
    )


def _most(query_terms: DataFrame) -> int:
    """The largest ``top_k`` of a batch, as a literal limit of what tasks keep per request."""
    return query_terms.agg(F.coalesce(F.max("top_k"), F.lit(0))).first()[0]


def block_bounds(blocks: DataFrame, query_terms: DataFrame) -> DataFrame:
    """``(request, top_k, block, bound)``: no row of the block scores higher for the request.

    Blocks of classes that a request does not ask for are left out.
    """
    wanted = F.when(F.col("sentiment") == "positive", 1).when(F.col("sentiment") == "negative", 0)
    return (
        blocks.join(query_terms, "term_id")
        .where(wanted.isNull() | (F.pmod("block", F.lit(3)) == wanted))
        .groupBy("request", "top_k", "block")
        .agg(F.sum(F.col("top") * F.col("query_weight")).alias("bound"))
        .where("bound > 0")
    )


def _ranked(rows: DataFrame, limit: int, *order) -> DataFrame:
    """The first ``top_k`` rows of each request; tasks drop all beyond ``limit`` on their own."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("request").orderBy(*order)))
    return ranked.where((F.col("rank") <= limit) & (F.col("rank") <= F.col("top_k")))


def _scores(postings: DataFrame, query_terms: DataFrame, kept: DataFrame) -> DataFrame:
    """Scores of the rows in the kept ``(request, block)``.

    The terms of a request are listed for each of its blocks first, so postings of all other
    blocks drop out in the join, and a frequent term meets the query in pieces of one block.
    """
    asked = query_terms.join(kept.select("request", "block"), "request")
    asked = stage(asked.select("request", "query_id", "top_k", "term_id", "block", "query_weight"), "asked-blocks")
    known = asked.count()
    if broadcast_fits(known):
        found = postings.join(F.broadcast(asked), ["term_id", "block"])
    else:
        # Postings of the requested terms only; the tasks of the join and of the sums follow its rows.
        postings = postings.join(query_terms.select("term_id").distinct(), "term_id", "left_semi")
        tasks = _tasks(postings.sparkSession, known + postings.count(), TASK_POSTINGS)
        keys = ("term_id", "block")
        found = postings.repartition(tasks, *keys).join(asked.repartition(tasks, *keys), list(keys))
        found = found.repartition(tasks, "request", terms.ROW)
    return (
        found.groupBy("request", "query_id", "top_k", terms.ROW, "doc_id")
        .agg(F.sum(F.col("weight") * F.col("query_weight")).alias("score"))
        .where("score > 0")
    )


def kept_blocks(postings: DataFrame, blocks: DataFrame, query_terms: DataFrame) -> DataFrame:
    """``(request, top_k, block, bound)`` of the blocks that can hold a hit; exact.

    The ``top_k`` blocks of the highest bounds hold at least as many matching rows. The score of
    the ``top_k``-th best of these is a threshold; blocks whose bound lies below it (beyond what
    counts as a tie) are skipped.
    """
    limit = _most(query_terms)
    bounds = stage(block_bounds(blocks, query_terms), "block-bounds")
    first = _ranked(bounds, limit, F.desc("bound"), "block")
    best = _ranked(_scores(postings, query_terms, first), limit, F.desc("score"), terms.ROW)
    least = best.groupBy("request", "top_k").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    least = least.where("n = top_k").select("request", "least")
    least = broadcast_if_measured(stage(least, "thresholds"), [])
    near = bounds.join(least, "request", "left")
    return near.where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - _TIE)).drop("least")


def rank_hits(postings: DataFrame, blocks: DataFrame, query_terms: DataFrame) -> DataFrame:
    """``(request, query_id, row_id, score, rank)``: the best documents of each request.

    ``query_terms`` is stored. Blocks that cannot hold a hit are skipped by their bounds before
    their postings are joined; the class filter is one of blocks. The literal limit, the largest
    ``top_k`` asked for, lets each task drop all other rows of a request before they are
    shuffled. Scores are compared at nine decimals, so copies of a document tie however their
    terms were added up; ties go by ``doc_id``, then row.
    """
    scores = _scores(postings, query_terms, kept_blocks(postings, blocks, query_terms))
    best = _ranked(scores, _most(query_terms), F.desc(F.round("score", 9)), "doc_id", terms.ROW)
    return best.select("request", "query_id", terms.ROW, "score", "rank")


def _show(hits: DataFrame, documents: DataFrame) -> DataFrame:
    return hits.join(documents, terms.ROW).select(
        "query_id",
        "rank",
        F.col("doc_id").cast("string").alias("doc_id"),
        "score",
        label_name(F.col("label")).alias("sentiment"),
        snippet(F.col("text")).alias("text"),
    )


def search_many(index: SearchIndex, requests: DataFrame) -> DataFrame:
    """Hits ``(query_id, rank, doc_id, score, sentiment, text)`` for all valid requests.

    Equal requests are answered once. The weighted terms of the batch and its hits are stored
    and measured; each is broadcast if small, otherwise Spark joins on its key. Of a stored
    index only the folders with a wanted term, and those with a hit, are read.
    """
    valid, _ = split_requests(requests)
    query_terms = stage(query_weights(index, valid), "query-terms")
    postings, blocks = (
        _pruned(t, query_terms, "term_id", index.term_width) for t in (index.postings, index.blocks)
    )
    hits = stage(rank_hits(postings, blocks, broadcast_if_measured(query_terms, [])), "hits")
    documents = _pruned(index.documents, hits, terms.ROW, index.row_width)
    return _show(broadcast_if_measured(hits, []), documents)


def responses(requests: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per valid request: ``(query_id, query, count, results)``."""
    valid, _ = split_requests(requests)
    listed = hits.groupBy("query_id").agg(
        F.array_sort(
            F.collect_list(F.struct("rank", "doc_id", "score", "sentiment", "text"))
        ).alias("results")
    )
    joined = valid.join(listed, "query_id", "left")
    return joined.select(
        "query_id", "query", F.coalesce(F.size("results"), F.lit(0)).alias("count"), "results"
    )


def search(
    index: SearchIndex, query: str, sentiment: str | None = None, top_k: int = 10
) -> DataFrame:
    """Hits of one query. A sentiment other than positive or negative filters nothing.

    The few terms and hits are known before the big tables are read, so both reads carry
    an ``IN`` list that folders and parquet statistics can use.
    """
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    spark = index.documents.sparkSession
    wanted = sentiment if sentiment in ("positive", "negative") else None
    request = spark.createDataFrame(
        [(0, query, wanted, top_k)], "query_id bigint, query string, sentiment string, top_k int"
    )
    query_terms = stage(query_weights(index, request), "query-terms")
    known = [r["term_id"] for r in query_terms.select("term_id").collect()]
    postings, blocks = (
        _pruned(t, query_terms, "term_id", index.term_width).where(F.col("term_id").isin(known))
        for t in (index.postings, index.blocks)
    )
    hits = stage(rank_hits(postings, blocks, broadcast_if_measured(query_terms, [])), "hits")
    documents = _pruned(index.documents, hits, terms.ROW, index.row_width)
    if top_k <= IN_LIST:
        rows = [r[terms.ROW] for r in hits.select(terms.ROW).collect()]
        documents = documents.where(F.col(terms.ROW).isin(rows))
    return _show(broadcast_if_measured(hits, []), documents).drop("query_id").orderBy("rank")
