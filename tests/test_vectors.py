import functools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textweir import session
from textweir.operators import cooccurrence, embeddings, nearest, skew, svd, terms, weights
from textweir.session import stage


def _docs(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "row_id bigint, doc_id bigint, clean string")
    return docs.repartition("row_id")


def test_bm25_golden(spark):
    """Three documents, weights worked out by hand; the empty one counts in the mean."""
    docs = _docs(spark, ["red red blue", "blue green", ""])
    fitted = terms.fit_terms(docs, (1, 1), 1, None)
    assert fitted.avgdl == 5 / 3
    weighed = weights.bm25(docs, fitted.vocab, (1, 1), fitted.n_docs, fitted.avgdl, None)
    found = terms.named(weighed, fitted.vocab, None)
    got = {(r.doc_id, r.term): r.weight for r in found.collect()}

    def weigh(tf, df, length):
        idf = math.log((3 - df + 0.5) / (df + 0.5) + 1)
        return idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / (5 / 3)))

    expected = {
        (0, "red"): weigh(2, 1, 3), (0, "blue"): weigh(1, 2, 3),
        (1, "blue"): weigh(1, 2, 2), (1, "green"): weigh(1, 1, 2),
    }
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-12) for k in expected)


def test_statistics_of_a_fit_are_counted_in_bounded_tasks(spark, monkeypatch):
    """However few partitions the documents come in, a task counts some of the text only."""
    seen = []
    whole = terms.term_statistics
    monkeypatch.setattr(terms, "term_statistics", lambda docs, *a: seen.append(docs) or whole(docs, *a))
    monkeypatch.setattr(terms, "TASK_BYTES", 1000)
    docs = stage(_docs(spark, ["red blue " * 20] * 40).coalesce(1), "one-part")
    fitted = terms.fit_terms(docs, (1, 2), 1, None)
    assert seen[0].rdd.getNumPartitions() >= 7
    got = {r.term: (r.df, r.cf) for r in fitted.vocab.collect()}
    assert got == {"red": (40, 800), "blue": (40, 800), "red blue": (40, 800), "blue red": (40, 760)}


def test_sums_by_term_follow_the_tasks_that_count(spark):
    """The sums of a fit are dealt to as many tasks as its text, not to the session's number."""
    docs = stage(_docs(spark, [f"red blue w{i} red" for i in range(40)]), "sums")
    found = terms.term_statistics(terms.by_document(docs, tasks=9), (1, 2), 9)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(term") == 1
    assert found.rdd.getNumPartitions() == 9
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, terms.term_statistics(docs, (1, 2)).collect()))


def test_word_vectors_from_given_counts(spark, monkeypatch):
    """Counts that are stored already are not made again."""
    docs = stage(_docs(spark, ["aa bb cc aa", "bb cc dd", "aa dd bb"] * 3), "few").repartition("row_id")
    counts = terms.term_statistics(docs)
    want = {r.term: r.term_id for r in embeddings.fit_word_vectors(docs, 2).vectors.collect()}
    monkeypatch.setattr(terms, "term_statistics", None)
    found = embeddings.fit_word_vectors(docs, 2, stats=counts).vectors.collect()
    assert {r.term: r.term_id for r in found} == want and len(want) == 4


def test_ngrams_and_second_tokenization(spark):
    docs = _docs(spark, ["<num> good go o", "x", ""])
    found = sorted((r.term, r.tf) for r in terms.term_counts(docs, (1, 3)).collect())
    assert found == [
        ("go", 1), ("good", 1), ("good go", 1), ("num", 1), ("num good", 1), ("num good go", 1),
    ]
    stats = terms.term_statistics(_docs(spark, ["aa bb aa", "aa"]))
    assert sorted(map(tuple, stats.collect())) == [("aa", 2, 3), ("bb", 1, 1)]


def test_max_features_breaks_ties_by_term(spark):
    docs = _docs(spark, ["dd cc bb aa aa"])
    vocab = terms.fit_vocabulary(terms.term_statistics(docs), None, 1, 3)
    assert [(r.term, r.term_id) for r in vocab.orderBy("term_id").collect()] == [
        ("aa", 0), ("bb", 1), ("cc", 2),
    ]


def _brute_cells(texts, known, window):
    cells = {}
    for text in texts:
        words = [w for w in text.split() if w in known]
        for i, a in enumerate(words):
            for j in range(max(0, i - window), min(len(words), i + window + 1)):
                if i != j:
                    key = (a, words[j])
                    cells[key] = cells.get(key, 0) + 1 / abs(i - j)
    return cells


def test_cooccurrence_and_ppmi_against_brute_force(spark):
    texts = ["aa bb zz aa aa cc", "cc bb aa bb", "aa", "zz"]
    docs = _docs(spark, texts)
    vocab = terms.fit_vocabulary(terms.term_statistics(docs), None, 1, 3)
    known = {r.term for r in vocab.collect()}
    for window in (1, 2, 4):
        sequence = cooccurrence.known_sequence(docs, vocab, 3)
        cells = cooccurrence.cooccurrence(sequence, window)
        named = cooccurrence.named_cells(cells, vocab, 3)
        got = {(r.row_term, r.col_term): r.x for r in named.collect()}
        expected = _brute_cells(texts, known, window)
        assert got.keys() == expected.keys()
        assert all(math.isclose(got[k], expected[k]) for k in expected)
        ppmi = {(r.row_id, r.col_id): r.x for r in cooccurrence.ppmi(cells, 3).collect()}
        assert all(x > 0 and math.isclose(x, ppmi[(c, r)]) for (r, c), x in ppmi.items())


def test_svd_matches_numpy(spark, monkeypatch):
    rng = np.random.default_rng(1)
    matrix = np.where(rng.random((90, 70)) < 0.2, rng.random((90, 70)), 0)
    matrix += 5 * np.outer(rng.random(90) < 0.3, rng.random(70) < 0.3)
    rows = [(int(i), int(j), float(matrix[i, j])) for i, j in zip(*matrix.nonzero(), strict=True)]
    cells = spark.createDataFrame(rows, "row_id int, col_id int, x double")
    u, s, _ = np.linalg.svd(matrix)
    exact = u[:, :8] * s[:8]
    for panel_bytes in (1 << 28, 90 * 8 * 6):
        monkeypatch.setattr(svd, "_PANEL_BYTES", panel_bytes)
        found, sigma = svd.truncated_svd(cells, 90, 8, oversampling=20)
        got = np.array([r.embedding for r in found.orderBy("row_id").collect()])
        assert np.allclose(sigma, s[:8], rtol=1e-3)
        assert np.abs(got @ got.T - exact @ exact.T).max() < 0.02 * s[0]


def test_svd_of_symmetric_matrices(spark):
    """Half the work for a symmetric matrix, with singular values of either sign."""
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    values = np.r_[9, -8, 7, -6, 5, 1 / np.arange(2, 117)]
    matrix = (q * values) @ q.T
    rows = [(i, j, float(matrix[i, j])) for i in range(120) for j in range(120)]
    cells = spark.createDataFrame(rows, "row_id int, col_id int, x double")
    exact = q[:, :5] * np.abs(values[:5])
    for symmetric in (True, False):
        found, sigma = svd.truncated_svd(cells, 120, 5, symmetric=symmetric)
        got = np.array([r.embedding for r in found.orderBy("row_id").collect()])
        assert np.allclose(sigma, [9, 8, 7, 6, 5], rtol=1e-6)
        assert np.abs(got @ got.T - exact @ exact.T).max() < 1e-3


def test_svd_of_few_columns_by_chunks_of_rows(spark, monkeypatch):
    """Where the matrix is narrow, no task holds all rows; both ways give the same products."""
    rng = np.random.default_rng(11)
    matrix = np.where(rng.random((300, 12)) < 0.6, rng.standard_normal((300, 12)), 0)
    matrix[64:128] = 0
    rows = [(int(i), int(j), float(matrix[i, j])) for i, j in zip(*matrix.nonzero(), strict=True)]
    cells = spark.createDataFrame(rows, "row_id int, col_id int, x double").repartition(3)
    whole = svd._add_product
    for narrow in (True, False):
        monkeypatch.setattr(svd, "_NARROW", 64 if narrow else 1 << 30)
        monkeypatch.setattr(svd, "_add_product", None if narrow else whole)
        found, sigma = svd.truncated_svd(cells, 300, 12)
        got = np.array([r.embedding for r in found.orderBy("row_id").collect()])
        assert np.allclose(sigma, np.linalg.svd(matrix)[1]) and np.allclose(got @ got.T, matrix @ matrix.T)


@pytest.mark.parametrize("symmetric", [True, False])
def test_svd_is_the_same_by_panels_and_by_whole_columns(spark, monkeypatch, symmetric):
    rng = np.random.default_rng(13)
    matrix = np.where(rng.random((70, 70)) < 0.3, rng.random((70, 70)), 0)
    matrix = matrix + matrix.T
    rows = [(int(i), int(j), float(matrix[i, j])) for i, j in zip(*matrix.nonzero(), strict=True)]
    cells = spark.createDataFrame(rows, "row_id int, col_id int, x double")
    monkeypatch.setattr(svd, "_NARROW", 1 << 30)
    monkeypatch.setattr(svd, "_CELLS_PER_PIECE", 150)
    found = []
    for small, panel in ((1 << 25, 1 << 26), (0, 1 << 26), (0, 70 * 8 * 4)):
        monkeypatch.setattr(svd, "_SMALL_BYTES", small)
        monkeypatch.setattr(svd, "_PANEL_BYTES", panel)
        rows, _ = svd.truncated_svd(cells, 70, 5, symmetric=symmetric)
        got = np.array([r.embedding for r in rows.orderBy("row_id").collect()])
        found.append(got @ got.T)
    assert np.allclose(found[0], found[1]) and np.allclose(found[0], found[2])


def test_svd_packs_blocks_in_pieces(spark, monkeypatch):
    """Few cells are sorted at once, however large a block; pieces of a block add up."""
    rng = np.random.default_rng(12)
    matrix = np.where(rng.random((80, 90)) < 0.4, rng.standard_normal((80, 90)), 0)
    matrix = matrix + 20 * np.outer(rng.random(80), rng.random(90))
    rows = [(int(i), int(j), float(matrix[i, j])) for i, j in zip(*matrix.nonzero(), strict=True)]
    cells = spark.createDataFrame(rows, "row_id int, col_id int, x double")
    monkeypatch.setattr(svd, "_NARROW", 1 << 30)
    stored, sizes = svd.stage, []
    monkeypatch.setattr(svd, "stage", lambda df, name: sizes.append(df.count()) or stored(df, name))
    monkeypatch.setattr(svd, "_CELLS_PER_PIECE", len(rows) // 24)
    found, sigma = svd.truncated_svd(cells, 80, 4, oversampling=40)
    assert sizes[0] >= 16
    exact = np.linalg.svd(matrix)[1][:4]
    assert np.allclose(sigma, exact, rtol=1e-6)


def test_svd_of_empty_and_low_rank(spark):
    empty = spark.createDataFrame([], "row_id int, col_id int, x double")
    found, sigma = svd.truncated_svd(empty, 3, 2)
    assert [r.embedding for r in found.collect()] == [[0.0, 0.0]] * 3 and sigma.tolist() == [0, 0]
    one = spark.createDataFrame([(0, 0, 3.0), (2, 0, 4.0)], "row_id int, col_id int, x double")
    found, sigma = svd.truncated_svd(one, 4, 3)
    rows = {r.row_id: r.embedding for r in found.collect()}
    assert np.isclose(sigma[0], 5) and np.allclose(sigma[1:], 0)
    assert np.isclose(abs(rows[0][0]), 3) and np.isclose(abs(rows[2][0]), 4)
    assert np.allclose(rows[1], 0) and len(rows) == 4


def test_svd_of_low_rank_in_many_panels(spark, monkeypatch):
    """More panels than rank: the same decomposition."""
    rng = np.random.default_rng(2)
    matrix = np.outer(rng.random(40), rng.random(30)) + np.outer(rng.random(40), rng.random(30))
    rows = [(i, j, float(matrix[i, j])) for i in range(40) for j in range(30)]
    cells = spark.createDataFrame(rows, "row_id int, col_id int, x double")
    monkeypatch.setattr(svd, "_PANEL_BYTES", 40 * 8)
    found, sigma = svd.truncated_svd(cells, 40, 6)
    got = np.array([r.embedding for r in found.orderBy("row_id").collect()])
    exact = np.linalg.svd(matrix)[1][:6]
    assert np.allclose(sigma[:2], exact[:2]) and np.allclose(sigma[2:], 0, atol=1e-6)
    assert np.allclose(got @ got.T, matrix @ matrix.T)


def test_rows_of_one_id_stay_apart(spark):
    """Two documents share an id: each keeps its own counts and weights."""
    docs = spark.createDataFrame(
        [(1, "red red"), (1, "blue"), (2, "red blue")], "doc_id bigint, clean string"
    )
    counts = terms.term_counts(terms.by_document(docs)).select("doc_id", "term", "tf").collect()
    assert sorted(tuple(r) for r in counts) == [
        (1, "blue", 1), (1, "red", 2), (2, "blue", 1), (2, "red", 1)
    ]
    fitted = terms.fit_terms(docs, (1, 1), 1, None)
    found = weights.tfidf(terms.by_document(docs), fitted.vocab, (1, 1), fitted.n_docs, None)
    lone = sorted(r.weight for r in found.collect() if r.doc_id == 1)
    assert np.allclose(lone, [1.0, 1.0])


def test_nearest_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    table = np.round(rng.random((60, 3)), 1)
    table /= np.linalg.norm(table, axis=1)[:, None] + 1e-12
    rows = [(f"k{i:02d}", [float(x) for x in v]) for i, v in enumerate(table)]
    vectors = spark.createDataFrame(rows, "term string, embedding array<double>")
    found = nearest.nearest(vectors, vectors.select("term"), 5).collect()
    got = {(r.term, r["rank"]): r.neighbor for r in found}
    scores = np.round(table @ table.T, 12)
    for i in range(60):
        order = sorted((j for j in range(60) if j != i), key=lambda j: (-scores[i, j], j))[:5]
        assert [got[f"k{i:02d}", n + 1] for n in range(5)] == [f"k{j:02d}" for j in order]


def test_nearest_breaks_ties_by_key_and_skips_unknown(spark):
    vectors = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("c", [0.6, 0.8]), ("b", [0.6, 0.8]), ("d", [0.0, 1.0])],
        "term string, embedding array<double>",
    )
    asked = spark.createDataFrame([("a",), ("unknown",)], "term string")
    found = nearest.nearest(vectors, asked, 2).orderBy("rank").collect()
    assert [(r.term, r.neighbor, r.rank) for r in found] == [("a", "b", 1), ("a", "c", 2)]
    none = spark.createDataFrame([("unknown",)], "term string")
    assert nearest.nearest(vectors, none, 2).count() == 0


def test_mean_embedding(spark):
    docs = _docs(spark, ["aa aa bb <num>", "zz", ""])
    vectors = spark.createDataFrame(
        [("aa", [1.0, 0.0]), ("bb", [4.0, 3.0])], "term string, embedding array<double>"
    )
    found = {r.doc_id: r.embedding for r in nearest.mean_embedding(docs, vectors, 2, 2).collect()}
    assert np.allclose(found[0], [2, 1]) and found[1] == [0, 0] and found[2] == [0, 0]


def test_mean_embedding_skips_missing_elements(spark):
    """Missing vectors and elements add nothing, their words count; a sum of nothing is null."""
    docs = spark.createDataFrame(
        [(i, i, text) for i, text in enumerate(["aa bb bb", "cc", "aa dd", "zz", "ee aa"])],
        "row_id bigint, doc_id bigint, clean string",
    ).repartition(2, "row_id")
    rows = [("aa", [1.0, 2.0]), ("bb", [4.0, None]), ("cc", None), ("dd", [3.0]), ("ee", [1.0, 1.0, 9.0])]
    vectors = spark.createDataFrame(rows, "term string, embedding array<double>")
    for bound in (5, None):
        found = {r.doc_id: r.embedding for r in nearest.mean_embedding(docs, vectors, 2, bound).collect()}
        assert found == {0: [3.0, 2 / 3], 1: [None, None], 2: [2.0, 1.0], 3: [0.0, 0.0], 4: [1.0, 1.5]}


def test_vectors_are_summed_before_they_are_shuffled(spark):
    """A document's vectors leave the task as one sum, not as one row for each word."""
    docs = spark.range(4).selectExpr("id AS row_id", "id AS doc_id", "'aa bb cc dd' AS clean").repartition(2, "row_id")
    vectors = spark.createDataFrame([(w, [1.0]) for w in ("aa", "bb", "cc", "dd")], "term string, embedding array<double>")
    known = docs.selectExpr("row_id", "explode(split(clean, ' ')) AS term").join(vectors, "term").selectExpr("row_id", "1L AS n", "embedding")
    sums = known.coalesce(1).sortWithinPartitions("row_id").mapInArrow(
        nearest._weighted_sums(1), "row_id bigint, total array<double>, words bigint"
    ).collect()
    assert sum(r.words for r in sums) == 16 and len(sums) < 16


def test_unit_rows(spark):
    from textweir.functions.vectors import unit

    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "e array<double>")
    assert [r[0] for r in df.select(unit("e")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_bigrams_need_no_second_shuffle(spark):
    """Counting after the spread by document adds no exchange."""
    docs = terms.by_document(spark.createDataFrame([(1, "aa bb")], "doc_id bigint, clean string"))
    plan = terms.term_counts(docs, (1, 2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_frequent_terms_are_dealt_over_tasks(spark, monkeypatch, request):
    """A vocabulary that must not be broadcast gives the same counts, no task a whole term."""
    rows = [(i, "common " * (i % 3 + 1) + f"rare{i % 40} both") for i in range(300)]
    docs = stage(spark.createDataFrame(rows, "doc_id bigint, clean string").withColumn("row_id", F.col("doc_id")), "d")
    fitted = terms.fit_terms(docs, (1, 1), 1)
    plain = weights.bag_of_words(docs, fitted.vocab, (1, 1), fitted.size).collect()
    stored = stage(fitted.vocab, "vocab")
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 50)
    settings = {"autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        request.addfinalizer(functools.partial(spark.conf.unset, f"spark.sql.{name}"))
        spark.conf.set(f"spark.sql.{name}", value)
    dealt = weights.bag_of_words(docs, stored, (1, 1), fitted.size)
    assert sorted(dealt.collect()) == sorted(plain)
    grams = terms.document_terms(docs).select("row_id", "term")
    joined = skew.spread_join(grams, stored, "term", "cf", F.col("row_id"))
    assert joined.columns == ["term", "row_id", "term_id", "df", "cf"] and joined.count() == grams.count()
    sizes = joined.groupBy("term", F.spark_partition_id().alias("p")).count()
    whole = {r.term: r.cf for r in stored.collect()}
    assert whole["common"] > 500
    assert max(r["count"] for r in sizes.where("term = 'common'").collect()) < whole["common"]


def test_documents_are_spread_by_size(spark, monkeypatch):
    docs = spark.createDataFrame([(n, "word " * 100) for n in range(40)], "doc_id bigint, clean string")
    monkeypatch.setattr(terms, "TASK_BYTES", 1_000)
    spread = terms.by_document(docs)
    assert spread.rdd.getNumPartitions() == 20
    assert terms.term_counts(spread).count() == 40
    assert terms.by_document(docs.where("doc_id < 0")).count() == 0
