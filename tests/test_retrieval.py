import random
from collections import defaultdict

import pytest

from textweir import session
from textweir.functions.text import Normalizer
from textweir.operators import retrieval, terms
from textweir.session import stage

DOCS = [
    (1, "good coffee good smell", 1), (2, "bad coffee bad smell", 0), (3, "good tea", 1),
    (4, "", 0), (5, "good coffee good smell", 1), (6, "tea bad", 0),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string, label int")


@pytest.fixture(scope="module")
def stored(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "index")
    retrieval.build_index(documents, path, Normalizer(reduction="none"))
    return retrieval.load_index(spark, path)


def test_tied_copies_rank_by_id(stored):
    hits = retrieval.search(stored, "good coffee").collect()
    assert [h.doc_id for h in hits[:2]] == ["1", "5"]
    assert hits[0].score == pytest.approx(hits[1].score)
    assert [h.score for h in hits] == sorted((h.score for h in hits), reverse=True)
    assert all(h.score > 0 for h in hits) and "4" not in [h.doc_id for h in hits]


def test_sentiment_and_unknown_terms(stored):
    assert {h.sentiment for h in retrieval.search(stored, "coffee", "negative").collect()} == {
        "negative"
    }
    everything = retrieval.search(stored, "coffee", "whatever").count()
    assert everything == retrieval.search(stored, "coffee").count() == 3
    assert retrieval.search(stored, "unseen words").count() == 0


def test_top_k_rules(stored):
    assert retrieval.search(stored, "coffee tea", top_k=2).count() == 2
    with pytest.raises(ValueError):
        retrieval.search(stored, "coffee", top_k=0)


def test_more_hits_than_a_form_may_ask_for(spark):
    rows = [(i, "same words", 1) for i in range(130)]
    index = retrieval.fit_index(
        spark.createDataFrame(rows, "doc_id bigint, text string, label int"), Normalizer()
    )
    assert retrieval.search(index, "same words", top_k=120).count() == 120


def test_whole_texts_are_stored(spark, tmp_path):
    long = "word other " * 300
    docs = spark.createDataFrame([(1, long, 1), (1, "other word", 0)], "doc_id bigint, text string, label int")
    path = retrieval.build_index(docs, str(tmp_path / "index"), Normalizer(reduction="none"), k1=1.2, b=0.5)
    index = retrieval.load_index(spark, path)
    assert sorted(len(r.text) for r in index.documents.collect()) == [10, len(long)]
    assert (index.k1, index.b) == (1.2, 0.5)
    hits = retrieval.search(index, "other word").collect()
    assert [h.doc_id for h in hits] == ["1", "1"] and max(len(h.text) for h in hits) == 500


def test_batches_read_wanted_folders_only(spark, stored):
    asked = spark.createDataFrame(
        [(1, "tea", None, 5)], "query_id bigint, query string, sentiment string, top_k int"
    )
    terms = retrieval.query_weights(stored, asked)
    pruned = retrieval._pruned(stored.postings, terms, "term_id", stored.term_width)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "bucket" in filters and pruned.count() < stored.postings.count()


def test_stored_index_equals_fitted_one(spark, documents, stored):
    asked = spark.createDataFrame(
        [(1, "good tea", None, 5), (2, "bad", "negative", 1), (3, "", None, 5),
         (4, "tea", "mixed", 5), (5, "tea", None, 99), (6, "unseen", None, 5)],
        "query_id bigint, query string, sentiment string, top_k int",
    )
    fresh = retrieval.fit_index(documents, Normalizer(reduction="none"))
    columns = ("query_id", "rank", "doc_id", "sentiment", "text")
    one, two = (
        sorted(retrieval.search_many(i, asked).select(*columns).collect()) for i in (fresh, stored)
    )
    assert one == two and {r.query_id for r in one} == {1, 2}
    rejected = retrieval.split_requests(asked)[1].collect()
    assert {r.query_id: r.reason for r in rejected} == {
        3: "empty query", 4: "unknown sentiment", 5: "bad top_k",
    }
    answers = retrieval.responses(asked, retrieval.search_many(stored, asked)).collect()
    assert {r.query_id: r["count"] for r in answers} == {1: 4, 2: 1, 6: 0}


def test_open_index_is_returned(stored):
    assert retrieval.load_index(stored) is stored


def test_blocks_are_skipped_and_hits_stay(spark, monkeypatch):
    """Against scores of all postings, with small blocks, ties and class filters."""
    monkeypatch.setattr(retrieval, "BLOCK_BITS", 2)
    rng = random.Random(6)
    words = [f"w{n}" for n in range(60)]
    rows = [
        (i % 150, " ".join(rng.choices(words, [1 / (n + 1) for n in range(60)], k=rng.choice((3, 8, 40)))),
         rng.choice((0, 1, 1, None)))
        for i in range(400)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int").repartition(1)
    index = retrieval.fit_index(docs, Normalizer(reduction="none"))
    asked = [
        (n, " ".join(rng.choices(words, k=rng.randint(1, 4))), rng.choice((None, "positive", "negative")),
         rng.choice((1, 3, 20)))
        for n in range(40)
    ]
    requests = spark.createDataFrame(asked, "query_id bigint, query string, sentiment string, top_k int")
    asked_terms = stage(retrieval.query_weights(index, requests), "asked")
    got = retrieval.rank_hits(index.postings, index.blocks, asked_terms).collect()
    wanted = {"positive": 1, "negative": 0}
    scores: dict = {}
    held = defaultdict(list)
    for p in index.postings.collect():
        held[p.term_id].append(p)
    tops = {}
    for t in asked_terms.collect():
        tops[t.request] = t.top_k
        for p in held[t.term_id]:
            if t.sentiment is None or p.label == wanted[t.sentiment]:
                key = (t.request, p.row_id, p.doc_id)
                scores[key] = scores.get(key, 0.0) + p.weight * t.query_weight
    want = set()
    for request, top_k in tops.items():
        mine = sorted((-round(s, 9), k[2], k[1]) for k, s in scores.items() if k[0] == request)
        want |= {(request, rank + 1, m[2]) for rank, m in enumerate(mine[:top_k])}
    assert {(r.request, r["rank"], r.row_id) for r in got} == want
    kept = retrieval.kept_blocks(index.postings, index.blocks, asked_terms).count()
    every = retrieval.block_bounds(index.blocks, asked_terms).count()
    assert 0 < kept < 0.8 * every


def test_stored_blocks(spark, stored):
    """Stored maxima are those of the stored postings; each row lies in one block of its class."""
    tops = {(r.term_id, r.block): r.top for r in stored.blocks.collect()}
    want: dict = {}
    for p in stored.postings.collect():
        assert p.block % 3 == p.label and p.block // 3 == p.row_id >> retrieval.BLOCK_BITS
        want[p.term_id, p.block] = max(want.get((p.term_id, p.block), 0.0), p.weight)
    assert tops == want


def test_largest_weights_are_found_in_bounded_tasks(spark, stored, monkeypatch):
    """Postings are dealt by their number, a block to one task, and the maxima stay the same."""
    postings = stage(stored.postings, "postings")
    want = {(r.term_id, r.block, r.top) for r in stored.blocks.collect()}
    monkeypatch.setattr(retrieval, "TASK_POSTINGS", 5)
    tops = retrieval.block_tops(postings)
    assert tops._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert tops.rdd.getNumPartitions() == -(-postings.count() // 5) > 1
    found = [(r.term_id, r.block, r.top) for r in tops.collect()]
    assert len(found) == len(want) and set(found) == want
    assert retrieval.block_tops(postings.where("term_id < 0")).count() == 0


def test_stored_index_and_joins_are_dealt_by_size(spark, documents, stored, tmp_path, monkeypatch):
    """Whatever the session's number of partitions, tasks that store or join postings are bounded."""
    requests = spark.createDataFrame(
        [(1, "good coffee", None, 3), (2, "tea bad", "negative", 2), (3, "good smell tea", "positive", 5)],
        "query_id bigint, query string, sentiment string, top_k int",
    )
    shown = lambda hits: sorted((*h[:3], round(h.score, 9), *h[4:]) for h in hits.collect())
    want = shown(retrieval.search_many(stored, requests))
    monkeypatch.setattr(retrieval, "TASK_POSTINGS", 4)
    monkeypatch.setattr(retrieval, "TASK_TEXTS", 2)
    path = str(tmp_path / "index")
    retrieval.build_index(documents, path, Normalizer(reduction="none"))
    parts = {f.rsplit("/", 1)[1][:10] for f in spark.read.parquet(f"{path}/postings").inputFiles()}
    assert len(parts) > 4
    index = retrieval.load_index(spark, path)
    monkeypatch.setattr(retrieval, "broadcast_fits", lambda *_: False)
    assert shown(retrieval.search_many(index, requests)) == want
    asked = stage(retrieval.query_weights(index, requests), "asked")
    kept = retrieval.block_bounds(index.blocks, asked)
    assert retrieval._scores(index.postings, asked, kept).rdd.getNumPartitions() > 4


def test_a_stored_index_leaves_no_tables_behind(spark, tmp_path, monkeypatch):
    """What an index is stored from goes when it is stored; clean text goes when postings are."""
    docs = spark.createDataFrame([(i, f"red apple number {w}", i % 2) for i, w in enumerate("ab cd ab ef cd ab".split())],
                                 "doc_id bigint, text string, label int")
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(scratch))
    index = retrieval.fit_index(docs, Normalizer(reduction="none"))
    known = {p.name.rsplit("-", 1)[0] for p in scratch.iterdir()}
    assert "clean" not in known and {"documents", "postings", "blocks", "vocab"} <= known
    assert index.documents.count() == 6
    known = {p.name for p in scratch.iterdir()}
    path = retrieval.build_index(docs, str(tmp_path / "index"), Normalizer(reduction="none"))
    assert {p.name for p in scratch.iterdir() if not p.name.startswith(".")} <= known
    found = retrieval.search(retrieval.load_index(spark, path), "apple ab", None, 2).collect()
    assert [r.doc_id for r in found] == ["0", "2"]


def test_statistics_deal_the_text_once(spark):
    """Documents of a fit are shuffled once before their terms are counted."""
    docs = spark.createDataFrame([(0, 0, "aa bb")], "row_id bigint, doc_id bigint, clean string")
    plan = terms.term_statistics(terms.identified(docs), (1, 2), 3)._jdf.queryExecution().optimizedPlan().toString()
    seen = []
    original = terms.term_statistics
    try:
        terms.term_statistics = lambda *a: seen.append(original(*a)) or seen[-1]
        terms.fit_terms(docs, (1, 2), 1)
    finally:
        terms.term_statistics = original
    fitted = seen[0]._jdf.queryExecution()
    assert plan.count("Repartition") == fitted.optimizedPlan().toString().count("Repartition") == 2
    assert fitted.executedPlan().toString().count("Exchange") == 2
