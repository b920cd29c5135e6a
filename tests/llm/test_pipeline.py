"""Each stage of the pipeline on what its predecessor kept."""

import hashlib

import pytest
from cases import SF, ordered, table, texts
from test_simhash import roots
from test_winnow import plain as contaminated
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textweir.llm import quality, secrets
from textweir.session import stage


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], SF), name))
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "secrets", "tokens"
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality(spark, steps):
    model = quality.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    whole = [(r.doc_id, r.text) for r in steps[0].collect()]
    x = [quality.difference(t.encode(), model.good, model.bad) for _, t in whole]
    want = [w for w, p in zip(whole, model.probability(x), strict=True) if p >= 0.3]
    assert ordered((r.doc_id, r.text) for r in steps[1].collect()) == ordered(want)


def test_near_duplicates(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    _, root = roots(rows)
    first = {}
    for n, (i, _) in enumerate(rows):
        first[root[n]] = min(i, first.get(root[n], i))
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(first.values())


def test_decontamination(spark, steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [r[0] for r in contaminated(rows, items) if not r[4]]
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(want)
    assert 0 < len(want) < len(rows)


def test_secrets(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert after.keys() == before.keys()
    for i, text in before.items():
        assert after[i].n_chars == len(after[i].text)
        assert not secrets.base_findings(after[i].text)
        assert (after[i].text == text) or "[secret]" in after[i].text


def test_tokens(steps):
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    before = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert len(rows) == len(before)
    for r in rows:
        assert r.ids == library.encode(before[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest()


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    want = steps[5].select("doc_id", "ids_sha256").collect()
    assert ordered(tuple(r) for r in got) == ordered(tuple(r) for r in want)


def edge_tables(spark, folder, rows, items):
    """A folder of tables whose documents have clashing columns, and no labels."""
    docs = table(spark, rows).withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")}
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_edge_cases(spark, tmp_path):
    """Nulls, repeated ids and rows, empty and long texts, clashing columns, through all stages."""
    rows = texts()
    leak = " ".join(rows[13][1].split()[5:17])
    items = [(1, leak), (2, None), (None, "one")]
    docs = edge_tables(spark, tmp_path, rows, items)
    stages = [stage(docs, "edge")]
    for name, apply in corpus_pipeline.STAGES:
        stages.append(stage(apply(spark, stages[-1], str(tmp_path)), name))
    pairs = [ordered((r.doc_id, r.text) for r in df.collect()) for df in stages[:-1]]
    assert all(df.dtypes == docs.dtypes for df in stages[1:-1])
    assert pairs[1] == ordered(rows)
    _, root = roots(rows)
    last = lambda i: (i is None, i)
    groups = {}
    for n, (i, _) in enumerate(rows):
        groups[root[n]] = min(i, groups.get(root[n], i), key=last)
    assert ordered((i,) for i, _ in pairs[2]) == ordered((i,) for i in groups.values())
    hit = {i: r[4] for i, r in enumerate(contaminated(pairs[2], items))}
    assert len(pairs[3]) == len(pairs[2]) - sum(hit.values()) and 0 < sum(hit.values())
    assert [i for i, _ in pairs[4]] == [i for i, _ in pairs[3]]
    got = ordered((r.doc_id, r.n_tokens == 0) for r in stages[5].collect())
    assert got == ordered((i, not t) for i, t in pairs[4])


def test_empty_tables(spark, tmp_path):
    edge_tables(spark, tmp_path, [], [])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and "ids_sha256" in got.columns
