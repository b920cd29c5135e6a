"""Queries over the test tables, one for each operator and one for the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from textweir.llm import (
    audit,
    bpe,
    chat,
    fingerprint,
    language,
    licenses,
    periodic,
    quality,
    secrets,
    simhash,
    substring,
    suffix,
    winnow,
)
from textweir.llm.common import digest, documents, hex_print
from textweir.session import stage

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the long word runs of earlier documents."""
    kept = substring.deduplicate(documents(spark, sf))
    return kept.select("doc_id", "n_words", "n_removed", digest(F.col("kept")).alias("kept_sha256"))


def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every document; the network is trained on findings in the same documents."""
    docs = documents(spark, sf)
    model = secrets.fit(docs)
    found = docs.select("doc_id", secrets.scan(F.col("text"), model).alias("findings"))
    return found.select("doc_id", *secrets.digests(F.col("findings")))


def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation formatted and read back, with one that quotes the control strings."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    quoting = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat.digests(chat.format_chats(rows.union(quoting)))


# An escaped text has one more backslash for each control string; a turn adds its marks.
OP3_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(role) + length(text)
    + len(regexp_extract_all(text, '#{3,}|</turn>'))) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""


def op4_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and its edited text; every hundredth id is searched for."""
    found = stage(fingerprint.compare_next(documents(spark, sf)), "compared")
    asked = F.col("doc_id") % 100 == 0
    near = fingerprint.search(found.select("fp"), found.where(asked).select("fp"))
    size = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    around = near.join(size, "fp").groupBy("query").agg((F.sum("n") - 1).alias("n"))
    wide = found.join(around, F.col("fp") == F.col("query"), "left")
    return wide.select(
        "doc_id", "n_chars", "edited_sha256",
        hex_print(F.col("fp")).alias("fingerprint"),
        hex_print(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprint.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked, F.col("n")).alias("n_near"),
    )


def op5_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate group of every document, by its SimHash."""
    groups = simhash.near_groups(documents(spark, sf))
    return groups.select(
        "doc_id", hex_print(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def op6_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """License of every document; source, language and id make its path."""
    docs = documents(spark, sf)
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select("doc_id", path.alias("path"), "text")
    return licenses.scan(files).drop("text")


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = winnow.report(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        winnow.items_digest(F.col("items")).alias("items_sha256"), "contaminated",
    )


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document; labels outside the held-out fifth are learned."""
    docs = documents(spark, sf)
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = quality.classify(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the long byte strings that occur earlier."""
    kept = suffix.deduplicate(documents(spark, sf))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as tokens and back."""
    vocabulary = bpe.load(VOCABULARY)
    coded = bpe.coded(F.col("text"), vocabulary, keep_ids=False)
    found = documents(spark, sf).select("doc_id", coded.alias("coded"))
    return found.select("doc_id", "coded.*")


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What five filters remove in every order, by source."""
    failed = audit.failures(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))
    return audit.interactions(failed)


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * len(regexp_extract_all(docs.text, '[A-Z]')) > 5 * length(docs.text) AS c,
    regexp_matches(docs.text, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e
  FROM docs JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
kinds AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END
    || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END
    || CASE WHEN e THEN 'E' ELSE '' END AS fails,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), placed AS (
  SELECT part, filter_order, step, n, good, toxic, fails,
    contains(fails, filter_order[step]) AS bad,
    translate(fails, filter_order[1:step - 1], '') <> fails AS gone
  FROM kinds, steps
), counted AS (
  SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (WHERE NOT bad AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE bad AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE bad AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = filter_order[step]), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE bad AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE bad AND NOT gone), 0) AS toxic_lost
  FROM placed GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM counted
"""


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic word runs of every document; the tail of a tenth of them repeats a stretch."""
    docs = documents(spark, sf).select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    seed = F.when(h % 10 == 0, F.floor(h / 10))
    bent = periodic.repeat_tail(F.when(seed.isNotNull(), F.col("text")), seed)
    found = periodic.collapse(docs.withColumn("text", F.coalesce(bent, "text")))
    top = periodic.greatest(F.col("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[top[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        periodic.runs_digest(F.col("runs")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op13_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; languages outside the held-out fifth are learned."""
    docs = documents(spark, sf)
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_secrets,
        op3_chat_format,
        op4_fingerprints,
        op5_simhash_dedup,
        op6_licenses,
        op7_decontamination,
        op8_quality,
        op9_suffix_dedup,
        op10_bpe,
        op11_filter_audit,
        op12_periodic_runs,
        op13_language_id,
        pipeline,
    )
}
ORACLES: dict[str, str] = {"op3_chat_format": OP3_SQL, "op11_filter_audit": OP11_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
