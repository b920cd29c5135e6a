"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from textweir.session import build_session
from workload.queries import QUERIES

HEADLINE = (
    "norm_standard norm_pages_tweet stem doc_freq bow tfidf bm25_weights cooccurrence ppmi "
    "mean_embedding nearest_vectors bm25_search bm25_search_many stratified_split class_report "
    "train_bow train_tfidf train_bm25 train_embedding train_tfidf_stem nearest_words lsa_terms predict "
    "index_roundtrip search_one stream_hits stream_scores repeated_ids svd_gram score_given"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    settings = {
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("textweir-bench", cores, **settings)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the Python workers and the code paths once, outside the measurements.
    warm = str(Path(sf).parent / "sf0.001")
    for name in ("stem", "bm25_weights", "train_tfidf"):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**line, "sf": Path(sf).name}))
    spark.stop()


if __name__ == "__main__":
    main()
