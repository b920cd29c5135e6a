"""Online requests as streams, each micro-batch answered by the batch operators.

Requests are independent of each other, so there is no state and no watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from textweir.operators.retrieval import SearchIndex, search_many
from textweir.plans.training import SentimentModel, predict
from textweir.session import staging


def _start(
    requests: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch overwrites its own folder, so a restart gives no duplicates.
        with staging(batch.sparkSession):
            answer(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_stream(
    requests: DataFrame,
    model: SentimentModel,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer a stream ``(doc_id, text)`` with label, sentiment and probability."""
    return _start(requests, lambda batch: predict(model, batch), out, checkpoint, trigger)


def search_stream(
    requests: DataFrame,
    index: SearchIndex,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer a stream ``(query_id, query, sentiment, top_k)`` with ranked hits."""
    return _start(requests, lambda batch: search_many(index, batch), out, checkpoint, trigger)
