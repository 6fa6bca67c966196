"""Toxicity assessment of conversations as they arrive.

The streaming checkpoint takes the place of a start row: a restarted query goes on after
the last finished batch. A batch that was cut short is written again under its own number,
so no result is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from threadwarden import schemas
from threadwarden.functions.text import CONTEXT_LIMIT
from threadwarden.operators import assess


def assess_stream(
    conversations: DataFrame,
    factory: assess.ScorerFactory,
    out: str,
    checkpoint: str,
    attributes: Sequence[str] = schemas.ATTRIBUTES,
    trigger: dict | None = None,
    context_size: int | None = CONTEXT_LIMIT,
    **call_options,
) -> StreamingQuery:
    """Write ``out/scores`` and ``out/errors``, one folder per micro-batch."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        calls_path = f"{out}/calls/batch={batch_id}"
        # a model reads the beginning of a conversation, which lies in its first part
        first = batch.filter("part = 0") if "part" in batch.columns else batch
        items = assess.prepare(first, context_size=context_size)
        assess.call_scorer(items, factory, **call_options).write.mode("overwrite").parquet(calls_path)
        parsed = assess.parse_responses(batch.sparkSession.read.parquet(calls_path))
        assess.flatten_scores(parsed, attributes).write.mode("overwrite").parquet(f"{out}/scores/batch={batch_id}")
        errors = assess.error_rows(parsed).unionByName(assess.parse_error_rows(parsed))
        errors.write.mode("overwrite").parquet(f"{out}/errors/batch={batch_id}")

    writer = conversations.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
