"""Scoring requests as they arrive, by the same plan as in batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from seasonflow.plans import scoring


def score_batch(
    requests: DataFrame, state: scoring.ServingState, model: PipelineModel, answers: str, batch: int
) -> None:
    """Writes the scores and the rejects of one micro-batch.

    Each batch owns its folder and overwrites it, so a batch that is run again after
    a failure leaves one copy of its answers.
    """
    held = requests.persist()
    try:
        checked = scoring.validate(held, state.keys)
        scoring.rejected(checked).write.mode("overwrite").parquet(f"{answers}/rejected/batch={batch}")
        scoring.score_requests(scoring.accepted(checked), state, model).write.mode("overwrite").parquet(f"{answers}/scored/batch={batch}")
    finally:
        held.unpersist()


def score_stream(
    requests: DataFrame,
    state: scoring.ServingState,
    model: PipelineModel,
    answers: str,
    offsets: str,
    once: bool = True,
    every: str = "1 minute",
) -> StreamingQuery:
    """Starts a query over a stream of ``request_id, line, date, hour`` rows.

    ``once`` answers what has arrived and stops; otherwise a batch runs ``every`` so
    often. Offsets are kept in ``offsets``, which must be shared storage.
    """

    def each(batch_rows: DataFrame, batch: int) -> None:
        score_batch(batch_rows, state, model, answers, batch)

    writer = requests.writeStream.foreachBatch(each).option("checkpointLocation", offsets)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()
